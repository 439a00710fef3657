"""Every registered query against the same query in SQL, on the whole small tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def rows_by_name(names, rows):
    order = sorted(range(len(names)), key=lambda at: names[at])
    return sorted(repr([row[at] for at in order]) for row in rows)


SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def test_every_query_has_sql():
    own = {query.__name__ for query in registered._QUERIES}
    assert own <= set(registered.queries()) and own <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", [query.__name__ for query in registered._QUERIES])
def test_query_matches_sql(spark, sql, name):
    result = registered.queries()[name](spark, SF_DIR)
    expected = sql.sql(registered.oracle_sql()[name])
    spark_types = {field: SAME_TYPE[kind] for field, kind in result.dtypes}
    assert spark_types == {field: str(kind) for field, kind in zip(expected.columns, expected.types)}
    wanted = rows_by_name(expected.columns, expected.fetchall())
    assert rows_by_name(result.columns, result.collect()) == wanted


def test_entry(spark):
    assert registered.entry(spark).count() == 10


def test_ingest_reads_a_directory_of_files_in_bounded_batches(spark, tmp_path, monkeypatch):
    """The table as a directory of files, too large for one batch."""
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    events.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    size = max(file.stat().st_size for file in (tmp_path / "events.parquet").glob("*.parquet"))
    read = registered.read_log_table
    monkeypatch.setattr(registered, "read_log_table", lambda *a, **k: read(*a, **k, max_bytes_per_trigger=2 * size))
    summary = registered.ingest_then_audit(spark, str(tmp_path)).collect()
    assert sum(row.record_count for row in summary) == events.count()
    assert sum(row.missing_offsets + row.duplicate_offsets for row in summary) == 0
