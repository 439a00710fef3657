from pathlib import Path

import pytest
from pyspark.sql import functions as F

from offsetledger.operators.offsets import offset_gaps, offset_summary
from offsetledger.plans.audit import audit_offsets, report_lines
from offsetledger.plans.folded import fold_hours, folded_summary, log_hour
from offsetledger.sources.commit_log import append_commit_log, batch_entries, commit_folder
from offsetledger.sources.data_files import list_files_at

DAY = {"start": "03-01-2026", "end": "03-01-2026"}
AT = 1_772_323_200_000  # 2026-03-01 00:00 UTC


@pytest.fixture
def hours(spark, tmp_path):
    """Three batches of a table, each logged in an hour of its own; some offsets are missing, some twice."""
    base, table = str(tmp_path / "log"), str(tmp_path / "output")
    rows = spark.range(600).where("id % 50 <> 7").union(spark.range(100, 110)).select(
        F.lit("t").alias("kafka_topic"), (F.col("id") % 2).cast("int").alias("kafka_partition"), F.expr("id div 2").alias("kafka_offset"),
        *[F.lit(value).alias(name) for name, value in (("year", "2026"), ("month", "03"), ("day", "01"), ("hour", "05"), ("run_id", "r"))],
        F.expr("id div 200").alias("batch_id"),
    )
    rows.write.partitionBy("year", "month", "day", "hour", "run_id", "batch_id").parquet(table)
    for batch in range(3):
        files = list_files_at(spark, [f"{table}/year=2026/month=03/day=01/hour=05/run_id=r/batch_id={batch}"])
        at = AT + 3_600_000 * batch
        append_commit_log(batch_entries(files, batch, at), commit_folder(base, "output", "r", batch, at))
    return base, table, str(tmp_path / "store")


def whole(spark, base):
    audit = audit_offsets(spark, base, **DAY)
    found = sorted(map(tuple, audit.summary.collect()))
    audit.close()
    return found


def test_log_hours_are_in_the_order_of_time(spark):
    row = spark.createDataFrame([("03-01-2026/07/15/output-batch-r-1/x.csv",)], "p string").select(log_hour(F.col("p"))).first()
    assert row[0] == "2026-03-01-07"


def test_folded_hours_equal_the_whole_audit_and_are_not_read_again(spark, hours):
    base, table, store = hours
    expected = whole(spark, base)
    assert sum(row[6] for row in expected) == 11 and sum(row[7] for row in expected) == 9
    for before in ("2026-03-01-00", "2026-03-01-01", "2026-03-01-02", "2026-03-01-02"):
        fold_hours(spark, base, store, before=before, **DAY)
        assert sorted(map(tuple, folded_summary(spark, base, store, **DAY).collect())) == expected
    assert sorted(path.name for path in Path(store, "words").glob("log_hour=*")) == ["log_hour=2026-03-01-00", "log_hour=2026-03-01-01"]
    for file in Path(table).rglob("*.parquet"):
        if "batch_id=2" not in str(file):
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
            file.write_bytes(b"not parquet")
    assert sorted(map(tuple, folded_summary(spark, base, store, **DAY).collect())) == expected


def test_a_file_logged_again_in_a_later_hour_counts_once(spark, hours):
    base, table, store = hours
    expected = whole(spark, base)
    fold_hours(spark, base, store, before="2026-03-01-01", **DAY)
    first = list_files_at(spark, [f"{table}/year=2026/month=03/day=01/hour=05/run_id=r/batch_id=0"])
    at = AT + 2 * 3_600_000
    append_commit_log(batch_entries(first, 9, at), commit_folder(base, "output", "again", 9, at))
    assert whole(spark, base) == expected
    assert sorted(map(tuple, folded_summary(spark, base, store, **DAY).collect())) == expected
    fold_hours(spark, base, store, before="2026-03-01-23", **DAY)
    assert sorted(map(tuple, folded_summary(spark, base, store, **DAY).collect())) == expected


def test_a_fold_that_failed_between_its_tables_is_replaced(spark, hours, tmp_path):
    base, _, store = hours
    fold_hours(spark, base, store, before="2026-03-01-02", **DAY)
    for path in sorted(Path(store, "files").rglob("*"), reverse=True):
        path.unlink() if path.is_file() else path.rmdir()
    Path(store, "files").rmdir()
    fold_hours(spark, base, store, before="2026-03-01-01", **DAY)
    fold_hours(spark, base, store, before="2026-03-01-02", **DAY)
    assert sorted(map(tuple, folded_summary(spark, base, store, **DAY).collect())) == whole(spark, base)


def test_report_lines(spark, hours):
    base, table, _ = hours
    audit = audit_offsets(spark, base, **DAY)
    lines = {section: [] for section in ("entries", "warnings", "summary", "verdict", "gaps")}
    for row in report_lines(audit, limit=3).orderBy("section", "line").collect():
        lines[row.section].append(row.text)
    assert lines["verdict"] == ["FAIL: 11 missing offset(s)"] and lines["warnings"] == []
    assert len(lines["summary"]) == 3 and len(lines["gaps"]) == 4
    assert len({len(text) for text in lines["summary"]}) == 1 and lines["gaps"][0].split() == audit.gaps().columns
    gaps = offset_gaps(spark.read.parquet(table)).orderBy("kafka_partition", "gap_after").limit(3).collect()
    assert [text.split() for text in lines["gaps"][1:]] == [[str(value) for value in row] for row in gaps]
    assert [text.split() for text in lines["summary"][1:]] == [
        [str(value) for value in row] for row in offset_summary(spark.read.parquet(table)).orderBy("kafka_partition").collect()
    ]
    audit.close()
