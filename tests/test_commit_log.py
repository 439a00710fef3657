from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from offsetledger.operators import selection as S
from offsetledger.plans.audit import select_log
from offsetledger.sources import commit_log as C

HEADER = "checkpoint_id,s3_key,commit_timestamp\n"


def ms(text):
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp() * 1000)


def write_entry(base, folder, name, checkpoint, key, millis):
    path = base / folder
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(f"{HEADER}{checkpoint},{key},{millis}\n")


@pytest.fixture
def base(tmp_path):
    """One row per file, as a per-file writer leaves it."""
    base = tmp_path / "wal log"
    write_entry(base, "03-03-2026/21/36", "output-subtask-0-a.csv", 5, "s3://d/output/x.parquet", ms("2026-03-03T21:36:59.999"))
    write_entry(base, "03-03-2026/21/37", "output-subtask-1-b.csv", 5, "s3://d/output/y.parquet", ms("2026-03-03T21:37:00.000"))
    write_entry(base, "03-03-2026/21/39", "dropped-subtask-0-c.csv", 6, "s3://d/dropped/z.parquet", ms("2026-03-03T21:39:59.999"))
    write_entry(base, "03-03-2026/21/40", "output-subtask-0-d.csv", 6, "s3://d/output/x.parquet", ms("2026-03-03T21:40:00.000"))
    write_entry(base, "03-04-2026/00/00", "late-subtask-0-e.csv", 15, "s3://d/late/w.parquet", ms("2026-03-04T00:00:00.000"))
    return base


def names(df):
    return sorted(row.log_path.rsplit("/", 1)[1] for row in df.collect())


def test_read_all_with_source_and_types(spark, base):
    log = C.read_commit_log(spark, str(base))
    assert log.dtypes == [
        ("checkpoint_id", "bigint"),
        ("s3_key", "string"),
        ("commit_timestamp", "bigint"),
        ("log_path", "string"),
        ("source", "string"),
        ("run_id", "string"),
    ]
    assert {(row.log_path[:16], row.source) for row in log.collect()} == {
        ("03-03-2026/21/36", "output"),
        ("03-03-2026/21/37", "output"),
        ("03-03-2026/21/39", "dropped"),
        ("03-03-2026/21/40", "output"),
        ("03-04-2026/00/00", "late"),
    }


def test_minute_range_is_inclusive_of_the_end_minute(spark, base):
    log = C.read_commit_log(spark, str(base))
    wanted = ["dropped-subtask-0-c.csv", "output-subtask-1-b.csv"]
    assert names(S.select_minutes(log, "03-03-2026 21:37", "03-03-2026 21:39")) == wanted
    through_plan = select_log(spark, str(base), start="03-03-2026 21:37", end="03-03-2026 21:39")
    assert names(through_plan) == wanted


def test_day_range(spark, base):
    log = C.read_commit_log(spark, str(base))
    assert len(names(S.select_days(log, "03-03-2026", "03-03-2026"))) == 4
    assert len(names(S.select_days(log, "03-02-2026", "03-04-2026"))) == 5
    assert len(names(select_log(spark, str(base), start="03-02-2026", end="03-04-2026", sources=None))) == 5
    # Sinks outside the audit are left out by default.
    assert len(names(select_log(spark, str(base), start="03-02-2026", end="03-04-2026"))) == 4


def test_only_named_folders_are_listed(spark, base):
    log = C.read_commit_log(spark, str(base), ["03-04-2026", "03-05-2026"])
    assert [path.rsplit("/", 1)[1] for path in log.inputFiles()] == ["late-subtask-0-e.csv"]


def test_paths(spark, base):
    log = C.read_commit_log(spark, str(base))
    assert names(S.select_paths(log, ["03-03-2026/21/37/"])) == ["output-subtask-1-b.csv"]
    assert len(names(S.select_paths(log, ["03-03-2026/21/37", "03-04-2026/00"]))) == 2
    assert names(select_log(spark, str(base), paths=["03-03-2026/21/37"])) == ["output-subtask-1-b.csv"]


def test_nothing_selected_gives_an_empty_log(spark, base, tmp_path):
    assert select_log(spark, str(base), start="01-01-2020", end="01-02-2020").count() == 0
    assert select_log(spark, str(base), start="03-04-2026", end="03-03-2026").count() == 0
    assert select_log(spark, str(tmp_path / "no such base"), paths=["03-03-2026"]).count() == 0
    with pytest.raises(ValueError):
        select_log(spark, str(base))


def test_wrong_shape_is_refused(spark, base):
    log = C.read_commit_log(spark, str(base))
    with pytest.raises(ValueError):
        S.select_days(log, "03-03-2026 21:37", "03-03-2026 21:39")
    with pytest.raises(ValueError):
        S.select_minutes(log, "03-03-2026", "03-03-2026")


def test_checkpoint_lookup_matches_the_whole_number(spark, base):
    assert S.files_of_checkpoint(C.read_commit_log(spark, str(base)), 5).count() == 2


def test_counts_tell_entries_from_files(spark, base):
    log = C.read_commit_log(spark, str(base))
    counts = {row.source: (row.entries, row.distinct_files) for row in S.entry_counts(log).collect()}
    assert counts == {"output": (3, 2), "dropped": (1, 1), "late": (1, 1)}
    assert tuple(S.audited_counts(log).first()) == (3, 1)
    assert S.distinct_keys(log).count() == 4


def test_finalized_and_stale_split_the_log(spark, base):
    log = C.read_commit_log(spark, str(base))
    files = spark.createDataFrame([("s3://d/output/x.parquet",), ("s3://d/dropped/z.parquet",)], "s3_key string")
    assert len(names(S.finalized(log, files))) == 3
    assert names(S.stale(log, files)) == ["late-subtask-0-e.csv", "output-subtask-1-b.csv"]


def test_written_entries_are_read_back_and_a_second_write_replaces_them(spark, tmp_path):
    base = str(tmp_path / "log")
    at = ms("2026-03-03T07:05:09.123")
    files = spark.createDataFrame([("file:/t/a%20b,c.parquet",), ("file:/t/d.parquet",)], "file_path string")
    folder = C.commit_folder(base, "output", "run1", 3, at)
    assert folder == f"{base}/03-03-2026/07/05/output-batch-run1-3"
    for _ in range(2):
        C.append_commit_log(C.batch_entries(files, 3, at), folder)
    log = C.read_commit_log(spark, base)
    rows = log.select("checkpoint_id", "s3_key", "commit_timestamp", "source").collect()
    assert sorted(map(tuple, rows)) == [
        (3, "file:/t/a b,c.parquet", at, "output"),
        (3, "file:/t/d.parquet", at, "output"),
    ]
    assert S.select_paths(log, ["03-03-2026/07/05"]).count() == 2


def test_classify_again_from_the_path(spark):
    log = spark.createDataFrame([("03-03-2026/00/01/dropped-subtask-0-a.csv",)], "log_path string")
    assert S.classify_source(log).select(F.col("source")).first()[0] == "dropped"
