from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from offsetledger.operators.selection import stale
from offsetledger.sources import data_files as D
from offsetledger.sources.commit_log import batch_entries


@pytest.fixture
def tables(spark, tmp_path):
    """Two bucketed tables of 24 hourly files each under a path with odd characters."""
    base = tmp_path / "a b+c"
    for sink in ("output", "dropped"):
        rows = spark.range(240).select(
            F.lit("t").alias("kafka_topic"),
            F.lit(0).alias("kafka_partition"),
            F.col("id").alias("kafka_offset"),
            F.lit("body").alias("uuid"),
            F.lit("2026").alias("year"),
            F.lit("03").alias("month"),
            F.lpad((F.col("id") % 2 + 1).cast("string"), 2, "0").alias("day"),
            F.lpad((F.floor(F.col("id") / 2) % 12).cast("string"), 2, "0").alias("hour"),
        )
        rows.coalesce(1).write.partitionBy("year", "month", "day", "hour").parquet(str(base / sink))
    return base


@pytest.fixture
def log(spark, tables):
    return batch_entries(D.list_files(spark, [str(tables / "output"), str(tables / "dropped")]), 1, 0)


def day_one(log):
    return log.filter(F.col("s3_key").contains("/day=01/"))


def test_listing_spells_paths_both_ways(spark, tables):
    rows = D.list_files_at(spark, [str(tables / "output")]).collect()
    assert len(rows) == 24
    assert all("a%20b+c" in row.file_path and row.s3_key.startswith(str(tables)) for row in rows)


def test_globs_follow_the_selected_buckets(spark, tables, log, monkeypatch):
    one_hour = log.filter(F.col("s3_key").contains("/output/") & F.col("s3_key").contains("/day=01/hour=03/"))
    (glob,) = D.data_globs(one_hour)
    assert glob.endswith("/output/{year=2026/month=03/day=01/hour=03}")
    assert len(D.data_globs(log)) == 2
    monkeypatch.setattr(D, "NAMES_PER_GLOB", 5)
    assert len(D.data_globs(log)) == 10
    assert D.read_committed(spark, log).count() == 480
    assert len(D.data_globs(log, [str(tables / "output")])) == 1


def test_exactly_the_logged_files_are_read_once(spark, tables, log):
    # Each file is logged twice and must still be read once.
    wanted = day_one(log).unionAll(day_one(log))
    rows = D.read_committed(spark, wanted)
    assert rows.columns == ["kafka_topic", "kafka_partition", "kafka_offset"]
    counts = rows.groupBy("kafka_offset").count().collect()
    assert {(row.kafka_offset, row["count"]) for row in counts} == {(n, 2) for n in range(0, 240, 2)}


def test_a_file_logged_under_two_spellings_is_read_once(spark, tables, log):
    bare = log.withColumn("s3_key", F.regexp_replace("s3_key", "^file:", ""))
    triple = log.withColumn("s3_key", F.regexp_replace("s3_key", "^file:", "file://"))
    nothing = log.limit(1).withColumn("s3_key", F.lit(None).cast("string"))
    both = bare.unionAll(log).unionAll(triple).unionAll(nothing)
    assert D.read_committed(spark, both).count() == 480
    assert len(D.data_globs(both)) == 2


def test_tables_inside_another_folder_are_read_once(spark, tables, log):
    flat = spark.range(1_000, 1_010).select(F.lit(0).alias("kafka_partition"), F.col("id").alias("kafka_offset"))
    flat.coalesce(1).write.parquet(str(tables / "flat"))
    (file,) = (tables / "flat").glob("*.parquet")
    moved = tables / "loose.parquet"
    moved.write_bytes(file.read_bytes())
    loose = spark.createDataFrame([(1, str(moved), 0)], log.schema)
    rows = D.read_committed(spark, log.unionAll(loose))
    assert rows.count() == 490


def damage(base, but):
    """Make every data file below a folder unreadable, except those whose path holds one of the given parts."""
    for file in Path(base).rglob("*.parquet"):
        if not any(part in str(file) for part in but):
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
            file.write_bytes(b"not parquet")


@pytest.fixture
def batches(spark, tmp_path):
    """A table of three runs of ten batches, each in its own directory of one hour."""
    rows = spark.range(300).select(
        F.lit("t").alias("kafka_topic"),
        F.lit(0).alias("kafka_partition"),
        F.col("id").alias("kafka_offset"),
        *[F.lit(value).alias(name) for name, value in (("year", "2026"), ("month", "03"), ("day", "01"), ("hour", "05"))],
        F.format_string("run %d:x", F.col("id") % 3).alias("run_id"),
        F.floor(F.col("id") / 30).alias("batch_id"),
    )
    path = str(tmp_path / "batches")
    rows.coalesce(1).write.partitionBy("year", "month", "day", "hour", "run_id", "batch_id").parquet(path)
    return path


def test_the_log_prunes_directories_while_the_query_runs(spark, batches):
    whole = batch_entries(D.list_files(spark, [batches]), 1, 0)
    log = whole.filter(F.col("s3_key").contains("run 1") & F.col("s3_key").contains("batch_id=4/"))
    for roots in (None, [batches]):
        rows = D.read_committed(spark, log.unionAll(log), roots=roots).select("kafka_partition", "kafka_offset")
        assert sorted(row.kafka_offset for row in rows.collect()) == list(range(121, 150, 3))
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "dynamicpruning" in plan and "ReadSchema: struct<kafka_partition:int,kafka_offset:bigint>" in plan
        assert D.read_committed(spark, whole, roots=roots).count() == 300
    # No file of another batch or run is opened.
    damage(batches, ["run 1%3Ax/batch_id=4/"])
    for roots in (None, [batches]):
        assert D.read_committed(spark, log, roots=roots).count() == 10
    with pytest.raises(Exception, match="parquet|Parquet"):
        D.read_committed(spark, whole).agg(F.sum("kafka_offset")).collect()


def test_batches_prune_where_files_are_many(spark, batches, monkeypatch):
    monkeypatch.setattr(D, "MAX_BROADCAST_FILES", 3)
    whole = batch_entries(D.list_files(spark, [batches]), 1, 0)
    log = whole.filter(F.col("s3_key").contains("batch_id=4/") | F.col("s3_key").contains("run 0"))
    assert sorted(row.kafka_offset for row in D.read_committed(spark, log).collect()) == sorted({*range(120, 150), *range(0, 300, 3)})
    few = log.filter(F.col("s3_key").contains("batch_id=4/"))
    damage(batches, ["batch_id=4/"])
    assert D.read_logged_batches(spark, few).agg(F.count("kafka_offset")).first()[0] == 30
    assert D.read_committed(spark, few).agg(F.count("kafka_offset")).first()[0] == 30


@pytest.mark.parametrize("wanted", [1, 2_001])
def test_only_wanted_files_give_rows(spark, tmp_path, wanted):
    """Hard links of one file stand for a large table; twice as many lie in the folder as are logged."""
    spark.range(1).select(F.lit(0).alias("kafka_partition"), F.col("id").alias("kafka_offset")).coalesce(1).write.parquet(str(tmp_path / "one"))
    (file,) = (tmp_path / "one").glob("*.parquet")
    folder = tmp_path / "t/year=2026/month=03/day=01/hour=00"
    folder.mkdir(parents=True)
    for number in range(2 * wanted):
        (folder / f"part-{number}.parquet").hardlink_to(file)
    names = spark.range(wanted).select(F.lit(1).alias("checkpoint_id"), F.format_string(f"{folder}/part-%d.parquet", F.col("id")).alias("s3_key"))
    assert D.read_committed(spark, names).count() == wanted
    folded = D.read_logged_batches(spark, names).groupBy("file_path").agg(F.count("*").alias("rows"))
    assert D.of_logged_files(folded, names).agg(F.sum("rows")).first()[0] == wanted


def test_a_missing_folder_does_not_hide_the_others(spark, tables, log):
    gone = spark.createDataFrame([(1, f"{tables}/gone/day-1/x.parquet", 0)], log.schema)
    assert D.read_committed(spark, log.unionAll(gone)).count() == 480
    assert D.list_files_at(spark, [f"{tables}/gone", f"{tables}/output"]).count() == 24


def test_a_folder_for_every_day_is_no_limit(spark, tmp_path):
    rows = spark.range(150).select(F.lit(0).alias("kafka_partition"), F.col("id").alias("kafka_offset"), (F.col("id")).alias("day"))
    rows.repartition(8, "day").write.partitionBy("day").parquet(str(tmp_path / "days"))
    log = batch_entries(D.list_files(spark, [str(tmp_path / "days")]), 1, 0)
    assert D.read_committed(spark, log).count() == 150


def test_lost_files_are_stale_and_not_read(spark, tables, log):
    kept = log.collect()
    logged = spark.createDataFrame(kept, log.schema)
    (lost,) = (tables / "output/year=2026/month=03/day=01/hour=00").glob("*.parquet")
    lost.unlink()
    globs = D.data_globs(logged)
    missing = stale(logged, D.list_files(spark, globs)).collect()
    assert [row.s3_key for row in missing] == [f"file:{lost}"]
    assert D.read_committed(spark, logged).count() == 470


def test_all_files_gone(spark, tables, log):
    logged = spark.createDataFrame([(1, f"{tables}/gone/year=2026/x.parquet", 0)], log.schema)
    assert D.read_committed(spark, logged).count() == 0
    assert D.read_committed(spark, logged.limit(0)).count() == 0
    assert stale(logged, D.list_files(spark, D.data_globs(logged))).count() == 1


def test_unreadable_files_fail_unless_tolerated(spark, tables, log):
    logged = spark.createDataFrame(log.collect(), log.schema)
    (damaged,) = (tables / "output/year=2026/month=03/day=01/hour=00").glob("*.parquet")
    damaged.write_bytes(b"not parquet at all")
    checksum = damaged.with_name(f".{damaged.name}.crc")
    if checksum.exists():
        checksum.unlink()
    with pytest.raises(Exception):
        D.read_committed(spark, logged).agg(F.sum("kafka_offset")).collect()
    rows = D.read_committed(spark, logged, strict=False)
    assert rows.agg(F.count("kafka_offset")).first()[0] == 470
    assert [row.s3_key for row in D.unread_entries(spark, logged).collect()] == [f"file:{damaged}"]


def test_readable_files_are_not_reported(spark, log):
    assert D.unread_entries(spark, log).count() == 0
    assert D.unread_entries(spark, log.limit(0)).count() == 0


def test_rows_with_their_file(spark, log):
    rows = D.read_committed(spark, day_one(log), with_file=True)
    assert rows.columns[-1] == "file_path"
    assert rows.select("file_path").distinct().count() == 24


def test_whole_table_keeps_its_zero_padding(spark, tables):
    row = D.read_table(spark, str(tables / "output")).select("year", "month", "day").first()
    assert (row.year, row.month) == ("2026", "03") and row.day in ("01", "02")


def test_other_errors_are_not_swallowed(spark):
    def load(path):
        raise AnalysisException("boom")

    with pytest.raises(AnalysisException):
        D.existing(load, "x")
