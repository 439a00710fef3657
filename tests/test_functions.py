from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from offsetledger.functions import paths, payload, timecols
from offsetledger.functions.ranges import parse_paths, parse_range

MOMENTS = [
    datetime(2026, 3, 3, 0, 0, 0),
    datetime(2026, 12, 31, 23, 59, 59, 999000),
    datetime(2024, 2, 29, 7, 5, 0),
    datetime(1969, 12, 31, 23, 59, 59, 999000),
    datetime(1970, 1, 1),
]


def millis(moment):
    return int(moment.replace(tzinfo=timezone.utc).timestamp() * 1000)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Pacific/Apia"])
def test_time_columns_are_utc_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(millis(moment),) for moment in MOMENTS], "ms long")
        rows = df.select("ms", timecols.bucket_path(F.col("ms")), timecols.log_folder(F.col("ms"))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    for moment, row in zip(MOMENTS, rows):
        assert row[1] == f"{moment:year=%Y/month=%m/day=%d/hour=%H}"
        assert row[2] == f"{moment:%m-%d-%Y/%H/%M}"


def test_epoch_millis_of_each_column_type(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2024-01-01 00:00:07.179999' AS plain, timestamp'2024-01-01 00:00:07.179999Z' AS zoned, 5L AS ms"
    )
    row = df.select(*[timecols.epoch_millis(df, name) for name in ("plain", "zoned", "ms")]).first()
    assert tuple(row) == (1704067207179, 1704067207179, 5)


def one(spark, column, *values):
    df = spark.createDataFrame([(value,) for value in values], "v string")
    return [row[0] for row in df.select(column(F.col("v"))).collect()]


def test_normalize_path(spark):
    assert one(spark, paths.normalize_path, "file:///a/b", "file:/a/b", "/a/b", "s3a://x/y", "s3n://x/y", "s3://x/y") == [
        "/a/b",
        "/a/b",
        "/a/b",
        "s3://x/y",
        "s3://x/y",
        "s3://x/y",
    ]


def test_decode_path_keeps_plus_signs(spark):
    assert one(spark, paths.decode_path, "file:/a%20b/c+d%25e") == ["file:/a b/c+d%e"]


def test_source_of_log_files(spark):
    named = {
        "03-03-2026/00/01/output-subtask-0-1f.csv": "output",
        "03-03-2026/00/01/dropped-subtask-12-1f.csv": "dropped",
        "03-03-2026/00/01/output-batch-ab12-7/part-00000-x.csv": "output",
        "03-03-2026/00/01/late-data-subtask-1-1f.csv": "late-data",
        "03-03-2026/00/01/output-1.csv": "output",
        "03-03-2026/00/01/other.csv": "other.csv",
    }
    assert one(spark, paths.source_of, *named) == list(named.values())


def test_below_base_takes_the_last_date_folder(spark):
    assert one(spark, paths.below_base, "s3://b/01-01-2020/wal/03-03-2026/00/01/x.csv") == ["03-03-2026/00/01/x.csv"]


def test_sink_prefix(spark):
    assert one(spark, paths.sink_prefix, "", "-Dropped", "Late") == ["output", "dropped", "late"]


def test_table_root_and_bucket_prefix(spark):
    key = "s3://b/t/year=2026/month=03/day=03/hour=04/part-0.parquet"
    assert one(spark, paths.table_root, key, "s3://b/flat/part-0.parquet") == ["s3://b/t", "s3://b/flat"]
    assert one(spark, lambda k: paths.bucket_prefix(k, ("year", "month")), key) == ["year=2026/month=03"]


def test_day_range():
    wanted = parse_range("02-28-2024", "03-01-2024")
    assert wanted.days == ["02-28-2024", "02-29-2024", "03-01-2024"]
    assert (wanted.first_day, wanted.last_day, wanted.first_ms) == (date(2024, 2, 28), date(2024, 3, 1), None)


def test_minute_range_covers_the_whole_last_minute():
    wanted = parse_range("03-03-2026 21:37", "03-03-2026 21:39")
    assert wanted.first_ms == millis(datetime(2026, 3, 3, 21, 37))
    assert wanted.last_ms == millis(datetime(2026, 3, 3, 21, 40)) - 1
    assert wanted.days == ["03-03-2026"]


@pytest.mark.parametrize(
    "start,end", [("03-03-2026 21:37", "03-03-2026"), ("03-03-2026", "03-03-2026 21:37"), ("2026-03-03", "2026-03-04")]
)
def test_unclear_ranges_are_refused(start, end):
    with pytest.raises(ValueError):
        parse_range(start, end)


def test_backward_range_is_empty():
    assert parse_range("03-04-2026", "03-03-2026").days == []


def test_paths_are_checked():
    assert parse_paths(["03-06-2026/15/40/", "03-06-2026"]) == ["03-06-2026/15/40", "03-06-2026"]
    for wrong in ([], ["../x"], ["03-06-2026/*"]):
        with pytest.raises(ValueError):
            parse_paths(wrong)


def test_payload_round_trip(spark):
    df = spark.createDataFrame([("u", 5)], "uuid string, ms long")
    value = payload.encode_payload(F.col("uuid"), F.col("ms"))
    decoded = df.select(value.alias("value")).select("value", payload.decode_payload(F.col("value")).alias("p"))
    row = decoded.select(F.col("value").cast("string"), "p.*").first()
    assert tuple(row) == ('{"uuid":"u","timestamp":5}', "u", 5)


def test_unknown_payload_format_is_refused():
    with pytest.raises(ValueError):
        payload.decode_payload(F.lit(None), "xml")
    with pytest.raises(ValueError):
        payload.encode_payload(F.lit(None), F.lit(None), "xml")
