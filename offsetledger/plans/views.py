"""Views of an ordinary table as a message log and as a commit log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offsetledger.functions.payload import encode_payload
from offsetledger.functions.timecols import bucket_path, epoch_millis, hour_start, log_folder


def stable_uuid(identity: Column) -> Column:
    """A UUID-shaped name derived from a value, the same on every run."""
    digest = F.md5(identity.cast("string"))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in cuts])


def log_view(
    df: DataFrame,
    topic: str,
    identity: str,
    time: str,
    partitions: int = 10,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """A table with a dense id as a log of JSON messages (schema `LOG`, then `keep`).

    Ids go round the partitions, so each partition's offsets are dense too.
    """
    millis = epoch_millis(df, time)
    number = F.col(identity)
    return df.select(
        F.lit(None).cast("binary").alias("key"),
        encode_payload(stable_uuid(number), millis).alias("value"),
        F.lit(topic).alias("topic"),
        (number % partitions).cast("int").alias("partition"),
        F.expr(f"{identity} div {partitions}").alias("offset"),
        F.timestamp_millis(millis).alias("timestamp"),
        F.lit(0).alias("timestampType"),
        *keep,
    )


def coordinates_view(
    df: DataFrame, identity: str, topic: Column, partitions: int = 10, keep: tuple[Column, ...] = ()
) -> DataFrame:
    """Only the log coordinates of `log_view`, then `keep`."""
    return df.select(
        topic.alias("kafka_topic"),
        (F.col(identity) % partitions).cast("int").alias("kafka_partition"),
        F.expr(f"{identity} div {partitions}").alias("kafka_offset"),
        *keep,
    )


def hourly_commit_log(records: DataFrame, source: str = "sink", millis: str = "timestamp") -> DataFrame:
    """The commit log an hourly writer of `records` would leave: one file per sink and hour.

    The checkpoint is the day's number since 1970, the commit time the hour's last record.
    """
    # Grouped by number; the names are made from the few hours, not from every record.
    hourly = records.groupBy(F.col(source).alias("_sink"), hour_start(F.col(millis)).alias("_hour"))
    last = hourly.agg(F.max(millis).alias("commit_timestamp"))
    folder = F.concat_ws("/", F.lit("s3://data"), F.col("_sink"), bucket_path(F.col("_hour")))
    file = F.concat(folder, F.lit("/part-0.parquet"))
    written = F.concat(log_folder(F.col("commit_timestamp")), F.lit("/"), F.col("_sink"), F.lit("-subtask-0-0.csv"))
    return last.select(
        F.expr("commit_timestamp div 86400000").alias("checkpoint_id"),
        file.alias("s3_key"),
        "commit_timestamp",
        written.alias("log_path"),
    )
