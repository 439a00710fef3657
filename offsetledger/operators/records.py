"""From log messages to routed records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offsetledger.functions.payload import decode_payload, malformed_reason
from offsetledger.schemas import ENRICHED, QUARANTINE

OUTPUT, DROPPED, QUARANTINED = "output", "dropped", "quarantine"


def default_drop_predicate() -> Column:
    """Every tenth offset goes to the side table. A fixed value, kept for equal results."""
    return F.col("kafka_offset") % 10 == 0


def decode(log: DataFrame, fmt: str = "json") -> DataFrame:
    """Decode each message's payload beside its log coordinates.

    `reason` says why a message is unusable; it is null for the good ones. The log's own
    timestamp is kept as `log_timestamp`, `timestamp` is the payload's.

    The payload passes through `inline`, below which no filter is pushed: a filter on its
    fields would otherwise parse every message again for each mention.
    """
    named = log.withColumnRenamed("timestamp", "log_timestamp")
    read = named.select("*", F.inline(F.array(decode_payload(F.col("value"), fmt))))
    return read.select(
        "uuid",
        "timestamp",
        F.col("topic").alias("kafka_topic"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("long").alias("kafka_offset"),
        "key",
        "value",
        "log_timestamp",
        "timestampType",
        malformed_reason(F.col("value"), F.col("uuid"), F.col("timestamp")).alias("reason"),
    )


def split_malformed(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable, malformed) messages of a decoded log."""
    return decoded.filter(F.col("reason").isNull()), decoded.filter(F.col("reason").isNotNull())


def enrich(usable: DataFrame, checkpoint_id: int | Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """The payload with its log coordinates and the checkpoint it belongs to."""
    return _with_checkpoint(usable, checkpoint_id).select(*ENRICHED.names, *keep)


def quarantine(malformed: DataFrame, checkpoint_id: int | Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """The whole message with its log coordinates and the reason."""
    return _with_checkpoint(malformed, checkpoint_id).select(*QUARANTINE.names, *keep)


def _with_checkpoint(df: DataFrame, checkpoint_id: int | Column) -> DataFrame:
    value = checkpoint_id if isinstance(checkpoint_id, Column) else F.lit(checkpoint_id)
    return df.withColumn("checkpoint_id", value.cast("long"))


def route(records: DataFrame, drop_predicate: Column | None = None) -> DataFrame:
    """Name the sink of every record in column `sink`."""
    drop = default_drop_predicate() if drop_predicate is None else drop_predicate
    return records.withColumn("sink", F.when(drop, DROPPED).otherwise(OUTPUT))


def union_records(frames: list[DataFrame]) -> DataFrame:
    """All records of several sinks, by column name."""
    return reduce(DataFrame.unionByName, frames)
