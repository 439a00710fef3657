"""The message log: read it as a stream or a batch, publish to it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from offsetledger.functions.payload import encode_payload
from offsetledger.schemas import LOG

# Messages that one batch of a topic takes, and the tasks it is read by: a first batch is no whole topic.
MAX_OFFSETS = 50_000_000
MIN_PARTITIONS = 64
# Bytes of files that one batch of a Parquet log takes.
MAX_BATCH_BYTES = 100 * 1024**3


def kafka_options(
    servers: str,
    topic: str,
    *,
    security_protocol: str = "PLAINTEXT",
    group_id: str | None = None,
    min_partitions: int | None = MIN_PARTITIONS,
    max_offsets_per_trigger: int | None = MAX_OFFSETS,
    **extra: str,
) -> dict[str, str]:
    """Options for Spark's Kafka source, from the earliest offset on.

    `min_partitions` splits large log partitions into several tasks, which is what keeps
    one hot log partition from holding up a batch.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    if security_protocol != "PLAINTEXT":
        options["kafka.security.protocol"] = security_protocol
    if group_id:
        options["kafka.group.id"] = group_id
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    options.update(extra)
    return options


def read_log(spark: SparkSession, options: dict[str, str], *, streaming: bool = True) -> DataFrame:
    """Subscribe to one topic; rows keep topic, partition and offset (schema `LOG`).

    Needs the spark-sql-kafka package on the session.
    """
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**options).load()


def read_log_table(
    spark: SparkSession,
    path: str,
    *,
    streaming: bool = True,
    schema: StructType = LOG,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int = MAX_BATCH_BYTES,
) -> DataFrame:
    """The same rows from a Parquet copy of a log, or the rows of any Parquet table.

    A stream takes so many bytes a batch, so a long backlog is no single batch. Its path
    may be a glob.
    """
    if not streaming:
        return spark.read.schema(schema).parquet(path)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        # The two limits exclude each other.
        return reader.option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)
    return reader.option("maxBytesPerTrigger", max_bytes_per_trigger).parquet(path)


def encode_messages(
    df: DataFrame, fmt: str = "json", uuid: str = "uuid", millis: str = "timestamp"
) -> DataFrame:
    """Add the log's `key` (null) and `value` columns from a uuid and an epoch-ms column."""
    return df.withColumns(
        {
            "key": F.lit(None).cast("binary"),
            "value": encode_payload(F.col(uuid), F.col(millis), fmt),
        }
    )


def publish(
    df: DataFrame,
    servers: str,
    topic: str,
    *,
    security_protocol: str = "PLAINTEXT",
    checkpoint_path: str | None = None,
    trigger: dict | None = None,
    **extra: str,
) -> StreamingQuery | None:
    """Write `key`, `value` and, if present, `partition` to a topic, at least once.

    A streaming frame returns its running query. Needs the spark-sql-kafka package.
    """
    columns = [name for name in ("key", "value", "partition") if name in df.columns]
    options = {"kafka.bootstrap.servers": servers, "topic": topic, **extra}
    if security_protocol != "PLAINTEXT":
        options["kafka.security.protocol"] = security_protocol
    rows = df.select(*columns)
    if not df.isStreaming:
        rows.write.format("kafka").options(**options).save()
        return None
    if not checkpoint_path:
        raise ValueError("a streaming publish needs checkpoint_path")
    writer = rows.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint_path)
    return writer.trigger(**(trigger or {"processingTime": "0 seconds"})).start()
