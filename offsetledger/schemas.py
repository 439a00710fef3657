"""Table schemas. Timestamps are epoch milliseconds, as they are stored."""

from pyspark.sql.types import (
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# One message as every log source delivers it (the column names of Spark's Kafka source).
LOG = StructType(
    [
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
        StructField("timestampType", IntegerType()),
    ]
)

# The message payload.
PAYLOAD = StructType(
    [
        StructField("uuid", StringType(), False),
        StructField("timestamp", LongType(), False),
    ]
)

# The payload in Avro's schema language. Field order and types are those of
# messages already in the log. Writers mark the long as timestamp-millis; the bytes are the
# same without, and the plain number is what the tables store.
PAYLOAD_AVRO = """
{
  "type": "record",
  "name": "Message",
  "fields": [
    {"name": "uuid", "type": "string"},
    {"name": "timestamp", "type": "long"}
  ]
}
"""

# A decoded message with its log coordinates; kept and dropped records share it.
ENRICHED = StructType(
    [
        StructField("uuid", StringType(), False),
        StructField("timestamp", LongType(), False),
        StructField("kafka_topic", StringType(), False),
        StructField("kafka_partition", IntegerType(), False),
        StructField("kafka_offset", LongType(), False),
        StructField("checkpoint_id", LongType(), False),
    ]
)

# A message that could not be decoded, whole, with the reason.
QUARANTINE = StructType(
    [
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("kafka_topic", StringType()),
        StructField("kafka_partition", IntegerType()),
        StructField("kafka_offset", LongType()),
        StructField("log_timestamp", TimestampType()),
        StructField("timestampType", IntegerType()),
        StructField("reason", StringType()),
        StructField("checkpoint_id", LongType()),
    ]
)

# Directory levels above the data files. Strings, so that zero padding survives.
BUCKET_COLUMNS = ("year", "month", "day", "hour")
BATCH_COLUMNS = ("run_id", "batch_id")
PARTITIONS = StructType(
    [StructField(name, StringType()) for name in BUCKET_COLUMNS]
    + [StructField("run_id", StringType()), StructField("batch_id", LongType())]
)

# One row per data file, as written to the commit log's CSV files.
COMMIT_LOG = StructType(
    [
        StructField("checkpoint_id", LongType()),
        StructField("s3_key", StringType()),
        StructField("commit_timestamp", LongType()),
    ]
)

# The commit log once read: which CSV file a row came from, the sink and the run it speaks for.
COMMIT_LOG_READ = StructType(
    COMMIT_LOG.fields
    + [StructField("log_path", StringType()), StructField("source", StringType()), StructField("run_id", StringType())]
)

# The log coordinates an audit looks at.
COORDINATES = StructType(
    [
        StructField("kafka_topic", StringType()),
        StructField("kafka_partition", IntegerType()),
        StructField("kafka_offset", LongType()),
    ]
)
