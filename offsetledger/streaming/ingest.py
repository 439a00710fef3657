"""Streaming ingest of a message log.

Every micro-batch writes its records once per sink into directories that only it owns
(`…/run_id=<query>/batch_id=<n>`), then logs the files it wrote. A replayed batch replaces
exactly its own files and log entries.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from offsetledger.functions.paths import decode_path, one_of, partition_value
from offsetledger.functions.timecols import bucket_columns
from offsetledger.operators.records import (
    DROPPED,
    OUTPUT,
    QUARANTINED,
    decode,
    enrich,
    quarantine,
    route,
)
from offsetledger.schemas import BATCH_COLUMNS, BUCKET_COLUMNS
from offsetledger.sources.commit_log import append_commit_log, batch_entries, commit_folder
from offsetledger.sources.data_files import NAMES_PER_GLOB, list_files

SINKS = (OUTPUT, DROPPED, QUARANTINED)
PARTITION_COLUMNS = (*BUCKET_COLUMNS, *BATCH_COLUMNS)
# Rows that one file of an event-time bucket is meant to hold at most.
ROWS_PER_FILE = 5_000_000
# The last millisecond of the year 9999.
LAST_BUCKET_MS = 253_402_300_799_999


@dataclass(frozen=True)
class IngestPaths:
    """Where an ingest writes. Malformed messages go beside `output` unless `quarantine` says where."""

    output: str
    dropped: str
    commit_log: str
    quarantine: str | None = None

    def tables(self) -> dict[str, str]:
        quarantine = self.quarantine or f"{self.output.rstrip('/')}-quarantine"
        return {OUTPUT: self.output, DROPPED: self.dropped, QUARANTINED: quarantine}


def prepare(
    log: DataFrame,
    *,
    fmt: str = "json",
    drop_predicate: Column | None = None,
    bucket_by: str = "processing",
) -> DataFrame:
    """Decode, route and bucket the log: all that can be said before the batch is known.

    The clock is read here, in the streaming plan, where it is the micro-batch's own time
    and stays the same when the batch is replayed.
    """
    if bucket_by not in ("processing", "event"):
        raise ValueError(f"bucket_by={bucket_by!r}: use 'processing' or 'event'")
    routed = route(decode(log, fmt), drop_predicate)
    malformed = F.col("reason").isNotNull()
    sink = F.when(malformed, QUARANTINED).otherwise(F.col("sink"))
    # Only quarantined rows need their raw bytes; the others would carry them through the cache.
    raw = {name: F.when(malformed, F.col(name)) for name in ("key", "value")}
    committed = F.unix_millis(F.current_timestamp())
    stamped = routed.withColumns({"sink": sink, "committed_ms": committed, **raw})
    clock = F.col("committed_ms")
    if bucket_by == "event":
        # Times no directory can be named after fall back to the batch's clock.
        clock = F.when(F.col("timestamp").between(0, LAST_BUCKET_MS), F.col("timestamp")).otherwise(clock)
    return stamped.withColumns(bucket_columns(clock))


def write_bucketed(df: DataFrame, path: str) -> None:
    """Add a batch below its bucket and batch directories, which hold nothing before."""
    df.write.mode("append").partitionBy(*PARTITION_COLUMNS).parquet(path)


def batch_folders(buckets: list[str], run_id: str, batch_id: int) -> list[str]:
    """The directories below a table that one batch owns."""
    leaf = f"run_id={partition_value(run_id)}/batch_id={batch_id}"
    return [f"{bucket}/{leaf}" for bucket in buckets]


def _clear(spark: SparkSession, path: str, folders: list[str]) -> None:
    """Delete what an earlier attempt at a batch left in its own directories."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    files = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf)
    for folder in folders:
        files.delete(jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{folder}"), True)


def _written_files(spark: SparkSession, path: str, folders: list[str], rows: int) -> tuple[DataFrame, int]:
    """A batch's files and their number, after checking that every directory is there and that they hold all rows."""
    globs = [one_of(path, folders[at : at + NAMES_PER_GLOB]) for at in range(0, len(folders), NAMES_PER_GLOB)]
    files = list_files(spark, globs, recursive=False)
    depth = len(PARTITION_COLUMNS)
    # A row for each directory of the batch, of which there is one an hour.
    below = F.slice(F.split(decode_path(F.col("file_path")), "/"), -1 - depth, depth)
    found = files.groupBy(F.array_join(below, "/").alias("folder")).agg(F.count("*").alias("files")).collect()
    lost = set(folders) - {row.folder for row in found}
    if lost:
        raise RuntimeError(f"no data file below {path}/{min(lost)}: the batch must not be logged as complete")
    number = sum(row.files for row in found)
    # Only the files' footers are read.
    stored = spark.read.option("basePath", path.rstrip("/")).parquet(*globs).count()
    if stored != rows:
        raise RuntimeError(f"{number} files of a batch hold {stored} rows instead of {rows}")
    return files, number


def process_batch(
    batch: DataFrame, batch_id: int, paths: IngestPaths, run_id: str, bucket_by: str = "processing"
) -> None:
    """Write one prepared batch and log its files.

    Order: files, then log. A crash in between is healed by the replay, which sees the same
    rows and so clears the same directories; what a failed attempt leaves in the log shows
    up as stale entries. A sink whose files do not hold its rows fails the batch.
    """
    spark = batch.sparkSession
    batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # A row for each sink and hour of the batch.
        counted = batch.groupBy("sink", *BUCKET_COLUMNS).agg(
            F.min("committed_ms").alias("committed_ms"), F.count("*").alias("rows")
        )
        found = counted.collect()
        for sink, path in paths.tables().items():
            mine = [row for row in found if row.sink == sink]
            if not mine:
                continue
            names = ["/".join(f"{name}={row[name]}" for name in BUCKET_COLUMNS) for row in mine]
            folders = batch_folders(names, run_id, batch_id)
            _clear(spark, path, folders)
            table = _sink_table(batch, sink, run_id, batch_id)
            buckets = counted.filter(F.col("sink") == sink).drop("sink", "committed_ms")
            write_bucketed(_gathered(table, sink, bucket_by, buckets, [row.rows for row in mine]), path)
            files, number = _written_files(spark, path, folders, sum(row.rows for row in mine))
            commit_ms = found[0].committed_ms
            folder = commit_folder(paths.commit_log, sink, run_id, batch_id, commit_ms)
            append_commit_log(batch_entries(files, batch_id, commit_ms), folder, 1 + number // 100_000)
    finally:
        batch.unpersist()


def _sink_table(batch: DataFrame, sink: str, run_id: str, batch_id: int) -> DataFrame:
    rows = batch.filter(F.col("sink") == sink)
    shape = quarantine if sink == QUARANTINED else enrich
    table = shape(rows, batch_id, BUCKET_COLUMNS)
    return table.withColumns({"run_id": F.lit(run_id), "batch_id": F.lit(batch_id).cast("long")})


def _gathered(table: DataFrame, sink: str, bucket_by: str, buckets: DataFrame, rows: list[int]) -> DataFrame:
    """Bring rows that share a directory together, where that saves files.

    By processing time a batch has one bucket: its main rows stay where they were read,
    the thin side tables are gathered. By event time each bucket becomes one file, or as many as its measured
    rows are worth, and buckets are dealt over the tasks, which write one file after the other.
    """
    if bucket_by != "event":
        return table if sink == OUTPUT else table.hint("rebalance")
    tasks = max(table.sparkSession.sparkContext.defaultParallelism, sum(rows) // ROWS_PER_FILE)
    files = sum(-(-n // ROWS_PER_FILE) for n in rows)
    if files > len(rows):
        # Hot buckets: a row for each bucket of the batch says into how many parts.
        parts = buckets.select(*BUCKET_COLUMNS, F.ceil(F.col("rows") / ROWS_PER_FILE).alias("_parts"))
        place = F.pmod(F.xxhash64("kafka_partition", "kafka_offset"), F.col("_parts")).alias("_part")
        table = table.join(F.broadcast(parts), list(BUCKET_COLUMNS)).select(*table.columns, place)
        return table.repartition(min(tasks, files), *BUCKET_COLUMNS, "_part").drop("_part")
    return table.repartition(min(tasks, files), *BUCKET_COLUMNS)


def run_ingest(
    log: DataFrame,
    paths: IngestPaths,
    checkpoint_path: str,
    *,
    fmt: str = "json",
    drop_predicate: Column | None = None,
    bucket_by: str = "processing",
    trigger: dict | None = None,
    run_id: str | None = None,
) -> StreamingQuery:
    """Start the ingest; exactly once per offset as long as `checkpoint_path` is kept.

    `trigger` defaults to one batch a minute. A batch's run id ends with the query's id,
    which lives in the checkpoint: a restart keeps it, a new checkpoint gets its own, so batch
    numbers that start again never touch earlier files. `run_id` is put before it.
    """
    prepared = prepare(log, fmt=fmt, drop_predicate=drop_predicate, bucket_by=bucket_by)
    counts = [F.count_if(F.col("sink") == sink).alias(sink) for sink in SINKS]
    observed = prepared.observe("ingest", *counts)

    def each(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        run = f"{run_id}-{own}" if run_id else own
        process_batch(batch, batch_id, paths, run, bucket_by)

    writer = observed.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_path)
    return writer.trigger(**(trigger or {"processingTime": "60 seconds"})).start()
