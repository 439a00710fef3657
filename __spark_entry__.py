"""The registered queries, each with the SQL that must give the same rows.

`events` serves as the message log: its ids go round ten log partitions. `lineitem` and
`orders` serve as sequences with many keys, gaps and duplicates.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offsetledger.functions.paths import decode_path, dir_name, normalize_path, sink_prefix
from offsetledger.functions.timecols import bucket_columns, epoch_millis, hour_start
from offsetledger.operators.offsets import (
    first_gaps,
    offset_gaps,
    offset_summary,
    offset_totals,
    offset_verdict,
)
from offsetledger.operators.records import decode, enrich, quarantine, route, split_malformed, union_records
from offsetledger.operators.round_robin import assign_round_robin, round_robin_batches
from offsetledger.operators.selection import (
    audited_counts,
    classify_source,
    distinct_keys,
    entry_counts,
    files_of_checkpoint,
    finalized,
    select_days,
    select_minutes,
    select_paths,
    stale,
)
from offsetledger.plans.audit import Audit, audit_offsets, report_lines
from offsetledger.plans.folded import fold_hours, folded_summary
from offsetledger.plans.views import coordinates_view, hourly_commit_log, log_view
from offsetledger.schemas import ENRICHED, PARTITIONS
from offsetledger.session import work_dir
from offsetledger.sources.commit_log import append_commit_log, batch_entries, commit_folder, read_commit_log
from offsetledger.sources.data_files import list_files_at, read_committed
from offsetledger.sources.log import read_log_table
from offsetledger.streaming.ingest import IngestPaths, run_ingest
from offsetledger.streaming.observed import ObservedCounts, reconcile, stored_counts

SMOKE_DIR = "/root/testdata/sf0.001"
TOPIC_KEYS = ("kafka_topic", "kafka_partition")
SUPPLIER = ("l_suppkey",)
CUSTOMER = ("o_custkey",)


# --- inputs -------------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_view(_table(spark, sf_dir, "events"), "events", "event_id", "ts")


def _damaged_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with the messages of four event types damaged, each in its own way."""
    log = log_view(_table(spark, sf_dir, "events"), "events", "event_id", "ts", keep=("event_type",))
    text = F.col("value").cast("string")
    millis = F.get_json_object(text, "$.timestamp")
    uuid = F.get_json_object(text, "$.uuid")
    damaged = (
        F.when(F.col("event_type") == "error", F.substring(text, 1, 20))
        .when(F.col("event_type") == "signup", F.lit(None).cast("string"))
        .when(F.col("event_type") == "click", F.concat(F.lit('{"timestamp":'), millis, F.lit("}")))
        .when(F.col("event_type") == "purchase", F.concat(F.lit('{"uuid":"'), uuid, F.lit('"}')))
        .otherwise(text)
    )
    return log.withColumn("value", damaged.cast("binary")).drop("event_type")


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched and routed; the checkpoint is the day's number."""
    usable, _ = split_malformed(decode(_log(spark, sf_dir)))
    return route(enrich(usable, F.expr("timestamp div 86400000")))


def _coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routed log coordinates with the event's time, without the payload's way through JSON."""
    events = _table(spark, sf_dir, "events")
    kept = (epoch_millis(events, "ts").alias("timestamp"), F.col("event_type"))
    return route(coordinates_view(events, "event_id", F.lit("events"), keep=kept))


def _sink(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("sink") == name)


def _hourly_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_source(hourly_commit_log(_coordinates(spark, sf_dir)))


def _repeated_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly log with the files of hours that saw an error logged a second time."""
    records = _coordinates(spark, sf_dir)
    again = records.filter(F.col("event_type") == "error")
    return classify_source(hourly_commit_log(records).unionByName(hourly_commit_log(again)))


def _purchase_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As existing files: those of hours whose records of that sink hold a purchase."""
    purchases = _coordinates(spark, sf_dir).filter(F.col("event_type") == "purchase")
    return distinct_keys(hourly_commit_log(purchases))


# --- records ------------------------------------------------------------------------


def log_records(spark, sf_dir):
    millis = F.unix_millis("timestamp").alias("log_ms")
    text = F.col("value").cast("string").alias("value")
    return _log(spark, sf_dir).select("topic", "partition", "offset", millis, text)


def enrich_events(spark, sf_dir):
    return _records(spark, sf_dir).drop("sink")


def decode_props(spark, sf_dir):
    props = F.from_json("props", "k BIGINT")
    return _table(spark, sf_dir, "events").select("event_id", props["k"].alias("k"))


def malformed_split(spark, sf_dir):
    reason = F.coalesce("reason", F.lit("usable")).alias("reason")
    return decode(_damaged_log(spark, sf_dir)).groupBy(reason).agg(F.count("*").alias("messages"))


def malformed_quarantine(spark, sf_dir):
    _, malformed = split_malformed(decode(_damaged_log(spark, sf_dir)))
    text = F.col("value").cast("string").alias("value")
    return quarantine(malformed, 7).select(
        "kafka_topic", "kafka_partition", "kafka_offset", "reason", text, "checkpoint_id"
    )


def route_output(spark, sf_dir):
    return _sink(_records(spark, sf_dir), "output").drop("sink")


def route_dropped(spark, sf_dir):
    return _sink(_records(spark, sf_dir), "dropped").drop("sink")


def route_counts(spark, sf_dir):
    return _coordinates(spark, sf_dir).groupBy("sink").agg(F.count("*").alias("records"))


def sink_prefixes(spark, sf_dir):
    """Event types as sink names; views go to the nameless main sink."""
    name = F.when(F.col("event_type") == "view", "").otherwise(F.concat(F.lit("-"), F.initcap("event_type")))
    named = _table(spark, sf_dir, "events").select(sink_prefix(name).alias("prefix"))
    return named.groupBy("prefix").agg(F.count("*").alias("records"))


def bucket_counts(spark, sf_dir):
    hour = hour_start(F.col("timestamp")).alias("start")
    hourly = _coordinates(spark, sf_dir).groupBy("sink", hour).agg(F.count("*").alias("records"))
    return hourly.withColumns(bucket_columns(F.col("start"))).drop("start")


def round_robin(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select("event_id")
    return assign_round_robin(events, 10, order_by="event_id")


def round_robin_orders(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_orderkey")
    return assign_round_robin(orders, 7, order_by="o_orderkey")


def round_robin_unordered(spark, sf_dir):
    """Each task goes round with its own rows: sizes differ by at most one for each task."""
    rows = _table(spark, sf_dir, "lineitem").select("l_orderkey").withColumn("task", F.spark_partition_id())
    sizes = assign_round_robin(rows, 10).groupBy("partition").agg(F.count("*").alias("n"), F.collect_set("task").alias("tasks"))
    tasks = F.size(F.array_distinct(F.flatten(F.collect_list("tasks"))))
    even = (F.max("n") - F.min("n") <= tasks).alias("even")
    return sizes.agg(F.sum("n").alias("assigned"), F.count("*").alias("partitions"), even)


# --- commit log ---------------------------------------------------------------------


def commit_log_entries(spark, sf_dir):
    return _hourly_log(spark, sf_dir)


def commit_log_by_checkpoint(spark, sf_dir):
    return files_of_checkpoint(_hourly_log(spark, sf_dir), 19_732)


def commit_log_day_range(spark, sf_dir):
    return select_days(_hourly_log(spark, sf_dir), "01-05-2024", "01-20-2024")


def commit_log_minute_range(spark, sf_dir):
    return select_minutes(_hourly_log(spark, sf_dir), "01-03-2024 21:37", "01-17-2024 04:39")


def commit_log_paths(spark, sf_dir):
    return select_paths(_hourly_log(spark, sf_dir), ["01-02-2024/", "01-04-2024/15", "01-09-2024/23/59"])


def commit_log_keys(spark, sf_dir):
    return distinct_keys(_repeated_log(spark, sf_dir))


def log_entry_counts(spark, sf_dir):
    return entry_counts(_repeated_log(spark, sf_dir))


def log_audited_counts(spark, sf_dir):
    return audited_counts(_repeated_log(spark, sf_dir))


def finalized_entries(spark, sf_dir):
    return finalized(_hourly_log(spark, sf_dir), _purchase_files(spark, sf_dir))


def stale_entries(spark, sf_dir):
    return stale(_hourly_log(spark, sf_dir), _purchase_files(spark, sf_dir))


# --- audit --------------------------------------------------------------------------


def offset_summary_all(spark, sf_dir):
    """Both sinks together."""
    return offset_summary(_coordinates(spark, sf_dir))


def offset_summary_redelivered(spark, sf_dir):
    """The dropped records arrive a second time."""
    records = _coordinates(spark, sf_dir)
    return offset_summary(union_records([records, _sink(records, "dropped")]))


def offset_summary_output(spark, sf_dir):
    return offset_summary(_sink(_coordinates(spark, sf_dir), "output"))


def offset_summary_topics(spark, sf_dir):
    """Event types as topics that share partition numbers and offsets."""
    records = coordinates_view(_table(spark, sf_dir, "events"), "event_id", F.col("event_type"))
    return offset_summary(records, TOPIC_KEYS)


def offset_totals_output(spark, sf_dir):
    return offset_totals(offset_summary_output(spark, sf_dir))


def offset_verdicts(spark, sf_dir):
    """One verdict per case: clean, gaps, duplicates only, both, nothing selected."""
    records = _coordinates(spark, sf_dir)
    cases = {
        "all": records,
        "output": _sink(records, "output"),
        "redelivered": union_records([records, _sink(records, "dropped")]),
        "redelivered output": union_records([_sink(records, "output")] * 2),
        "nothing": records.filter(F.col("kafka_topic") == "no such topic"),
    }
    verdicts = [
        offset_verdict(offset_summary(rows)).select(F.lit(case).alias("case_name"), "*") for case, rows in cases.items()
    ]
    return reduce(DataFrame.unionByName, verdicts)


def offset_gaps_output(spark, sf_dir):
    return offset_gaps(_sink(_coordinates(spark, sf_dir), "output"))


def offset_gaps_top50(spark, sf_dir):
    return offset_gaps(_sink(_coordinates(spark, sf_dir), "output"), limit=50)


def offset_gaps_topics(spark, sf_dir):
    records = coordinates_view(_table(spark, sf_dir, "events"), "event_id", F.col("event_type"))
    return offset_gaps(records, TOPIC_KEYS)


def supplier_order_audit(spark, sf_dir):
    return offset_summary(_table(spark, sf_dir, "lineitem"), SUPPLIER, "l_orderkey")


def supplier_order_gaps(spark, sf_dir):
    return offset_gaps(_table(spark, sf_dir, "lineitem"), SUPPLIER, "l_orderkey")


def supplier_order_top50(spark, sf_dir):
    return first_gaps(supplier_order_gaps(spark, sf_dir), SUPPLIER)


def supplier_order_verdict(spark, sf_dir):
    return offset_verdict(supplier_order_audit(spark, sf_dir))


def customer_order_audit(spark, sf_dir):
    return offset_summary(_table(spark, sf_dir, "orders"), CUSTOMER, "o_orderkey")


def customer_order_gaps(spark, sf_dir):
    return offset_gaps(_table(spark, sf_dir, "orders"), CUSTOMER, "o_orderkey")


# --- streaming ----------------------------------------------------------------------


def _ingest(spark: SparkSession, sf_dir: str, bucket_by: str) -> IngestPaths:
    """Stream the whole events table into a new folder until nothing is left to read."""
    base = work_dir(spark, "ingest")
    paths = IngestPaths(f"{base}/output", f"{base}/dropped", f"{base}/commit-log", f"{base}/quarantine")
    schema = _table(spark, sf_dir, "events").schema
    # The glob admits a single file as well as a directory of files.
    events = read_log_table(spark, f"{sf_dir}/events.parquet*", schema=schema)
    query = run_ingest(
        log_view(events, "events", "event_id", "ts"),
        paths,
        f"{base}/checkpoint",
        bucket_by=bucket_by,
        trigger={"availableNow": True},
    )
    query.awaitTermination()
    return paths


def ingest_then_audit(spark, sf_dir):
    """Log → tables and commit log → the logged files → offset summary."""
    paths = _ingest(spark, sf_dir, "processing")
    log = read_commit_log(spark, paths.commit_log)
    return offset_summary(read_committed(spark, log))


def ingest_records(spark, sf_dir):
    """Every record as stored, read back through the commit log."""
    paths = _ingest(spark, sf_dir, "processing")
    records = read_committed(spark, read_commit_log(spark, paths.commit_log), ENRICHED)
    return records.select("uuid", "timestamp", "kafka_topic", "kafka_partition", "kafka_offset")


def ingest_buckets(spark, sf_dir):
    """Rows per directory of the tables an event-time ingest wrote."""
    paths = _ingest(spark, sf_dir, "event")
    tables = []
    for sink, path in (("output", paths.output), ("dropped", paths.dropped)):
        table = spark.read.schema(PARTITIONS).parquet(path)
        tables.append(table.select(F.lit(sink).alias("sink"), "year", "month", "day", "hour"))
    return union_records(tables).groupBy("sink", "year", "month", "day", "hour").agg(F.count("*").alias("records"))


THIRDS = 3
FIRST_HOUR_MS = 1_704_067_200_000  # 2024-01-01 00:00 UTC


def _third(spark: SparkSession, sf_dir: str, third: int, damaged: bool = False) -> DataFrame:
    """A third of the events as log messages; damaged, those of type `error` are cut off."""
    keep = ("event_id", "event_type")
    log = log_view(_table(spark, sf_dir, "events"), "events", "event_id", "ts", keep=keep).where(F.col("event_id") % THIRDS == third)
    if damaged:
        cut = F.substring(F.col("value").cast("string"), 1, 20).cast("binary")
        log = log.withColumn("value", F.when(F.col("event_type") == "error", cut).otherwise(F.col("value")))
    return log.drop(*keep)


def _paths(base: str) -> IngestPaths:
    return IngestPaths(f"{base}/output", f"{base}/dropped", f"{base}/commit-log", f"{base}/quarantine")


def _committed(spark: SparkSession, sf_dir: str, damaged: tuple[int, ...] = (), started=lambda query: None) -> IngestPaths:
    """An ingest of the whole events table in three batches, a third of the ids each: the stream is started anew on
    its checkpoint whenever a third has been added to the log."""
    base = work_dir(spark, "committed")
    paths = _paths(base)
    for third in range(THIRDS):
        _third(spark, sf_dir, third, third in damaged).write.parquet(f"{base}/log/part={third}")
        stream = read_log_table(spark, f"{base}/log/part=*")
        query = run_ingest(stream, paths, f"{base}/checkpoint", trigger={"availableNow": True})
        query.awaitTermination()
        started(query)
    return paths


def _days() -> dict[str, str]:
    now = datetime.now(timezone.utc)
    return {"start": f"{now - timedelta(1):%m-%d-%Y}", "end": f"{now + timedelta(1):%m-%d-%Y}"}


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _log_attempt(spark: SparkSession, paths: IngestPaths, files: list[str], batch_id: int) -> None:
    """Commit-log entries such as a failed attempt leaves them."""
    now = int(datetime.now(timezone.utc).timestamp() * 1000)
    names = spark.createDataFrame([(file,) for file in files], "file_path string")
    append_commit_log(batch_entries(names, batch_id, now), commit_folder(paths.commit_log, "output", "failed", batch_id, now))


def _committed_audit(spark: SparkSession, sf_dir: str, **options) -> Audit:
    return audit_offsets(spark, _committed(spark, sf_dir).commit_log, **_days(), **options)


def committed_log_entries(spark, sf_dir):
    """The commit log after three batches: rows of the logged files per sink and checkpoint."""
    log = read_commit_log(spark, _committed(spark, sf_dir).commit_log)
    rows = read_committed(spark, log, ENRICHED, with_file=True)
    file = normalize_path(decode_path(F.col("file_path"))).alias("file")
    stored = rows.select(file, "kafka_offset").groupBy("file").agg(F.count("*").alias("rows"))
    entries = log.select(normalize_path(F.col("s3_key")).alias("file"), "source", "checkpoint_id")
    return entries.join(stored, "file").groupBy("source", "checkpoint_id").agg(F.sum("rows").alias("rows"))


def committed_checkpoints(spark, sf_dir):
    """Every record carries the checkpoint under which its file is logged."""
    log = read_commit_log(spark, _committed(spark, sf_dir).commit_log)
    rows = read_committed(spark, log, ENRICHED, with_file=True)
    rows = rows.select(normalize_path(decode_path(F.col("file_path"))).alias("file"), "checkpoint_id")
    logged = log.select(normalize_path(F.col("s3_key")).alias("file"), F.col("checkpoint_id").alias("logged_id"))
    same = F.count_if(F.col("checkpoint_id") == F.col("logged_id"))
    return rows.join(logged, "file").agg(F.count("*").alias("records"), same.alias("same_checkpoint"))


def committed_audit(spark, sf_dir):
    """Summary of an audit of the real commit log over whole days."""
    return _committed_audit(spark, sf_dir).summary


def committed_gaps_output(spark, sf_dir):
    """Gaps when only the main sink's files are audited."""
    return _committed_audit(spark, sf_dir, sources=("output",)).gaps()


def committed_verdicts(spark, sf_dir):
    """Verdicts on the real commit log: both sinks, the main one alone, and with every file lost."""
    paths = _committed(spark, sf_dir)
    log = read_commit_log(spark, paths.commit_log)
    lost = log.withColumn("s3_key", F.concat("s3_key", F.lit(".lost")))
    cases = {"both": log, "output": log.filter("source = 'output'"), "lost": lost}
    verdicts = [
        offset_verdict(offset_summary(read_committed(spark, entries)), entries).select(
            F.lit(case).alias("case_name"), "status", "total_missing", "total_duplicates", "exit_code"
        )
        for case, entries in cases.items()
    ]
    return reduce(DataFrame.unionAll, verdicts)


def committed_pruned(spark, sf_dir):
    """The records of one checkpoint: of the tables only its batch's directories are opened."""
    paths = _committed(spark, sf_dir)
    log = files_of_checkpoint(read_commit_log(spark, paths.commit_log), 1)
    return read_committed(spark, log, ENRICHED, roots=[paths.output, paths.dropped])


def committed_stale(spark, sf_dir):
    """Entries per sink and checkpoint, and whether their files are gone, after one sink has lost those of a batch."""
    paths = _committed(spark, sf_dir)
    log = read_commit_log(spark, paths.commit_log)
    lost = log.where("source = 'dropped' and checkpoint_id = 1").select(dir_name(F.col("s3_key")).alias("folder")).distinct()
    for row in lost.collect():  # a batch has one directory an hour
        _delete(spark, row.folder)
    files = list_files_at(spark, [paths.output, paths.dropped])
    known = finalized(log, files).withColumn("stale", F.lit(False))
    gone = stale(log, files).withColumn("stale", F.lit(True))
    return known.unionByName(gone).select("source", "checkpoint_id", "stale").distinct()


def committed_unread(spark, sf_dir):
    """A tolerant audit in which a failed attempt has left a broken, an empty and a lost file: one scan of the data."""
    paths = _committed(spark, sf_dir)
    folder = f"{paths.output}/year=2024/month=01/day=01/hour=00/run_id=failed/batch_id=7"
    spark.createDataFrame([], ENRICHED).coalesce(1).write.parquet(folder)
    spark.createDataFrame([("not parquet",)], "value string").coalesce(1).write.mode("append").text(folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in files.globStatus(path(f"{folder}/*.txt")):
        files.rename(status.getPath(), path(f"{folder}/part-broken.parquet"))
    names = [row.file_path for row in list_files_at(spark, [folder]).collect()]
    _log_attempt(spark, paths, [*names, f"{folder}/part-lost.parquet"], 7)
    audit = audit_offsets(spark, paths.commit_log, **_days(), strict=False)
    counts = {
        "entries without rows": audit.unread.agg(F.count("*").alias("n")),
        "entries without file": audit.stale.agg(F.count("*").alias("n")),
        "rows": audit.summary.agg(F.sum("record_count").alias("n")),
        "missing offsets": audit.summary.agg(F.sum("missing_offsets").alias("n")),
    }
    return reduce(DataFrame.unionAll, [frame.select(F.lit(name).alias("counted"), "n") for name, frame in counts.items()])


def audit_report(spark, sf_dir):
    """The report's lines of an audit of the main sink alone, which misses every tenth offset."""
    lines = report_lines(_committed_audit(spark, sf_dir, sources=("output",)))
    return lines.where(F.col("section").isin("summary", "verdict", "gaps"))


def folded_audit(spark, sf_dir):
    """Each batch in a log hour of its own, two hours folded one by one, the third read: the whole audit's summary."""
    base = work_dir(spark, "folded")
    log = read_commit_log(spark, _committed(spark, sf_dir).commit_log).persist()
    for third in range(THIRDS):
        at = FIRST_HOUR_MS + 3_600_000 * third
        for source in ("output", "dropped"):
            entries = log.where((F.col("checkpoint_id") == third) & (F.col("source") == source))
            entries = entries.select("checkpoint_id", "s3_key", F.lit(at).alias("commit_timestamp"))
            append_commit_log(entries, commit_folder(f"{base}/log", source, "run", third, at))
    log.unpersist()
    day = {"start": "01-01-2024", "end": "01-01-2024"}
    for before in ("2024-01-01-01", "2024-01-01-02"):
        fold_hours(spark, f"{base}/log", f"{base}/store", before=before, **day)
    return folded_summary(spark, f"{base}/log", f"{base}/store", **day)


def ingest_reconciled(spark, sf_dir):
    """Rows that each batch reported per sink beside those stored, one batch having damaged messages."""
    seen = ObservedCounts()
    spark.streams.addListener(seen)
    try:
        paths = _committed(spark, sf_dir, damaged=(1,), started=lambda query: seen.wait_for(query.runId))
    finally:
        spark.streams.removeListener(seen)
    log = read_commit_log(spark, paths.commit_log)
    return reconcile(seen.table(spark), stored_counts(spark, log))


def _suspended(spark: SparkSession, sf_dir: str) -> IngestPaths:
    """An ingest that is stopped after its first batch, finds the entry of a failed attempt, and goes on."""
    base = work_dir(spark, "suspended")
    paths = _paths(base)
    for third in range(THIRDS):
        _third(spark, sf_dir, third).write.parquet(f"{base}/log/part={third}")
        if third == 1:
            continue  # suspended: the log grows while nothing reads it
        stream = read_log_table(spark, f"{base}/log/part=*")
        query = run_ingest(stream, paths, f"{base}/checkpoint", trigger={"processingTime": "0 seconds"})
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        if third == 0:
            folder = f"{paths.output}/year=2024/month=01/day=01/hour=00/run_id=failed/batch_id=1"
            _log_attempt(spark, paths, [f"{folder}/part-0.parquet"], 1)
    return paths


def suspended_audit(spark, sf_dir):
    """The summary after a suspension equals that of an ingest without one."""
    return audit_offsets(spark, _suspended(spark, sf_dir).commit_log, **_days()).summary


def suspended_stale(spark, sf_dir):
    """Of all entries after a suspension only the failed attempt's is stale, beside the rows that are stored."""
    audit = audit_offsets(spark, _suspended(spark, sf_dir).commit_log, **_days())
    stored = audit.summary.select(F.lit("stored").alias("what"), F.lit(None).cast("long").alias("checkpoint_id"), "record_count")
    stored = stored.groupBy("what", "checkpoint_id").agg(F.sum("record_count").alias("n"))
    return stored.unionAll(audit.stale.groupBy(F.lit("stale"), "checkpoint_id").agg(F.count("*")))


def round_robin_ties(spark, sf_dir):
    """In the order of a column with many equal values."""
    return assign_round_robin(_table(spark, sf_dir, "lineitem").select("l_suppkey"), 10, order_by="l_suppkey")


def round_robin_stream(spark, sf_dir):
    """Rows per partition of a stream of several batches, one of which fails after its sink and is replayed."""
    base = work_dir(spark, "round-robin")
    failed: list[int] = []

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}")
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("the batch is not committed")

    def run() -> None:
        stream = read_log_table(spark, f"{base}/log/part=*").select(F.col("partition").alias("own"), "offset")
        writer = stream.writeStream.foreachBatch(round_robin_batches(sink, 10, f"{base}/starts"))
        writer.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()

    for third in range(THIRDS):
        _third(spark, sf_dir, third).write.parquet(f"{base}/log/part={third}")
        tried = len(failed)
        try:
            run()
        except StreamingQueryException:
            if len(failed) == tried:
                raise
            run()
    return spark.read.parquet(f"{base}/out").groupBy("partition").agg(F.count("*").alias("rows"))


def entry(spark: SparkSession) -> DataFrame:
    """Offset audit of the whole log: both sinks together miss nothing."""
    return offset_summary_all(spark, SMOKE_DIR)


_QUERIES = [
    log_records,
    enrich_events,
    decode_props,
    malformed_split,
    malformed_quarantine,
    route_output,
    route_dropped,
    route_counts,
    sink_prefixes,
    bucket_counts,
    round_robin,
    round_robin_orders,
    round_robin_unordered,
    commit_log_entries,
    commit_log_by_checkpoint,
    commit_log_day_range,
    commit_log_minute_range,
    commit_log_paths,
    commit_log_keys,
    log_entry_counts,
    log_audited_counts,
    finalized_entries,
    stale_entries,
    offset_summary_all,
    offset_summary_redelivered,
    offset_summary_output,
    offset_summary_topics,
    offset_totals_output,
    offset_verdicts,
    offset_gaps_output,
    offset_gaps_top50,
    offset_gaps_topics,
    supplier_order_audit,
    supplier_order_gaps,
    supplier_order_top50,
    supplier_order_verdict,
    customer_order_audit,
    customer_order_gaps,
    ingest_then_audit,
    ingest_records,
    ingest_buckets,
    committed_log_entries,
    committed_checkpoints,
    committed_audit,
    committed_gaps_output,
    committed_verdicts,
    committed_pruned,
    committed_stale,
    committed_unread,
    audit_report,
    folded_audit,
    ingest_reconciled,
    suspended_audit,
    suspended_stale,
    round_robin_ties,
    round_robin_stream,
]


def _optional() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the subpackage `llm` and its pipeline; none where these folders are absent."""
    try:
        import corpus_pipeline
        import offsetledger.llm.queries as llm
    except ModuleNotFoundError as error:
        if error.name == "corpus_pipeline" or (error.name or "").startswith("offsetledger.llm"):
            return {}, {}
        raise
    sql = dict(llm.ORACLE_SQL)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return llm.QUERIES | {"pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in _QUERIES} | _optional()[0]


# --- the same in SQL ----------------------------------------------------------------

_UUID = (
    "concat_ws('-', substr(md5(CAST(event_id AS VARCHAR)), 1, 8), substr(md5(CAST(event_id AS VARCHAR)), 9, 4), "
    "substr(md5(CAST(event_id AS VARCHAR)), 13, 4), substr(md5(CAST(event_id AS VARCHAR)), 17, 4), "
    "substr(md5(CAST(event_id AS VARCHAR)), 21, 12))"
)
_PAYLOAD = f"""'{{"uuid":"' || {_UUID} || '","timestamp":' || (epoch_us(ts) // 1000) || '}}'"""
_RECORDS = f"""
records AS (
    SELECT {_UUID} AS uuid, (epoch_us(ts) // 1000) AS timestamp, 'events' AS kafka_topic,
           CAST(event_id % 10 AS INTEGER) AS kafka_partition, event_id // 10 AS kafka_offset,
           (epoch_us(ts) // 1000) // 86400000 AS checkpoint_id, event_type, ts,
           CASE WHEN (event_id // 10) % 10 = 0 THEN 'dropped' ELSE 'output' END AS sink
    FROM events
)"""
_ENRICHED = "uuid, timestamp, kafka_topic, kafka_partition, kafka_offset, checkpoint_id"


def _commit_log_sql(where: str = "TRUE", name: str = "hourly") -> str:
    return f"""
{name} AS (
    SELECT commit_timestamp // 86400000 AS checkpoint_id,
           's3://data/' || sink || '/' || bucket || '/part-0.parquet' AS s3_key,
           commit_timestamp,
           strftime(make_timestamp(commit_timestamp * 1000), '%m-%d-%Y/%H/%M/') || sink || '-subtask-0-0.csv' AS log_path,
           sink AS source
    FROM (
        SELECT sink, strftime(ts, 'year=%Y/month=%m/day=%d/hour=%H') AS bucket, max(timestamp) AS commit_timestamp
        FROM records WHERE {where} GROUP BY sink, bucket
    )
)"""


_HOURLY = f"WITH {_RECORDS}, {_commit_log_sql()}"
_REPEATED = (
    f"WITH {_RECORDS}, {_commit_log_sql(name='once')}, {_commit_log_sql("event_type = 'error'", 'again')}, "
    "repeated AS (SELECT * FROM once UNION ALL SELECT * FROM again)"
)
_PURCHASES = f"WITH {_RECORDS}, {_commit_log_sql()}, {_commit_log_sql("event_type = 'purchase'", 'existing')}"


def _summary_sql(rows: str, keys: str, offset: str) -> str:
    return f"""
SELECT {keys}, min({offset}) AS min_offset, max({offset}) AS max_offset, count(*) AS record_count,
       count(DISTINCT {offset}) AS distinct_offsets, max({offset}) - min({offset}) + 1 AS expected_count,
       max({offset}) - min({offset}) + 1 - count(DISTINCT {offset}) AS missing_offsets,
       count(*) - count(DISTINCT {offset}) AS duplicate_offsets
FROM {rows} GROUP BY {keys}"""


def _gaps_sql(rows: str, keys: str, offset: str) -> str:
    return f"""
SELECT {keys}, {offset} AS gap_after, next_offset AS resumes_at, next_offset - {offset} - 1 AS missing_count
FROM (
    SELECT {keys}, {offset}, lead({offset}) OVER (PARTITION BY {keys} ORDER BY {offset}) AS next_offset
    FROM (SELECT DISTINCT {keys}, {offset} FROM {rows})
)
WHERE next_offset - {offset} > 1"""


def _verdict_sql(case: str, rows: str, keys: str, offset: str) -> str:
    named = f"'{case}' AS case_name, " if case else ""
    return f"""
SELECT {named}
       CASE WHEN entries = 0 THEN 'ERROR' WHEN missing > 0 THEN 'FAIL' WHEN duplicates > 0 THEN 'WARN' ELSE 'PASS' END AS status,
       missing AS total_missing, duplicates AS total_duplicates, entries,
       CASE WHEN entries = 0 OR missing > 0 THEN 1 ELSE 0 END AS exit_code
FROM (
    SELECT CAST(coalesce(sum(missing_offsets), 0) AS BIGINT) AS missing,
           CAST(coalesce(sum(duplicate_offsets), 0) AS BIGINT) AS duplicates, count(*) AS entries
    FROM ({_summary_sql(rows, keys, offset)})
)"""


_COORDINATES = ("kafka_partition", "kafka_offset")
_TOPICS = """(
    SELECT event_type AS kafka_topic, CAST(event_id % 10 AS INTEGER) AS kafka_partition, event_id // 10 AS kafka_offset
    FROM events
)"""
_OUTPUT = "(SELECT * FROM records WHERE sink = 'output')"
_VERDICT_CASES = {
    "all": "records",
    "output": _OUTPUT,
    "redelivered": "(SELECT * FROM records UNION ALL SELECT * FROM records WHERE sink = 'dropped')",
    "redelivered output": f"(SELECT * FROM {_OUTPUT} UNION ALL SELECT * FROM {_OUTPUT})",
    "nothing": "(SELECT * FROM records WHERE kafka_topic = 'no such topic')",
}
_DAMAGED = f"""
damaged AS (
    SELECT 'events' AS kafka_topic, CAST(event_id % 10 AS INTEGER) AS kafka_partition, event_id // 10 AS kafka_offset,
           CASE event_type WHEN 'error' THEN 'undecodable' WHEN 'signup' THEN 'null value'
                WHEN 'click' THEN 'no uuid' WHEN 'purchase' THEN 'no timestamp' ELSE 'usable' END AS reason,
           CASE event_type WHEN 'error' THEN substr({_PAYLOAD}, 1, 20) WHEN 'signup' THEN NULL
                WHEN 'click' THEN '{{"timestamp":' || (epoch_us(ts) // 1000) || '}}'
                WHEN 'purchase' THEN '{{"uuid":"' || {_UUID} || '"}}' ELSE {_PAYLOAD} END AS value
    FROM events
)"""
_BUCKETS = f"""
WITH {_RECORDS}
SELECT sink, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
       strftime(ts, '%H') AS hour, count(*) AS records
FROM records GROUP BY ALL"""


def _lines_sql(section: str, rows: str, columns: tuple[str, ...], order: str) -> str:
    """Rows as right-aligned text below a header."""
    widths = ", ".join(f"greatest(max(length(CAST({c} AS VARCHAR))), {len(c)}) AS w_{c}" for c in columns)
    padded = " || '  ' || ".join(f"lpad(CAST({c} AS VARCHAR), CAST(w_{c} AS INTEGER), ' ')" for c in columns)
    header = " || '  ' || ".join(f"lpad('{c}', CAST(w_{c} AS INTEGER), ' ')" for c in columns)
    return f"""
SELECT '{section}' AS section, 1 + row_number() OVER (ORDER BY {order}) AS line, {padded} AS text
FROM ({rows}), (SELECT {widths} FROM ({rows}))
UNION ALL SELECT '{section}', 1, {header} FROM (SELECT {widths} FROM ({rows}))"""


def _report_sql() -> str:
    columns = ("kafka_partition", "min_offset", "max_offset", "record_count", "distinct_offsets", "expected_count")
    columns = (*columns, "missing_offsets", "duplicate_offsets")
    gap_columns = ("kafka_partition", "gap_after", "resumes_at", "missing_count")
    return f"""WITH {_RECORDS}, summary AS ({_summary_sql(_OUTPUT, *_COORDINATES)}),
all_gaps AS ({_gaps_sql(_OUTPUT, *_COORDINATES)}), gaps AS (SELECT * FROM all_gaps ORDER BY kafka_partition, gap_after LIMIT 50)
{_lines_sql("summary", "SELECT * FROM summary", columns, "kafka_partition")}
UNION ALL {_lines_sql("gaps", "SELECT * FROM gaps", gap_columns, "kafka_partition, gap_after")}
UNION ALL SELECT 'verdict', 1, 'FAIL: ' || CAST(sum(missing_offsets) AS VARCHAR) || ' missing offset(s)' FROM summary"""


def oracle_sql() -> dict[str, str]:
    audit_all = f"WITH {_RECORDS} {_summary_sql('records', *_COORDINATES)}"
    output_summary = _summary_sql(_OUTPUT, *_COORDINATES)
    supplier = ("lineitem", "l_suppkey", "l_orderkey")
    customer = ("orders", "o_custkey", "o_orderkey")
    cases = " UNION ALL ".join(_verdict_sql(case, rows, *_COORDINATES) for case, rows in _VERDICT_CASES.items())
    return {
        "log_records": f"""SELECT 'events' AS topic, CAST(event_id % 10 AS INTEGER) AS partition,
            event_id // 10 AS "offset", (epoch_us(ts) // 1000) AS log_ms, {_PAYLOAD} AS value FROM events""",
        "enrich_events": f"WITH {_RECORDS} SELECT {_ENRICHED} FROM records",
        "decode_props": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
        "malformed_split": f"WITH {_DAMAGED} SELECT reason, count(*) AS messages FROM damaged GROUP BY reason",
        "malformed_quarantine": f"""WITH {_DAMAGED} SELECT kafka_topic, kafka_partition, kafka_offset, reason, value,
            CAST(7 AS BIGINT) AS checkpoint_id FROM damaged WHERE reason <> 'usable'""",
        "route_output": f"WITH {_RECORDS} SELECT {_ENRICHED} FROM records WHERE sink = 'output'",
        "route_dropped": f"WITH {_RECORDS} SELECT {_ENRICHED} FROM records WHERE sink = 'dropped'",
        "route_counts": f"WITH {_RECORDS} SELECT sink, count(*) AS records FROM records GROUP BY sink",
        "sink_prefixes": """SELECT CASE WHEN event_type = 'view' THEN 'output' ELSE event_type END AS prefix,
            count(*) AS records FROM events GROUP BY prefix""",
        "bucket_counts": _BUCKETS,
        "round_robin": """SELECT event_id,
            CAST((row_number() OVER (ORDER BY event_id) - 1) % 10 AS INTEGER) AS partition FROM events""",
        "round_robin_orders": """SELECT o_orderkey,
            CAST((row_number() OVER (ORDER BY o_orderkey) - 1) % 7 AS INTEGER) AS partition FROM orders""",
        "round_robin_unordered": """SELECT count(*) AS assigned, least(count(*), CAST(10 AS BIGINT)) AS partitions, true AS even
            FROM lineitem""",
        "commit_log_entries": f"{_HOURLY} SELECT * FROM hourly",
        "commit_log_by_checkpoint": f"{_HOURLY} SELECT * FROM hourly WHERE checkpoint_id = 19732",
        "commit_log_day_range": f"""{_HOURLY} SELECT * FROM hourly
            WHERE CAST(make_timestamp(commit_timestamp * 1000) AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",
        "commit_log_minute_range": f"""{_HOURLY} SELECT * FROM hourly
            WHERE make_timestamp(commit_timestamp * 1000) >= TIMESTAMP '2024-01-03 21:37:00'
              AND make_timestamp(commit_timestamp * 1000) < TIMESTAMP '2024-01-17 04:40:00'""",
        "commit_log_paths": f"""{_HOURLY} SELECT * FROM hourly WHERE log_path LIKE '01-02-2024/%'
            OR log_path LIKE '01-04-2024/15/%' OR log_path LIKE '01-09-2024/23/59/%'""",
        "commit_log_keys": f"{_REPEATED} SELECT DISTINCT s3_key FROM repeated",
        "log_entry_counts": f"""{_REPEATED} SELECT source, count(*) AS entries,
            count(DISTINCT s3_key) AS distinct_files FROM repeated GROUP BY source""",
        "log_audited_counts": f"""{_REPEATED} SELECT count(*) FILTER (WHERE source = 'output') AS output_entries,
            count(*) FILTER (WHERE source = 'dropped') AS dropped_entries FROM repeated""",
        "finalized_entries": f"""{_PURCHASES} SELECT * FROM hourly
            WHERE s3_key IN (SELECT s3_key FROM existing)""",
        "stale_entries": f"""{_PURCHASES} SELECT * FROM hourly
            WHERE s3_key NOT IN (SELECT s3_key FROM existing)""",
        "offset_summary_all": audit_all,
        "offset_summary_redelivered": f"""WITH {_RECORDS}
            {_summary_sql(_VERDICT_CASES["redelivered"], *_COORDINATES)}""",
        "offset_summary_output": f"WITH {_RECORDS} {output_summary}",
        "offset_summary_topics": _summary_sql(_TOPICS, "kafka_topic, kafka_partition", "kafka_offset"),
        "offset_totals_output": f"""WITH {_RECORDS}
            SELECT CAST(coalesce(sum(missing_offsets), 0) AS BIGINT) AS total_missing,
                   CAST(coalesce(sum(duplicate_offsets), 0) AS BIGINT) AS total_duplicates FROM ({output_summary})""",
        "offset_verdicts": f"WITH {_RECORDS} {cases}",
        "offset_gaps_output": f"WITH {_RECORDS} {_gaps_sql(_OUTPUT, *_COORDINATES)}",
        "offset_gaps_top50": f"""WITH {_RECORDS} {_gaps_sql(_OUTPUT, *_COORDINATES)}
            ORDER BY kafka_partition, gap_after LIMIT 50""",
        "offset_gaps_topics": _gaps_sql(_TOPICS, "kafka_topic, kafka_partition", "kafka_offset"),
        "supplier_order_audit": _summary_sql(*supplier),
        "supplier_order_gaps": _gaps_sql(*supplier),
        "supplier_order_top50": f"{_gaps_sql(*supplier)} ORDER BY l_suppkey, gap_after LIMIT 50",
        "supplier_order_verdict": _verdict_sql("", *supplier),
        "customer_order_audit": _summary_sql(*customer),
        "customer_order_gaps": _gaps_sql(*customer),
        "ingest_then_audit": audit_all,
        "ingest_records": f"""WITH {_RECORDS}
            SELECT uuid, timestamp, kafka_topic, kafka_partition, kafka_offset FROM records""",
        "ingest_buckets": _BUCKETS,
        "committed_log_entries": """SELECT CASE WHEN (event_id // 10) % 10 = 0 THEN 'dropped' ELSE 'output' END AS source,
            event_id % 3 AS checkpoint_id, count(*) AS rows FROM events GROUP BY ALL""",
        "committed_checkpoints": "SELECT count(*) AS records, count(*) AS same_checkpoint FROM events",
        "committed_audit": audit_all,
        "committed_gaps_output": f"WITH {_RECORDS} {_gaps_sql(_OUTPUT, *_COORDINATES)}",
        "committed_verdicts": f"""WITH {_RECORDS} SELECT CASE case_name WHEN 'all' THEN 'both' WHEN 'nothing' THEN 'lost'
                ELSE case_name END AS case_name, status, total_missing, total_duplicates, exit_code
            FROM ({cases}) WHERE case_name IN ('all', 'output', 'nothing')""",
        "committed_pruned": f"""WITH {_RECORDS} SELECT uuid, timestamp, kafka_topic, kafka_partition, kafka_offset,
            CAST(1 AS BIGINT) AS checkpoint_id FROM records WHERE (kafka_offset * 10 + kafka_partition) % 3 = 1""",
        "committed_stale": """SELECT DISTINCT CASE WHEN (event_id // 10) % 10 = 0 THEN 'dropped' ELSE 'output' END AS source,
            event_id % 3 AS checkpoint_id, event_id % 3 = 1 AND (event_id // 10) % 10 = 0 AS stale FROM events""",
        "committed_unread": """SELECT 'rows' AS counted, count(*) AS n FROM events UNION ALL
            SELECT * FROM (VALUES ('entries without rows', CAST(2 AS BIGINT)), ('entries without file', 1), ('missing offsets', 0))""",
        "audit_report": _report_sql(),
        "folded_audit": audit_all,
        "ingest_reconciled": """SELECT event_id % 3 AS batch_id, CASE WHEN event_type = 'error' AND event_id % 3 = 1 THEN 'quarantine'
                WHEN (event_id // 10) % 10 = 0 THEN 'dropped' ELSE 'output' END AS sink, count(*) AS observed, count(*) AS stored,
            CAST(0 AS BIGINT) AS difference FROM events GROUP BY ALL""",
        "suspended_audit": audit_all,
        "suspended_stale": """SELECT 'stored' AS what, CAST(NULL AS BIGINT) AS checkpoint_id, count(*) AS n FROM events
            UNION ALL SELECT 'stale', 1, 1""",
        "round_robin_ties": """SELECT l_suppkey,
            CAST((row_number() OVER (ORDER BY l_suppkey) - 1) % 10 AS INTEGER) AS partition FROM lineitem""",
        "round_robin_stream": """SELECT partition, count(*) AS rows FROM (
            SELECT CAST((row_number() OVER (ORDER BY event_id) - 1) % 10 AS INTEGER) AS partition FROM events) GROUP BY partition""",
} | _optional()[1]
