"""What the running ingest has seen, batch by batch, and its comparison with what the commit log holds."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from offsetledger.functions.paths import decode_path, normalize_path
from offsetledger.schemas import COORDINATES
from offsetledger.sources.data_files import read_committed

COUNTS = "query_id string, batch_id long, sink string, observed long"


class ObservedCounts(StreamingQueryListener):
    """Collects the rows per sink that every finished batch of an ingest reports; a few numbers a batch.

    Add it with `spark.streams.addListener`. `flush` appends what has come in since to a table, for long runs.
    """

    def __init__(self) -> None:
        self._rows: dict[tuple[str, int, str], int] = {}
        self._lock = threading.Lock()
        self._ended: set[str] = set()
        self._news = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = progress.observedMetrics.get("ingest")
        if counts is None:
            return
        with self._lock:
            for sink, rows in counts.asDict().items():
                # A batch that is replayed reports again; its last report stands.
                if rows:
                    self._rows[str(progress.id), progress.batchId, sink] = rows

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def wait_for(self, run_id, seconds: float = 60) -> bool:
        """Reports come after their batch; those of a run are all in when its end is."""
        with self._news:
            return self._news.wait_for(lambda: str(run_id) in self._ended, seconds)

    def table(self, spark: SparkSession) -> DataFrame:
        with self._lock:
            rows = [(*key, n) for key, n in sorted(self._rows.items())]
        return spark.createDataFrame(rows, COUNTS)

    def flush(self, spark: SparkSession, path: str) -> None:
        frame = self.table(spark)
        with self._lock:
            self._rows.clear()
        frame.write.mode("append").parquet(path)


def stored_counts(spark: SparkSession, log: DataFrame) -> DataFrame:
    """Rows of the logged files per batch and sink."""
    rows = read_committed(spark, log, COORDINATES, with_file=True).groupBy("file_path").agg(F.count("*").alias("rows"))
    rows = rows.select(normalize_path(decode_path(F.col("file_path"))).alias("_key"), "rows")
    files = log.select(normalize_path(F.col("s3_key")).alias("_key"), F.col("checkpoint_id").alias("batch_id"), F.col("source").alias("sink"))
    return files.distinct().join(rows, "_key").groupBy("batch_id", "sink").agg(F.sum("rows").alias("stored"))


def reconcile(observed: DataFrame, stored: DataFrame) -> DataFrame:
    """Per batch and sink what was seen and what is stored, and the difference; zero where either knows nothing."""
    seen = observed.groupBy("batch_id", "sink").agg(F.sum("observed").alias("observed"))
    both = seen.join(stored, ["batch_id", "sink"], "full_outer")
    zero = F.lit(0).cast("long")
    both = both.withColumns({"observed": F.coalesce("observed", zero), "stored": F.coalesce("stored", zero)})
    return both.withColumn("difference", F.col("observed") - F.col("stored"))
