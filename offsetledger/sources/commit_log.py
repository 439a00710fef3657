"""The commit log: CSV files naming the data files of every checkpoint."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offsetledger.functions.paths import below_base, decode_path, glob_escape, one_of, partition_value, run_of, source_of
from offsetledger.schemas import COMMIT_LOG, COMMIT_LOG_READ


def read_commit_log(spark: SparkSession, base: str, folders: list[str] | None = None) -> DataFrame:
    """All entries below `base`, or only those in the given `MM-DD-YYYY[/HH[/mm]]` folders.

    Naming folders keeps the listing to them. Folders that do not exist are skipped; none
    existing gives an empty frame.
    """
    if folders is not None and not folders:
        return spark.createDataFrame([], COMMIT_LOG_READ)
    path = glob_escape(base) if folders is None else one_of(base, folders)
    reader = spark.read.schema(COMMIT_LOG).option("header", True)
    reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    try:
        entries = reader.csv(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMIT_LOG_READ)
    log_path = below_base(decode_path(F.col("_metadata.file_path")))
    entries = entries.select("*", log_path.alias("log_path"))
    return entries.withColumns({"source": source_of(F.col("log_path")), "run_id": run_of(F.col("log_path"))})


def batch_entries(files: DataFrame, batch_id: int, commit_ms: int) -> DataFrame:
    """Commit-log rows for the files one batch wrote (a frame with their `file_path`)."""
    return files.select(
        F.lit(batch_id).cast("long").alias("checkpoint_id"),
        decode_path(F.col("file_path")).alias("s3_key"),
        F.lit(commit_ms).cast("long").alias("commit_timestamp"),
    )


def commit_folder(base: str, prefix: str, run_id: str, batch_id: int, commit_ms: int) -> str:
    """Folder of one sink's entries for one batch; the same again when a batch is replayed."""
    at = datetime.fromtimestamp(commit_ms // 1000, timezone.utc)
    run = partition_value(run_id)
    return f"{base.rstrip('/')}/{at:%m-%d-%Y/%H/%M}/{prefix}-batch-{run}-{batch_id}"


def append_commit_log(entries: DataFrame, folder: str, files: int = 1) -> None:
    """Write one sink's entries of one batch, replacing an earlier attempt's."""
    entries.repartition(files).write.mode("overwrite").option("header", True).csv(folder)
