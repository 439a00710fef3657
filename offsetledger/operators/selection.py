"""Choosing commit-log entries, and telling finalized from stale ones."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offsetledger.functions.paths import normalize_path, source_of
from offsetledger.functions.ranges import parse_paths, parse_range

AUDITED = ("output", "dropped")


def classify_source(log: DataFrame) -> DataFrame:
    """Name each entry's sink from its `log_path`."""
    return log.withColumn("source", source_of(F.col("log_path")))


def select_days(log: DataFrame, start: str, end: str) -> DataFrame:
    """Entries in the day folders `start`..`end` (`MM-DD-YYYY`, both inclusive)."""
    wanted = parse_range(start, end)
    if wanted.first_ms is not None:
        raise ValueError("select_days takes whole days; use select_minutes")
    day = F.to_date(F.substring("log_path", 1, 10), "MM-dd-yyyy")
    return log.filter(day.between(F.lit(wanted.first_day), F.lit(wanted.last_day)))


def select_minutes(log: DataFrame, start: str, end: str) -> DataFrame:
    """Entries committed from minute `start` to the end of minute `end`."""
    wanted = parse_range(start, end)
    if wanted.first_ms is None:
        raise ValueError("select_minutes takes minutes; use select_days")
    return log.filter(F.col("commit_timestamp").between(wanted.first_ms, wanted.last_ms))


def select_paths(log: DataFrame, paths: list[str]) -> DataFrame:
    """Entries whose log file lies in one of the folders `MM-DD-YYYY[/HH[/mm]]`."""
    tests = [F.col("log_path").startswith(f"{path}/") for path in parse_paths(paths)]
    return log.filter(reduce(or_, tests))


def files_of_checkpoint(log: DataFrame, checkpoint_id: int, run_id: str | None = None) -> DataFrame:
    """Entries of one checkpoint, of all runs or of one; ids start again with each run."""
    entries = log.filter(F.col("checkpoint_id") == checkpoint_id)
    return entries if run_id is None else entries.filter(F.col("run_id") == run_id)


def distinct_keys(log: DataFrame) -> DataFrame:
    """The data files the log names, each once."""
    return log.select("s3_key").distinct()


def finalized(log: DataFrame, files: DataFrame) -> DataFrame:
    """Entries whose data file exists (`files` has a normalized `s3_key`)."""
    return _matching(log, files, "left_semi")


def stale(log: DataFrame, files: DataFrame) -> DataFrame:
    """Entries whose data file does not exist: left by failed attempts, or lost since."""
    return _matching(log, files, "left_anti")


def _matching(log: DataFrame, files: DataFrame, how: str) -> DataFrame:
    keyed = log.withColumn("_key", normalize_path(F.col("s3_key")))
    existing = files.select(F.col("s3_key").alias("_key"))
    return keyed.join(existing, "_key", how).select(*log.columns)


def entry_counts(log: DataFrame) -> DataFrame:
    """Per sink: log entries, and the different files they name."""
    return log.groupBy("source").agg(
        F.count("*").alias("entries"), F.countDistinct("s3_key").alias("distinct_files")
    )


def audited_counts(log: DataFrame) -> DataFrame:
    """One row: entries of the main and of the dropped sink."""
    return log.agg(
        F.count_if(F.col("source") == "output").alias("output_entries"),
        F.count_if(F.col("source") == "dropped").alias("dropped_entries"),
    )
