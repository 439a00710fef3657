"""Partial audits kept by hour of the commit log, so that a long audit reads only what is new.

Offset words of closed hours are stored once, below `words/log_hour=`, and the files they came from below
`files/log_hour=`, which is written last: an hour is folded when it is there. Words of any hours merge by `bit_or`
and sum. A file that is logged again in a later hour is not folded again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offsetledger.functions.paths import decode_path, normalize_path
from offsetledger.operators.offsets import DEFAULT_KEYS, merge_words, summarize_words
from offsetledger.plans.audit import select_log, words_by_file
from offsetledger.sources.data_files import existing


def log_hour(log_path: Column) -> Column:
    """`YYYY-MM-DD-HH` of a commit-log path that begins with `MM-DD-YYYY/HH`: in the order of time."""
    cuts = ((7, 4), (1, 2), (4, 2), (12, 2))
    return F.concat_ws("-", *[F.substring(log_path, start, length) for start, length in cuts])


def _hours(log: DataFrame) -> DataFrame:
    """The files of a log, each once, with the first hour that names it."""
    key = normalize_path(F.col("s3_key")).alias("s3_key")
    return log.groupBy(key).agg(F.min(log_hour(F.col("log_path"))).alias("log_hour"))


def _stored(spark: SparkSession, store: str, table: str) -> DataFrame | None:
    return existing(spark.read.parquet, f"{store.rstrip('/')}/{table}")


def _not_folded(files: DataFrame, done: DataFrame | None) -> DataFrame:
    """Files of hours that are not folded yet, without those that a folded hour has."""
    if done is None:
        return files
    hours = done.select("log_hour").distinct()
    return files.join(F.broadcast(hours), "log_hour", "left_anti").join(done.select("s3_key"), "s3_key", "left_anti")


def _words_of(spark: SparkSession, log: DataFrame, files: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Words of some of a log's files, with the hour of each."""
    keyed = log.withColumn("_key", normalize_path(F.col("s3_key")))
    wanted = keyed.join(files.select(F.col("s3_key").alias("_key")), "_key", "left_semi").select(*log.columns)
    words = words_by_file(spark, wanted, keys)
    named = words.withColumn("s3_key", normalize_path(decode_path(F.col("file_path"))))
    return named.join(files, "s3_key").drop("s3_key", "file_path")


def fold_hours(
    spark: SparkSession, base: str, store: str, *, start: str, end: str, before: str, keys: tuple[str, ...] = DEFAULT_KEYS
) -> None:
    """Fold the hours of the days `start`..`end` (`MM-DD-YYYY`) that lie before hour `before` (`YYYY-MM-DD-HH`).

    Hours that are stored already cost nothing. Give an hour that no writer adds to any more. A fold that fails
    leaves its hours open, and the next one replaces what it wrote of them.
    """
    log = select_log(spark, base, start=start, end=end)
    done = _stored(spark, store, "files")
    files = _not_folded(_hours(log.filter(log_hour(F.col("log_path")) < before)), done).persist()
    try:
        if files.isEmpty():
            return
        words = merge_words(_words_of(spark, log, files, keys), ("log_hour", *keys))
        for name, frame in (("words", words), ("files", files)):
            writer = frame.repartition("log_hour").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("log_hour").parquet(f"{store.rstrip('/')}/{name}")
    finally:
        files.unpersist()


def folded_words(
    spark: SparkSession, base: str, store: str, *, start: str, end: str, keys: tuple[str, ...] = DEFAULT_KEYS
) -> DataFrame:
    """Offset words of the days `start`..`end`: stored ones, and those of hours that are not folded yet.

    Of the data only files of the latter are read.
    """
    log = select_log(spark, base, start=start, end=end)
    files, done = _hours(log), _stored(spark, store, "files")
    words = _words_of(spark, log, _not_folded(files, done), keys).drop("log_hour")
    if done is not None:
        hours = log.select(log_hour(F.col("log_path")).alias("log_hour")).distinct()
        stored = _stored(spark, store, "words").withColumn("log_hour", F.col("log_hour").cast("string"))
        words = words.unionByName(stored.join(F.broadcast(hours), "log_hour", "left_semi").drop("log_hour"))
    return merge_words(words, keys)


def folded_summary(
    spark: SparkSession, base: str, store: str, *, start: str, end: str, keys: tuple[str, ...] = DEFAULT_KEYS
) -> DataFrame:
    """The audit's summary from folded hours and what is new."""
    return summarize_words(folded_words(spark, base, store, start=start, end=end, keys=keys), keys)
