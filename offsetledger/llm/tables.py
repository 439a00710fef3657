"""Reading input tables, and tables written between jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offsetledger.session import work_dir

#: White space of the word rules: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written to the shared folder and read again: the plan behind it is cut.

    The files outlive a lost executor, and later jobs read them instead of repeating the work.
    """
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables written on the way to a result, deleted when the block ends.

    What the block returns must not read them any more: write it with `written` outside, or with `result`.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def written(self, df: DataFrame, purpose: str) -> DataFrame:
        path = work_dir(self.spark, purpose)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def result(self, df: DataFrame, purpose: str) -> DataFrame:
        """`df` written to stay."""
        return written(df, purpose)

    def __exit__(self, *_) -> None:
        for path in self.paths:
            delete(self.spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system Spark knows; one that is gone is no error."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def drawn(df: DataFrame, limit: int, seed: int, *key: str) -> DataFrame:
    """At most `limit` rows, the same for the same rows, by a hash of the columns `key`.

    Only hashes below four times the share that is wanted are ordered, so that however many tasks there
    are, they send few rows to the one that takes the first.
    """
    place = F.xxhash64(*key, F.lit(seed))
    n, steps = df.count(), 1 << 40
    if n > 4 * limit:
        df = df.where(F.pmod(place, F.lit(steps)) < 4 * limit * steps // n)
    return df.orderBy(place, *key).limit(limit)
