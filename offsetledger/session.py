"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# For an audit on a cluster. Two narrow columns make little of each file, so scan tasks take
# large splits; with few map tasks, many shuffle partitions to start from stay cheap.
AUDIT_SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "1g",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
}


def build_session(app: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings this package is tuned for; `conf` wins over them.

    AQE merges small shuffle partitions and splits skewed joins; how many partitions it
    starts from is the job's to say (see `AUDIT_SETTINGS`).
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    settings.update(conf or {})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared folder named in `spark.checkpoint.dir`.

    Only a local master may fall back to this machine's temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return os.path.join(tempfile.mkdtemp(prefix=f"{purpose}-"), "work")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written to a new folder of the shared one and read again: later jobs see the same rows in the same tasks' order."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
