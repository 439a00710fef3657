"""Data files found through the commit log.

No file's name passes through Python: listings and the log are frames, joined by file. What the driver asks for by
name are directories: of a bucketed table those of the hours that the log names, of others the files' folders.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from offsetledger.functions.paths import (
    base_name,
    bucket_prefix,
    decode_path,
    glob_escape,
    level_names,
    level_values,
    normalize_path,
    one_of,
    table_root,
)
from offsetledger.schemas import BUCKET_COLUMNS, COORDINATES, ENRICHED, PARTITIONS

# Directory names put into one glob; more names make more globs.
NAMES_PER_GLOB = 128
# Logged files (about 150 bytes each) that are sent to every task; beyond that, batches are, and rows meet files by a shuffle.
MAX_BROADCAST_FILES = 300_000


def existing(load, path: str | list[str]) -> DataFrame | None:
    try:
        return load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _located(log: DataFrame) -> DataFrame:
    """The log's files, each once: `s3_key` normalized, its table, the levels and values of its directories, its name."""
    key = F.col("s3_key")
    located = log.filter(key.isNotNull()).select(
        normalize_path(key).alias("s3_key"),
        table_root(normalize_path(key)).alias("table"),
        table_root(key).alias("root"),
        bucket_prefix(key, BUCKET_COLUMNS).alias("dir"),
    )
    # A table logged under several spellings of its path is one table.
    files = located.groupBy("s3_key", "table", "dir").agg(F.min("root").alias("root"))
    return files.withColumns({"levels": level_names(F.col("s3_key")), "file_name": base_name(F.col("s3_key"))})


def _folders(located: DataFrame) -> dict[tuple[str, str, str], list[str]]:
    """Globs by table, root and levels: of bucketed tables for the hours' directories, else for the files' folder."""
    found = located.groupBy("table", "levels", "dir").agg(F.min("root").alias("root")).collect()
    roots, names = {}, {}
    for row in found:
        levels = row.levels if row.dir else ""
        roots[row.table] = min(roots.get(row.table, row.root), row.root)
        names.setdefault((row.table, levels), set()).add(row.dir)
    globs = {}
    for (table, levels), dirs in sorted(names.items()):
        ordered, root = sorted(dirs), roots[table]
        if ordered == [""]:
            globs[table, root, levels] = [one_of(*root.rsplit("/", 1)[:1], [root.rsplit("/", 1)[1]])]
        else:
            globs[table, root, levels] = [one_of(root, ordered[at : at + NAMES_PER_GLOB]) for at in range(0, len(ordered), NAMES_PER_GLOB)]
    return globs


def data_globs(log: DataFrame, roots: list[str] | None = None) -> list[str]:
    """Globs for the directories the log's keys lie in: of bucketed tables the bucket
    directories, else the files' own folders.

    So the listing follows the audited range and not the table's age, however long either
    is. The driver holds a name for each directory, as any listing of them does.
    """
    if roots is not None:
        return [glob_escape(root.rstrip("/")) for root in roots]
    return [glob for globs in _folders(_located(log)).values() for glob in globs]


def list_files(spark: SparkSession, globs: list[str], recursive: bool = True) -> DataFrame:
    """Parquet files below the globs, each once: `file_path` as scans report it, `s3_key` normalized.

    A scan that reads nothing of the files: Spark lists the directories in parallel, and the names stay in its
    tasks. A glob that matches nothing lists nothing.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    reader = reader.option("recursiveFileLookup", recursive)
    whole = existing(reader.load, globs) if globs else None
    frames = [whole] if whole is not None else [existing(reader.load, glob) for glob in globs]
    found = [frame.select(F.col("_metadata.file_path")) for frame in frames if frame is not None]
    if not found:
        return spark.createDataFrame([], "file_path string, s3_key string")
    names = reduce(DataFrame.unionAll, found)
    names = names.distinct() if len(found) > 1 else names
    return names.withColumn("s3_key", normalize_path(decode_path(F.col("file_path"))))


def list_files_at(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Parquet files below literal directories; absent ones list nothing."""
    return list_files(spark, [glob_escape(path) for path in paths])


@dataclass(frozen=True)
class Listing:
    """The files found where a log's keys lie."""

    files: DataFrame


def find_files(spark: SparkSession, log: DataFrame, roots: list[str] | None = None) -> Listing:
    """List the directories the log's keys lie in; `roots` names tables to list whole."""
    return Listing(list_files(spark, data_globs(log, roots)))


def read_table(spark: SparkSession, path: str, schema: StructType = ENRICHED) -> DataFrame:
    """A whole bucketed table with its directory levels as columns, zero padding kept."""
    return spark.read.schema(StructType(schema.fields + PARTITIONS.fields)).parquet(path)


def _scan(spark: SparkSession, globs: list[str], root: str, levels: list[str], schema: StructType, strict: bool) -> DataFrame | None:
    """The rows below some directories of one table, with the directories' values as strings."""
    reader = spark.read.schema(StructType([*schema.fields, *(StructField(level, StringType()) for level in levels)]))
    if levels:
        reader = reader.option("basePath", root)
    else:
        # A folder's own files: the glob is for files, so tables in folders below are not listed.
        globs = [f"{glob}/*.parquet" for glob in globs]
    if not strict:
        reader = reader.option("ignoreMissingFiles", True).option("ignoreCorruptFiles", True)
    frames = [frame for glob in globs if (frame := existing(reader.parquet, glob)) is not None]
    # Partition columns of a glob without any file are read as data.
    file = (F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"))
    frames = [frame.select(*schema.names, *levels, *file) for frame in frames]
    return reduce(DataFrame.unionAll, frames) if frames else None


def read_committed(
    spark: SparkSession,
    log: DataFrame,
    schema: StructType = COORDINATES,
    *,
    roots: list[str] | None = None,
    strict: bool = True,
    with_file: bool = False,
) -> DataFrame:
    """Rows of the existing files named in the log, each file once; columns of `schema`.

    `with_file` adds `file_path`. The rows are joined with the log's files by directory and name, and that join prunes
    the directories to be read while the query runs: those of batches that the log does not name are never opened, for
    one file or for a million. `roots` names tables to list whole instead of the hours that the log names; then nothing
    of the log is known before the scan. `strict=False` skips files that cannot be read.
    """
    return _committed(spark, log, schema, roots, strict, with_file, files=True)


def read_logged_batches(
    spark: SparkSession, log: DataFrame, schema: StructType = COORDINATES, *, roots: list[str] | None = None, strict: bool = True
) -> DataFrame:
    """Rows, with `file_path`, of all files of the batches that the log names: a superset of `read_committed`.

    For what is folded by file first and joined with the log's files then, when it is small.
    """
    return _committed(spark, log, schema, roots, strict, True, files=False)


def _committed(
    spark: SparkSession, log: DataFrame, schema: StructType, roots: list[str] | None, strict: bool, with_file: bool, files: bool
) -> DataFrame:
    located = _located(log)
    if roots is None:
        folders = _folders(located)
    else:
        folders = {(_normal(root), root.rstrip("/"), "/".join(PARTITIONS.names)): [glob_escape(root.rstrip("/"))] for root in roots}
    few = located.count() <= MAX_BROADCAST_FILES
    parts = []
    for (table, root, names), globs in folders.items():
        levels = names.split("/") if names else []
        rows = _scan(spark, globs, root, levels, schema, strict)
        if rows is None:
            continue
        # The log's files in this table; a comparison that a plan can prune by.
        mine = located.filter((F.col("table") == table) & F.col("s3_key").startswith(f"{table}/"))
        mine = mine.select(*[level_values(F.col("s3_key"), level).alias(level) for level in levels], "file_name")
        if not files or not few:
            # Batches identify their directories; hours alone do where there are none.
            batch = [level for level in levels if level not in BUCKET_COLUMNS] or levels
            if batch:
                batches = mine.select(*batch).distinct()
                rows = rows.join(F.broadcast(batches) if few or batches.count() <= MAX_BROADCAST_FILES else batches, batch, "left_semi")
        if files:
            rows = rows.join(F.broadcast(mine) if few else mine, [*levels, "file_name"], "left_semi")
        parts.append(rows.select(*schema.names, *(["file_path"] if with_file else [])))
    if parts:
        return reduce(DataFrame.unionAll, parts)
    empty = spark.createDataFrame([], schema)
    return empty.withColumn("file_path", F.lit("")) if with_file else empty


def _normal(root: str) -> str:
    """`normalize_path` of one literal path."""
    for scheme in ("s3n://", "s3a://"):
        root = f"s3://{root[len(scheme):]}" if root.startswith(scheme) else root
    return ("/" + root[5:].lstrip("/") if root.startswith("file:") else root).rstrip("/")


def unread_entries(
    spark: SparkSession,
    log: DataFrame,
    column: str = "kafka_offset",
    listing: Listing | None = None,
    read: DataFrame | None = None,
) -> DataFrame:
    """Entries whose existing file gave no row: unreadable, or empty.

    `read` says of each `file_path` how many `rows` it gave, where a scan has found that out already; else one
    column of the logged files is read, tolerating the broken ones.
    """
    listing = listing or find_files(spark, log)
    if read is None:
        rows = read_committed(spark, log, StructType([COORDINATES[column]]), strict=False, with_file=True)
        read = rows.groupBy("file_path").agg(F.count(column).alias("rows"))
    silent = listing.files.join(read.filter("rows > 0"), "file_path", "left_anti").select(F.col("s3_key").alias("_key"))
    keyed = log.withColumn("_key", normalize_path(F.col("s3_key")))
    return keyed.join(silent, "_key", "left_semi").select(*log.columns)


def of_logged_files(rows: DataFrame, log: DataFrame) -> DataFrame:
    """The rows whose `file_path` the log names."""
    keys = log.select(normalize_path(F.col("s3_key")).alias("_key")).distinct()
    keyed = rows.withColumn("_key", normalize_path(decode_path(F.col("file_path"))))
    return keyed.join(keys, "_key", "left_semi").drop("_key")
