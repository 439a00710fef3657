"""Path columns: identity between a logged key and a scanned file, and what a name says."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# A log file's sink: `<sink>-subtask-…` names the file, `<sink>-batch-…` names its folder.
_SINK_IN_NAME = r"([^/]+?)-(?:subtask|batch)-[^/]*(?:/[^/]+)?$"
_RUN_IN_NAME = r"/[^/]+?-batch-([^/]+)-[0-9]+/[^/]+$"
# Fixed value: characters that Spark escapes in the names of partition directories.
_ESCAPED = "\"#%'*/:=?\\{[]^"
_LOG_FOLDER = r"^.*/([0-9]{2}-[0-9]{2}-[0-9]{4}/.*)$"
_BUCKETS = r"^(.*?)/year=[^/]+/"


def decode_path(file_path: Column) -> Column:
    """`_metadata.file_path` without its URL encoding (a plus sign is a plus sign there)."""
    return F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))


def normalize_path(path: Column) -> Column:
    """One spelling for the same file: local paths bare, every S3 connector as `s3://`."""
    local = F.regexp_replace(path, "^file:/+", "/")
    return F.regexp_replace(local, "^s3[an]://", "s3://")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def dir_name(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def below_base(path: Column) -> Column:
    """The part of a commit-log path from its `MM-DD-YYYY` folder on."""
    return F.regexp_extract(path, _LOG_FOLDER, 1)


def sink_prefix(sink_name: Column) -> Column:
    """File-name prefix of a sink: the nameless main sink is `output`."""
    return F.when(sink_name == "", "output").otherwise(F.lower(F.regexp_replace(sink_name, "^-", "")))


def source_of(log_path: Column) -> Column:
    """The sink a commit-log file speaks for, by its name; unknown names stay themselves."""
    marked = F.regexp_extract(log_path, _SINK_IN_NAME, 1)
    return F.when(marked != "", marked).otherwise(F.split(base_name(log_path), "-")[0])


def run_of(log_path: Column) -> Column:
    """The run that wrote a commit-log file, by its folder's name; null for files named otherwise."""
    run = F.regexp_extract(log_path, _RUN_IN_NAME, 1)
    return F.when(run != "", F.url_decode(F.replace(run, F.lit("+"), F.lit("%2B"))))


def partition_value(value: str) -> str:
    """A value as Spark spells it in a partition directory's name."""
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED or ord(c) < 32 or ord(c) == 127 else c for c in value)


def table_root(key: Column) -> Column:
    """The table directory of a data file: what precedes its buckets, else its folder."""
    root = F.regexp_extract(key, _BUCKETS, 1)
    return F.when(root != "", root).otherwise(dir_name(key))


def bucket_prefix(key: Column, levels: tuple[str, ...]) -> Column:
    """The part of a key below its table root, cut after the given bucket levels."""
    pattern = "/(" + "/".join(f"{level}=[^/]+" for level in levels) + ")/"
    return F.regexp_extract(key, pattern, 1)


def level_names(key: Column) -> Column:
    """Names of a key's partition directories, from `year` on, joined by slashes; empty where it has none."""
    below = F.regexp_extract(key, r"/(year=[^/]+/(?:[^/=]+=[^/]+/)*)[^/]+$", 1)
    return F.rtrim(F.regexp_replace(below, r"=[^/]+/", "/"), F.lit("/"))


def level_values(key: Column, level: str) -> Column:
    """The value of one partition directory, without the escapes of its name."""
    value = F.regexp_extract(key, f"/{level}=([^/]+)/", 1)
    return F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))


def glob_escape(path: str) -> str:
    """A literal path inside a Hadoop glob."""
    return re.sub(r"([\\*?\[\]{},])", r"\\\1", path)


def one_of(base: str, names: list[str]) -> str:
    """A glob for whichever of `names` exist below `base`; the absent ones are no error."""
    options = ",".join(glob_escape(name.strip("/")) for name in names)
    return f"{glob_escape(base.rstrip('/'))}/{{{options}}}"
