"""URL filtering with rules and a cascade of Bloom filters.

Rules name a host, which stands for its subdomains too, and the beginning of a path; the longest that
fits decides. Hosts that have a page blocked by a rule are listed, and pages that no rule fits are
blocked if their host is listed.

Membership in the list is looked up in a cascade over the corpus's complete key universe: the first
filter holds the listed hosts, the second those other hosts that the first takes for listed, the third
the listed hosts that the second takes for others, and so on until no error is left. Every host of the
corpus gets an exact answer, without a join. The bits of each level are set by tasks and combined per
word by Spark; the hosts themselves are never collected. A cascade that outgrows the bound of its
broadcast gives way to a shuffled join with the list.

Defined cases: a null url, or one without `://`, has an empty host and path, which no rule fits and
no list holds; without listed hosts nothing is looked up; repeated rows are judged each for itself;
extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offsetledger.llm.tables import written

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("com", "/", ALLOW),
    Rule("example.com", "/en/", BLOCK),
    Rule("www.example.com", "/en/", ALLOW),
    Rule("net", "/es/", BLOCK),
    Rule("net", "/fr/", BLOCK),
)

#: A cascade is broadcast if all its levels together have no more bytes than this.
MAX_CASCADE_BYTES = 64 << 20
#: Levels after which a cascade that does not get smaller is given up; chance alone would leave one key so long
#: once in 10^15 times.
STUCK_LEVELS = 24


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    text = F.coalesce(url, F.lit(""))
    start = F.instr(text, "://")
    rest = F.when(start > 0, F.substring(text, start + 3, F.length(text))).otherwise("")
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"\A([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest fitting rule's name and verdict, or null."""
    chosen = F.lit(None).cast("struct<name: string, verdict: string>")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


# --- the cascade --------------------------------------------------------------------


def _places(key1: np.ndarray, key2: np.ndarray, level: int, bits: int, hashes: int) -> np.ndarray:
    """Bit numbers of each key in a level: (keys, hashes)."""
    salt = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
    a = (key1.view(np.uint64) ^ salt) * np.uint64(0xD6E8FEB86659FD93)
    a ^= a >> np.uint64(32)
    b = ((key2.view(np.uint64) + salt) * np.uint64(0xCA5A826395121157)) | np.uint64(1)
    with np.errstate(over="ignore"):
        return ((a[:, None] + np.arange(hashes, dtype=np.uint64) * b[:, None]) >> np.uint64(11)) % np.uint64(bits)


@dataclass
class Level:
    bits: int
    hashes: int
    data: np.ndarray

    def holds(self, key1: np.ndarray, key2: np.ndarray, level: int) -> np.ndarray:
        at = _places(key1, key2, level, self.bits, self.hashes)
        return (self.data[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).all(axis=1)


class Cascade:
    """Levels that alternate between listed keys and false positives."""

    def __init__(self) -> None:
        self.levels: list[Level] = []

    def holds(self, key1: np.ndarray, key2: np.ndarray) -> np.ndarray:
        """Exact for every key of the universe the cascade was built on."""
        found = np.zeros(len(key1), dtype=bool)
        left = np.arange(len(key1))
        for at, level in enumerate(self.levels):
            passed = level.holds(key1[left], key2[left], at)
            found[left[~passed]] = at % 2 == 1  # turned away by a filter of false positives: listed
            left = left[passed]
        found[left] = len(self.levels) % 2 == 1
        return found


def _filter_of(keys: DataFrame, n: int, rate: float, level: int) -> Level | None:
    """A Bloom filter of `n` keys with about this rate of false positives; None if it is too large."""
    bits = 64 * math.ceil(-n * math.log(rate) / math.log(2) ** 2 / 64)
    if bits // 8 > MAX_CASCADE_BYTES:
        return None
    hashes = max(1, round(bits / n * math.log(2)))

    def set_bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            places = np.unique(_places(batch["key1"].to_numpy(), batch["key2"].to_numpy(), level, bits, hashes))
            word = (places >> np.uint64(6)).astype(np.int64)
            first = np.flatnonzero(np.diff(np.r_[-1, word]))
            value = np.uint64(1) << (places & np.uint64(63))
            value = np.bitwise_or.reduceat(value, first) if len(first) else value
            yield pd.DataFrame({"at": word[first], "value": value.view(np.int64)})

    rows = keys.select("key1", "key2").mapInPandas(set_bits, "at long, value long").groupBy("at").agg(F.bit_or("value").alias("value"))
    words = rows.toPandas()
    data = np.zeros(bits // 64, dtype=np.uint64)
    data[words["at"].to_numpy()] = words["value"].to_numpy(dtype=np.int64).view(np.uint64)
    return Level(bits, hashes, data)


def build_cascade(universe: DataFrame, rate: float = 0.05) -> Cascade | None:
    """From rows (key1, key2, listed), each key once. None if it outgrows `MAX_CASCADE_BYTES`.

    Each level leaves fewer keys of one kind; if none goes away for many levels, a listed key and another are the
    same in both hashes, and no cascade can tell them apart: that is an error.
    """
    cascade, wrong, included, sizes = Cascade(), universe, True, []
    while True:
        keys = wrong.where(F.col("listed") == included)
        n = keys.count()
        if not n:
            return cascade
        sizes.append(n)
        if len(sizes) > STUCK_LEVELS and set(sizes[-1 - STUCK_LEVELS :: 2]) == {n}:
            raise ValueError(f"{n} keys, listed={included}, can't be told from others by their hashes")
        at = len(cascade.levels)
        level = _filter_of(keys, n, rate, at)
        if level is None or sum(x.data.nbytes for x in cascade.levels) + level.data.nbytes > MAX_CASCADE_BYTES:
            return None
        cascade.levels.append(level)
        holds = F.pandas_udf(lambda a, b, level=level, at=at: pd.Series(level.holds(a.to_numpy(), b.to_numpy(), at)), "boolean")
        # The next filter holds the errors of this one, and is asked about the keys of this one.
        others = wrong.where(F.col("listed") != included).where(holds("key1", "key2"))
        wrong = written(keys.union(others), "cascade")
        included = not included


def with_keys(df: DataFrame, host: str = "host") -> DataFrame:
    return df.withColumn("key1", F.xxhash64(host)).withColumn("key2", F.xxhash64(F.lit(1), host))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict."""
    host, path = url_parts(F.col("url"))
    parts = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    parts = parts.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    hosts = parts.groupBy("host").agg(F.max(F.coalesce(F.col("fit.verdict") == BLOCK, F.lit(False))).alias("listed"))
    universe = written(with_keys(hosts).select("key1", "key2", "listed"), "hosts")
    cascade = build_cascade(universe)
    if cascade is None:
        listed = hosts.where("listed").select("host", "listed")
        judged = parts.join(listed, "host", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    elif cascade.levels:
        shared = pages.sparkSession.sparkContext.broadcast(cascade)  # its size is checked while it is built
        listed = F.pandas_udf(lambda a, b: pd.Series(shared.value.holds(a.to_numpy(), b.to_numpy())), "boolean")
        judged = with_keys(parts).withColumn("listed", listed("key1", "key2"))
    else:
        judged = parts.withColumn("listed", F.lit(False))
    verdict = F.coalesce(F.col("fit.verdict"), F.when(F.col("listed"), BLOCK).otherwise(ALLOW))
    return judged.select("page_id", "host", "path", F.col("fit.name").alias("rule"), verdict.alias("verdict"))
