"""Periodic runs of words, found through Lyndon arrays, and texts with their repetitions collapsed.

A run is a longest stretch of consecutive words that repeats with some smallest period. Of interest here
are those of at least `min_exponent` periods and `min_length` words: loops of a generator, tables of
one line, stuck scrapers.

1. The first phase of a grouping suffix sorter takes suffixes by their first symbol, then, from the
   greatest group to the least, lets each member extend the nearest lower suffix before it: of those, the
   ones that are extended equally often move to a new group above their old one. When it ends, a
   suffix's group is its longest Lyndon prefix, so the lengths are the Lyndon array, without sorting any
   suffix to its end. It runs once under an order of the words and once under its reverse.
2. Every run has a Lyndon root of its period's length at some place of one of the two arrays. So each
   entry is a candidate root; where its first word recurs after it, longest common extensions to the right
   and to the left give the run. Places inside a run already found are not extended again.

Only stretches that can hold a run are taken through this: each three neighbouring words of a run of four
or more periods occur at least three times in the text. Which ones do is read off one sort of hashes;
equal hashes of different words only add stretches. Texts never meet, so nothing is shuffled, and a
long text costs n log n for the hashes and linear time for the arrays.

Words are `[^\\x20\\x09-\\x0D]+`. Defined cases: a null text, an empty one or one without words has no
run and collapses to the empty text; repeated rows and null ids are rows like others; a table without rows
gives none; columns other than `doc_id` and `text` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_EXPONENT, MIN_LENGTH = 4, 6
_SPACE_RUN = "[\\x20\\x09-\\x0D]+"
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

_FOUND = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())]
)


def lyndon_array(symbols: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place; symbols are 0, 1, 2, ...

    Groups hold places in ascending order. `before` and `after` link the places not taken yet, all of
    which are in lower groups, so the nearest lower suffix before a place is its link.
    """
    n, kinds = len(symbols), max(symbols, default=-1) + 1
    group = list(symbols)
    members: list[list[int]] = [[] for _ in range(kinds)]
    for at, symbol in enumerate(symbols):
        members[symbol].append(at)
    size = [1] * kinds
    below, above = list(range(-1, kinds - 1)), list(range(1, kinds + 1))
    before, after = list(range(-1, n)), list(range(1, n + 1))
    now = kinds - 1
    while now >= 0:
        extended: dict[tuple[int, int], list[int]] = {}
        lower = times = -1
        for at in members[now]:
            if group[at] != now:
                continue  # it has moved up
            left, right = before[at], after[at]
            before[right] = left
            if left >= 0:
                after[left] = right
            if left == lower:
                times += 1
                continue
            if lower >= 0:
                extended.setdefault((times, group[lower]), []).append(lower)
            lower, times = left, 1
        if lower >= 0:
            extended.setdefault((times, group[lower]), []).append(lower)
        # Of one old group those extended most often end up highest.
        for times, old in sorted(extended, reverse=True):
            new, moved = len(size), extended[times, old]
            size.append(size[old] + times * size[now])
            members.append(moved)
            for at in moved:
                group[at] = new
            higher = above[old]
            below.append(old)
            above.append(higher)
            below[higher], above[old] = new, new
        now = below[now]
    return [size[g] for g in group]


def _common(data: bytes, a: int, b: int, room: int, step_back: bool = False) -> int:
    """How many symbols (four bytes each) agree from places a and b on, or up to before them."""

    def same(done: int, step: int) -> bool:
        if step_back:
            x, y = a - done - step, b - done - step
        else:
            x, y = a + done, b + done
        return data[4 * x : 4 * (x + step)] == data[4 * y : 4 * (y + step)]

    done, step = 0, 1
    while done + step <= room and same(done, step):
        done += step
        step *= 2
    while step > 1:
        step //= 2
        if done + step <= room and same(done, step):
            done += step
    return done


def runs_of(symbols: list[int], min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> set[tuple[int, int, int]]:
    """(start, length, period) of every run long enough; symbols are 0, 1, 2, ..."""
    n, top = len(symbols), max(symbols, default=0)
    data = np.array(symbols, dtype="<i4").tobytes()
    found: set[tuple[int, int, int]] = set()
    for order in (symbols, [top - symbol for symbol in symbols]):
        latest: dict[int, tuple[int, int]] = {}  # of each period the run found last
        for at, period in enumerate(lyndon_array(order)):
            again = at + period
            if again >= n or symbols[at] != symbols[again]:
                continue
            begin, end = latest.get(period, (0, 0))
            if begin <= at and again <= end:
                continue  # two runs of one period overlap in less than it
            end = again + _common(data, at, again, n - again)
            begin = at - _common(data, at, again, at, step_back=True)
            if end - begin >= 2 * period:
                latest[period] = (begin, end)
                if end - begin >= max(min_length, min_exponent * period):
                    found.add((begin, end - begin, period))
    return found


def stretches(words: list[bytes], min_exponent: int, min_length: int) -> list[tuple[int, int]]:
    """Bounds of the stretches that hold every run of at least `min_exponent` periods."""
    # Three neighbours of a run of e periods recur in all of them but the last.
    width, times = (3, min_exponent - 1) if min_exponent >= 3 and min_length > min_exponent else (1, min_exponent)
    if len(words) < max(min_length, width + times - 1):
        return []
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    with np.errstate(over="ignore"):
        grams = hashes * _MIX[0]
        for at in range(1, width):
            grams = (grams[:-1] ^ (grams[:-1] >> np.uint64(29))) + hashes[at:] * _MIX[at]
    ordered = np.sort(grams)
    often = ordered[: len(ordered) - times + 1]
    often = often[often == ordered[times - 1 :]]
    if not len(often):
        return []
    edge = np.flatnonzero(np.diff(np.r_[False, np.isin(grams, often), False].astype(np.int8)))
    bounds = zip(edge[::2].tolist(), (edge[1::2] + width - 1).tolist())
    return [(low, high) for low, high in bounds if high - low >= min_length]


def runs_in(words: list[bytes], min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a list of words, by start, then period."""
    found: list[tuple[int, int, int]] = []
    for low, high in stretches(words, min_exponent, min_length):
        number: dict[bytes, int] = {}
        symbols = [number.setdefault(word, len(number)) for word in words[low:high]]
        found += [(low + start, length, period) for start, length, period in runs_of(symbols, min_exponent, min_length)]
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that lie in a run beyond its first period."""
    if not runs:
        return words
    kept: list[bytes] = []
    end = 0  # everything before it is decided
    for low, high in sorted((start + period, start + length) for start, length, period in runs):
        if low > end:
            kept += words[end:low]
        end = max(end, high)
    return kept + words[end:]


def find_runs(docs: DataFrame, min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, its `runs` by start and period, its `collapsed` text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found, texts = [], [], []
            for text in batch.column("text").to_pylist():
                # Bytes are split at exactly the white space of the word rule.
                words = (text or "").encode().split()
                runs = runs_in(words, min_exponent, min_length)
                counts.append(len(words))
                found.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                texts.append(b" ".join(collapse(words, runs)).decode())
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(found, pa.list_(_RUN)), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, schema=_FOUND_ARROW)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _FOUND)


def with_planted_loops(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the documents, by a hash of the id, end in a loop of their own words.

    A document's part from word a on becomes its first p words over and over. A null id has no hash,
    so its text stays.
    """
    number = F.crc32(F.col("doc_id").cast("long").cast("string"))
    row = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", number.alias("h"))
    words = F.filter(F.split("text", _SPACE_RUN), lambda word: word != "")
    row = row.withColumn("w", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("w"))
    row = row.withColumn("a", F.when(F.col("n") > 0, F.expr("cast((h div 10) % n as int)")))
    row = row.withColumn("p", F.expr("cast(1 + (n - a) div (3 + (h div 10) % 8) as int)"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    loop = F.slice(F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), times)), F.lit(1), F.col("n") - F.col("a"))
    looped = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), loop), " ")
    return row.select("doc_id", F.when(F.col("a").isNotNull(), looped).otherwise(F.col("text")).alias("text"))


def strongest(runs: Column) -> Column:
    """The run of greatest exact length/period; of equal ones the first."""
    better = lambda best, x: F.when(best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x).otherwise(best)
    return F.aggregate(runs, F.get(runs, F.lit(0)), better)


def digests(docs: DataFrame, min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> DataFrame:
    """One row per document: its strongest run, and hashes of all its runs and of its collapsed text."""
    found = find_runs(docs, min_exponent, min_length).withColumn("best", strongest(F.col("runs")))
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
