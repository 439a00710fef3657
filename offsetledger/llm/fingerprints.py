"""Document fingerprints from improbable byte windows, and their likeness.

1. Each 64-byte window of a text has an entropy, put on a scale of 0 to 1000. How often each value occurs
   is counted over all windows of all texts; the rarer a value, the lower its rank.
2. Of each 64 neighbouring windows the leftmost one of lowest rank gains a point. Windows with 16 or more
   points are the text's features: rare, and well apart. Windows of almost no entropy never are.
3. Features enter Bloom filters of 2,048 bits, five bits each, 160 different features to a filter, in the
   order of their first occurrence; the chain of filters is the fingerprint.
4. Two filters are alike by the bits they share, less what chance gives filters so full, in proportion to
   what they could share at most. Each filter of the chain with fewer features is held against all of the
   other chain and its best likeness taken; the mean, weighted by features, is the likeness of the texts.

The counts are 1,001 sums over the whole corpus, formed in the tasks; only these reach the driver. Texts
are taken in pieces of bounded size that overlap by the 127 windows a choice depends on, and short ones
many to a piece.

A fingerprint is written `<features>:<filters in base64>`. Defined cases: a null text is empty, and has the
fingerprint `0:`; a text without features, as one shorter than a window, counts as one feature as a whole; equal
fingerprints have likeness 1, and an empty one has likeness 0 to any other; repeated rows are rows like
others; rows that share a doc_id have the same neighbour; a null id comes before all others; tables without rows
give none; columns other than `doc_id` and `text` are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StringType, StructType

from offsetledger.llm.shingles import mix
from offsetledger.llm.tables import written

WIDTH = 64
#: Neighbouring windows among which one gains a point, and the points that make a feature.
NEIGHBOURS, POINTS = 64, 16
SCALE = 1000
#: Windows of a lower entropy than this are never features.
LEAST_ENTROPY = 100
FILTER_BITS, HASHES, FILTER_FEATURES = 2048, 5, 160
#: Share of what two filters can have in common beyond chance that still counts as nothing.
CUT = 0.3
#: Bytes taken at once; a task's arrays take about 150 times as much memory.
PIECE = 1 << 18
#: Rows of one id that are brought together with its neighbour's beginning.
ROWS_PER_PART = 10_000
HEADS = "array<struct<key: long, part: int, kind: int, doc_id: long, n_chars: long, text: string, fingerprint: string>>"
#: Ids with what their neighbours need, sent to all tasks (about 100 bytes each); beyond that, both sides are shuffled.
MAX_BROADCAST_IDS = 300_000

#: Ids that agree above these bits are one group when neighbours are sought.
GROUP_BITS = (14, 30, 46, None)

_ONE = 1 << 20  # of the fixed-point numbers that entropies are summed in
_COUNTS = np.arange(WIDTH + 1)
_PART = np.rint(_COUNTS * np.log2(np.maximum(_COUNTS, 1)) * _ONE).astype(np.int64)
_GAIN = np.r_[np.diff(_PART), 0]  # from a count to the next
_FULL = int(_PART[WIDTH])
_NEVER = SCALE + 1

_random = np.random.Generator(np.random.PCG64(11))
_VALUE = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACE = _random.integers(1, 1 << 63, WIDTH, dtype=np.uint64) | np.uint64(1)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def entropies(data: np.ndarray) -> np.ndarray:
    """Entropy of each window of WIDTH bytes, 0 to SCALE, by sliding.

    From one window to the next, the byte that leaves lowers its count, and the one that enters raises its
    own. How often a byte occurs in the window it begins or ends is read off the places of equal bytes.
    """
    n = len(data) - WIDTH + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    places = np.argsort(data, kind="stable")
    stride = len(data) + 2 * WIDTH
    line = data[places].astype(np.int64) * stride + places  # ascending
    at = np.arange(len(data))
    begins, ends = np.empty(len(data), dtype=np.int64), np.empty(len(data), dtype=np.int64)
    begins[places] = np.searchsorted(line, line + WIDTH) - at  # equal bytes in the window it begins
    ends[places] = at - np.searchsorted(line, line - WIDTH, side="right")  # equal ones before it, in the window it ends
    change = _GAIN[ends[WIDTH:]] - _GAIN[begins[: n - 1] - 1]
    # The byte that leaves may equal the one that enters; it stands outside the window that one ends.
    first = int(_PART[np.bincount(data[:WIDTH], minlength=256)].sum())
    total = np.cumsum(np.r_[first, change])
    return SCALE * (_FULL - total) // _FULL


def pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, text of each window, whether it is new) of pieces of bounded size.

    Windows across the end of a text belong to none (-1). A long text goes on in the next piece, which
    repeats the windows that choices near the border depend on; those that were decided are not new.
    """
    overlap = 2 * NEIGHBOURS
    held: list[bytes] = []
    owner: list[np.ndarray] = []
    new: list[np.ndarray] = []
    size = 0
    for at, raw in enumerate(texts):
        windows = len(raw) - WIDTH + 1
        for begin in range(0, max(windows, 0), PIECE):
            low, high = max(begin - overlap, 0), min(begin + PIECE + overlap, windows)
            held.append(raw[low : high + WIDTH - 1])
            mine = np.full(high - low + WIDTH - 1, -1, dtype=np.int64)
            mine[: high - low] = at
            place = np.arange(low, high + WIDTH - 1)
            owner.append(mine)
            new.append((place >= begin) & (place < begin + PIECE))
            size += len(mine)
            if size >= PIECE:
                yield np.frombuffer(b"".join(held), dtype=np.uint8), np.concatenate(owner), np.concatenate(new)
                held, owner, new, size = [], [], [], 0
    if held:
        yield np.frombuffer(b"".join(held), dtype=np.uint8), np.concatenate(owner), np.concatenate(new)


def entropy_counts(docs: DataFrame) -> np.ndarray:
    """How many windows of all texts have each entropy."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SCALE + 1, dtype=np.int64)
        for batch in batches:
            for data, owner, new in pieces([_bytes(text) for text in batch.column(0).to_pylist()]):
                n = len(data) - WIDTH + 1
                counts += np.bincount(entropies(data)[(owner[:n] >= 0) & new[:n]], minlength=SCALE + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(counts)), pa.array(counts[counts > 0])], ["entropy", "n"])

    counted = docs.select("text").mapInArrow(run, "entropy long, n long").groupBy("entropy").agg(F.sum("n").alias("n"))
    out = np.zeros(SCALE + 1, dtype=np.int64)
    for row in counted.collect():
        out[row.entropy] = row.n
    return out


def rarity(counts: np.ndarray) -> np.ndarray:
    """Rank of each entropy, the least frequent first; too low ones get no rank."""
    rank = np.empty(SCALE + 1, dtype=np.int64)
    rank[np.lexsort((np.arange(SCALE + 1), counts))] = np.arange(SCALE + 1)
    rank[:LEAST_ENTROPY] = _NEVER
    return rank


def _leftmost_least(rank: np.ndarray) -> np.ndarray:
    """For each NEIGHBOURS neighbours, the place of the leftmost least rank."""
    width, n = NEIGHBOURS, len(rank) - NEIGHBOURS + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    keyed = rank << 32 | np.arange(len(rank))
    padded = np.full(-(-len(rank) // width) * width, np.iinfo(np.int64).max)
    padded[: len(rank)] = keyed
    rows = padded.reshape(-1, width)
    forward = np.minimum.accumulate(rows, axis=1).ravel()
    backward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n]) & 0xFFFFFFFF


def features(texts: list[bytes], rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the text, hash) of each feature, in order of place; texts in order."""
    owners, hashes = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]
    for data, owner, new in pieces(texts):
        n = len(data) - WIDTH + 1
        owner, new = owner[:n], new[:n]
        mine = np.where(owner >= 0, rank[entropies(data)], _NEVER)
        least = _leftmost_least(mine)
        # Neighbourhoods lie in one text; those of texts that meet in a piece do not count.
        if len(least):
            begins, ends = owner[: len(least)], owner[NEIGHBOURS - 1 :]
            least = least[(begins >= 0) & (begins == ends)]
        place, points = np.unique(least, return_counts=True)
        place = place[(points >= POINTS) & (mine[place] < _NEVER) & new[place]]
        with np.errstate(over="ignore"):
            block = _VALUE[data[place[:, None] + np.arange(WIDTH)]] * _PLACE
            hashes.append(mix(block.sum(axis=1, dtype=np.uint64)))
        owners.append(owner[place])
    return np.concatenate(owners), np.concatenate(hashes)


def fingerprints_of(texts: list[bytes], rank: np.ndarray) -> list[str]:
    """The fingerprint of each text."""
    owner, value = features(texts, rank)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for at, raw in enumerate(texts):
        mine = value[bounds[at] : bounds[at + 1]]
        if not raw:
            out.append("0:")
            continue
        if not len(mine):
            mine = mix(np.array([xxhash.xxh3_64_intdigest(raw)], dtype=np.uint64))
        first = np.sort(np.unique(mine, return_index=True)[1])
        mine = mine[first]
        bits = np.zeros((-(-len(mine) // FILTER_FEATURES), FILTER_BITS), dtype=bool)
        chain = np.arange(len(mine)) // FILTER_FEATURES
        for k in range(HASHES):
            bits[chain, (mine >> np.uint64(11 * k)).astype(np.int64) % FILTER_BITS] = True
        out.append(f"{len(mine)}:{base64.b64encode(np.packbits(bits).tobytes()).decode()}")
    return out


def _filters(fingerprint: str) -> tuple[int, np.ndarray]:
    count, _, packed = fingerprint.partition(":")
    bits = np.unpackbits(np.frombuffer(base64.b64decode(packed), dtype=np.uint8))
    return int(count), bits.reshape(-1, FILTER_BITS).astype(np.float32)


def _one_way(a: np.ndarray, features_of_a: int, b: np.ndarray) -> float:
    """Mean over the filters of `a`, by their features, of the best likeness to a filter of `b`."""
    full_a, full_b = a.sum(axis=1), b.sum(axis=1)
    best = np.zeros(len(a))
    for at in range(0, len(b), 1024):
        some, full = b[at : at + 1024], full_b[None, at : at + 1024]
        for low in range(0, len(a), 1024):
            rows = slice(low, low + 1024)
            shared = (a[rows] @ some.T).astype(np.float64)
            most = np.minimum(full_a[rows, None], full).astype(np.float64)
            chance = full_a[rows, None].astype(np.float64) * full / FILTER_BITS
            floor = chance + CUT * (most - chance)
            # Filters so full that chance shares all of them say nothing.
            alike = np.where(most > floor, (shared - floor) / np.maximum(most - floor, 1e-9), 0.0)
            best[rows] = np.maximum(best[rows], np.clip(alike, 0.0, 1.0).max(axis=1))
    weights = np.full(len(a), FILTER_FEATURES, dtype=np.float64)
    weights[-1] = features_of_a - FILTER_FEATURES * (len(a) - 1)
    return float((best * weights).sum() / weights.sum())


def likeness_of(x: str, y: str) -> float:
    """0 to 1, the same both ways."""
    if x == y:
        return 1.0
    (n, a), (m, b) = _filters(x), _filters(y)
    if not n or not m:
        return 0.0
    if n == m:
        return (_one_way(a, n, b) + _one_way(b, m, a)) / 2
    return _one_way(a, n, b) if n < m else _one_way(b, m, a)


@pandas_udf(DoubleType())
def likeness(x: pd.Series, y: pd.Series) -> pd.Series:
    """Likeness of two columns of fingerprints; null where one is."""
    return pd.Series([None if a is None or b is None else likeness_of(a, b) for a, b in zip(x.tolist(), y.tolist())], dtype="float64")


def fingerprint_udf(rank: np.ndarray):
    """A column function from texts to fingerprints under the given ranks."""

    @pandas_udf(StringType())
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series(fingerprints_of([_bytes(text) for text in texts.tolist()], rank))

    return fingerprint


def following(ids: DataFrame) -> DataFrame:
    """(id, next_id): of different longs the next greater one; after the last comes the first.

    Neighbours are sought among ids that agree but for their low bits, and what is last there, among
    the least ids of such groups, level by level: no window holds more than 2^18 rows, whatever the ids.
    """
    lowest = ids.agg(F.min("id").alias("id")).first().id
    levels, level = [], ids.select("id")
    for bits in GROUP_BITS:
        level = level.withColumn("group", F.lit(0).cast("long") if bits is None else F.shiftright("id", bits))
        levels.append(level.withColumn("next_id", F.lead("id").over(Window.partitionBy("group").orderBy("id"))))
        level = level.groupBy("group").agg(F.min("id").alias("id")).select("id")
    found, left = [levels[0].where("next_id is not null").select("id", "next_id")], levels[0].where("next_id is null")
    for bits, upper in zip(GROUP_BITS, levels[1:]):
        step = upper.select(F.shiftright("id", bits).alias("group"), F.col("group").alias("upper"), "next_id")
        left = left.select("id", "group").join(step, "group").select("id", F.col("upper").alias("group"), "next_id")
        found.append(left.where("next_id is not null").select("id", "next_id"))
        left = left.where("next_id is null")
    found.append(left.select("id", F.lit(lowest).cast("long").alias("next_id")))
    return reduce(DataFrame.unionAll, found)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row, under the entropies of this very table."""
    fingerprint = fingerprint_udf(rarity(entropy_counts(docs)))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprint("text").alias("fingerprint"))


def neighbourhoods(rows: DataFrame) -> DataFrame:
    """Per id of `rows` (id, text): its predecessor `before`, the code points that one `need`s of it, and the hash of
    the text that it gives (the least); into how many parts rows are dealt (`parts`, `before_parts`)."""
    need = F.max(F.expr("length(text) div 4")).cast("int").alias("need")
    parts = F.ceil(F.count("*") / ROWS_PER_PART).cast("int").alias("parts")
    of_id = written(rows.groupBy("id").agg(need, parts, F.min(F.xxhash64("text")).alias("least")), "ids")
    before = following(of_id).join(of_id, "id")
    before = before.select(F.col("next_id").alias("id"), F.col("id").alias("before"), "need", F.col("parts").alias("before_parts"))
    return written(before.join(of_id.drop("need"), "id"), "neighbourhoods")


def with_next(docs: DataFrame, fingerprint) -> DataFrame:
    """Rows with their fingerprint and the next document's, and the edited text: its last quarter replaced by
    the beginning of the next document.

    A text is read once, fingerprinted where it is read, and sent on as the part that is kept (by its own id) and as
    the beginning that its predecessor needs (by that one's id).
    """
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), id_.alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    near = neighbourhoods(rows)
    if near.count() <= MAX_BROADCAST_IDS:
        near = F.broadcast(near)
    n = F.length("text")
    placed = rows.join(near, "id").withColumns({"fingerprint": fingerprint("text"), "at": F.monotonically_increasing_id()})

    def sent(key: str, part: Column, kind: int, doc_id: Column, n_chars: Column, text: Column) -> Column:
        fields = {"key": F.col(key), "part": part, "kind": F.lit(kind), "doc_id": doc_id, "n_chars": n_chars, "text": text}
        return F.struct(*[value.alias(name) for name, value in fields.items()], F.col("fingerprint").alias("fingerprint"))

    none = F.lit(None).cast("long")
    kept = F.substring(F.col("text"), F.lit(1), n - F.expr("length(text) div 4"))
    own = sent("id", F.pmod("at", "parts").cast("int"), 1, F.col("doc_id"), n.cast("long"), kept)
    head = F.substring(F.col("text"), F.lit(1), F.col("need"))
    heads = F.transform(F.sequence(F.lit(0), F.col("before_parts") - 1), lambda part: sent("before", part, 0, none, none, head))
    given = F.when(F.xxhash64("text") == F.col("least"), heads).otherwise(F.array().cast(HEADS))
    rows = placed.select(F.inline(F.concat(F.array(own), given)))
    # Beginnings come first; a part has at most ROWS_PER_PART rows besides, whatever shares an id.
    first = Window.partitionBy("key", "part").orderBy("kind")
    rows = rows.withColumns({"head": F.first("text").over(first), "next_fingerprint": F.first("fingerprint").over(first)})
    edited = F.concat("text", F.substring(F.col("head"), F.lit(1), F.expr("cast(n_chars div 4 as int)")))
    return rows.where("kind = 1").select("doc_id", "n_chars", edited.alias("edited"), "fingerprint", "next_fingerprint")


def compare_udf(rank: np.ndarray):
    """From a text and two fingerprints: the text's fingerprint and its likeness to the first, and theirs to each other."""

    @pandas_udf(StructType().add("fingerprint", StringType()).add("near_own", DoubleType()).add("near_other", DoubleType()))
    def compare(texts: pd.Series, own: pd.Series, other: pd.Series) -> pd.DataFrame:
        found = fingerprints_of([_bytes(text) for text in texts.tolist()], rank)
        near_own = [likeness_of(x, y) for x, y in zip(own.tolist(), found)]
        near_other = [likeness_of(x, y) for x, y in zip(own.tolist(), other.tolist())]
        return pd.DataFrame({"fingerprint": found, "near_own": near_own, "near_other": near_other})

    return compare


def digests(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint and its edited text's, and how alike they and its neighbour's are."""
    rank = rarity(entropy_counts(docs))
    rows = with_next(docs, fingerprint_udf(rank))
    rows = rows.withColumn("compared", compare_udf(rank)("edited", "fingerprint", "next_fingerprint"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        F.col("compared.fingerprint").alias("edited_fingerprint"),
        F.col("compared.near_own").alias("near_edited"),
        F.col("compared.near_other").alias("near_next"),
    )
