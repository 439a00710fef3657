"""Exact repeated-passage removal by column-wise suffix sorting of many documents.

Texts are UTF-8 bytes. A byte goes if a string of `window` bytes that covers it starts anywhere else too.

1. Each window of a text has an anchor: the place of the least hash of its strings of `gram` bytes. Equal
   windows have equal anchors at equal places, so the text falls into segments (runs of windows with one
   anchor), and a window can only repeat in segments with its anchor.
2. Segments whose anchor occurs once fall out. The others are counted by anchor and content. A segment that occurs twice is repeated as a whole. One
   that shares its anchor with different segments is sorted with them, one row per different content.
3. The sort is column-wise, as for the Burrows-Wheeler transform of a collection: all segments of a
   block are aligned at their anchors, and each round inserts one symbol of every segment, from the last
   column to the first. The order of the suffixes that start in a column follows from the symbol and the
   order of the column before; the common prefix of neighbours is one more than the least one between
   their places there. A window repeats if its common prefix with a neighbour reaches `window`.
   Only the current column's order, symbols and prefixes are kept: suffixes of other columns can't match.
   Segments come in sequence from Spark's sorted shuffle files, in blocks of bounded size.
4. An anchor with more different segments than a block should hold (a passage in very many documents)
   is dealt out again by the hash of each of its windows, which counts the same strings.

Hashes of content have 64 bits within an anchor's 64 bits. Defined cases: a null text is empty; a text
shorter than a window loses nothing; repeated rows repeat each other's text, so they lose all of it that
is long enough; rows that share a doc_id are told apart by their text; tables without rows give none;
extra columns are carried by `deduplicated` and not read otherwise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from offsetledger.llm.shingles import mix
from offsetledger.llm.tables import Scratch

WINDOW = 400
#: Bytes of a text taken at once; longer texts go on from there, overlapping by a window.
PIECE = 1 << 22
#: Different segments of one anchor that are sorted in one block.
MAX_SEGMENTS = 20_000
#: Segments of a block, which may hold many anchors.
BLOCK = 8_000

_random = np.random.Generator(np.random.PCG64(7))
_BYTES = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_POS_BITS = np.uint64(23)

#: Bits of `place`: a segment's first window, then its last one and its anchor counted from there.
_PLACE_BITS = 12
_SEGMENTS = "key long, doc_id long, anchor long, content long, place long"
_CUT = "anchor long, key long, doc_id long, low long, at long, alone boolean, bytes binary"
_RANGES = "key long, doc_id long, low long, high long"
_HASHED = "anchor long, start int, hash long, key long, doc_id long, low long, alone boolean"


def gram_of(window: int) -> int:
    """Length of the strings whose least hash is an anchor: a power of two, up to a quarter of the window."""
    if not 4 <= window < 1 << _PLACE_BITS:
        raise ValueError(f"window={window}: use 4 to {(1 << _PLACE_BITS) - 1} bytes")
    return 1 << (window // 4).bit_length() - 1


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each string of `gram` bytes, by doubling the length."""
    value, length = _BYTES[data], 1
    while length < gram:
        value = mix(value[: len(value) - length] * np.uint64(0x9E3779B97F4A7C15) + (value[length:] ^ np.uint64(length)))
        length *= 2
    return value


def _window_least(value: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours, from running minima inside blocks of that width."""
    n = len(value) - width + 1
    padded = np.full(-(-len(value) // width) * width, np.iinfo(value.dtype).max, dtype=value.dtype)
    padded[: len(value)] = value
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def segments_of(raw: bytes, window: int) -> list[tuple[int, int, int, int, int]]:
    """(anchor, content, low, high, at): windows starting from low to high have their anchor at `at`."""
    found, gram = [], gram_of(window)
    for begin in range(0, max(len(raw) - window + 1, 0), PIECE):
        part = raw[begin : begin + PIECE + window - 1]
        hashes = _gram_hashes(np.frombuffer(part, dtype=np.uint8), gram)
        places = np.arange(len(hashes), dtype=np.uint64)
        # The hash above, the place below: of equal hashes the leftmost is least.
        ranked = (hashes >> _POS_BITS << _POS_BITS) | places
        at = (_window_least(ranked, window - gram + 1) & ((np.uint64(1) << _POS_BITS) - np.uint64(1))).astype(np.int64)
        lows = np.flatnonzero(np.diff(np.r_[-1, at]))
        highs = np.r_[lows[1:] - 1, len(at) - 1]
        anchors = hashes[at[lows]].view(np.int64)
        for anchor, low, high, place in zip(anchors.tolist(), lows.tolist(), highs.tolist(), at[lows].tolist()):
            seed = (place - low) << 32 | (high - low)
            content = xxhash.xxh3_64_intdigest(part[low : high + window], seed) - (1 << 63)
            found.append((anchor, content, begin + low, begin + high, begin + place))
    return found


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _to_segments(window: int) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [field.split()[0] for field in _SEGMENTS.split(", ")]
        for batch in batches:
            rows: list[tuple] = []
            for key, doc, text in zip(batch["key"].tolist(), batch["doc_id"].tolist(), batch["text"].tolist()):
                rows += [
                    (key, doc, anchor, content, (low << _PLACE_BITS | high - low) << _PLACE_BITS | at - low)
                    for anchor, content, low, high, at in segments_of(_bytes(text), window)
                ]
                if len(rows) > 50_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            yield pd.DataFrame(rows, columns=names)

    return run


def _to_bytes(window: int) -> Callable:
    """The bytes of each text's segments that are to be sorted."""
    schema = pa.schema(
        [("anchor", pa.int64()), ("key", pa.int64()), ("doc_id", pa.int64()), ("low", pa.int64()), ("at", pa.int64())]
        + [("alone", pa.bool_()), ("bytes", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for at in range(batch.num_rows):
                (row,) = batch.slice(at, 1).to_pylist()
                raw = _bytes(row["row"]["text"])
                for x in row["marked"]:
                    rows.append((x["anchor"], row["key"], row["id"], x["low"], x["at"], x["alone"], raw[x["low"] : x["high"] + window]))
                if len(rows) >= BLOCK or rows and at == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows = []

    return run


class Columns:
    """Column-wise sorting of a block of segments that are aligned at their anchors."""

    def __init__(self, group: np.ndarray, left: np.ndarray, texts: list[bytes], window: int) -> None:
        """`group`: number of each segment's anchor; `left`: bytes before the anchor."""
        self.window = window
        # Sorting small integers is linear.
        self.group = group.astype(np.uint16 if len(group) < 1 << 16 else np.int64)
        self.sizes = np.array([len(text) for text in texts])
        self.data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.first = -left  # the column of a segment's first byte; the anchor's is 0
        self.last = self.first + self.sizes - 1

    def repeated(self) -> Iterator[tuple[int, np.ndarray]]:
        """(column, segments whose window starting there also starts in another segment)."""
        order = np.zeros(0, dtype=np.int64)  # the BWT order of the suffixes that start in the last column
        prefix = np.zeros(0, dtype=np.int64)  # common prefix with the one before in that order
        by_last = np.argsort(-self.last, kind="stable")
        entering = 0
        for column in range(int(self.last.max()), int(self.first.min()) - 1, -1):
            begin = entering
            while entering < len(by_last) and self.last[by_last[entering]] == column:
                entering += 1
            keep = self.first[order] <= column
            if not keep.all():
                prefix = _least_since_kept(prefix, keep)
                order = order[keep]
            # New segments have an empty suffix so far: before all others, nothing in common.
            new = by_last[begin:entering]
            old = np.r_[new, order]
            before = np.r_[np.zeros(len(new) + (len(order) > 0), dtype=np.int64), prefix[1:]]
            if not len(old):
                continue
            symbol = self.data[self.begins[old] + column - self.first[old]]
            by_symbol = np.argsort(symbol, kind="stable")
            by_group = np.argsort(self.group[old][by_symbol], kind="stable")
            placed = by_symbol[by_group]
            order = old[placed]
            same = (self.group[order[1:]] == self.group[order[:-1]]) & (symbol[placed[1:]] == symbol[placed[:-1]])
            prefix = np.zeros(len(order), dtype=np.int64)
            at = np.flatnonzero(same)
            if len(at):
                prefix[at + 1] = 1 + _range_least(before, placed[at] + 1, placed[at + 1] + 1)
            long = prefix >= self.window
            if long.any():
                near = long | np.r_[long[1:], False]
                yield column, order[near]


def _least_since_kept(prefix: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """Prefixes of the kept ones with the kept one before: the least of those in between."""
    kept = np.flatnonzero(keep)
    if not len(kept):
        return prefix[:0]
    out = np.zeros(len(kept), dtype=np.int64)
    if len(kept) > 1:
        out[1:] = _range_least(prefix, kept[:-1] + 1, kept[1:] + 1)
    return out


def _range_least(value: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of value[low:high] for each pair of bounds."""
    bounds = np.empty(2 * len(low), dtype=np.int64)
    bounds[::2], bounds[1::2] = low, high
    return np.minimum.reduceat(np.append(value, 0), bounds)[::2]


def _ranges(block: pd.DataFrame, window: int) -> pd.DataFrame:
    """Removed runs [low, high) of the block's segments that occur only once."""
    group = np.unique(block["anchor"].to_numpy(), return_inverse=True)[1]
    texts = block["bytes"].tolist()
    left = (block["at"] - block["low"]).to_numpy()
    sort = Columns(group, left, texts, window)
    widest = int(sort.sizes.max()) - window + 1
    hit = np.zeros((len(block), widest + 1), dtype=bool)
    for column, found in sort.repeated():
        hit[found, column - sort.first[found]] = True
    hit[~block["alone"].to_numpy()] = False
    edge = np.diff(np.pad(hit, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, start = np.nonzero(edge == 1)
    end = np.nonzero(edge == -1)[1]
    low = block["low"].to_numpy()[row]
    return pd.DataFrame(
        {"key": block["key"].to_numpy()[row], "doc_id": block["doc_id"].to_numpy()[row], "low": low + start, "high": low + end - 1 + window}
    )


def _sort_blocks(window: int) -> Callable:
    """Blocks of whole anchors, in the order of the sorted partition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            batch["bytes"] = [bytes(b) for b in batch["bytes"]]
            held.append(batch)
            size += len(batch)
            if size >= BLOCK:
                rows = pd.concat(held, ignore_index=True)
                # The last anchor may go on in the next batch.
                whole = rows["anchor"].to_numpy() != rows["anchor"].iloc[-1]
                if whole.any():
                    yield _ranges(rows[whole].reset_index(drop=True), window)
                held = [rows[~whole]]
                size = len(held[0])
        if size:
            yield _ranges(pd.concat(held, ignore_index=True), window)

    return run


def _hash_windows(window: int) -> Callable:
    """Every window of a segment, by its place before the anchor and a hash of its content."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [field.split()[0] for field in _HASHED.split(", ")]
        for batch in batches:
            rows: list[tuple] = []
            for x in batch.itertuples(index=False):
                raw = bytes(x.bytes)
                for i in range(len(raw) - window + 1):
                    value = xxhash.xxh3_64_intdigest(raw[i : i + window]) - (1 << 63)
                    rows.append((x.anchor, i - (x.at - x.low), value, x.key, x.doc_id, x.low + i, x.alone))
                if len(rows) > 50_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            yield pd.DataFrame(rows, columns=names)

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    """Each row as a struct `row`, and what tells it apart: `id`, and a hash `key` of its text."""
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(-1))
    return docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("key"), number.alias("id"))


def repeated_ranges(docs: DataFrame, window: int = WINDOW, max_segments: int = MAX_SEGMENTS) -> DataFrame:
    """Bytes to remove as runs [low, high) per (id, key) of `_keyed`; runs may overlap.

    Only these runs stay on disk; the tables on the way to them are deleted.
    """
    with Scratch(docs.sparkSession) as scratch:
        return scratch.result(_repeated_ranges(docs, window, max_segments, scratch.written), "ranges")


def _repeated_ranges(docs: DataFrame, window: int, max_segments: int, written) -> DataFrame:
    keyed = _keyed(docs)
    texts = keyed.select("key", F.col("id").alias("doc_id"), F.col("row.text").alias("text"))
    segments = texts.where(F.octet_length("text") >= window).mapInPandas(_to_segments(window), _SEGMENTS)
    segments = written(segments, "segments")
    # Most anchors occur once; the others' segments are few.
    again = segments.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    segments = written(segments.join(again, "anchor", "left_semi"), "again")
    first = F.min(F.struct("doc_id", "key", "place")).alias("first")
    contents = segments.groupBy("anchor", "content").agg(F.count("*").alias("copies"), first)
    contents = contents.join(contents.groupBy("anchor").agg(F.count("*").alias("kinds")), "anchor")
    # Of a content that occurs several times, one occurrence takes part in the sort, for the others' sake.
    chosen = (F.struct("doc_id", "key", "place") == F.col("first")) & (F.col("kinds") > 1)
    marked = segments.join(contents, ["anchor", "content"])
    low, mask = F.shiftright("place", 2 * _PLACE_BITS), (1 << _PLACE_BITS) - 1
    high, at = low + F.shiftright("place", _PLACE_BITS).bitwiseAND(mask), low + F.col("place").bitwiseAND(mask)
    marked = marked.select("key", "doc_id", "anchor", low.alias("low"), high.alias("high"), at.alias("at"), "copies", "kinds", chosen.alias("sorted"))
    marked = written(marked.where("sorted or copies > 1"), "marked")

    ranges = marked.where("copies > 1").select("key", "doc_id", "low", (F.col("high") + window).alias("high"))
    sortable = marked.where("sorted").withColumn("x", F.struct("anchor", "low", "high", "at", (F.col("copies") == 1).alias("alone")))
    few = _cut(sortable.where(F.col("kinds") <= max_segments), keyed, window)
    few = few.repartition("anchor").sortWithinPartitions("anchor").mapInPandas(_sort_blocks(window), _RANGES)
    ranges = ranges.union(few)
    frequent = sortable.where(F.col("kinds") > max_segments)
    if not frequent.isEmpty():
        windows = written(_cut(frequent, keyed, window).mapInPandas(_hash_windows(window), _HASHED), "windows")
        again = windows.groupBy("anchor", "start", "hash").agg(F.count("*").alias("n")).where("n > 1").drop("n")
        found = windows.where("alone").join(again, ["anchor", "start", "hash"])
        ranges = ranges.union(found.select("key", "doc_id", "low", (F.col("low") + window).alias("high")))
    return ranges.withColumnRenamed("doc_id", "id")


def _cut(sortable: DataFrame, keyed: DataFrame, window: int) -> DataFrame:
    """The segments with their bytes."""
    by_doc = sortable.groupBy("key", F.col("doc_id").alias("id")).agg(F.collect_list("x").alias("marked"))
    return keyed.join(by_doc, ["key", "id"]).select("row", "key", "id", "marked").mapInArrow(_to_bytes(window), _CUT)


def _merged(runs: list) -> list[tuple[int, int]]:
    """Overlapping and touching runs as one."""
    out: list[list[int]] = []
    for low, high in sorted((run["low"], run["high"]) for run in runs):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [(low, high) for low, high in out]


def _kept(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    parts, end = [], 0
    for low, high in runs:
        parts.append(raw[end:low])
        end = high
    return b"".join([*parts, raw[end:]])


def _with_runs(docs: DataFrame, window: int, max_segments: int) -> DataFrame:
    """Each row as a struct `row`, and `runs`, null where nothing goes."""
    ranges = repeated_ranges(docs, window, max_segments)
    by_doc = ranges.groupBy("key", "id").agg(F.collect_set(F.struct("low", "high")).alias("runs"))
    return _keyed(docs).join(by_doc, ["key", "id"], "left").select("row", "runs")


def digests(docs: DataFrame, window: int = WINDOW, max_segments: int = MAX_SEGMENTS) -> DataFrame:
    """One row per document: sizes, and the hash and the text of what is left (whole characters of it)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                raw, runs = _bytes(row["row"]["text"]), _merged(row["runs"] or [])
                kept = _kept(raw, runs)
                sizes = (row["row"]["doc_id"], len(raw), len(raw) - len(kept), len(runs))
                out.append((*sizes, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
            columns = list(zip(*out)) or [[]] * 6
            arrays = [pa.array(c, pa.int64()) for c in columns[:4]] + [pa.array(c, pa.string()) for c in columns[4:]]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"])

    fields = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string"
    return _with_runs(docs, window, max_segments).mapInArrow(run, fields)


def deduplicated(docs: DataFrame, window: int = WINDOW, max_segments: int = MAX_SEGMENTS) -> DataFrame:
    """`docs` with the repeated bytes cut out of `text`; what a cut leaves of a character goes too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.struct_field(batch.column("row"), "text").to_pylist()
            for at, runs in enumerate(batch.column("runs").to_pylist()):
                if runs:
                    texts[at] = _kept(_bytes(texts[at]), _merged(runs)).decode("utf-8", "ignore")
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "left"])

    joined = _with_runs(docs, window, max_segments)
    cut = joined.mapInArrow(run, StructType([joined.schema["row"]]).add("left", StringType()))
    return cut.select(F.col("row").withField("text", F.col("left")).alias("row")).select("row.*")
