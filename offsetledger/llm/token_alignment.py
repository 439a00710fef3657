"""Alignment of two tokenizers' tokens over the same bytes, and how widely each pair of tokens is linked.

Both token lists of a text are described by the byte offsets where their tokens end. Where both end, a
group of tokens ends. Diagonal run skipping finds the groups: at the current shift between the two index
positions, blocks of the two end arrays are compared as bytes, a block twice as long after every match,
then half as long after a mismatch, so that a stretch of one-to-one groups is jumped over in a few
comparisons. The irregular group after it is resolved by stepping through whichever list ends first
until both end, and the shift is updated.

Tokens of a group are linked where their bytes overlap. Of every pair of ids linked in a text the texts are
counted, over the whole corpus: pairs are exploded next to the scan and pre-aggregated there, so that a pair
that every text has costs one row a task. The counts go back to the texts by a broadcast of the pairs if there
are few enough, by a shuffle if not (Spark splits its skewed keys). There are no more pairs than ids of the one
times ids of the other vocabulary.

Defined cases: a null or empty text has no tokens; so has one whose joined token bytes, of either tokenizer,
are not a space and the text (normalisation, or a mark that reads as a space); special tokens' strings in texts
are plain text; repeated rows and null ids are rows like others and count as texts of their own; a text is taken
whole, as one list of tokens, however long; a table without rows gives none; columns other than `doc_id` and
`text` are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offsetledger.llm.sentencepiece_codec import Model
from offsetledger.llm.tables import written

#: Texts taken at once, and chunks of text kept with their ids in a Python worker, about 300 bytes each.
CHUNK, MAX_CHUNKS = 128, 600_000
#: Pairs sent to all tasks, about 50 bytes each; beyond that both sides are shuffled.
MAX_BROADCAST_PAIRS = 1_000_000

_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<int>"
_MARK = "▁"


def _byte_level() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: itself if it is seen, else one from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in set(seen)]
    return {chr(byte): byte for byte in seen} | {chr(0x100 + at): byte for at, byte in enumerate(hidden)}


class Pair:
    """Two tokenizers and their tokens' bytes."""

    _loaded: dict[tuple[str, str], Pair] = {}

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks share the cores
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        model = Model.read(b_path)
        pieces = [piece for piece, _, _ in model.pieces]
        # Whether spaces part the second tokenizer's pieces: no normalisation, no piece that goes on over one or has a line feed.
        plain = not model.charsmap and not model.squeeze and model.dummy_prefix and model.escape
        self.apart = plain and not any(_MARK in piece.lstrip(_MARK) or "\n" in piece for piece in pieces)
        self.known: dict[str, tuple[bytes, bytes] | None] = {}
        byte_of, vocabulary = _byte_level(), self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, at in vocabulary.items():
            self.a_bytes[at] = bytes(byte_of[c] for c in token)
        self.b_bytes = [self._piece(at) for at in range(self.b.get_piece_size())]
        self.a_sizes = np.array([len(x) for x in self.a_bytes])
        self.b_sizes = np.array([len(x) for x in self.b_bytes])
        # The written form of each id with what follows it: inside or at the end of its side of a group.
        self.written = [f"{at}{end}" for n, ends in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;")) for end in ends for at in range(n)]

    @classmethod
    def of(cls, a_path: str, b_path: str) -> Pair:
        key = (a_path, b_path)
        if key not in cls._loaded:
            cls._loaded[key] = cls(a_path, b_path)
        return cls._loaded[key]

    def _piece(self, at: int) -> bytes:
        piece = self.b.id_to_piece(at)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(at) else piece.replace(_MARK, " ").encode()

    def _learn(self, chunks: set[str]) -> None:
        """Ids of chunks in both tokenizers; none where a chunk can't be told apart from its neighbours."""
        known = self.known
        if len(known) + len(chunks) > MAX_CHUNKS:
            known.clear()
        sound, apart = [], []
        for chunk in chunks:
            body = chunk.removeprefix("\n")
            (sound if body and not body[0].isspace() and not body[-1].isspace() else apart).append(chunk)
        known.update((chunk, None) for chunk in apart)
        for at in range(0, len(sound), 4096):
            some = sound[at : at + 4096]
            # A chunk of a line's begin stands without a space.
            found = self.a.encode_batch_fast([chunk if chunk[0] == "\n" else f" {chunk}" for chunk in some], add_special_tokens=False)
            for chunk, encoding, b in zip(some, found, self.b.encode(some, num_threads=1)):
                a, raw = encoding.ids, f" {chunk}".encode()
                if chunk[0] == "\n":  # the second tokenizer has put a space before it
                    raw = raw[1:]
                    b = b[1:] if self.b_bytes[b[0]] == b" " else []
                same = b"".join([self.a_bytes[x] for x in a]) == raw == b"".join([self.b_bytes[x] for x in b])
                known[chunk] = (np.array(a, dtype="<u4").tobytes(), np.array(b, dtype="<u4").tobytes()) if same else None

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of a space and the text in both; none where the tokens' bytes are not those.

        No token of either reaches over a space or line feed between two other characters, so chunks between those are
        encoded once and put together. A text with other white space at a chunk's edge, or whose chunks do not
        keep their bytes, is encoded as a whole.
        """
        none, known = np.zeros(0, dtype="<u4"), self.known
        split = [text.replace("\n", " \n").split(" ") if text and self.apart else None for text in texts]
        if new := {chunk for chunks in split if chunks for chunk in chunks if chunk not in known}:
            self._learn(new)
        for text, chunks in zip(texts, split):
            found = [known.get(chunk) for chunk in chunks] if chunks else [None]
            if text and None not in found and chunks[0][0] != "\n":
                yield tuple(np.frombuffer(b"".join(side), dtype="<u4") for side in zip(*found))
                continue
            a, b = (self.a.encode(f" {text}", add_special_tokens=False).ids, self.b.encode(text)) if text else ([], [])
            raw = f" {text}".encode()
            whole = text and b"".join([self.a_bytes[x] for x in a]) == raw and b"".join([self.b_bytes[x] for x in b]) == raw
            yield (np.array(a, dtype="<u4"), np.array(b, dtype="<u4")) if whole else (none, none)

    def group_text(self, a: np.ndarray, b: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray) -> str:
        """`a1,a2|b1;a3|b2,b3`: the ids of each group."""
        if not len(a_cuts):
            return ""
        out = np.empty(len(a) + len(b), dtype=np.int64)
        a_ends, b_ends = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
        a_ends[a_cuts - 1] = b_ends[b_cuts - 1] = 1
        a_group, b_group = np.cumsum(a_ends) - a_ends, np.cumsum(b_ends) - b_ends
        n_a, n_b = len(self.a_bytes), len(self.b_bytes)
        out[np.arange(len(a)) + np.r_[0, b_cuts[:-1]][a_group]] = a + a_ends * n_a
        out[np.arange(len(b)) + a_cuts[b_group]] = b + b_ends * n_b + 2 * n_a
        return "".join([self.written[x] for x in out.tolist()])[:-1]


def align(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[list[int], list[int], list[int], list[int]]:
    """Token counts of both sides up to each group's end, and the linked positions of both sides.

    Ends ascend and the last ones are equal.
    """
    a_raw, b_raw = a_ends.astype("<i8").tobytes(), b_ends.astype("<i8").tobytes()
    a_list, b_list = a_ends.tolist(), b_ends.tolist()
    n, m = len(a_list), len(b_list)
    a_cuts: list[int] = []
    b_cuts: list[int] = []
    a_links: list[int] = []
    b_links: list[int] = []
    i = j = 0
    while i < n:
        room = min(n - i, m - j)
        if a_list[i] == b_list[j]:
            # Exponential probing along the diagonal, then the rest of the last block by halves.
            done, step = 1, 1
            while done + step <= room and a_raw[8 * (i + done) : 8 * (i + done + step)] == b_raw[8 * (j + done) : 8 * (j + done + step)]:
                done += step
                step *= 2
            while step > 1:
                step //= 2
                if done + step <= room and a_raw[8 * (i + done) : 8 * (i + done + step)] == b_raw[8 * (j + done) : 8 * (j + done + step)]:
                    done += step
            a_links += range(i, i + done)
            b_links += range(j, j + done)
            i += done
            j += done
            a_cuts += range(i - done + 1, i + 1)
            b_cuts += range(j - done + 1, j + 1)
            if i >= n:
                break
        # An irregular group: until both lists end at one byte.
        a_end, b_end = a_list[i], b_list[j]
        while True:
            a_links.append(i)
            b_links.append(j)
            if a_end < b_end:
                i += 1
                a_end = a_list[i]
            elif a_end > b_end:
                j += 1
                b_end = b_list[j]
            else:
                break
        i += 1
        j += 1
        a_cuts.append(i)
        b_cuts.append(j)
    return a_cuts, b_cuts, a_links, b_links


def alignments(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per row of `docs`: its sizes, its `groups`, and its linked `pairs` with how many `times` each.

    A pair is a * (ids of the second vocabulary) + b; `pair_ids` takes it apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair.of(a_path, b_path)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                some = batch.slice(at, CHUNK)
                texts = [text or "" for text in some.column("text").to_pylist()]
                sizes, groups, pairs, times = [], [], [], []
                for ids in pair.encode(texts):
                    a, b = (x.astype(np.int64) for x in ids)
                    a_cuts, b_cuts, a_links, b_links = align(pair.a_sizes[a].cumsum(), pair.b_sizes[b].cumsum())
                    sizes.append((len(a), len(b), len(a_cuts), len(a_links)))
                    groups.append(pair.group_text(a, b, np.array(a_cuts, dtype=np.int64), np.array(b_cuts, dtype=np.int64)))
                    code, count = np.unique(a[a_links] * len(pair.b_bytes) + b[b_links] if a_links else a, return_counts=True)
                    pairs.append(code)
                    times.append(count.astype(np.int32))
                offsets = pa.array(np.cumsum([0, *map(len, pairs)]), pa.int32())
                columns = [some.column("doc_id"), *(pa.array(x, pa.int64()) for x in zip(*sizes)), pa.array(groups, pa.string())]
                columns += [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x))) for x in (pairs, times)]
                yield pa.RecordBatch.from_arrays(columns, [field.split()[0] for field in _ALIGNED.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _ALIGNED)


def pair_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """(pair, n_docs, best): how many texts have the pair linked, and whether none of its first id has more."""
    counts = written(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n_docs")), "pair-counts")
    first = F.expr(f"pair div {b_size}")
    most = counts.groupBy(first.alias("a")).agg(F.max("n_docs").alias("most"))
    return counts.withColumn("a", first).join(most, "a").select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def pair_ids(pairs: DataFrame, b_size: int) -> DataFrame:
    """`pairs` with the two ids, `a_id` and `b_id`, of column `pair`."""
    return pairs.withColumns({"a_id": F.expr(f"pair div {b_size}"), "b_id": F.col("pair") % b_size})


def digests(docs: DataFrame, a_path: str, b_path: str, max_broadcast: int = MAX_BROADCAST_PAIRS) -> DataFrame:
    """One row per document: sizes of its alignment, a hash of its groups, and its links' counts over the corpus."""
    b_size = len(Pair.of(a_path, b_path).b_bytes)
    hashed = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    sizes = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    aligned = alignments(docs, a_path, b_path).select(F.monotonically_increasing_id().alias("row"), *sizes, hashed, "pairs", "times")
    aligned = written(aligned, "aligned")
    counts = written(pair_counts(aligned, b_size), "pairs")
    if counts.count() <= max_broadcast:
        counts = F.broadcast(counts)
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select("row", "link.pairs", "link.times")
    summed = links.join(counts, links["pairs"] == counts["pair"]).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("long").alias("n_best"),
        F.sum(F.col("times") * F.col("n_docs")).alias("count_sum"),
    )
    zero = F.lit(0).cast("long")
    return aligned.join(summed, "row", "left").select(
        *sizes, F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"
    )
