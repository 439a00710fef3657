"""Packing documents into token windows, online, by the sum-of-squares rule.

A document's ids end with one closing id. Every full window's worth of a document becomes a window
of its own; the rest, shorter than a window, is placed whole into a partly filled window. Of all
fill levels that have a window with room (and an empty one), it goes to the level for which the
sum of squares of the numbers of windows at each fill level, full ones left out, comes out smallest.
Only that array of counts is searched, never the windows.

Each task packs the rows of its own input split, in their order, so nothing is shuffled and a
repeated task gives the same windows. Of what is still partly filled when a task ends, the fullest windows
stay, as many as all of it will fill; what the others hold is cut to fill the room in these, and the last, short
rest is cut into lengths that are powers of two, which need no padding. So there is no padding at all, and
at most one document is cut for each window left over.

Defined cases: a null or empty text is its closing id alone; repeated rows are packed each for
itself; a table without rows gives none; extra columns are not read.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 2048
END_ID = 1
#: Words kept in a Python worker's table of encoded words, about 250 bytes each.
MAX_WORDS = 1_000_000
#: Windows numbered by one task; the task's number stands above these bits.
_TASK_BITS = 36

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class WordEncoder:
    """Ids of a text, from a table of the ids of its words.

    Pre-tokenizers that never reach across a space let every word be encoded once, and words recur.
    New words of letters only are encoded many to a string and told apart by the end-of-word mark
    of their last id; all others are encoded one by one.
    """

    _loaded: dict[str, WordEncoder] = {}

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks share the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for token, at in vocabulary.items():
            self.ends[at] = token.endswith("</w>")
        self.known: dict[str, bytes] = {"": b""}
        capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        normalizer = self.tokenizer.normalizer
        self.folds = normalizer is not None and normalizer.normalize_str(capitals) == capitals.lower()

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4") for x in found]

    def _learn(self, words: set[str]) -> None:
        known = self.known
        if len(known) + len(words) > MAX_WORDS:
            known.clear()
            known[""] = b""
        marked = [w for w in words if w[-1] in ",." and w[:-1].isalpha()]
        bodies = {w for w in words if w.isalpha()}.union(w[:-1] for w in marked if w[:-1] not in known)
        # Where the vocabulary has no capitals, a word with some is encoded as the one without.
        lower = {w: w.lower() for w in bodies if w.isascii()} if self.folds else {}
        plain = list({lower.get(w, w) for w in bodies}.difference(known))
        for at in range(0, len(plain), 512):
            some = plain[at : at + 512]
            ids = self._encode([" ".join(some)])[0]
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(some):
                raw, begin = ids.tobytes(), 0
                for word, stop in zip(some, (4 * stops).tolist()):
                    known[word] = raw[begin:stop]
                    begin = stop
            else:  # a letter that the vocabulary takes apart
                known.update((w, x.tobytes()) for w, x in zip(some, self._encode(some)))
        known.update((w, known[low]) for w, low in lower.items())
        for mark in ",.":
            if mark not in known:
                known[mark] = self._encode([mark])[0].tobytes()
        for word in marked:
            known[word] = known[word[:-1]] + known[word[-1]]
        rest = [w for w in words if w not in known]
        for at in range(0, len(rest), 4096):
            some = rest[at : at + 4096]
            known.update((w, x.tobytes()) for w, x in zip(some, self._encode(some)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids, little-endian and four bytes each."""
        out: list[bytes | None] = []
        missing: set[str] = set()
        again: list[int] = []
        get = self.known.get
        for at, text in enumerate(texts):
            words = text.replace("\n", " ").split(" ")
            found = list(map(get, words))
            if None in found:
                missing.update(word for word, ids in zip(words, found) if ids is None)
                again.append(at)
                out.append(None)
            else:
                out.append(b"".join(found))
        if missing:
            self._learn(missing)
        for at in again:
            found = list(map(get, texts[at].replace("\n", " ").split(" ")))
            # A word may be gone again if the table was emptied for this batch.
            out[at] = self._encode([texts[at]])[0].tobytes() if None in found else b"".join(found)
        return out


class Levels:
    """Partly filled windows by fill level, and the choice of a level for a piece."""

    def __init__(self, window: int) -> None:
        self.window = window
        self.counts = np.zeros(window + 1, dtype=np.int64)
        self.open: dict[int, list] = defaultdict(list)

    def choose(self, size: int) -> int:
        """The fill level to put `size` ids on; 0 opens a window. Ties go to the fullest."""
        top = self.window - size
        from_level = self.counts[: top + 1]
        to_level = self.counts[size:].copy()
        to_level[top] = 0  # a full window counts nowhere
        change = 2 * (to_level - from_level) + 2
        change[0] = 2 * to_level[0] + 1
        change[top] = 1 if top == 0 else 1 - 2 * from_level[top]
        change[1:][from_level[1:] == 0] = np.iinfo(np.int64).max
        return int(top - np.argmin(change[::-1]))

    def place(self, size: int, piece) -> list | None:
        """Put a piece on a window; the window's pieces if that fills it."""
        level = self.choose(size)
        pieces = []
        if level:
            pieces = self.open[level].pop()
            self.counts[level] -= 1
        pieces.append(piece)
        if level + size == self.window:
            return pieces
        self.open[level + size].append(pieces)
        self.counts[level + size] += 1
        return None

    def left(self) -> list[tuple[int, list]]:
        """Fill level and pieces of every open window, the fullest first."""
        return [(level, pieces) for level in sorted(self.open, reverse=True) for pieces in self.open[level]]


def _pack_split(batches: Iterator[pd.DataFrame], path: str, window: int, split: int) -> Iterator[pd.DataFrame]:
    encoder, levels = WordEncoder.of(path), Levels(window)
    closing = END_ID.to_bytes(4, "little")
    next_sequence = split << _TASK_BITS
    rows: list[tuple] = []

    def emit(pieces: list) -> None:
        nonlocal next_sequence
        offset = 0
        for doc, start, ids, tokens in pieces:
            rows.append((doc, start, len(ids) // 4, zlib.crc32(ids), tokens, next_sequence, offset))
            offset += len(ids) // 4
        next_sequence += 1

    def drain() -> pd.DataFrame:
        names = [c.split()[0] for c in PIECES.split(", ")]
        out = pd.DataFrame(rows, columns=names).astype({n: "Int64" for n in names})
        rows.clear()
        return out

    for batch in batches:
        for at in range(0, len(batch), 256):
            some = batch.iloc[at : at + 256]
            texts = ["" if text is None else text for text in some["text"].tolist()]
            for doc, ids in zip(some["doc_id"].tolist(), encoder.encode(texts)):
                doc = None if pd.isna(doc) else int(doc)
                ids += closing
                tokens = len(ids) // 4
                whole = tokens - tokens % window
                for start in range(0, whole, window):
                    emit([(doc, start, ids[4 * start : 4 * (start + window)], tokens)])
                if tokens > whole:
                    full = levels.place(tokens - whole, (doc, whole, ids[4 * whole :], tokens))
                    if full:
                        emit(full)
        if rows:
            yield drain()

    # The fullest open windows stay as they are, as many as all that is left will fill; the others fill their room.
    left = levels.left()
    remaining = sum(fill for fill, _ in left)
    kept, others = left[: remaining // window], left[remaining // window :]
    donated = _Cutter([piece for _, pieces in others for piece in pieces])
    for fill, pieces in kept:
        emit(pieces + donated.take(window - fill))
    remaining %= window
    while remaining:
        emit(donated.take(_power(remaining)))
        remaining -= _power(remaining)
    if rows:
        yield drain()


class _Cutter:
    """Pieces laid end to end, to be taken off in any lengths."""

    def __init__(self, pieces: list) -> None:
        self.pieces = pieces[::-1]

    def take(self, length: int) -> list:
        out = []
        while length:
            doc, start, ids, tokens = self.pieces.pop()
            n = min(len(ids) // 4, length)
            out.append((doc, start, ids[: 4 * n], tokens))
            if 4 * n < len(ids):
                self.pieces.append((doc, start + n, ids[4 * n :], tokens))
            length -= n
        return out


def _power(n: int) -> int:
    """The largest power of two up to n."""
    return 1 << (n.bit_length() - 1) if n else 0


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW) -> DataFrame:
    """One row per piece; `sequence_id` and `offset` place it, its ids are `length` from `start` on."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _pack_split(batches, tokenizer_path, window, TaskContext.get().partitionId())

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, PIECES)
