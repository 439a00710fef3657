"""Hashed word shingles of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from offsetledger.llm.tables import SPACES

WIDTH = 5
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_random = np.random.Generator(np.random.PCG64(20240601))
_BYTES = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTES[65:91] = _BYTES[97:123]  # A-Z as a-z
_PLACES = _random.integers(1, 1 << 63, WIDTH, dtype=np.uint64) | np.uint64(1)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[ord(c) for c in SPACES]] = True

_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A finishing step that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 1 << 20)
        _powers = np.multiply.accumulate(np.r_[np.uint64(1), np.full(size, _BASE)])
        _inverses = np.multiply.accumulate(np.r_[np.uint64(1), np.full(size, _INVERSE)])
    return _powers, _inverses


def blocks(texts: list, chars: int = 1 << 20) -> Iterator[slice]:
    """Slices of `texts` of about so many characters; a longer text is a slice of its own."""
    begin = total = 0
    for at, text in enumerate(texts):
        size = len(text or "")
        if at > begin and total + size > chars:
            yield slice(begin, at)
            begin, total = at, 0
        total += size
    if begin < len(texts):
        yield slice(begin, len(texts))


def shingles(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(index of the text, hash) of each word shingle, texts in order, repeats included.

    A-Z count as a-z. A text of one to four words has its whole sequence as its one shingle.
    """
    raw = [(text or "").encode("utf-8", "surrogatepass") for text in texts]
    begins = np.cumsum([0] + [len(x) + 1 for x in raw[:-1]]) if raw else np.zeros(0, dtype=np.int64)
    data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    space = _IS_SPACE[data]
    edge = np.flatnonzero(np.diff(np.r_[True, space].astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    powers, inverses = _tables(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.r_[np.uint64(0), np.cumsum(_BYTES[data] * powers[: len(data)], dtype=np.uint64)]
        words = mix((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))
        text_of = np.searchsorted(begins, starts, side="right") - 1
        n = len(words)
        value = np.zeros(max(n - WIDTH + 1, 0), dtype=np.uint64)
        for at in range(WIDTH):
            value += words[at : at + len(value)] * _PLACES[at]
        whole = text_of[: len(value)] == text_of[WIDTH - 1 :] if len(value) else np.zeros(0, dtype=bool)
        owner, value = text_of[: len(value)][whole], mix(value[whole])
        first, count = np.unique(text_of, return_index=True, return_counts=True)[1:]
        few = count < WIDTH
        if few.any():
            short = [
                mix(np.array([(words[f : f + c] * _PLACES[:c]).sum(dtype=np.uint64) + np.uint64(c)]))[0]
                for f, c in zip(first[few].tolist(), count[few].tolist())
            ]
            owner = np.r_[owner, text_of[first[few]]]
            value = np.r_[value, np.array(short, dtype=np.uint64)]
    return owner, value


def distinct(owner: np.ndarray, value: np.ndarray, rank: np.ndarray | None = None):
    """Sorted by text, then `rank` of the shingle where given, then hash; each shingle once."""
    order = np.lexsort((value, owner) if rank is None else (value, rank, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return owner[new], value[new]
