"""SentencePiece models run by the tokenizers library.

The model's protobuf is read here, field by field, and rebuilt: normaliser, the mark for spaces, pieces
with their scores (unigram models) or the merges that they imply (BPE models), and byte fallback. New words
are encoded in multithreaded batches and kept, as words recur; every text's ids are compared with
those of the SentencePiece library itself.

Defined cases: a null text counts as empty and has no ids; repeated rows are encoded each for itself; tables
without rows give none; extra columns are not read.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Words kept in a Python worker's table.
MAX_WORDS = 1_000_000
THREADS = 2


# --- the model file -------------------------------------------------------------------


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            size = varint()
            at += size
            yield key >> 3, data[at - size : at]
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            at += size
            yield key >> 3, data[at - size : at]
        else:
            raise ValueError(f"wire type {kind} in a model file")


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True

    @classmethod
    def read(cls, path: str) -> Model:
        model = cls()
        with open(path, "rb") as file:
            for number, value in _fields(file.read()):
                if number == 1:
                    own = dict(_fields(value))
                    score = struct.unpack("<f", own.get(2, b"\0\0\0\0"))[0]
                    model.pieces.append((own.get(1, b"").decode(), score, own.get(3, NORMAL)))
                elif number == 2:
                    own = dict(_fields(value))
                    model.kind, model.byte_fallback = own.get(3, UNIGRAM), bool(own.get(35, 0))
                elif number == 3:
                    own = dict(_fields(value))
                    model.charsmap = own.get(2, b"")
                    model.dummy_prefix, model.squeeze, model.escape = (bool(own.get(n, 1)) for n in (3, 4, 5))
        return model

    def id_of(self, kind: int) -> int | None:
        return next((at for at, piece in enumerate(self.pieces) if piece[2] == kind), None)


def build(model: Model):
    """The same tokenizer in the tokenizers library."""
    os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    unknown = model.id_of(UNKNOWN)
    if model.kind == UNIGRAM:
        core = models.Unigram([(piece, score) for piece, score, _ in model.pieces], unknown, model.byte_fallback)
    elif model.kind == BPE:
        ids = {piece: at for at, (piece, _, _) in enumerate(model.pieces)}
        joinable = {piece for piece, _, kind in model.pieces if kind in (NORMAL, USER)}
        # The best-scored pair of neighbours is merged first; of one piece's splits, the first known one.
        ranked = sorted((-score, ids[piece], piece) for piece, score, kind in model.pieces if kind == NORMAL and len(piece) > 1)
        merges = [
            (piece[:cut], piece[cut:]) for _, _, piece in ranked for cut in range(1, len(piece)) if piece[:cut] in joinable and piece[cut:] in joinable
        ]
        core = models.BPE(ids, merges, unk_token=model.pieces[unknown][0], fuse_unk=True, byte_fallback=model.byte_fallback)
    else:
        raise ValueError("only unigram and BPE models are read")
    tokenizer = Tokenizer(core)
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.squeeze:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK if model.escape else " "))
    if model.escape:
        steps.append(normalizers.Replace(" ", MARK))
    if steps:
        tokenizer.normalizer = normalizers.Sequence(steps)
    if model.escape and not any(MARK in piece.lstrip(MARK) for piece, _, _ in model.pieces):
        # No piece goes on over a mark, so words can be encoded by themselves.
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*"), "isolated")
    strip = [decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *strip])
    tokenizer.add_special_tokens([AddedToken(p, normalized=False, special=True) for p, _, kind in model.pieces if kind == USER])
    return tokenizer


class Codec:
    """Encodes and decodes batches of texts with one model."""

    _loaded: dict[str, Codec] = {}

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = Model.read(path)
        self.tokenizer = build(self.model)
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.by_word = self.tokenizer.pre_tokenizer is not None and not any(kind == USER for _, _, kind in self.model.pieces)
        pieces = [self._bytes(*piece) for piece in self.model.pieces]
        self.sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        self.opens = np.array([p.startswith(MARK) for p, _, _ in self.model.pieces])
        self.known: dict[str, bytes] = {}
        self.normalizer = self.tokenizer.normalizer
        # Only the mark and the spaces: no character changes.
        self.plain = not self.model.charsmap and not self.model.squeeze and self.model.dummy_prefix and self.model.escape

    @classmethod
    def of(cls, path: str) -> Codec:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    @staticmethod
    def _bytes(piece: str, score: float, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == CONTROL:
            return b""
        return " ⁇ ".encode() if kind == UNKNOWN else piece.replace(MARK, " ").encode()

    def _learn(self, words: set[str]) -> None:
        """Encode words (each with its marks) in large batches."""
        if len(self.known) + len(words) > MAX_WORDS:
            self.known.clear()
        simple = [w for w in words if w[0] == MARK and MARK not in w[1:] and len(w) > 1]
        texts = ["".join(simple[at : at + 256]) for at in range(0, len(simple), 256)]
        for at, ids in enumerate(self._encode_raw(texts)):
            some = simple[256 * at : 256 * (at + 1)]
            starts = np.flatnonzero(self.opens[ids])
            if len(starts) == len(some):
                raw, cuts = ids.tobytes(), [*(4 * starts).tolist(), 4 * len(ids)]
                self.known.update((w, raw[a:b]) for w, a, b in zip(some, cuts, cuts[1:]))
            else:
                self.known.update((w, x.tobytes()) for w, x in zip(some, self._encode_raw(some)))
        rest = [w for w in words if w not in self.known]
        self.known.update((w, x.tobytes()) for w, x in zip(rest, self._encode_raw(rest)))

    def _encode_raw(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts that are normalised already."""
        normalizer, self.tokenizer.normalizer = self.tokenizer.normalizer, None
        found = [np.array(x.ids, dtype="<u4") for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        self.tokenizer.normalizer = normalizer
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids, little-endian, four bytes each."""
        if not self.by_word:
            return [np.array(x.ids, dtype="<u4").tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        words = []
        for text in texts:
            if self.plain:
                normal = MARK + text.replace(" ", MARK) if text else ""
            else:
                normal = self.normalizer.normalize_str(text)
            head = normal[: len(normal) - len(normal.lstrip(MARK))]
            parts = normal[len(head) :].split(MARK)
            if "" in parts[1:]:  # several marks in a row belong to the word after them
                parts = re.findall(f"{MARK}+[^{MARK}]*|[^{MARK}]+", normal)
            elif normal:
                parts = [head + parts[0], *[MARK + part for part in parts[1:]]]
            else:
                parts = []
            words.append(parts)
        known, out = self.known, []
        if new := {word for word in set().union(*words) if word not in known}:
            self._learn(new)
        for parts in words:
            try:
                out.append(b"".join([known[part] for part in parts]))
            except KeyError:
                self._learn({part for part in parts if part not in known})
                out.append(b"".join([known[part] for part in parts]))
        return out

    def decode(self, ids: bytes) -> str:
        """The text of ids: pieces as bytes, marks as spaces, without the leading one."""
        at = np.frombuffer(ids, dtype="<u4")
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        if not len(at):
            return ""
        source = np.arange(ends[-1]) + np.repeat(self.begins[at] - (ends - sizes), sizes)
        text = self.data[source].tobytes().decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


# --- over tables ----------------------------------------------------------------------


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids of every text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec.of(path)
        for batch in batches:
            for at in range(0, len(batch), 256):
                some = batch.iloc[at : at + 256]
                found = codec.encode([text or "" for text in some["text"].tolist()])
                yield pd.DataFrame({"doc_id": some["doc_id"].to_numpy(), "ids": [np.frombuffer(x, dtype="<u4").astype(np.int32) for x in found]})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of every array of ids; a null array gives a null text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec.of(path)
        for batch in batches:
            texts = [None if ids is None else codec.decode(np.asarray(ids, dtype="<u4").tobytes()) for ids in batch["ids"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text": texts})

    return encoded.select("doc_id", "ids").mapInPandas(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: its number of ids, their checksum, whether the library gives the same, whether they decode to the text.

    Where normalisation changes a text (a leading mark, say), it does not decode to itself.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec.of(path)
        for batch in batches:
            for at in range(0, len(batch), 256):
                some = batch.iloc[at : at + 256]
                texts = [text or "" for text in some["text"].tolist()]
                found = codec.encode(texts)
                same = [np.array(codec.library.encode(text), dtype="<u4").tobytes() == ids for text, ids in zip(texts, found)]
                back = [codec.decode(ids) == text for text, ids in zip(texts, found)]
                sums = [zlib.crc32(ids) for ids in found]
                yield pd.DataFrame(
                    {"doc_id": some["doc_id"].to_numpy(), "n_ids": [len(x) // 4 for x in found], "ids_crc32": sums, "parity": same, "round_trip": back}
                )

    fields = "doc_id long, n_ids long, ids_crc32 long, parity boolean, round_trip boolean"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, fields)
