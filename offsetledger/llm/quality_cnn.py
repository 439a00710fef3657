"""A byte-level convolutional network for text quality, in numpy.

Bytes are embedded, and learned filters run over overlapping chunks that cover the whole document.
Each filter's strongest answer in each chunk is kept (max-pooling); the mean, the least and the
greatest of these over a document's chunks are combined into one probability.

It is trained on the driver on a bounded sample of labelled rows (`Training.docs_per_label` documents
of each label, at most `Training.chunks_per_doc` evenly spread chunks of each), the same one for the
same tables. Labels of held-out documents, those whose crc32 of the id as text is divisible by five,
are never read. Scores are made in the tasks, for every byte of every text.

Defined cases: a null text counts as empty, and an empty one is a chunk of zero bytes, which has a
score like any other; a null doc_id is not held out, and its label is not used; repeated rows are scored
each for itself; without training rows of both labels every score is 0.5; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from offsetledger.llm.tables import drawn

CHUNK, OVERLAP = 512, 64
WIDTH, STRIDE, EMBED, FILTERS = 8, 4, 8, 48
THRESHOLD = 0.3
_STEP = CHUNK - OVERLAP


@dataclass(frozen=True)
class Training:
    docs_per_label: int = 800
    chunks_per_doc: int = 12
    epochs: int = 10
    batch: int = 32
    rate: float = 0.004
    seed: int = 11


def chunk_starts(size: int) -> np.ndarray:
    """Starts of the chunks that cover `size` bytes; the last one ends with the text."""
    if size <= CHUNK:
        return np.zeros(1, dtype=np.int64)
    return np.append(np.arange(0, size - CHUNK, _STEP), size - CHUNK)


def chunks_of(text: str | None, most: int | None = None) -> np.ndarray:
    """The chunks as rows of bytes; with `most`, that many, evenly spread."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if len(data) < CHUNK:
        data = np.pad(data, (0, CHUNK - len(data)))
    starts = chunk_starts(len(data))
    if most and len(starts) > most:
        starts = starts[np.linspace(0, len(starts) - 1, most).astype(np.int64)]
    return np.lib.stride_tricks.sliding_window_view(data, CHUNK)[starts]


class ByteNet:
    """The network's weights, its forward pass and one step of training."""

    def __init__(self, seed: int) -> None:
        random = np.random.default_rng(seed)
        self.embed = random.normal(0, 0.5, (256, EMBED)).astype(np.float32)
        self.embed[0] = 0
        self.filters = random.normal(0, 1 / np.sqrt(WIDTH * EMBED), (WIDTH * EMBED, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, dtype=np.float32)
        self.out = random.normal(0, 0.05, 3 * FILTERS).astype(np.float32)
        self.shift = np.zeros(1, dtype=np.float32)

    def weights(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.out, self.shift]

    def _windows(self, chunks: np.ndarray) -> np.ndarray:
        """The embedded bytes under each filter position: (chunk, position, width * embed)."""
        bytes_under = np.lib.stride_tricks.sliding_window_view(chunks, WIDTH, axis=1)[:, ::STRIDE]
        return self.embed[bytes_under].reshape(len(chunks), bytes_under.shape[1], -1)

    def pooled(self, chunks: np.ndarray) -> np.ndarray:
        """Each filter's strongest answer per chunk."""
        return np.maximum((self._windows(chunks) @ self.filters).max(axis=1) + self.bias, 0)

    def combine(self, mean: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(np.concatenate([mean, least, most], axis=1) @ self.out + self.shift[0])))

    def gradients(self, chunks: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        windows = self._windows(chunks)
        answers = windows @ self.filters
        at = answers.argmax(axis=1)
        raw = np.take_along_axis(answers, at[:, None], axis=1)[:, 0] + self.bias
        pooled = np.maximum(raw, 0)
        ends = np.cumsum(counts)
        begins = ends - counts
        doc_of = np.repeat(np.arange(len(counts)), counts)
        mean = np.add.reduceat(pooled, begins) / counts[:, None]
        least = np.minimum.reduceat(pooled, begins)
        most = np.maximum.reduceat(pooled, begins)
        error = (self.combine(mean, least, most) - labels) / len(labels)
        g_out = np.concatenate([mean, least, most], axis=1).T @ error
        w_mean, w_least, w_most = self.out.reshape(3, FILTERS)
        back = (error[:, None] * w_mean / counts[:, None])[doc_of]
        back += (error[:, None] * w_least)[doc_of] * (pooled == least[doc_of])
        back += (error[:, None] * w_most)[doc_of] * (pooled == most[doc_of])
        back *= raw > 0
        g_filters = np.zeros_like(self.filters)
        g_embed = np.zeros_like(self.embed)
        rows = np.arange(len(chunks))
        for f in range(FILTERS):
            used = np.flatnonzero(back[:, f])
            if not len(used):
                continue
            weight = back[used, f]
            g_filters[:, f] = weight @ windows[rows[used], at[used, f]]
            # Summed weight of each byte under each place of the filter.
            under = chunks[used[:, None], at[used, f, None] * STRIDE + np.arange(WIDTH)] + 256 * np.arange(WIDTH)
            summed = np.bincount(under.ravel(), np.repeat(weight, WIDTH), 256 * WIDTH).reshape(WIDTH, 256)
            g_embed += (summed.T @ self.filters[:, f].reshape(WIDTH, EMBED)).astype(np.float32)
        g_embed[0] = 0
        return [g_embed, g_filters, back.sum(axis=0), g_out, np.array([error.sum()])]


def fit(examples: list[tuple[np.ndarray, int]], prior: float, training: Training) -> ByteNet:
    """Adam over shuffled batches, both labels alike; then the shift is set for the labels' true share."""
    net, random = ByteNet(training.seed), np.random.default_rng(training.seed)
    first = [np.zeros_like(w) for w in net.weights()]
    second = [np.zeros_like(w) for w in net.weights()]
    steps, total = 0, training.epochs * -(-len(examples) // training.batch)
    for _ in range(training.epochs):
        order = random.permutation(len(examples))
        for begin in range(0, len(order), training.batch):
            some = [examples[i] for i in order[begin : begin + training.batch]]
            labels = np.array([label for _, label in some], dtype=np.float32)
            counts = np.array([len(c) for c, _ in some])
            steps += 1
            rate = training.rate * (1 - steps / (total + 1))
            found = net.gradients(np.concatenate([c for c, _ in some]), counts, labels)
            for w, g, m, v in zip(net.weights(), found, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.999**steps)) + 1e-7)
    share = sum(label for _, label in examples) / len(examples)
    net.shift += np.float32(np.log(prior / (1 - prior)) - np.log(share / (1 - share)))
    return net


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, training: Training = Training()) -> ByteNet | None:
    """A network fitted to a bounded sample of the labelled documents that are not held out."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    usable = usable.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {row.quality: row["count"] for row in usable.groupBy("quality").count().collect()}
    if len(counts) < 2:
        return None
    bad, good = (drawn(usable.where(F.col("quality") == q), training.docs_per_label, training.seed, "doc_id") for q in (0, 1))
    sample = bad.union(good).distinct()  # at most twice docs_per_label short rows

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cuts = [chunks_of(text, training.chunks_per_doc).tobytes() for text in batch["text"]]
            yield batch[["doc_id", "quality"]].assign(chunks=cuts)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    # Of rows that share an id one text counts, so no more come back than ids were drawn.
    texts = texts.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    rows = texts.mapInPandas(cut, "doc_id long, quality int, chunks binary").collect()
    rows.sort(key=lambda row: (row.doc_id, row.quality, bytes(row.chunks)))
    if len({row.quality for row in rows}) < 2:
        return None
    examples = [(np.frombuffer(row.chunks, dtype=np.uint8).reshape(-1, CHUNK), row.quality) for row in rows]
    return fit(examples, counts[1] / (counts[0] + counts[1]), training)


def _score_texts(net: ByteNet, texts: list, at_once: int = 256) -> np.ndarray:
    """Scores of whole texts; chunks of several texts go through the network together."""
    total = np.zeros((len(texts), FILTERS), dtype=np.float64)
    least = np.full((len(texts), FILTERS), np.inf, dtype=np.float32)
    most = np.zeros((len(texts), FILTERS), dtype=np.float32)
    counts = np.zeros(len(texts), dtype=np.int64)
    waiting: list[tuple[int, np.ndarray]] = []

    def run() -> None:
        pooled = net.pooled(np.concatenate([c for _, c in waiting]))
        sizes = np.array([len(c) for _, c in waiting])
        begins = np.cumsum(sizes) - sizes
        for (at, _), begin, size in zip(waiting, begins, sizes):
            own = pooled[begin : begin + size]
            total[at] += own.sum(axis=0)
            least[at] = np.minimum(least[at], own.min(axis=0))
            most[at] = np.maximum(most[at], own.max(axis=0))
            counts[at] += size
        waiting.clear()

    held = 0
    for at, text in enumerate(texts):
        chunks = chunks_of(text)
        for begin in range(0, len(chunks), at_once):
            part = chunks[begin : begin + at_once]
            if held + len(part) > at_once:
                run()
                held = 0
            waiting.append((at, part))
            held += len(part)
    if waiting:
        run()
    return net.combine((total / counts[:, None]).astype(np.float32), least, most)


def score(docs: DataFrame, net: ByteNet | None) -> DataFrame:
    """`docs` with columns `score` and `predicted` after its own (which must not have these names)."""
    fields = ", ".join(f"`{name}` {kind}" for name, kind in docs.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.full(len(batch), 0.5) if net is None else _score_texts(net, batch["text"].tolist())
            found = found.astype(np.float64)
            yield batch.assign(score=found, predicted=(found >= THRESHOLD).astype(np.int32))

    return docs.mapInPandas(run, f"{fields}, score double, predicted int")


def quality_scores(docs: DataFrame, labels: DataFrame, training: Training = Training()) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    net = train(docs, labels, training)
    scored = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), net)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def kept_documents(docs: DataFrame, labels: DataFrame, training: Training = Training()) -> DataFrame:
    """The rows of `docs` that are predicted good, with their columns as they were."""
    return kept_by(docs, train(docs, labels, training))


def kept_by(docs: DataFrame, net: ByteNet | None) -> DataFrame:
    """The rows of `docs` that a network trained elsewhere predicts to be good."""
    packed = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = np.full(len(texts), 0.5) if net is None else _score_texts(net, texts)
            yield batch.select(["row"]).filter(pa.array(found >= THRESHOLD))

    kept = packed.mapInArrow(run, StructType([packed.schema["row"]]))
    return kept.select("row.*").toDF(*docs.columns)
