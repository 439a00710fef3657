"""Exact top-k by inner product: norm-sorted scan with partial sums and Cauchy-Schwarz bounds.

Components are integers, floor(scale * x). Candidates are read by descending length. Vectors are rotated by
the right singular vectors of all of them, so that a few leading components hold most of a product;
these are multiplied first, and what is left of a product is at most the product of the two rests'
lengths. A candidate that can't reach a query's k-th best score so far is left out, and a query is
done when even the length of the next candidate is too small. Scores are exact integers.

Queries go in groups against slices of the candidates: a task holds one group and streams the slice's
candidates through it. A group's queries start from the k-th best score among the `HEAD` longest
candidates. Only groups and the head, both of fixed size, are ever held whole.

Defined cases: vectors that are null or hold null or non-finite components take no part, nor do rows without an
id; shorter vectors count as padded with zeros; an empty vector scores 0 with all; rows with the query's
id are the query's own; rows that repeat id and vector count once; extra columns are not read. A score
that does not fit a long is an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offsetledger.llm.tables import written

SCALE = 256
#: Longest candidates from which the first bounds come.
HEAD = 4096
#: Queries of a group, and candidates that a slice is meant to have.
GROUP, SLICE = 200_000, 500_000
#: Bytes of a group's numbers, three times over in a task; with many components a group has fewer queries.
GROUP_BYTES = 256 << 20
#: Tasks that add up the others' statistics.
ADDERS = 32
#: Queries and candidates multiplied at once.
_ROWS, _COLUMNS = 1024, 2048

_STATS = "sums binary, dims int, most double, n long"
_VECTORS = "vec_id long, length double, vector binary"
_FOUND = "query_id long, own long, score long, vec_id long"


def _integers(column: pd.Series, dims: int) -> np.ndarray:
    """Rows of floor(scale * x), padded to `dims`."""
    out = np.zeros((len(column), dims))
    for at, vector in enumerate(column):
        out[at, : len(vector)] = vector
    return np.floor(out * SCALE)


def _statistics(dims: int):
    """Sums of products of components, their greatest size, and the number of rows, per task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, most, n = np.zeros((dims, dims)), 0.0, 0
        for batch in batches:
            x = _integers(batch["v"], dims)
            sums += x.T @ x
            most = max(most, np.abs(x).max(initial=0))
            n += len(x)
        yield pd.DataFrame({"sums": [sums.tobytes()], "dims": [dims], "most": [most], "n": [n]})

    return run


def _added(dims: int):
    """The statistics of several tasks as one row; of no task as zeros."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, most, n = np.zeros((dims, dims)), 0.0, 0
        for batch in batches:
            for raw in batch["sums"]:
                sums += np.frombuffer(raw).reshape(dims, dims)
            most, n = max(most, batch["most"].max()) if len(batch) else most, n + int(batch["n"].sum())
        yield pd.DataFrame({"sums": [sums.tobytes()], "dims": [dims], "most": [most], "n": [n]})

    return run


def _pack(dims: int, kind: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _integers(batch["v"], dims)
            rows = x.astype(kind)
            yield pd.DataFrame({"vec_id": batch["vec_id"], "length": np.sqrt((x * x).sum(axis=1)), "vector": [row.tobytes() for row in rows]})

    return run


class Search:
    """One group of queries and their best scores so far."""

    def __init__(self, rotation: np.ndarray, kind: str, exact: bool, k: int, lead: int) -> None:
        self.rotation, self.kind, self.exact, self.k, self.lead = rotation, kind, exact, k, lead

    def _unpack(self, rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        vectors = np.frombuffer(b"".join(map(bytes, rows["vector"])), dtype=self.kind).reshape(len(rows), -1)
        values = vectors.astype(np.float64)
        turned = values @ self.rotation
        rest = np.sqrt((turned[:, self.lead :] ** 2).sum(axis=1))
        values = values if self.exact else vectors.astype(object)
        return rows["vec_id"].to_numpy(dtype=np.int64), values, turned[:, : self.lead], rest

    def start(self, queries: pd.DataFrame) -> None:
        self.ids, self.values, self.leading, self.rest = self._unpack(queries)
        self.lengths = queries["length"].to_numpy(dtype=np.float64)
        self.own = queries["own"].to_numpy(dtype=np.int64) if "own" in queries else np.zeros(len(queries), dtype=np.int64)
        self.bound = queries["bound"].to_numpy(dtype=np.float64) if "bound" in queries else np.full(len(queries), -np.inf)
        n = len(queries)
        # Score and id of the best so far; an id of -1 marks a free place.
        self.best = np.full((n, self.k), np.iinfo(np.int64).min, dtype=np.int64)
        self.best_ids = np.full((n, self.k), np.iinfo(np.int64).max, dtype=np.int64)
        self.filled = np.zeros((n, self.k), dtype=bool)

    def feed(self, candidates: pd.DataFrame) -> None:
        """Candidates come by descending length."""
        for at in range(0, len(candidates), _COLUMNS):
            some = candidates.iloc[at : at + _COLUMNS]
            longest = float(some["length"].iloc[0])
            slack = 1e-9 * self.lengths * longest + 1e-6
            active = np.flatnonzero(self.lengths * longest + slack >= self.bound)
            if not len(active):
                return
            ids, values, leading, rest = self._unpack(some)
            for begin in range(0, len(active), _ROWS):
                self._compare(active[begin : begin + _ROWS], ids, values, leading, rest, slack)

    def _compare(self, rows, ids, values, leading, rest, slack) -> None:
        most = self.leading[rows] @ leading.T + self.rest[rows][:, None] * rest[None, :]
        possible = (most >= (self.bound[rows] - slack[rows])[:, None]) & (ids[None, :] != self.ids[rows][:, None])
        used = np.flatnonzero(possible.any(axis=1))
        if not len(used):
            return
        if self.exact and possible[used].mean() > 0.05:
            score = (self.values[rows[used]] @ values.T).astype(np.int64)
            for row, at in enumerate(used):
                columns = np.flatnonzero(possible[at])
                self._merge(rows[at], score[row, columns], ids[columns])
        else:
            for at in used:
                columns = np.flatnonzero(possible[at])
                self._merge(rows[at], (values[columns] @ self.values[rows[at]]).astype(np.int64), ids[columns])

    def _merge(self, row: int, score: np.ndarray, ids: np.ndarray) -> None:
        old = self.filled[row]
        score = np.concatenate([self.best[row][old], score])
        ids = np.concatenate([self.best_ids[row][old], ids])
        if len(score) > 4 * self.k:
            least = np.partition(score, len(score) - self.k)[len(score) - self.k]
            keep = score >= least
            score, ids = score[keep], ids[keep]
        order = np.lexsort((ids, -score))[: self.k]
        n = len(order)
        self.best[row, :n], self.best_ids[row, :n], self.filled[row, :n] = score[order], ids[order], True
        if n == self.k:
            self.bound[row] = max(self.bound[row], float(score[order[-1]]))

    def result(self) -> pd.DataFrame:
        row, place = np.nonzero(self.filled)
        return pd.DataFrame({"query_id": self.ids[row], "own": self.own[row], "score": self.best[row, place], "vec_id": self.best_ids[row, place]})


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, group: int = GROUP, slice_rows: int = SLICE, head: int = HEAD) -> DataFrame:
    """query_id, rank, vec_id, score: for each id divisible by `every` its k best other vectors."""
    spark = vectors.sparkSession
    v = F.col("embedding").cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False)))
    if isinstance(dims := rows.agg(F.max(F.size("v"))).first()[0], int) and dims > 0:
        # dims^2 numbers from each task are added in some tasks, then in one; the driver gets them once.
        parts = rows.mapInPandas(_statistics(dims), _STATS).repartition(ADDERS)
        total = parts.mapInPandas(_added(dims), _STATS).coalesce(1).mapInPandas(_added(dims), _STATS).first()
        sums, most, n = np.frombuffer(total.sums).reshape(dims, dims), total.most, total.n
        if most >= 2.0**63:
            raise ValueError(f"a component of {most / SCALE:g} has no place in a long integer")
    else:
        dims, sums, most, n = 1, np.ones((1, 1)), 0.0, rows.count()
    energy, basis = np.linalg.eigh(sums)
    rotation = basis[:, ::-1]
    share = np.cumsum(energy[::-1]) / max(energy.sum(), 1e-300)
    lead = min(dims, max(4, int(np.searchsorted(share, 0.8)) + 1))
    kind = "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<i8"
    exact = dims * most * most < 2**53

    packed = written(rows.mapInPandas(_pack(dims, kind), _VECTORS).distinct(), "vectors")
    longest = packed.orderBy(F.desc("length"), "vec_id").limit(head).toPandas()
    search = dict(rotation=np.ascontiguousarray(rotation), kind=kind, exact=exact, k=k, lead=lead)

    def bounds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), _ROWS):
                some = batch.iloc[at : at + _ROWS]
                first = Search(**search)
                first.start(some)
                first.feed(longest)
                yield some.assign(bound=first.bound)

    queries = packed.where(F.col("vec_id") % every == 0)
    queries = written(queries.mapInPandas(bounds, _VECTORS + ", bound double").withColumn("own", F.xxhash64("vector")), "queries")
    groups = max(1, math.ceil(queries.count() / min(group, max(1, GROUP_BYTES // (8 * dims)))))
    slices = max(spark.sparkContext.defaultParallelism, math.ceil(n / slice_rows))
    g = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(groups)).cast("int")
    s = F.pmod(F.xxhash64("vec_id", "vector", F.lit(1)), F.lit(slices)).cast("int")
    asked = queries.withColumn("g", g).withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    asked = asked.select("g", "s", F.lit(0).alias("kind"), "vec_id", "length", "vector", "bound", "own")
    told = packed.withColumn("s", s).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    told = told.select("g", "s", F.lit(1).alias("kind"), "vec_id", "length", "vector", F.lit(None).cast("double").alias("bound"), F.lit(None).cast("long").alias("own"))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, held, running = None, [], None
        for batch in batches:
            key = batch["g"].to_numpy(dtype=np.int64) * slices + batch["s"].to_numpy()
            cuts = np.flatnonzero(np.diff(key)) + 1
            for low, high in zip(np.r_[0, cuts], np.r_[cuts, len(batch)]):
                if high <= low:
                    continue
                part = batch.iloc[low:high]
                if key[low] != current:
                    if running is not None:
                        yield running.result()
                    current, held, running = key[low], [], None
                held.append(part[part["kind"] == 0])
                told_now = part[part["kind"] == 1]
                if len(told_now):
                    if running is None:
                        ready = pd.concat(held)
                        held = []
                        if not len(ready):
                            continue
                        running = Search(**search)
                        running.start(ready)
                    running.feed(told_now)
        if running is not None:
            yield running.result()

    dealt = asked.union(told).repartition("g", "s").sortWithinPartitions("g", "s", "kind", F.desc("length"))
    found = dealt.mapInPandas(scan, _FOUND)
    # A query has at most k rows from each slice.
    place = Window.partitionBy("query_id", "own").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
