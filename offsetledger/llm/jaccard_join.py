"""Near duplicates by Jaccard similarity of word shingles, exact, with vertical partitioning.

The global order of shingles puts rare ones first: those that are not frequent by hash, then frequent ones by count. It
is cut into fragments, and every set with it. Overlaps are counted in each fragment by itself and summed per
pair: that sum decides on every link.

What is asked for is the component of every document, so a group of g documents that share a
shingle need not become g^2 pairs:

* documents with equal sets are one class, and only classes go on;
* stars: of each class the least values of a few hash functions over its set are kept. Classes that share most of these
  are probably similar, and each is counted against a hub or two of those that it shares them with, round by round
  with other hubs, among what is not joined yet, as long as that joins many;
* the rest, exactly: two sets that are similar enough share a shingle among the first fifth of each, and one more for
  each shingle that this prefix is made longer by. Prefixes are grouped by shingle, groups inside one component
  fall out, then sets that share less than any partner of possible size would need. What is left goes through
  stars again, now with hubs of each shingle's group, so that a group of copies that are only just similar grows together
  first; of what is open then every pair across components that shares enough of its prefixes is counted, first the best
  pair between two components. A pair that shares many shingles is made where it meets first, or nearly so.

So no link between components is missed, and a large group of copies costs a few pairs a member.

Frequent shingles are found by exact counts within blocks of texts, summed over all of them. They only
arrange the order: any order gives the same links. A shingle's group is never one task's: very frequent ones are
split by salt, what is known of a group is pre-aggregated and joined back, and pairs are dealt by shingle and size.

Every table on the way is deleted when the result is written.

Defined cases: a null or empty text, or one without words, has no shingles, is linked with nothing and
is its own component; rows that share a doc_id are one node, linked where any of its texts is; a row with a null
doc_id takes part like others and names no component (one of such rows only has a null name); very long texts are
taken whole; tables without rows give none; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offsetledger.llm.components import components
from offsetledger.llm.shingles import blocks, distinct, mix, shingles
from offsetledger.llm.tables import Scratch

#: Similarity is at least SHARE / 100.
SHARE = 80
#: Per cent of a set by which its prefix is longer than it must be.
LONGER = 8
#: Fragments of the global order: so many of shingles that are not frequent (a power of two), and one of frequent ones.
FRAGMENTS = 4
#: A shingle is frequent from so many texts on, and from so many per million texts.
FREQUENT, FREQUENT_PER_MILLION = 32, 100
#: Shingles counted at once, and the least count within them that is reported.
COUNTED, REPORTED = 8_000_000, 3
#: Members that a part of a split group is meant to have.
GROUP = 50_000
#: Hash functions whose least values are kept, and how many must agree for a pair to be counted in a star.
LEAST_VALUES, VOTES = 12, 6
#: Shingles before its own that a row of a prefix knows: two sets that share one of them have met there.
EARLIER = 4
#: One of so many classes is drawn for the hubs of a round; the first hubs are drawn from all.
DRAW = 8
#: Stars are tried while a round joins at least one of so many pairs.
WORTHWHILE = 50
MAX_STAR_ROUNDS = 5
#: Classes whose texts are wanted that are sent to all tasks; beyond that, both sides are shuffled.
MAX_BROADCAST_IDS = 200_000

_SALT_BITS = 16
_ROWS = "doc_id long, n long, sig1 long, sig2 long, least array<long>, token long"
_TOKENS = "bucket long, sig1 long"
_SETS = "class_id long, n long, fragment int, tokens array<long>"
_ODD = np.random.Generator(np.random.PCG64(10)).integers(1, 1 << 63, LEAST_VALUES, dtype=np.uint64) | np.uint64(1)


class Order:
    """The global order: frequent shingles last, by the logarithm of their count; then by hash."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray) -> None:
        at = np.argsort(tokens)
        self.tokens = tokens[at]
        self.rank = (1 + np.log2(np.maximum(counts[at], 1))).astype(np.int8)
        self.salts = np.minimum(counts[at] // GROUP, (1 << _SALT_BITS) - 2)

    def of(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (0 for what is not frequent) and number of salts."""
        if not len(self.tokens):
            return np.zeros(len(value), dtype=np.int8), np.zeros(len(value), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.tokens, value), len(self.tokens) - 1)
        hit = self.tokens[at] == value
        return np.where(hit, self.rank[at], 0), np.where(hit, self.salts[at], 0)


def _signatures(owner: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size of each text's set and two hashes of it."""
    counts = np.bincount(owner, minlength=n)
    out = []
    for seed in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        sums = np.r_[np.uint64(0), np.cumsum(mix(value ^ np.uint64(seed)), dtype=np.uint64)]
        ends = np.cumsum(counts)
        out.append(mix(sums[ends] - sums[ends - counts]).view(np.int64))
    return counts, *out


def _least_values(value: np.ndarray, n: np.ndarray) -> list:
    """Of each text with shingles the least value of each hash function; texts in order."""
    some = np.flatnonzero(n)
    out: list = [None] * len(n)
    if len(some):
        begins = (np.cumsum(n) - n)[some]
        with np.errstate(over="ignore"):
            least = np.stack([np.minimum.reduceat(value * odd, begins) for odd in _ODD], axis=1).view(np.int64)
        for at, row in zip(some.tolist(), least):
            out[at] = row
    return out


def _summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row per document, and for each block of texts one per shingle that several of them have."""
    held: list[np.ndarray] = []
    size = 0

    def count() -> pd.DataFrame:
        token, n = np.unique(np.concatenate(held), return_counts=True)
        often = n >= REPORTED
        empty = pd.array([pd.NA] * int(often.sum()), dtype="Int64")
        return pd.DataFrame({"doc_id": empty, "n": n[often], "sig1": empty, "sig2": empty, "least": None, "token": token[often].view(np.int64)})

    for batch in batches:
        texts = batch["text"].tolist()
        for part in blocks(texts):
            owner, value = distinct(*shingles(texts[part]))
            n, sig1, sig2 = _signatures(owner, value, len(texts[part]))
            ids = batch["doc_id"].iloc[part].astype("Int64").reset_index(drop=True)
            rows = pd.DataFrame({"doc_id": ids, "n": n, "sig1": sig1, "sig2": sig2, "least": _least_values(value, n)})
            yield rows.assign(token=pd.array([pd.NA] * len(rows), dtype="Int64"))
            held.append(value)
            size += len(value)
            if size >= COUNTED:
                yield count()
                held.clear()
                size = 0
    if size:
        yield count()


def _prefixes(batches: Iterator[pd.DataFrame], order: Order) -> Iterator[pd.DataFrame]:
    """The prefix of each document's set; of equal sets within one task only the first."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        texts = batch["text"].tolist()
        for part in blocks(texts):
            owner, value = distinct(*shingles(texts[part]))
            n, sig1, sig2 = _signatures(owner, value, len(texts[part]))
            owner, value = distinct(owner, value, order.of(value)[0])
            begins = np.cumsum(n) - n
            new = np.zeros(len(n), dtype=bool)
            for at, key in enumerate(zip(sig1.tolist(), sig2.tolist())):
                if key not in seen:
                    seen.add(key)
                    new[at] = True
            pos = np.arange(len(value)) - begins[owner]
            size = n - (SHARE * n + 99) // 100 + 1 + (LONGER * n + 99) // 100
            take = new[owner] & (pos < size[owner])
            owner, value = owner[take], value[take]
            sig = sig1[owner]
            split = order.of(value)[1]
            salt = np.where(split > 0, 1 + (mix(sig.view(np.uint64)) >> np.uint64(1)).astype(np.int64) % np.maximum(split, 1), 0)
            bucket = (value & ~np.uint64((1 << _SALT_BITS) - 1)).view(np.int64) | salt
            yield pd.DataFrame({"bucket": bucket, "sig1": sig})


def _fragments(batches: Iterator[pd.DataFrame], order: Order) -> Iterator[pd.DataFrame]:
    """The sets of the wanted classes, cut along the global order."""
    for batch in batches:
        texts = batch["text"].tolist()
        for part in blocks(texts):
            owner, value = distinct(*shingles(texts[part]))
            n, sig1, sig2 = _signatures(owner, value, len(texts[part]))
            rows = batch.iloc[part]
            # Of the texts under one id only the one with the class's set is meant.
            mine = (rows["sig1"].to_numpy() == sig1) & (rows["sig2"].to_numpy() == sig2)
            owner, value = owner[mine[owner]], value[mine[owner]]
            # Not frequent ones lie in the order by their hash, frequent ones come after them.
            fragment = np.where(order.of(value)[0] > 0, FRAGMENTS, (value >> np.uint64(32)).astype(np.int64) * FRAGMENTS >> 32)
            at = np.lexsort((value, fragment, owner))
            owner, value, fragment = owner[at], value[at], fragment[at]
            cuts = np.flatnonzero(np.diff(np.r_[-1, owner * (FRAGMENTS + 1) + fragment]))
            if not len(cuts):
                continue
            sets, own = np.split(value.view(np.int64), cuts[1:]), owner[cuts]
            ids = rows["class_id"].to_numpy()
            yield pd.DataFrame({"class_id": ids[own], "n": n[own], "fragment": fragment[cuts].astype(np.int32), "tokens": sets})


def _sets_of(texts: DataFrame, classes: DataFrame, order: Order) -> DataFrame:
    """The cut sets of `classes`, each text read where it lies."""
    key = F.lit(-(1 << 63)).cast("long")
    wanted = classes.select(F.coalesce("doc_id", key).alias("key"), "sig1", "sig2", "class_id")
    if wanted.count() <= MAX_BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    rows = texts.select(F.coalesce("doc_id", key).alias("key"), "text").join(wanted, "key").drop("key")
    sets = rows.mapInPandas(lambda batches: _fragments(batches, order), _SETS)
    return sets.dropDuplicates(["class_id", "fragment"])  # rows may repeat each other


def _completed(sets: DataFrame, pairs: DataFrame, texts: DataFrame, classes: DataFrame, order: Order, scratch: Scratch) -> DataFrame:
    """`sets` with those of the classes in `pairs` that it lacks."""
    lacking = pairs.select(F.col("a").alias("class_id")).union(pairs.select("b")).distinct().join(sets, "class_id", "left_anti")
    lacking = scratch.written(lacking, "lacking")
    if lacking.isEmpty():
        return sets
    return sets.unionAll(scratch.written(_sets_of(texts, classes.join(lacking, "class_id", "left_semi"), order), "sets"))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar enough: overlaps per fragment, summed."""
    a = sets.select(F.col("class_id").alias("a"), F.col("n").alias("na"), "fragment", F.col("tokens").alias("ta"))
    b = sets.select(F.col("class_id").alias("b"), F.col("n").alias("nb"), "fragment", F.col("tokens").alias("tb"))
    # A pair has a row for each fragment that both sets have.
    partial = pairs.select("a", "b").join(a, "a").join(b, ["b", "fragment"])
    partial = partial.select("a", "b", "na", "nb", F.size(F.array_intersect("ta", "tb")).alias("common"))
    total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("o"))
    return total.where(100 * F.col("o") >= SHARE * (F.col("na") + F.col("nb") - F.col("o"))).select("a", "b")


def _rest(n: Column) -> Column:
    """Shingles of a set of this size after its prefix."""
    return F.greatest(F.floor((SHARE * n + 99) / 100) - 1 - F.floor((LONGER * n + 99) / 100), F.lit(0))


def _needed(na: Column, nb: Column) -> Column:
    """Common shingles in both prefixes that similar sets of these sizes have at least.

    The prefix that ends first in the order bounds what can follow: all of its set's other shingles.
    """
    return F.ceil(SHARE * (na + nb) / (100 + SHARE)) - F.greatest(_rest(na), _rest(nb))


def _least_needed(n: Column, low: Column, high: Column) -> Column:
    """The least of `_needed` over all partner sizes from `low` to `high`, `n` lying between them.

    Up to n the longer set's rest stays, so the smallest partner needs least. Beyond n the unrounded number
    falls by `slope` a size and three roundings move it by less than 3, so the least is near `high`.
    """
    slope = (SHARE - LONGER) / 100 - SHARE / (100 + SHARE)
    # As one array: written out, the terms make a method that the JVM does not compile.
    backs = F.array(*map(F.lit, range(int(3 / slope) + 1)))
    beyond = F.transform(backs, lambda back: _needed(n, F.greatest(n, high - back)))
    return F.least(_needed(low, n), _needed(n, n), F.array_min(beyond))


def _near_size(na: str, nb: str) -> Column:
    return 100 * F.least(na, nb) >= SHARE * F.greatest(na, nb)


def _enough(na: str, nb: str, common: str) -> Column:
    """Whether sets of these sizes can be similar with so many common shingles in their prefixes."""
    return _near_size(na, nb) & (F.col(common) >= _needed(F.col(na), F.col(nb)))


def _labelled(rows: DataFrame, joined: DataFrame | None) -> DataFrame:
    """`rows` with the component of their class."""
    if joined is None:
        return rows.withColumn("component", F.col("class_id"))
    names = joined.select(F.col("node").alias("class_id"), "component")
    return rows.join(names, "class_id", "left").withColumn("component", F.coalesce("component", "class_id"))


def _grown(joined: DataFrame | None, found: DataFrame, scratch: Scratch) -> DataFrame:
    """Components after more links: only links between components go through the contraction."""
    if joined is None:
        return components(found, scratch)
    ends = found.select(F.col("a").alias("class_id")).union(found.select("b")).distinct()
    ends = _labelled(ends, joined).select(F.col("class_id").alias("node"), "component")
    names = scratch.written(ends, "ends")
    a = names.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    b = names.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    between = components(found.join(a, "a").join(b, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")), scratch)
    nodes = joined.unionByName(names.join(joined.select("node"), "node", "left_anti"))
    upper = between.select(F.col("node").alias("component"), F.col("component").alias("name"))
    nodes = nodes.join(upper, "component", "left").select("node", F.coalesce("name", "component").alias("component"))
    return scratch.written(nodes, "components")


def _star_pairs(rows: DataFrame, turn: int, least: int = VOTES) -> DataFrame:
    """Each class with the hubs of most of the values it shares with them, `least` at least; a turn has two hubs for a value.

    The hub of a value is the most `central` of a draw of its classes: the one whose values most others have too, as the
    text has that the others were copied from. Of two copies each may be similar to that one only.
    """
    pairs = []
    for seed in (2 * turn, 2 * turn + 1):
        drawn = F.pmod(F.xxhash64("class_id", F.lit(seed)), F.lit(DRAW)) if seed else F.lit(0)
        place = F.struct((drawn != 0).alias("out"), (-F.col("central")).alias("at"), "class_id", "n", "component")
        hubs = rows.groupBy("at", "value").agg(F.min(place).alias("hub"), F.min("component").alias("low"), F.max("component").alias("high"))
        hubs = hubs.where("low < high").drop("low", "high")
        votes = rows.join(hubs, ["at", "value"]).where("component <> hub.component")
        votes = votes.groupBy("class_id", "n", F.col("hub.class_id").alias("h"), F.col("hub.n").alias("hn")).agg(F.count("*").alias("votes"))
        likely = votes.where((F.col("votes") >= least) & _near_size("n", "hn"))
        best = likely.groupBy("class_id").agg(F.max_by("h", F.struct("votes", F.xxhash64("h", F.lit(seed)))).alias("h"))
        pairs.append(best.select(F.least("class_id", "h").alias("a"), F.greatest("class_id", "h").alias("b")))
    return pairs[0].union(pairs[1]).distinct()


def _across(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Of `rows` (token, class_id, n, component) those of sets that share enough with any others of possible
    size, in groups that hold several components, with the size `k` of their group.

    The least that any partner between the smallest and the largest size needs is taken for all groups of a set
    together. Sizes and components of a group are pre-aggregated and joined back, so that no task holds a group.
    """
    own, n = Window.partitionBy("class_id"), F.col("n")
    for _ in range(2):
        known = rows.groupBy("token").agg(
            F.count("*").alias("k"), F.min("n").alias("low"), F.max("n").alias("high"), F.min("component").alias("first"), F.max("component").alias("last")
        )
        rows = rows.select("token", "class_id", "n", "component").join(known.where("first < last").drop("first", "last"), "token")
        low = F.greatest(F.min("low").over(own), F.ceil(SHARE * n / 100))
        high = F.least(F.max("high").over(own), F.floor(100 * n / SHARE))
        rows = rows.withColumns({"least": low, "most": high, "c": F.count("*").over(own)})
        # Whatever its size, a partner needs more of a set's prefix than what that is longer by.
        rows = rows.where(100 * F.col("c") > LONGER * n)
        rows = rows.withColumn("needed", _least_needed(n, F.col("least"), F.col("most"))).where("c >= needed").drop("low", "high", "least", "most")
        rows = scratch.written(rows, "across")  # the next round reads them twice
    return rows


def _reopened(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """Of the rows of `_across` those that are open still when classes have been joined."""
    rows = _labelled(rows.select("token", "class_id", "n", "needed"), joined)
    known = rows.groupBy("token").agg(F.count("*").alias("k"), F.min("component").alias("first"), F.max("component").alias("last"))
    rows = rows.join(known.where("first < last").drop("first", "last"), "token")
    return rows.withColumn("c", F.count("*").over(Window.partitionBy("class_id"))).where("c >= needed")


def _telling(rows: DataFrame) -> DataFrame:
    """Of each set's open shingles those of which it shares one with any set that is similar enough.

    A set whose partner needs m of its c open shingles shares one of the first c - m + 1 with it, in any
    order that is the same for both sets; here those in the smallest groups come first.
    """
    first = Window.partitionBy("class_id").orderBy("k", "token")
    earlier = F.collect_list("token").over(first.rowsBetween(-EARLIER, -1))
    return rows.withColumns({"place": F.row_number().over(first), "earlier": earlier}).where("place <= c - needed + 1")


def _meetings(rows: DataFrame) -> DataFrame:
    """(a, b) of sets across components that share a telling shingle, in one or in neighbouring bands of size.

    Every such pair is there once at least, with the first telling shingle that both have. At a later one it is left
    out if both have one of the few shingles before it in common, for it has been made at that one, or before.
    """
    telling = _telling(rows)
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / SHARE))).cast("int")
    x = telling.select("token", F.col("class_id").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca"), F.col("earlier").alias("ea"), band.alias("band"))
    y = telling.select("token", F.col("class_id").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb"), F.col("earlier").alias("eb"), band.alias("own"))
    # Sizes up to a band apart lie in the same or a neighbouring band; the smaller set looks upwards.
    y = y.select("token", "b", "nb", "cb", "eb", F.explode(F.array(F.col("own"), F.col("own") - 1)).alias("band"))
    smaller = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    new = smaller & (F.col("ca") != F.col("cb")) & _near_size("na", "nb") & ~F.arrays_overlap("ea", "eb")
    return x.join(y, ["token", "band"]).where(new).select("a", "b")


def _counted(pairs: DataFrame, rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Of the pairs (a, b) those that have enough common shingles in both prefixes, with their number."""
    pairs = scratch.written(pairs, "meetings")
    ends = pairs.select(F.col("a").alias("class_id")).union(pairs.select("b")).distinct()
    own = rows.join(ends, "class_id", "left_semi").groupBy("class_id").agg(F.collect_set("token").alias("tokens"), F.first("n").alias("n"), F.first("component").alias("component"))
    for side in "ab":
        side_of = own.select(F.col("class_id").alias(side), F.col("tokens").alias(f"t{side}"), F.col("n").alias(f"n{side}"), F.col("component").alias(f"c{side}"))
        pairs = pairs.join(side_of, side)
    counted = pairs.withColumn("common", F.size(F.array_intersect("ta", "tb")))
    return counted.where(_enough("na", "nb", "common")).select("a", "ca", "b", "cb", "common")


def _all_pairs(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Every pair across components that has enough common shingles in both prefixes, with their number."""
    return _counted(_meetings(rows).distinct(), rows, scratch)


def _relabelled(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """The pairs that still lie across components."""
    for side, label in (("a", "ca"), ("b", "cb")):
        names = joined.select(F.col("node").alias(side), F.col("component").alias("name"))
        pairs = pairs.join(names, side, "left").withColumn(label, F.coalesce("name", label)).drop("name")
    return pairs.where("ca <> cb")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    with Scratch(docs.sparkSession) as scratch:
        return scratch.result(_near_duplicates(docs, scratch), "near-duplicates")


def _near_duplicates(docs: DataFrame, scratch: Scratch) -> DataFrame:
    written = scratch.written
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    summary = written(texts.mapInPandas(_summarise, _ROWS), "summary")
    rows = summary.where("token is null").drop("token")
    often = max(FREQUENT, rows.count() * FREQUENT_PER_MILLION // 1_000_000)
    # At most the shingles of an average text times the millions, however many texts there are.
    counted = summary.where("token is not null").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= often)
    frequent = counted.toPandas()
    order = Order(frequent["token"].to_numpy(dtype=np.int64).view(np.uint64), frequent["n"].to_numpy(dtype=np.int64))

    alike = rows.where("n > 0").groupBy("sig1", "sig2").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("least").alias("least"))
    classes = written(alike.withColumn("class_id", F.monotonically_increasing_id()), "classes")
    members = rows.where("n > 0").join(classes.select("sig1", "sig2", "class_id"), ["sig1", "sig2"]).select("doc_id", "n", "class_id")
    empty = rows.where("n = 0").select("doc_id", "n", F.lit(None).cast("long").alias("class_id"))
    members = written(members.unionAll(empty), "members")
    # Texts under one id are one node.
    named = members.where("doc_id is not null and class_id is not null")
    several = named.groupBy("doc_id").agg(F.min("class_id").alias("a"), F.max("class_id").alias("z")).where("a < z")
    links = written(named.join(several, "doc_id").where("class_id <> a").select("a", F.col("class_id").alias("b")).distinct(), "links")
    joined = None if links.isEmpty() else components(links, scratch)

    # Stars among the classes that share most of their least values with others.
    values = classes.select("class_id", "n", F.posexplode("least").alias("at", "value"))
    shared = values.groupBy("at", "value").agg(F.count("*").alias("k")).where("k > 1")
    own = Window.partitionBy("class_id")
    open_ = values.join(shared, ["at", "value"]).withColumns({"c": F.count("*").over(own), "central": F.sum("k").over(own)})
    open_ = written(open_.where(F.col("c") >= VOTES).drop("c", "k"), "open")
    sets = _sets_of(texts, classes.join(open_.select("class_id").distinct(), "class_id", "left_semi"), order)
    sets = written(sets, "sets")
    for turn in range(MAX_STAR_ROUNDS):
        pairs = written(_star_pairs(_labelled(open_, joined), turn), "pairs")
        tried = pairs.count()
        found = written(_verified(pairs, sets), "found") if tried else pairs
        joins = found.count() if tried else 0
        if joins:
            joined = _grown(joined, found, scratch)
        if joins * WORTHWHILE <= tried:
            break

    # The rest, exactly.
    tokens = texts.mapInPandas(lambda batches: _prefixes(batches, order), _TOKENS)
    salted = F.col("bucket").bitwiseAND((1 << _SALT_BITS) - 1) != 0
    tokens = tokens.withColumn("k", F.count("*").over(Window.partitionBy("bucket"))).where((F.col("k") > 1) | salted)
    base = F.col("bucket").bitwiseAND(~((1 << _SALT_BITS) - 1)).alias("token")
    tokens = _labelled(tokens.select(base, "sig1").join(classes.select("sig1", "class_id", "n"), "sig1").drop("sig1"), joined)
    rest = _across(written(tokens.distinct(), "tokens"), scratch)  # copies in several tasks are one
    for turn in range(MAX_STAR_ROUNDS):
        central = (100 * F.sum("k").over(own) / F.col("n")).cast("long").alias("central")
        hubs = _telling(rest.select("*", central)).select(F.lit(0).alias("at"), F.col("token").alias("value"), "class_id", "n", "component", "central")
        pairs = written(_counted(_star_pairs(written(hubs, "hubs"), turn, 1), rest, scratch), "pairs")
        tried = pairs.count()
        if tried:
            sets = _completed(sets, pairs, texts, classes, order, scratch)
        found = written(_verified(pairs, sets), "found") if tried else pairs
        joins = found.count() if tried else 0
        if joins:
            joined = _grown(joined, found, scratch)
            rest = written(_reopened(rest, joined), "open")
        if joins * WORTHWHILE <= tried:
            break
    pairs = written(_all_pairs(rest, scratch), "pairs")
    if not pairs.isEmpty():
        sets = _completed(sets, pairs, texts, classes, order, scratch)
        best = pairs.groupBy(F.least("ca", "cb").alias("x"), F.greatest("ca", "cb").alias("y"))
        best = best.agg(F.max_by(F.struct("a", "b"), F.struct("common", "a", "b")).alias("pair")).select("pair.*")
        found = written(_verified(best, sets), "found")
        if not found.isEmpty():
            joined = _grown(joined, found, scratch)
            pairs = _relabelled(pairs, joined)
        found = written(_verified(pairs.join(best, ["a", "b"], "left_anti"), sets), "found")
        if not found.isEmpty():
            joined = _grown(joined, found, scratch)

    # A component is named by the least id of its rows.
    rows = _labelled(members, joined)
    names = rows.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("name"))
    rows = rows.join(names, "component", "left")
    # An empty text under an id that has others belongs with them.
    ids = rows.where("class_id is not null").join(members.where("class_id is null").select("doc_id").distinct(), "doc_id", "left_semi")
    ids = ids.groupBy("doc_id").agg(F.min("name").alias("other"))
    rows = rows.join(ids, "doc_id", "left")
    label = F.when(F.col("class_id").isNotNull(), F.col("name")).otherwise(F.coalesce("other", "doc_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), label.cast("long").alias("component_id"))
