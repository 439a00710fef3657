"""Connected components of an undirected graph, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offsetledger.llm.tables import Scratch


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(node, component) for every node of `edges` (a, b); a component is named by its least node.

    By contraction: each round every node points to whichever of itself and its neighbours comes first in that
    round's random order, then to where that one points; the edges are renamed so and loops dropped,
    until none is left. The number of rounds grows with the logarithm of the number of nodes. Each
    round's tables are written to the shared folder and deleted when the names are put together at the
    end; a caller's `scratch` keeps the result only as long as its own tables.
    """
    with Scratch(edges.sparkSession) as own:
        keep = own.result if scratch is None else scratch.written
        return keep(_contracted(edges, own.written), "components")


def _contracted(edges: DataFrame, written) -> DataFrame:
    edges = written(edges.select("a", "b").where("a <> b").distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        turn = len(rounds)

        def place(node):
            return F.struct(F.xxhash64(node, F.lit(turn)).alias("at"), F.col(node).alias("node"))

        both = edges.union(edges.select("b", "a"))
        first = both.groupBy("a").agg(F.min(place("b")).alias("other"))
        parent = first.select(F.col("a").alias("u"), F.least("other", place("a"))["node"].alias("p"))
        upper = parent.select(F.col("u").alias("p"), F.col("p").alias("q"))
        jumped = written(parent.join(upper, "p", "left").select("u", F.coalesce("q", "p").alias("p")), "jumped")
        rounds.append(jumped)
        a = jumped.select(F.col("u").alias("a"), F.col("p").alias("a2"))
        b = jumped.select(F.col("u").alias("b"), F.col("p").alias("b2"))
        edges = edges.join(a, "a").join(b, "b").select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
        edges = written(edges.where("a <> b").distinct(), "edges")
    labels = nodes.withColumn("component", F.col("node"))
    for jumped in rounds:
        step = jumped.withColumnRenamed("u", "component")
        labels = labels.join(step, "component", "left").select("node", F.coalesce("p", "component").alias("component"))
    labels = written(labels, "labels")
    names = labels.groupBy("component").agg(F.min("node").alias("name"))
    return labels.join(names, "component").select("node", F.col("name").alias("component"))
