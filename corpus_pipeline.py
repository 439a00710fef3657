"""The corpus pipeline: documents in, packed token windows out.

Each stage takes what the one before has kept, written as Parquet. The filtering stages leave texts as
they are; only the suffix-array stage cuts repeated passages out of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offsetledger.llm import jaccard_join, packing, quality_cnn, quality_rules, suffix_dedup
from offsetledger.llm.queries import tokenizer_file
from offsetledger.llm.tables import table, written

#: Bytes of a passage that counts as repeated. The 51 words of a passage of over 50 have more than this if they
#: have four letters each on the average; op2's own query keeps its 400.
PASSAGE = 256


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules reject go."""
    return quality_rules.kept_documents(docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte network predicts to be bad go.

    It is trained on the whole table: among the documents that the rules keep, hardly any is labelled bad.
    """
    net = quality_cnn.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    if net is None:
        raise ValueError(f"no network: {sf_dir} lacks labelled documents, not held out, of both labels")
    return quality_cnn.kept_by(docs, net)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates stays.

    Rows that share an id are documents of their own here, and so are rows without one: the join is given numbers
    that tell rows apart. Of a component the row with the least id stays, of several such the first.
    """
    names = docs.columns
    rows = docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("number"))
    found = jaccard_join.near_duplicates(rows.select(F.col("number").alias("doc_id"), "row.text"))
    found = found.select(F.col("doc_id").alias("number"), F.col("component_id").alias("component"))
    ids = rows.select("number", F.col("row.doc_id").alias("id"))
    order = F.struct(F.col("id").isNull(), "id", "number")
    first = ids.join(found, "number").groupBy("component").agg(F.min(order)["number"].alias("number"))
    return rows.join(first, "number", "left_semi").select("row.*").toDF(*names)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of passages that occur anywhere else too are cut out; every document stays."""
    cut = suffix_dedup.deduplicated(docs, PASSAGE)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document left, as pieces of token windows."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality rules", rules),
    ("quality classifier", classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-"))
    return docs


#: A trained classifier and a tokenizer can't be written in SQL; tests/llm compares with brute force.
ORACLE_SQL = None
