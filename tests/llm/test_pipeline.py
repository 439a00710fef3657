import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from offsetledger.llm import jaccard_join, quality_rules
from tests.llm.test_dedup import brute_components, removed

SF_DIR = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    for at, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        path = str(tmp_path / str(at))
        out.write.parquet(path)
        out, before = spark.read.parquet(path), docs.orderBy("doc_id").collect()
        if at < len(pipeline.STAGES) - 1:
            assert out.columns == columns
        after = {row.doc_id: row for row in out.collect()}
        if at == 0:
            wanted = {row.doc_id for row in quality_rules.quality_rules(docs).where("kept").collect()}
            assert set(after) == wanted and all(after[row.doc_id].text == row.text for row in before if row.doc_id in wanted)
        elif at == 1:
            assert len(after) > 0.97 * len(before)
        elif at == 2:
            names = brute_components([row.text for row in before])[1]
            assert set(after) == {before[n].doc_id for n in set(names)}
        elif at == 3:
            raws = [row.text.encode() for row in before]
            for row, raw, gone in zip(before, raws, removed(raws, pipeline.PASSAGE)):
                kept = bytes(b for b, g in zip(raw, gone) if not g).decode("utf-8", "ignore")
                assert after[row.doc_id].text == kept and after[row.doc_id].n_chars == len(kept)
        else:
            assert {row.doc_id for row in out.collect()} == {row.doc_id for row in before}
        docs = out


def test_copies_of_rows_go(spark, documents):
    text = " ".join(f"w{n}" for n in range(80))
    docs = documents([text, text, "other " + text[: len(text) // 2]], [(0, text, "en", "s", 1), (None, "x", None, None, None)])
    kept = pipeline.near_duplicates(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    assert sorted(str(row.doc_id) for row in kept.collect()) == ["0", "2", "None"]
    assert jaccard_join.near_duplicates(docs).count() == 5


def test_clean_documents_that_share_an_id_stay(spark, documents):
    texts = [" ".join(f"{at}w{n}" for n in range(80)) for at in range(3)]
    docs = documents([], [(0, texts[0], "en", "s", 1), (0, texts[1], "en", "s", 2), (None, texts[2], "en", "s", 3), (None, texts[2], "en", "s", 4), (7, None, "en", "s", 5)])
    docs = docs.selectExpr("*", "1 as row", "2 as number", "3 as component", "4 as `a.b`")
    kept = pipeline.near_duplicates(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    assert sorted(map(str, (row.text for row in kept.collect()))) == sorted([*texts, "None"])
    assert pipeline.near_duplicates(spark, docs.limit(0), SF_DIR).count() == 0


def test_classifier_is_trained_on_the_whole_table_and_rejects(spark, documents, tmp_path):
    dice = random.Random(5)

    def bad_line(end=""):
        return " ".join("".join(dice.choice("qxzjvkw") for _ in range(dice.randint(3, 9))) + end for _ in range(60))

    good = [row.text for row in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) > 1000").orderBy("doc_id").limit(150).collect()]
    # Every bad document of the table has too many marks for the rules; those of the stage have none.
    documents([f"{bad_line()}\n{bad_line('!!')}\n{bad_line('!!')}" for _ in range(150)] + good).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(at, int(at >= 150)) for at in range(150 + len(good))]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    kept = pipeline.rules(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path))
    extra = [(1000 + n, f"{bad_line()}\n{bad_line()}", "en", "s", 1) for n in range(20)]
    documents([], extra).write.parquet(str(tmp_path / "extra"))
    passed = pipeline.rules(spark, spark.read.parquet(str(tmp_path / "extra")), str(tmp_path))
    kept.union(passed).write.parquet(str(tmp_path / "kept"))
    frame = spark.read.parquet(str(tmp_path / "kept"))
    before = {row.doc_id for row in frame.collect()}
    assert not any(n < 150 for n in before) and sum(n >= 1000 for n in before) == 20
    after = {row.doc_id for row in pipeline.classifier(spark, frame, str(tmp_path)).collect()}
    assert not any(n >= 1000 for n in after) and len(after) > 0.97 * (len(before) - 20)


def test_classifier_without_bad_labels_fails(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 1").write.parquet(str(tmp_path / "labels.parquet"))
    with pytest.raises(ValueError, match="both labels"):
        pipeline.classifier(spark, docs, str(tmp_path))
