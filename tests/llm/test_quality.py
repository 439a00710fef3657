import duckdb
import numpy as np

from offsetledger.llm import quality_cnn as Q
from offsetledger.llm import quality_rules as R
from offsetledger.llm.queries import ORACLE_SQL

GOOD = " ".join(f"word{n}" for n in range(60)) + "."
MENU = "\n".join(" | ".join(f"item{n}{m}" for n in range(9)) for m in range(9))
SHOUT = " ".join(f"W{n}!!" for n in range(60))
TEXTS = [GOOD, MENU, SHOUT, None, "", " \t\n", "a b " * 40, GOOD + "\nAll rights reserved.\nx\nx\n\nx", "é" * 10 + " " + "b", "x " * 30_000]


def test_rules_by_hand(documents):
    rows = {row.doc_id: row for row in R.quality_rules(documents(TEXTS)).collect()}
    assert [rows[n].kept for n in range(9)] == [True, False, False, False, False, False, False, True, False]
    assert rows[1].base_failed is False and rows[1].n_failed_lines == 9
    assert rows[3].n_words == rows[4].n_words == rows[5].n_words == 0
    assert (rows[6].n_words, rows[6].n_repeat_words, rows[6].base_failed) == (80, 80, True)
    assert (rows[7].n_dup_lines, rows[7].n_failed_lines) == (2, 4)  # a notice and three entries without an end mark
    assert rows[9].n_repeat_words == 30_000


LINES = [
    ("Some sentence that goes on and then breaks off...", True),
    ("Another one\u2026  ", True),
    ("https://a.org/x  www.b.org", True),
    ("See https://a.org/x for more.", False),
    ("Home", True),
    ("Home.", False),
    ('He said "no."', False),
    ("Ein kurzes, aber doch recht langes Wortungeheuer", False),
    ("\u2022 two words", True),
    ("- two words.", False),
    ("\u2022 a point with rather more than a few words", False),
    ("Back to top of this page of ours.", True),
    ("a & b & c & d", True),
    ("one | two | three", True),
    ("\u4eca\u65e5\u306f\u3002", False),
]


def test_each_line_rule(documents):
    for text, fails in LINES:
        (row,) = R.quality_rules(documents([GOOD + "\n" + text])).collect()
        assert (row.n_failed_lines == 1) == fails, text
    (row,) = R.judge(documents([GOOD + "\n" + "\n".join(text for text, _ in LINES)])).select("rules.*").collect()
    assert row.clean_text.split("\n") == [GOOD, *(text for text, fails in LINES if not fails)]


def test_results_can_be_filtered(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    every = {row.doc_id: row for row in R.quality_rules(docs).collect()}
    for condition, test in (
        ("kept", lambda row: row.kept),
        ("not base_failed", lambda row: not row.base_failed),
        ("n_words > 300 and n_repeat_words < 5", lambda row: row.n_words > 300 and row.n_repeat_words < 5),
        ("lost_chars > 0 or n_dup_lines > 0", lambda row: row.lost_chars > 0 or row.n_dup_lines > 0),
    ):
        found = {row.doc_id: row for row in R.quality_rules(docs).where(condition).collect()}
        assert found == {key: row for key, row in every.items() if test(row)}, condition
    assert R.judge(docs).where("rules.kept").count() == sum(row.kept for row in every.values())


def test_rules_equal_their_sql(documents):
    texts = TEXTS + [GOOD + "\n" + text for text, _ in LINES]
    docs = documents(texts, [(0, GOOD, None, None, None), (0, GOOD, None, None, None), (None, MENU, "x", "y", 1)])
    connection = duckdb.connect()
    connection.register("documents", docs.toArrow())
    result = R.quality_rules(docs)
    expected = connection.sql(ORACLE_SQL["op6_quality_rules"])
    wanted = sorted(repr(row) for row in expected.project(", ".join(result.columns)).fetchall())
    assert sorted(repr(tuple(row)) for row in result.collect()) == wanted


def test_kept_rows_stay_as_they_were(documents):
    docs = documents(TEXTS).selectExpr("*", "1 AS rules", "2 AS _row", "3 AS kept", "4 AS doc")
    kept = R.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(kept.collect()) == sorted(docs.where("doc_id IN (0, 7)").collect())
    assert R.kept_documents(docs.limit(0)).count() == 0


def test_no_python_in_the_rules(documents):
    plan = R.kept_documents(documents(TEXTS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Exchange" not in plan


def test_chunks_cover_every_byte():
    for size in (1, 511, 512, 513, 960, 961, 5000):
        text = "x" * size
        covered = np.zeros(max(size, Q.CHUNK), dtype=bool)
        for start in Q.chunk_starts(len(covered)):
            covered[start : start + Q.CHUNK] = True
        assert covered.all() and Q.chunks_of(text).shape[1] == Q.CHUNK


def test_gradients_are_right():
    random = np.random.default_rng(1)
    net = Q.ByteNet(2)
    for name in ("embed", "filters", "bias", "out", "shift"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    chunks = random.integers(1, 256, (5, Q.CHUNK), dtype=np.uint8)
    counts, labels = np.array([2, 3]), np.array([1.0, 0.0])

    def loss():
        pooled = net.pooled(chunks)
        parts = np.split(pooled, [2])
        p = net.combine(*(np.stack([f(x) for x in parts]) for f in (lambda x: x.mean(0), lambda x: x.min(0), lambda x: x.max(0))))
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    found = net.gradients(chunks, counts, labels)
    for weight, gradient in zip((net.filters, net.out, net.shift), (found[1], found[3], found[4])):
        at = tuple(random.integers(0, n) for n in weight.shape)
        weight[at] += 1e-5
        up = loss()
        weight[at] -= 2e-5
        slope = (up - loss()) / 2e-5
        weight[at] += 1e-5
        assert abs(slope - gradient[at]) < 1e-4 + 0.02 * abs(slope)


def test_classifier_learns_and_never_sees_held_out_labels(spark, documents):
    texts = [GOOD.replace("word", f"w{n}") if n % 2 else SHOUT.replace("W", f"Q{n}") for n in range(300)]
    docs = documents([*texts, None, ""])
    labels = spark.createDataFrame([(n, n % 2, 0) for n in range(300)], "doc_id long, quality int, toxic int")
    small = Q.Training(docs_per_label=60, epochs=6)
    rows = Q.quality_scores(docs, labels, small).collect()
    right = [row.predicted == row.doc_id % 2 for row in rows if row.doc_id < 300 and row.held_out]
    assert len(rows) == 302 and len(right) > 30 and sum(right) > 0.9 * len(right)
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.3) for row in rows)
    # Other labels of the held-out documents change nothing.
    turned = labels.selectExpr("doc_id", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0, 1 - quality, quality) AS quality")
    again = {row.doc_id: row.score for row in Q.quality_scores(docs, turned, small).collect()}
    assert all(again[row.doc_id] == row.score for row in rows)


def test_without_labels_or_rows(spark, documents):
    docs = documents([GOOD, None])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [row.score for row in Q.quality_scores(docs, none).collect()] == [0.5, 0.5]
    assert Q.quality_scores(docs.limit(0), none).count() == 0
    odd = docs.selectExpr("*", "1 AS row", "2 AS score", "named_struct('a', 1) AS nested")
    assert sorted(Q.kept_documents(odd, none).collect()) == sorted(odd.collect())
