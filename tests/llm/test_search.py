import math
import random

import duckdb
import pytest

from offsetledger.llm import topk as T
from offsetledger.llm import url_filter as U
from offsetledger.llm.queries import ORACLE_SQL

URLS = [
    "http://A.com/x", "http://a.com", "https://www.Example.com/en/1", "https://example.com/en/", "http://m.example.com/en/x?y#z", "ftp://b.net/es/q",
    "b.net/es/q", None, "", "http://b.net/other", "http://xnet/es/", "http://b.net?/es/", "http://q.org/a#b/c", "://", "http://net/fr/1", "x://y://b.net/fr/",
]


def pages_of(spark, n=300):
    dice = random.Random(4)
    hosts = [f"{a}{n}.{b}" for n in range(60) for a in ("", "www.") for b in ("example.com", "a.net", "b.org")]
    made = [f"http://{dice.choice(hosts)}/{dice.choice(('en', 'es', 'fr'))}/{dice.randint(0, 9)}" for _ in range(n)]
    return spark.createDataFrame(list(enumerate([*URLS, *made, made[0]])), "page_id long, url string")


def test_verdicts_equal_their_sql(spark):
    pages = pages_of(spark).selectExpr("*", "1 AS host", "2 AS path", "3 AS key1", "4 AS listed")
    connection = duckdb.connect()
    connection.register("pages", pages.select("page_id", "url").toArrow())
    names = ["page_id", "host", "path", "rule", "verdict"]
    wanted = connection.sql(ORACLE_SQL["op7_url_filter"]).project(", ".join(names)).fetchall()
    result = U.judge(pages)
    assert result.columns == names
    assert sorted(map(repr, map(tuple, result.collect()))) == sorted(map(repr, wanted))
    assert U.judge(pages.limit(0)).count() == 0


def test_a_cascade_too_large_gives_way_to_a_join(spark, monkeypatch):
    pages = pages_of(spark)
    before = sorted(map(repr, U.judge(pages).collect()))
    monkeypatch.setattr(U, "MAX_CASCADE_BYTES", 1)
    assert sorted(map(repr, U.judge(pages).collect())) == before


@pytest.mark.parametrize("share", [0.01, 0.5, 0.99])
def test_the_cascade_is_exact_on_its_universe(spark, share):
    keys = U.with_keys(spark.range(5000).selectExpr("CAST(id AS STRING) AS host", f"pmod(xxhash64(id), 1000) < {1000 * share} AS listed"))
    cascade = U.build_cascade(keys.select("key1", "key2", "listed"), rate=0.3)
    frame = keys.toPandas()
    assert len(cascade.levels) > 1
    assert (cascade.holds(frame["key1"].to_numpy(), frame["key2"].to_numpy()) == frame["listed"].to_numpy()).all()


def best(rows, every, k):
    ints = {}
    for number, vector in rows:
        if number is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        ints[number] = [math.floor(256 * x) for x in vector]
    out = []
    for q in ints:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(ints[q], v)), n) for n, v in ints.items() if n != q)
            out += [(q, rank, n, -s) for rank, (s, n) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("scale,group,slices,head", [(1.0, 200_000, 500_000, 4096), (1.0, 3, 20, 7), (1e6, 3, 50, 5), (2e5, 10, 50, 5)])
def test_best_scores_equal_brute_force(spark, scale, group, slices, head):
    dice = random.Random(8)
    rows = [(n, [dice.gauss(0, 1) * scale * dice.choice((0.1, 1, 3)) for _ in range(dice.choice((6, 6, 6, 4)))]) for n in range(200)]
    rows += [(n, rows[5][1]) for n in range(300, 340)] + [(350, []), (351, None), (352, [None, 1.0]), (353, [float("nan")]), (354, [float("inf")]), (None, [1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS v", "2 AS bound", "3 AS length")
    found = T.top_k(frame, 10, 5, group, slices, head)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == best(rows, 10, 5)


def test_few_or_no_vectors(spark):
    frame = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, -1.0]), (0, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert [tuple(row) for row in T.top_k(frame).collect()] == [(0, 1, 1, 256 * 128 - 512 * 256)]
    assert T.top_k(frame.limit(0)).count() == 0
    assert T.top_k(frame.where("vec_id = 0").distinct()).count() == 0


def test_components_beyond_a_long_are_an_error(spark):
    vectors = spark.createDataFrame([(0, [1 / 256, 0.0]), (1, [1e300, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="long integer"):
        T.top_k(vectors)


def test_groups_are_sized_by_bytes(spark, monkeypatch):
    dice = random.Random(3)
    rows = [(n, [dice.gauss(0, 1) for _ in range(6)]) for n in range(200)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    before = sorted(map(tuple, T.top_k(vectors, every=7).collect()))
    monkeypatch.setattr(T, "GROUP_BYTES", 6 * 8 * 3)
    assert sorted(map(tuple, T.top_k(vectors, every=7).collect())) == before


def test_second_keys_do_not_follow_from_first_ones(spark):
    from pyspark.sql import functions as F

    hosts = spark.createDataFrame([(f"h{n}",) for n in range(50)], "host string")
    both = U.with_keys(hosts)
    assert both.where(F.col("key2") == F.xxhash64(F.col("host"), F.lit(1))).count() == 0
    assert both.select("key2").distinct().count() == 50


def test_keys_that_are_the_same_end_in_an_error(spark):
    universe = spark.createDataFrame([(1, 2, True), (1, 2, False), (3, 4, False)], "key1 long, key2 long, listed boolean")
    with pytest.raises(ValueError, match="told from"):
        U.build_cascade(universe)
