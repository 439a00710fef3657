import random
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from offsetledger.operators import offsets as O

SCHEMA = "kafka_partition int, kafka_offset long"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def keyed(offsets, key=0):
    return [(key, offset) for offset in offsets]


def brute_force(rows):
    """(summary, gaps) by sorting every key's offsets."""
    groups = defaultdict(list)
    for *key, offset in rows:
        groups[tuple(key)].append(offset)
    summary, gaps = set(), set()
    for key, offsets in groups.items():
        seen = sorted(set(offsets))
        expected = seen[-1] - seen[0] + 1
        summary.add(
            (*key, seen[0], seen[-1], len(offsets), len(seen), expected, expected - len(seen), len(offsets) - len(seen))
        )
        gaps.update((*key, low, high, high - low - 1) for low, high in zip(seen, seen[1:]) if high - low > 1)
    return summary, gaps


def as_set(df):
    rows = [tuple(row) for row in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def status(df):
    return O.offset_verdict(O.offset_summary(df)).first()


@pytest.mark.parametrize(
    "offsets,missing,duplicates,verdict,code",
    [
        ([5, 6, 7], 0, 0, "PASS", 0),
        ([1, 2, 5, 9], 5, 0, "FAIL", 1),
        ([1, 2, 2, 3], 0, 1, "WARN", 0),
        ([1, 1, 3], 1, 1, "FAIL", 1),
        ([42], 0, 0, "PASS", 0),
        ([], 0, 0, "ERROR", 1),
    ],
)
def test_verdicts(spark, offsets, missing, duplicates, verdict, code):
    result = status(frame(spark, keyed(offsets)))
    assert (result.total_missing, result.total_duplicates) == (missing, duplicates)
    assert (result.status, result.exit_code) == (verdict, code)


def test_an_empty_log_is_an_error_and_a_full_one_counts_entries(spark):
    summary = O.offset_summary(frame(spark, keyed([1, 2])))
    log = spark.createDataFrame([(1,), (2,), (3,)], "checkpoint_id long")
    assert O.offset_verdict(summary, log).first().entries == 3
    assert O.offset_verdict(summary, log.limit(0)).first().status == "ERROR"
    nothing_read = O.offset_verdict(O.offset_summary(frame(spark, keyed([]))), log).first()
    assert (nothing_read.status, nothing_read.entries, nothing_read.exit_code) == ("ERROR", 3, 1)


def test_gaps_of_a_known_sequence(spark):
    df = frame(spark, keyed([1, 2, 5, 9]))
    assert as_set(O.offset_gaps(df)) == {(0, 2, 5, 2), (0, 5, 9, 3)}
    assert as_set(O.offset_gaps(frame(spark, keyed([5, 6, 7])))) == set()


def test_limit_takes_the_first_gaps(spark):
    df = frame(spark, keyed([1, 3, 5, 7], 1) + keyed([1, 3], 0))
    rows = O.offset_gaps(df, limit=2).collect()
    assert [tuple(row) for row in rows] == [(0, 1, 3, 1), (1, 1, 3, 1)]


def test_two_topics_collide_only_without_the_topic_key(spark):
    rows = [(topic, 0, offset) for topic in "ab" for offset in range(3)]
    df = spark.createDataFrame(rows, "kafka_topic string, " + SCHEMA)
    assert O.offset_totals(O.offset_summary(df)).first().total_duplicates == 3
    both = O.offset_summary(df, ("kafka_topic", "kafka_partition"))
    assert O.offset_totals(both).first().total_duplicates == 0


def test_word_and_chunk_borders(spark):
    chunk, far = 1 << 20, 1 << 40
    offsets = [-64, -63, -1, 0, 63, 64, 127, 129, chunk - 1, chunk, 3 * chunk, far - 1, far, 5 * far, 1 << 61]
    rows = keyed(offsets) + keyed(range(64), 1) + keyed([63], 2) + keyed([far, far], 3)
    summary, gaps = brute_force(rows)
    df = frame(spark, rows)
    assert as_set(O.offset_summary(df)) == summary
    assert as_set(O.offset_gaps(df)) == gaps


def test_null_offsets_count_as_rows_only(spark):
    df = frame(spark, [(0, 1), (0, None), (0, 3), (1, None)])
    rows = {row.kafka_partition: row for row in O.offset_summary(df).collect()}
    assert (rows[0].record_count, rows[0].distinct_offsets, rows[0].missing_offsets) == (3, 2, 1)
    assert (rows[1].record_count, rows[1].distinct_offsets, rows[1].min_offset) == (1, 0, None)
    assert as_set(O.offset_gaps(df)) == {(0, 1, 3, 1)}


def test_empty_totals_are_zero(spark):
    assert tuple(O.offset_totals(O.offset_summary(frame(spark, []))).first()) == (0, 0)


offsets_lists = st.lists(
    st.tuples(
        st.integers(0, 2),
        st.one_of(st.integers(0, 200), st.integers(2**20 - 70, 2**20 + 70), st.integers(-(2**50), 2**50)),
    ),
    min_size=1,
    max_size=80,
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=offsets_lists)
def test_any_rows_match_brute_force(spark, rows):
    summary, gaps = brute_force(rows)
    df = frame(spark, rows)
    assert as_set(O.offset_summary(df)) == summary
    assert as_set(O.offset_gaps(df)) == gaps
    assert sum(row[-1] for row in gaps) == sum(row[-2] for row in summary)


def test_one_key_and_one_offset_with_a_third_of_all_rows(spark):
    """A hot key, and inside another key one offset delivered over and over."""
    random.seed(7)
    hot = keyed([n for n in range(30_000) if n % 7], 0)
    copies = keyed([11] * 30_000, 1) + keyed([1, 12], 1)
    rest = [(random.randrange(2, 50), random.randrange(5_000)) for _ in range(30_000)]
    rows = hot + copies + rest
    summary, gaps = brute_force(rows)
    df = frame(spark, rows).repartition(8)
    assert as_set(O.offset_summary(df)) == summary
    assert as_set(O.offset_gaps(df)) == gaps
    # The copies are folded before the shuffle: no word holds more rows than one per task.
    words = O.offset_words(df)
    assert words.filter("kafka_partition = 1").count() == 1


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_scan_two_columns_once_and_fold_before_the_shuffle(spark, tmp_path):
    rows = [(n % 3, n, "payload") for n in range(1_000)]
    spark.createDataFrame(rows, SCHEMA + ", body string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    gaps = O.offset_gaps(df)
    gaps.collect()
    final = plan_of(gaps).split("Initial Plan")[0]
    assert final.count("FileScan") == 1
    assert "ReadSchema: struct<kafka_partition:int,kafka_offset:bigint>" in final
    for plan in (final, plan_of(O.offset_summary(df))):
        assert "partial_bit_or" in plan
        assert "Cartesian" not in plan and "NestedLoop" not in plan
