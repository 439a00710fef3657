import pytest
from pyspark.sql import functions as F

from offsetledger import schemas
from offsetledger.operators import records as R
from offsetledger.operators.round_robin import assign_round_robin, dense_position, round_robin_batches

GOOD = b'{"uuid":"u%d","timestamp":%d}'


def log(spark, values):
    rows = [(None, value, "t", 0, offset, None, 0) for offset, value in enumerate(values)]
    return spark.createDataFrame(rows, schemas.LOG)


def test_malformed_messages_are_told_apart(spark):
    values = [
        bytearray(GOOD % (0, 0)),
        None,
        bytearray(b"\xff\xfe"),
        bytearray(b'{"uuid":"x","timest'),
        bytearray(b'{"timestamp":1}'),
        bytearray(b'{"uuid":"x"}'),
        bytearray(b'{"uuid":"x","timestamp":"soon"}'),
        bytearray(b""),
    ]
    rows = R.decode(log(spark, values)).orderBy("kafka_offset").collect()
    assert [row.reason for row in rows] == [
        None,
        "null value",
        "undecodable",
        "undecodable",
        "no uuid",
        "no timestamp",
        "no timestamp",
        "undecodable",
    ]
    usable, malformed = R.split_malformed(R.decode(log(spark, values)))
    assert (usable.count(), malformed.count()) == (1, 7)
    kept = R.quarantine(malformed, 3)
    assert kept.columns == schemas.QUARANTINE.names
    assert {bytes(row.value) if row.value is not None else None for row in kept.collect()} == {
        bytes(value) if value is not None else None for value in values[1:]
    }


def test_enriched_rows_have_the_stored_schema(spark):
    values = [bytearray(GOOD % (n, 1000 + n)) for n in range(25)]
    usable, _ = R.split_malformed(R.decode(log(spark, values)))
    enriched = R.enrich(usable, 4)
    assert [(field.name, field.dataType) for field in enriched.schema] == [
        (field.name, field.dataType) for field in schemas.ENRICHED
    ]
    row = enriched.filter("kafka_offset = 3").first()
    assert tuple(row) == ("u3", 1003, "t", 0, 3, 4)


def test_route_default_and_own_predicate(spark):
    df = spark.range(25).select(F.col("id").alias("kafka_offset"))
    dropped = R.route(df).filter("sink = 'dropped'")
    assert sorted(row.kafka_offset for row in dropped.collect()) == [0, 10, 20]
    own = R.route(df, F.col("kafka_offset") > 20).filter("sink = 'dropped'")
    assert own.count() == 4


def test_union_matches_columns_by_name(spark):
    left, right = spark.sql("SELECT 1 AS a, 2 AS b"), spark.sql("SELECT 4 AS b, 3 AS a")
    assert sorted(map(tuple, R.union_records([left, right]).collect())) == [(1, 2), (3, 4)]


def test_unordered_round_robin_is_even_in_every_task(spark):
    df = assign_round_robin(spark.range(0, 1003, 1, 4), 10)
    counts = df.groupBy(F.spark_partition_id(), "partition").count().collect()
    sizes = [row["count"] for row in counts]
    assert sum(sizes) == 1003 and max(sizes) - min(sizes) <= 1


def test_unordered_round_robin_is_even_over_many_small_tasks(spark):
    df = assign_round_robin(spark.range(0, 1200, 1, 400), 10)
    sizes = [row["count"] for row in df.groupBy("partition").count().collect()]
    assert len(sizes) == 10 and max(sizes) - min(sizes) <= 4


def test_round_robin_on_a_stream(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
    query = assign_round_robin(stream, 4).writeStream.format("memory").queryName("placed").trigger(availableNow=True).start()
    query.awaitTermination()
    sizes = {row.partition: row["count"] for row in spark.table("placed").groupBy("partition").count().collect()}
    assert set(sizes) == {0, 1, 2, 3} and min(sizes.values()) > 150


def test_ordered_round_robin_equals_the_global_count(spark):
    # Uneven values, shuffled input, more slices than needed.
    values = sorted({n * n for n in range(500)} | set(range(100_000, 100_300)))
    df = spark.createDataFrame([(value,) for value in values], "v long").repartition(7)
    for rows_per_slice in (10_000, 400, 50):
        rows = assign_round_robin(df, 7, "v", rows_per_slice).collect()
        assert sorted((row.v, row.partition) for row in rows) == [(v, at % 7) for at, v in enumerate(values)]


def test_ordered_round_robin_of_no_rows_and_of_missing_numbers(spark):
    df = spark.createDataFrame([(3,), (None,), (1,), (2,)], "v long")
    assert assign_round_robin(df.limit(0), 3, "v").collect() == []
    for rows_per_slice in (10, 2):
        rows = assign_round_robin(df, 10, "v", rows_per_slice).collect()
        assert sorted((row.partition, row.v) for row in rows) == [(0, 1), (1, 2), (2, 3), (3, None)]


def test_ordered_round_robin_by_time(spark):
    df = spark.range(50).select(F.timestamp_seconds(F.col("id") * 60).alias("at"), "id")
    rows = assign_round_robin(df, 4, "at", 20).collect()
    assert all(row.partition == row.id % 4 for row in rows) and len(rows) == 50


@pytest.mark.parametrize("crash", [False, True])
def test_a_stream_goes_round_exactly_over_batches_and_replays(spark, tmp_path, crash):
    sizes = [17, 1, 0, 40, 5]
    taken, failed = {}, []

    def sink(batch, batch_id):
        taken[batch_id] = [row.partition for row in batch.collect()]
        if crash and batch_id == 3 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost")

    state = str(tmp_path / "starts")
    for batch_id, n in enumerate(sizes):
        frame = spark.range(n).repartition(3)
        process = round_robin_batches(sink, 7, state)  # a new driver each time
        try:
            process(frame, batch_id)
        except RuntimeError:
            process(frame, batch_id)
    counts = [sum(taken[batch].count(partition) for batch in taken) for partition in range(7)]
    assert sum(counts) == sum(sizes) and max(counts) - min(counts) <= 1
    assert [len(taken[batch]) for batch in range(5)] == sizes and failed == ([3] if crash else [])


def test_ordered_round_robin_of_strings_and_of_one_value(spark):
    rows = spark.range(500).selectExpr("cast(id % 3 as string) as name", "id")
    placed = dense_position(rows, "name", rows_per_slice=20).collect()
    assert sorted(row._position for row in placed) == list(range(500))
    assert [row.name for row in sorted(placed, key=lambda row: row._position)] == sorted(row.name for row in placed)
    same = assign_round_robin(spark.range(100).selectExpr("1 as x", "id"), 8, order_by="x")
    assert sorted(row["count"] for row in same.groupBy("partition").count().collect()) == [12] * 4 + [13] * 4
