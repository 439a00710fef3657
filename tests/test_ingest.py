import json
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from offsetledger import schemas
from offsetledger.__main__ import main
from offsetledger.operators.selection import files_of_checkpoint
from offsetledger.operators.offsets import offset_summary, offset_totals
from offsetledger.plans.audit import audit_offsets, render_report
from offsetledger.plans.views import log_view
from offsetledger.sources.commit_log import read_commit_log
from offsetledger.sources.data_files import list_files_at, read_committed
from offsetledger.sources.log import MAX_OFFSETS, MIN_PARTITIONS, encode_messages, kafka_options, publish, read_log_table
from offsetledger.streaming import ingest as I

NOW = {"availableNow": True}
BATCHES = 3
PER_BATCH = 200


class Job:
    """A log of three files, read one per batch, and the places its ingest writes to."""

    def __init__(self, spark, base: Path):
        self.spark, self.base = spark, base
        self.paths = I.IngestPaths(
            str(base / "output"), str(base / "dropped"), str(base / "wal"), str(base / "quarantine")
        )
        ids = spark.range(BATCHES * PER_BATCH).withColumn("at", F.timestamp_seconds(F.col("id") * 600))
        self.log = log_view(ids, "t", "id", "at", partitions=4)
        for number in range(BATCHES):
            part = F.col("offset").between(number * PER_BATCH // 4, (number + 1) * PER_BATCH // 4 - 1)
            self.append(self.log.filter(part))

    def append(self, rows):
        rows.coalesce(1).write.mode("append").parquet(str(self.base / "log"))

    def run(self, checkpoint="checkpoint", **options):
        log = read_log_table(self.spark, str(self.base / "log"), max_files_per_trigger=1)
        query = I.run_ingest(log, self.paths, str(self.base / checkpoint), trigger=NOW, **options)
        query.awaitTermination()
        return query

    def logged(self):
        return read_commit_log(self.spark, self.paths.commit_log)

    def days(self):
        return sorted(path.name for path in Path(self.paths.commit_log).iterdir())

    def audit(self, **options):
        days = self.days()
        return audit_offsets(self.spark, self.paths.commit_log, start=days[0], end=days[-1], **options)

    def verdict(self, **options):
        audit = self.audit(**options)
        try:
            return audit.verdict.first(), audit.stale.count()
        finally:
            audit.close()


@pytest.fixture
def job(spark, tmp_path):
    return Job(spark, tmp_path)


def stored(job):
    rows = read_committed(job.spark, job.logged(), schemas.ENRICHED)
    return sorted(tuple(row) for row in rows.drop("checkpoint_id").collect())


def test_ingest_then_audit_then_failures(job, spark):
    query = job.run()
    assert sum(progress["numInputRows"] for progress in query.recentProgress) == BATCHES * PER_BATCH
    observed = [progress.observedMetrics["ingest"].asDict() for progress in query.recentProgress if progress.observedMetrics]
    assert sum(row["output"] for row in observed) == 540 and sum(row["dropped"] for row in observed) == 60
    verdict, lost = job.verdict()
    assert (verdict.status, verdict.total_missing, verdict.total_duplicates, lost) == ("PASS", 0, 0, 0)
    # The main table alone lacks every tenth offset; the first of them precedes its range.
    output_only, _ = job.verdict(sources=("output",))
    assert (output_only.status, output_only.total_missing) == ("FAIL", 4 * 14)

    # Layout and stored columns.
    files = list_files_at(spark, [job.paths.output]).collect()
    assert all("/year=" in row.s3_key and "/run_id=" in row.s3_key and "/batch_id=" in row.s3_key for row in files)
    read = spark.read.parquet(files[0].file_path)
    assert [(field.name, field.dataType) for field in read.schema] == [
        (field.name, field.dataType) for field in schemas.ENRICHED
    ]

    # Records carry the checkpoint their file is logged under.
    log = job.logged().select(F.col("s3_key"), F.col("checkpoint_id").alias("logged_id"))
    rows = spark.read.option("recursiveFileLookup", True).parquet(job.paths.output, job.paths.dropped)
    rows = rows.select("checkpoint_id", F.col("_metadata.file_path").alias("s3_key")).distinct()
    matched = rows.join(log, "s3_key")
    assert matched.count() == log.count() == rows.count()
    assert matched.filter("checkpoint_id <> logged_id").count() == 0
    assert matched.select("logged_id").distinct().count() == BATCHES

    # Replay: forget the last commit and start again.
    before, entries = stored(job), sorted(map(tuple, job.logged().select("checkpoint_id", "source").collect()))
    commits = job.base / "checkpoint" / "commits"
    (commits / str(BATCHES - 1)).unlink()
    (commits / f".{BATCHES - 1}.crc").unlink(missing_ok=True)
    job.run()
    assert stored(job) == before
    assert sorted(map(tuple, job.logged().select("checkpoint_id", "source").collect())) == entries
    assert job.verdict()[0].status == "PASS"

    # Resume: more messages, same query.
    more = spark.range(BATCHES * PER_BATCH, BATCHES * PER_BATCH + 40).withColumn("at", F.timestamp_seconds("id"))
    job.append(log_view(more, "t", "id", "at", partitions=4))
    job.run()
    verdict, _ = job.verdict()
    assert verdict.status == "PASS" and len(stored(job)) == BATCHES * PER_BATCH + 40

    # An entry of a failed attempt is reported and changes nothing.
    folder = next(Path(job.paths.commit_log).rglob("output-batch-*"))
    (folder / "extra.csv").write_text(
        f"checkpoint_id,s3_key,commit_timestamp\n9,file:{job.paths.output}/year=2026/x.parquet,1\n"
    )
    verdict, lost = job.verdict()
    assert (verdict.status, lost) == ("PASS", 1)

    # A lost file in the middle is a gap and a stale entry.
    middle = job.logged().filter("checkpoint_id = 1 AND source = 'output'").first().s3_key
    Path(middle.removeprefix("file:")).unlink()
    audit = job.audit()
    text, code = render_report(audit)
    audit.close()
    assert code == 1 and "FAIL" in text and "2 log entries" in text and "gap_after" in text
    days = job.days()
    arguments = ["--master", "local[2]", "audit", "--commit-log", job.paths.commit_log]
    assert main([*arguments, days[0], days[-1]]) == 1
    assert main([*arguments, "01-01-2020", "01-01-2020"]) == 1

    # A damaged file stops the audit unless it is told to go on, and is then named.
    other = job.logged().filter("checkpoint_id = 2 AND source = 'output'").first().s3_key
    Path(other.removeprefix("file:")).write_bytes(b"not parquet")
    Path(other.removeprefix("file:")).with_name(f".{other.rsplit('/', 1)[1]}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception):
        job.verdict()
    audit = job.audit(strict=False)
    assert "1 log entries name files that gave no rows" in render_report(audit)[0]
    audit.close()


def test_same_checkpoint_numbers_of_another_run_do_not_collide(job):
    job.run("first")
    job.run("second")
    verdict, _ = job.verdict()
    # Everything was ingested twice and nothing was overwritten.
    assert (verdict.status, verdict.total_duplicates) == ("WARN", BATCHES * PER_BATCH)
    assert job.logged().select("checkpoint_id").distinct().count() == BATCHES


@pytest.mark.parametrize("step,sink", [("append_commit_log", "output"), ("write_bucketed", "dropped")])
def test_a_crash_inside_a_batch_is_healed_by_its_replay(job, spark, monkeypatch, step, sink):
    original = getattr(I, step)
    target = {"append_commit_log": "/output-batch-", "write_bucketed": job.paths.dropped}[step]
    crashed = []

    def crash_once(df, path, *rest):
        if target in path and len(list(Path(job.paths.commit_log).rglob("*-batch-*"))) >= 2 and not crashed:
            crashed.append(path)
            raise RuntimeError("executor lost")
        return original(df, path, *rest)

    monkeypatch.setattr(I, step, crash_once)
    with pytest.raises(StreamingQueryException):
        job.run()
    assert crashed and sink in crashed[0]
    job.run()
    verdict, lost = job.verdict()
    assert (verdict.status, lost, len(stored(job))) == ("PASS", 0, BATCHES * PER_BATCH)
    # Nothing of the failed attempt is left beside the logged files.
    tables = list_files_at(spark, [job.paths.output, job.paths.dropped])
    assert tables.count() == job.logged().count()


def test_malformed_messages_go_to_quarantine(job, spark):
    bad = [
        (None, value, "t", 0, 150 + at, None, 0)
        for at, value in enumerate([bytearray(b"?"), bytearray(b"{}"), bytearray(b'{"uuid":1'), None])
    ]
    job.append(spark.createDataFrame(bad, schemas.LOG))
    job.append(spark.createDataFrame([(None, bytearray(b'{"uuid":"z","timestamp":1}'), "t", 0, 154, None, 0)], schemas.LOG))
    job.run()
    verdict, _ = job.verdict()
    assert (verdict.status, verdict.total_missing) == ("FAIL", 4)
    counted, _ = job.verdict(sources=("output", "dropped", "quarantine"))
    assert counted.status == "PASS"
    rows = read_committed(spark, job.logged().filter("source = 'quarantine'"), schemas.QUARANTINE).collect()
    assert sorted((row.kafka_offset, row.reason) for row in rows) == [
        (150, "undecodable"),
        (151, "undecodable"),
        (152, "undecodable"),
        (153, "null value"),
    ]


def test_event_time_buckets_and_own_predicate(job, spark):
    job.run(bucket_by="event", drop_predicate=F.col("timestamp") < 3_600_000)
    table = spark.read.schema(schemas.PARTITIONS).parquet(job.paths.output)
    counts = table.groupBy("month", "day", "hour").count().collect()
    # One message every ten minutes from 1970 on; the first hour was routed away.
    assert len(counts) == 99 and {row["count"] for row in counts} == {6}
    assert spark.read.parquet(job.paths.dropped).count() == 6
    assert job.verdict()[0].status == "PASS"


@pytest.mark.parametrize("run_id", ["job:1", "a/b c", "50%=x", "{d}[1]*?^'q'"])
def test_any_run_id_is_logged(job, run_id):
    job.run(run_id=run_id)
    assert job.verdict()[0].status == "PASS" and len(stored(job)) == BATCHES * PER_BATCH
    (run,) = {row.run_id for row in job.logged().collect()}
    assert run.startswith(f"{run_id}-")


@pytest.mark.parametrize("name", ["out[1]", "o{a,b}", "o * b"])
def test_any_table_path_is_logged(spark, tmp_path, name):
    job = Job(spark, tmp_path)
    job.paths = I.IngestPaths(str(tmp_path / name / "output"), str(tmp_path / name / "dropped"), str(tmp_path / name / "wal"))
    job.run()
    assert job.verdict()[0].status == "PASS" and len(stored(job)) == BATCHES * PER_BATCH


def test_two_checkpoints_under_one_run_id_keep_all_rows(job, spark):
    job.run("first", run_id="nightly")
    job.run("second", run_id="nightly")
    assert len(stored(job)) == 2 * BATCHES * PER_BATCH
    runs = {row.run_id for row in job.logged().collect()}
    assert len(runs) == 2
    of_one = files_of_checkpoint(job.logged(), 0, min(runs))
    assert of_one.count() and 2 * of_one.count() == files_of_checkpoint(job.logged(), 0).count()


def test_a_batch_without_its_files_fails(job, monkeypatch):
    monkeypatch.setattr(I, "write_bucketed", lambda df, path: None)
    with pytest.raises(StreamingQueryException, match="no data file below"):
        job.run()
    assert not Path(job.paths.commit_log).exists()


def test_malformed_messages_are_kept_by_default(job, spark):
    job.paths = I.IngestPaths(job.paths.output, job.paths.dropped, job.paths.commit_log)
    job.append(spark.createDataFrame([(None, bytearray(b"?"), "t", 0, 150, None, 0)], schemas.LOG))
    job.run()
    assert spark.read.parquet(f"{job.paths.output}-quarantine").count() == 1


def test_lost_files(job):
    job.run()
    files = [Path(row.s3_key.removeprefix("file:")) for row in job.logged().filter("source = 'output'").collect()]
    for file in files[1:]:
        file.unlink()
    verdict, lost = job.verdict()
    assert verdict.status != "ERROR" and lost == len(files) - 1
    for row in job.logged().collect():
        Path(row.s3_key.removeprefix("file:")).unlink(missing_ok=True)
    audit = job.audit()
    text, code = render_report(audit)
    audit.close()
    assert code == 1 and text.startswith("ERROR") and "gave no offset" in text


def test_times_without_a_directory_use_the_clock(spark):
    rows = [(None, bytearray(b'{"uuid":"a","timestamp":%d}' % ms), "t", 0, at, None, 0) for at, ms in enumerate([10**17, -5, 0])]
    prepared = I.prepare(spark.createDataFrame(rows, schemas.LOG), bucket_by="event")
    years = [row.year for row in prepared.orderBy("kafka_offset").collect()]
    assert years[2] == "1970" and years[0] == years[1] > "2000"
    with pytest.raises(ValueError):
        I.prepare(spark.createDataFrame(rows, schemas.LOG), bucket_by="arrival")


def test_raw_bytes_are_kept_for_quarantine_only(spark):
    rows = [(bytearray(b"k"), value, "t", 0, 1, None, 0) for value in (bytearray(b"?"), bytearray(b'{"uuid":"a","timestamp":1}'))]
    prepared = I.prepare(spark.createDataFrame(rows, schemas.LOG)).collect()
    assert {(row.sink, row.key is None, row.value is None) for row in prepared} == {
        ("quarantine", False, False),
        ("output", True, True),
    }


def test_replay_keeps_the_batch_clock(job):
    job.run()
    written = {row.log_path for row in job.logged().select("log_path").collect()}
    offsets = json.loads((job.base / "checkpoint/offsets/0").read_text().splitlines()[1])
    stamp = offsets["batchTimestampMs"]
    assert job.logged().filter(f"checkpoint_id = 0 AND commit_timestamp = {stamp}").count() == 2
    assert all("-batch-" in path for path in written)


def test_cli_ingest_and_audit_by_path(job, spark, capsys):
    local = ["--master", "local[2]"]
    arguments = [*local, "ingest", "--log-table", f"{job.base}/log", "--output", job.paths.output, "--dropped", job.paths.dropped]
    arguments += ["--commit-log", job.paths.commit_log, "--checkpoint", f"{job.base}/cp", "--available-now"]
    assert main(arguments) == 0
    assert offset_totals(offset_summary(read_committed(spark, job.logged()))).first().total_missing == 0
    assert main([*local, "audit", "--commit-log", job.paths.commit_log, "--paths", *job.days()]) == 0
    assert "PASS" in capsys.readouterr().out
    assert main([*local, "files", "--commit-log", job.paths.commit_log, "0"]) == 0
    printed = capsys.readouterr().out.split()
    assert sorted(printed) == sorted(row.s3_key for row in job.logged().collect())
    with pytest.raises(SystemExit):
        main(["audit", "--commit-log", job.paths.commit_log, "01-01-2024"])


def test_kafka_options():
    plain = kafka_options("b:9092", "t")
    bounds = {"maxOffsetsPerTrigger": str(MAX_OFFSETS), "minPartitions": str(MIN_PARTITIONS)}
    assert plain == {"kafka.bootstrap.servers": "b:9092", "subscribe": "t", "startingOffsets": "earliest", **bounds}
    secured = kafka_options(
        "b:9094", "t", security_protocol="SSL", group_id="g", min_partitions=64, max_offsets_per_trigger=9
    )
    assert secured["kafka.security.protocol"] == "SSL" and secured["kafka.group.id"] == "g"
    assert secured["minPartitions"] == "64" and secured["maxOffsetsPerTrigger"] == "9"


def test_messages_to_publish(spark):
    rows = encode_messages(spark.sql("SELECT 'u' AS uuid, 7L AS timestamp"))
    assert rows.select(F.col("value").cast("string")).first()[0] == '{"uuid":"u","timestamp":7}'
    assert rows.first().key is None
    stream = spark.readStream.format("rate").load().select(F.lit(b"x").alias("value"))
    with pytest.raises(ValueError):
        publish(stream, "b:9092", "t")
