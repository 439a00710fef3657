"""Command line: `python -m offsetledger ingest …`, `audit`, `files`, `publish`.

Options default to the environment variables named in the help, so the same deployment
settings serve all jobs. Run it through spark-submit on a cluster.
"""

from __future__ import annotations

import argparse
import os
import sys

from offsetledger.operators.offsets import DEFAULT_KEYS
from offsetledger.operators.round_robin import assign_round_robin
from offsetledger.operators.selection import AUDITED, files_of_checkpoint
from offsetledger.plans.audit import audit_offsets, render_report
from offsetledger.session import AUDIT_SETTINGS, build_session
from offsetledger.sources.commit_log import read_commit_log
from offsetledger.sources.log import MAX_OFFSETS, MIN_PARTITIONS, encode_messages, kafka_options, publish, read_log, read_log_table
from offsetledger.streaming.ingest import IngestPaths, run_ingest


def _setting(parser: argparse.ArgumentParser, flag: str, variable: str, default: str | None = None) -> None:
    value = os.environ.get(variable, default)
    parser.add_argument(flag, default=value, required=value is None, help=f"${variable}, now {value}")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="offsetledger", description=__doc__)
    parser.add_argument("--master", help="Spark master; leave out under spark-submit")
    jobs = parser.add_subparsers(dest="job", required=True)

    audit = jobs.add_parser("audit", help="check a range of the commit log for missing offsets")
    _setting(audit, "--commit-log", "WRITE_AHEAD_COMMIT_LOG_PATH")
    audit.add_argument("range", nargs="*", metavar="DATE", help="start and end: MM-DD-YYYY or 'MM-DD-YYYY HH:MM'")
    audit.add_argument("--paths", nargs="+", help="folders below the commit log, such as 11-02-2025/07/15")
    audit.add_argument("--keys", nargs="+", default=list(DEFAULT_KEYS))
    audit.add_argument("--sources", nargs="+", default=list(AUDITED))
    audit.add_argument("--roots", nargs="+", help="tables to list whole instead of the logged directories")
    audit.add_argument("--tolerant", action="store_true", help="skip data files that cannot be read")

    files = jobs.add_parser("files", help="list the data files of one checkpoint")
    _setting(files, "--commit-log", "WRITE_AHEAD_COMMIT_LOG_PATH")
    files.add_argument("checkpoint_id", type=int)
    files.add_argument("--run", help="only of this run; ids start again with each")

    publishing = jobs.add_parser("publish", help="send a Parquet table to a topic, evenly over its partitions")
    publishing.add_argument("--table", required=True)
    publishing.add_argument("--uuid", default="uuid", help="column of the message's uuid")
    publishing.add_argument("--timestamp", default="timestamp", help="column of its time in epoch ms")
    publishing.add_argument("--partitions", type=int, required=True, help="how many partitions the topic has")
    publishing.add_argument("--order-by", help="unique column to go round in the order of")

    ingest = jobs.add_parser("ingest", help="stream the log into bucketed tables and their commit log")
    for job in (publishing, ingest):
        _setting(job, "--servers", "KAFKA_BOOTSTRAP_SERVERS", "localhost:9092")
        _setting(job, "--topic", "KAFKA_TOPIC", "events")
        _setting(job, "--security-protocol", "KAFKA_SECURITY_PROTOCOL", "PLAINTEXT")
        job.add_argument("--format", choices=("json", "avro"), default="json")
    ingest.add_argument("--group-id", default=os.environ.get("KAFKA_GROUP_ID"))
    ingest.add_argument("--min-partitions", type=int, default=MIN_PARTITIONS, help="tasks per batch; splits large log partitions")
    ingest.add_argument("--max-offsets", type=int, default=MAX_OFFSETS, help="most messages per batch")
    ingest.add_argument("--log-table", help="read a Parquet copy of the log instead of a topic")
    _setting(ingest, "--output", "OUTPUT_PATH")
    _setting(ingest, "--dropped", "DROPPED_PATH")
    _setting(ingest, "--commit-log", "WRITE_AHEAD_COMMIT_LOG_PATH")
    ingest.add_argument("--quarantine", default=os.environ.get("QUARANTINE_PATH"))
    ingest.add_argument("--checkpoint", required=True, help="shared folder of the query's progress")
    ingest.add_argument("--bucket-by", choices=("processing", "event"), default="processing")
    ingest.add_argument("--interval", default="60 seconds", help="time between batches")
    ingest.add_argument("--available-now", action="store_true", help="stop when the log is read up")
    return parser


def main(argv: list[str] | None = None) -> int:
    parser = _parser()
    args = parser.parse_args(argv)
    if args.job == "audit" and (len(args.range) != 2) == (not args.paths):
        parser.error("audit: give a start and an end, or --paths")
    settings = AUDIT_SETTINGS if args.job == "audit" else {}
    spark = build_session(f"offsetledger-{args.job}", args.master, settings)
    if args.job == "publish":
        rows = encode_messages(spark.read.parquet(args.table), args.format, args.uuid, args.timestamp)
        assigned = assign_round_robin(rows, args.partitions, args.order_by)
        publish(assigned, args.servers, args.topic, security_protocol=args.security_protocol)
        return 0
    if args.job == "files":
        entries = files_of_checkpoint(read_commit_log(spark, args.commit_log), args.checkpoint_id, args.run)
        for row in entries.select("s3_key").toLocalIterator():
            print(row.s3_key)
        return 0
    if args.job == "audit":
        chosen = {"paths": args.paths} if args.paths else dict(zip(("start", "end"), args.range))
        audit = audit_offsets(
            spark,
            args.commit_log,
            keys=tuple(args.keys),
            sources=tuple(args.sources),
            roots=args.roots,
            strict=not args.tolerant,
            **chosen,
        )
        try:
            text, code = render_report(audit)
        finally:
            audit.close()
        print(text)
        return code
    if args.log_table:
        log = read_log_table(spark, args.log_table)
    else:
        options = kafka_options(
            args.servers,
            args.topic,
            security_protocol=args.security_protocol,
            group_id=args.group_id,
            min_partitions=args.min_partitions,
            max_offsets_per_trigger=args.max_offsets,
        )
        log = read_log(spark, options)
    query = run_ingest(
        log,
        IngestPaths(args.output, args.dropped, args.commit_log, args.quarantine),
        args.checkpoint,
        fmt=args.format,
        bucket_by=args.bucket_by,
        trigger={"availableNow": True} if args.available_now else {"processingTime": args.interval},
    )
    query.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
