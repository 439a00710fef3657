"""The offset audit: from a commit-log range to a verdict."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offsetledger.functions.ranges import parse_paths, parse_range
from offsetledger.operators.offsets import (
    DEFAULT_KEYS,
    REPORTED_GAPS,
    first_gaps,
    gaps_of_words,
    merge_words,
    offset_verdict,
    offset_words,
    summarize_words,
)
from offsetledger.operators.selection import AUDITED, entry_counts, select_minutes, stale
from offsetledger.sources.commit_log import read_commit_log
from offsetledger.sources.data_files import Listing, find_files, of_logged_files, read_logged_batches, unread_entries


@dataclass
class Audit:
    """An audit's frames. `log`, `files` and `file_words` are cached; `close()` lets them go."""

    title: str
    keys: tuple[str, ...]
    log: DataFrame
    files: DataFrame
    stale: DataFrame
    # Offset words of each file, and of all files together.
    file_words: DataFrame
    words: DataFrame
    summary: DataFrame
    verdict: DataFrame
    # Entries that gave no row; only a tolerant audit can have them.
    unread: DataFrame | None = None

    def gaps(self, limit: int | None = None) -> DataFrame:
        gaps = gaps_of_words(self.words, self.keys)
        return gaps if limit is None else first_gaps(gaps, self.keys, limit)

    def close(self) -> None:
        for cached in (self.file_words, self.files, self.log):
            cached.unpersist()


def select_log(
    spark: SparkSession,
    base: str,
    *,
    start: str | None = None,
    end: str | None = None,
    paths: list[str] | None = None,
    sources: tuple[str, ...] | None = AUDITED,
) -> DataFrame:
    """Commit-log entries of a day range, a minute range or some folders.

    Only the folders concerned are listed and read.
    """
    if paths is not None:
        log = read_commit_log(spark, base, parse_paths(paths))
    elif start is not None and end is not None:
        wanted = parse_range(start, end)
        log = read_commit_log(spark, base, wanted.folders)
        if wanted.first_ms is not None:
            log = select_minutes(log, start, end)
    else:
        raise ValueError("give start and end, or paths")
    return log if sources is None else log.filter(F.col("source").isin(*sources))


def audit_offsets(
    spark: SparkSession,
    base: str,
    *,
    start: str | None = None,
    end: str | None = None,
    paths: list[str] | None = None,
    keys: tuple[str, ...] = DEFAULT_KEYS,
    sources: tuple[str, ...] | None = AUDITED,
    roots: list[str] | None = None,
    strict: bool = True,
) -> Audit:
    """Prove that the files logged in a range hold every offset between their outer ones.

    The data is scanned once, two columns wide, into offset words of each file; files that the log does not name
    fall out then. Summary, verdict and gaps, and in a tolerant audit (`strict=False`) what each file gave, are all
    computed from those words.
    """
    log = select_log(spark, base, start=start, end=end, paths=paths, sources=sources)
    log = log.persist(StorageLevel.MEMORY_AND_DISK)
    found = find_files(spark, log, roots)
    listing = Listing(found.files.persist(StorageLevel.MEMORY_AND_DISK))
    file_words = words_by_file(spark, log, keys, roots=roots, strict=strict).persist(StorageLevel.MEMORY_AND_DISK)
    words = merge_words(file_words, keys)
    summary = summarize_words(words, keys)
    return Audit(
        title=f"paths: {' '.join(paths)}" if paths is not None else f"{start} to {end}",
        keys=keys,
        log=log,
        files=listing.files,
        stale=stale(log, listing.files),
        file_words=file_words,
        words=words,
        summary=summary,
        verdict=offset_verdict(summary, log),
        unread=None if strict else unread_entries(spark, log, listing=listing, read=rows_by_file(file_words)),
    )


def words_by_file(
    spark: SparkSession, log: DataFrame, keys: tuple[str, ...] = DEFAULT_KEYS, *, roots: list[str] | None = None, strict: bool = True
) -> DataFrame:
    """Offset words of each file that the log names, with its `file_path`, in one scan."""
    rows = read_logged_batches(spark, log, roots=roots, strict=strict)
    return of_logged_files(offset_words(rows, ("file_path", *keys)), log)


def rows_by_file(file_words: DataFrame) -> DataFrame:
    """How many rows with an offset each file gave; one that gave none has no row here."""
    return file_words.filter("word is not null").groupBy("file_path").agg(F.sum("rows").alias("rows"))


def report_lines(audit: Audit, limit: int = REPORTED_GAPS) -> DataFrame:
    """The report as rows: `section`, `line` (from 1 in its section) and `text`.

    Sections: entries, warnings, summary, verdict, gaps. A summary has a line for each log partition; of the gaps
    there are the first `limit`, and only where offsets are missing.
    """
    one = F.lit(1).cast("long")
    counts = entry_counts(audit.log).select(
        F.row_number().over(Window.orderBy("source")).cast("long").alias("line"),
        F.format_string("%s: %d log entries, %d files", "source", "entries", "distinct_files").alias("text"),
    )
    warnings = _warning(audit.stale, one, "%d log entries name files that do not exist")
    if audit.unread is not None:
        warnings = warnings.unionAll(_warning(audit.unread, one + 1, "%d log entries name files that gave no rows"))
    verdict = audit.verdict.select(
        one.alias("line"),
        F.when(F.col("status") == "ERROR", F.format_string("ERROR: %d commit-log entries gave no offset", "entries"))
        .when(F.col("status") == "FAIL", F.format_string("FAIL: %d missing offset(s)", "total_missing"))
        .when(F.col("status") == "WARN", F.format_string("WARN: %d duplicate offset(s)", "total_duplicates"))
        .otherwise("PASS: no offset is missing, none is duplicate")
        .alias("text"),
    )
    sections = {
        "entries": counts,
        "warnings": warnings,
        "summary": _table_lines(audit.summary, audit.keys),
        "verdict": verdict,
        "gaps": _table_lines(audit.gaps(limit), (*audit.keys, "gap_after")),
    }
    return reduce(DataFrame.unionAll, [rows.select(F.lit(name).alias("section"), "line", "text") for name, rows in sections.items()])


def _warning(entries: DataFrame, line: Column, text: str) -> DataFrame:
    """One line if there are entries, else none."""
    counted = entries.agg(F.count("*").alias("n")).filter("n > 0")
    return counted.select(line.alias("line"), F.concat(F.lit("WARNING: "), F.format_string(text, "n")).alias("text"))


def _table_lines(df: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """The rows of a small frame as aligned columns of text below a header line."""
    every = Window.partitionBy(F.lit(0))
    cells = {name: F.coalesce(F.col(name).cast("string"), F.lit("None")) for name in df.columns}
    widths = {f"_{name}": F.greatest(F.max(F.length(cells[name])).over(every), F.lit(len(name))) for name in df.columns}
    placed = df.withColumns({**widths, "_at": F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))})
    rows = placed.select(
        (F.col("_at") + 1).cast("long").alias("line"),
        F.concat_ws("  ", *[F.lpad(cells[name], F.col(f"_{name}"), " ") for name in df.columns]).alias("text"),
    )
    header = placed.filter("_at = 1").select(
        F.lit(1).cast("long").alias("line"),
        F.concat_ws("  ", *[F.lpad(F.lit(name), F.col(f"_{name}"), " ") for name in df.columns]).alias("text"),
    )
    return header.unionAll(rows)


def render_report(audit: Audit) -> tuple[str, int]:
    """The audit's report lines as one text, and the exit code."""
    result = audit.verdict.first()
    if result.status == "ERROR":
        if not result.entries:
            return f"ERROR: no commit-log entries for {audit.title}", result.exit_code
        gone = audit.stale.count()
        said = f"ERROR: {result.entries} commit-log entries for {audit.title} gave no offset, {gone} name lost files"
        return said, result.exit_code
    found: dict[str, list[tuple[int, str]]] = {}
    for row in report_lines(audit).collect():
        found.setdefault(row.section, []).append((row.line, row.text))
    text = {name: [line for _, line in sorted(lines)] for name, lines in found.items()}
    lines = [f"Offset audit ({audit.title})", *text.get("entries", []), *text.get("warnings", [])]
    lines += ["", *text.get("summary", []), "", *text["verdict"]]
    if result.status == "FAIL":
        lines += ["", *text.get("gaps", [])]
    elif result.status == "WARN":
        lines.append("PASS: no offset is missing")
    return "\n".join(lines), result.exit_code
