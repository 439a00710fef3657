"""Missing and duplicate offsets, exactly, per key.

Offsets are folded into 64-offset words before anything is shuffled: one row per key and
word with a bit per offset seen. A dense log shrinks about 64 times on the map side, copies
of one offset collapse into its bit, and a hot key spreads over all its words. Summary and
gaps both come from the words, so an audit reads its data once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD_BITS = 6
# Gaps are sought inside chunks of 2^20 offsets (at most 2^19 runs), then between the
# chunks of 2^40 offsets, then between those: no window partition outgrows a task.
CHUNK_BITS = (20, 40)

DEFAULT_KEYS = ("kafka_partition",)
REPORTED_GAPS = 50


def _trailing_zeros(bits: Column) -> Column:
    # Clearing the lowest set bit overflows for the top bit alone, whose answer is 63.
    below = F.bitwise_not(bits).bitwiseAND(F.try_subtract(bits, F.lit(1).cast("long")))
    return F.coalesce(F.bit_count(below), F.when(bits.isNotNull(), 63))


def _highest_bit(bits: Column) -> Column:
    return F.length(F.bin(bits)) - 1


def offset_words(df: DataFrame, keys: tuple[str, ...] = DEFAULT_KEYS, offset: str = "kafka_offset") -> DataFrame:
    """One row per key and 64-offset word: the `mask` of offsets seen and its `rows`."""
    value = F.col(offset).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), value.bitwiseAND(F.lit(63)).cast("int"))
    word = F.shiftright(value, WORD_BITS)
    return df.groupBy(*keys, word.alias("word")).agg(F.bit_or(bit).alias("mask"), F.count("*").alias("rows"))


def merge_words(words: DataFrame, keys: tuple[str, ...] = DEFAULT_KEYS) -> DataFrame:
    """Words folded from several parts of the rows (files, hours, batches) as the words of all rows."""
    return words.groupBy(*keys, "word").agg(F.bit_or("mask").alias("mask"), F.sum("rows").alias("rows"))


def summarize_words(words: DataFrame, keys: tuple[str, ...] = DEFAULT_KEYS) -> DataFrame:
    """The summary of already folded offsets."""
    seen = F.coalesce(F.bit_count("mask").cast("long"), F.lit(0))
    per_key = words.groupBy(*keys).agg(
        F.min("word").alias("low_word"),
        F.min_by("mask", "word").alias("low_mask"),
        F.max("word").alias("high_word"),
        F.max_by("mask", "word").alias("high_mask"),
        F.sum("rows").alias("record_count"),
        F.sum(seen).alias("distinct_offsets"),
    )
    low = F.shiftleft("low_word", WORD_BITS) + _trailing_zeros(F.col("low_mask"))
    high = F.shiftleft("high_word", WORD_BITS) + _highest_bit(F.col("high_mask"))
    expected = F.col("max_offset") - F.col("min_offset") + 1
    ranged = per_key.withColumns({"min_offset": low, "max_offset": high}).withColumn("expected_count", expected)
    return ranged.select(
        *keys,
        "min_offset",
        "max_offset",
        "record_count",
        "distinct_offsets",
        "expected_count",
        (F.col("expected_count") - F.col("distinct_offsets")).alias("missing_offsets"),
        (F.col("record_count") - F.col("distinct_offsets")).alias("duplicate_offsets"),
    )


def offset_summary(df: DataFrame, keys: tuple[str, ...] = DEFAULT_KEYS, offset: str = "kafka_offset") -> DataFrame:
    """Per key: range, rows, different offsets, and how many are missing or repeated."""
    return summarize_words(offset_words(df, keys, offset), keys)


def _runs(words: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Unbroken offset runs inside the words: `first`, `last`.

    Plain bit tests on exploded positions stay in generated code, which lambda functions
    over arrays would leave.
    """
    mask = F.col("mask")
    # A run starts at a set bit with none set below it.
    starts = mask.bitwiseAND(F.bitwise_not(F.shiftleft(mask, 1)))
    one_run = F.array(_trailing_zeros(mask))
    any_position = F.sequence(F.lit(0), F.lit(63))
    at = F.explode(F.when(F.bit_count(starts) == 1, one_run).otherwise(any_position))
    placed = words.filter(mask.isNotNull()).select(*keys, "word", "mask", at.alias("at"))
    placed = placed.filter(F.getbit(starts, F.col("at")) == 1)
    # The run ends before the first clear bit from its start on.
    length = _trailing_zeros(F.bitwise_not(F.call_function("shiftrightunsigned", mask, F.col("at"))))
    first = F.shiftleft("word", WORD_BITS) + F.col("at")
    return placed.select(*keys, first.alias("first"), (first + length - 1).alias("last"))


def gaps_of_words(words: DataFrame, keys: tuple[str, ...] = DEFAULT_KEYS) -> DataFrame:
    """Every gap between neighbouring runs of a key.

    Inside a chunk the next run is a `lead`; across chunks only each chunk's outer bounds
    matter, so they are folded level by level until one group per key is left.
    """
    spans = _runs(words, keys)
    levels = []
    for bits in (*CHUNK_BITS, None):
        group = [*keys]
        if bits is not None:
            spans = spans.withColumn("_chunk", F.shiftright("first", bits))
            group.append("_chunk")
        # One exchange serves both the window and the fold to the next level.
        spans = spans.repartition(*group)
        following = F.lead("first").over(Window.partitionBy(*group).orderBy("first"))
        levels.append(spans.withColumn("_next", following))
        if bits is not None:
            spans = spans.groupBy(*group).agg(F.min("first").alias("first"), F.max("last").alias("last"))
            spans = spans.drop("_chunk")
    found = [
        level.filter(F.col("_next") - F.col("last") > 1).select(
            *keys,
            F.col("last").alias("gap_after"),
            F.col("_next").alias("resumes_at"),
            (F.col("_next") - F.col("last") - 1).alias("missing_count"),
        )
        for level in levels
    ]
    return reduce(DataFrame.unionAll, found)


def first_gaps(gaps: DataFrame, keys: tuple[str, ...] = DEFAULT_KEYS, limit: int = REPORTED_GAPS) -> DataFrame:
    """The first gaps in key and offset order, for a report."""
    return gaps.orderBy(*keys, "gap_after").limit(limit)


def offset_gaps(
    df: DataFrame,
    keys: tuple[str, ...] = DEFAULT_KEYS,
    offset: str = "kafka_offset",
    limit: int | None = None,
) -> DataFrame:
    """Gaps between neighbouring offsets of a key; all of them, or the first `limit`."""
    gaps = gaps_of_words(offset_words(df, keys, offset), keys)
    return gaps if limit is None else first_gaps(gaps, keys, limit)


def offset_totals(summary: DataFrame) -> DataFrame:
    """One row: all missing and all duplicate offsets; zeros for an empty summary."""
    return summary.agg(
        F.coalesce(F.sum("missing_offsets"), F.lit(0)).cast("long").alias("total_missing"),
        F.coalesce(F.sum("duplicate_offsets"), F.lit(0)).cast("long").alias("total_duplicates"),
    )


def offset_verdict(summary: DataFrame, log: DataFrame | None = None) -> DataFrame:
    """One row: `status`, totals, `entries` and the process `exit_code`.

    ERROR when nothing was selected or what was selected gave no offset (all its files are lost
    or empty), FAIL when offsets are missing, WARN when some are
    duplicates only, else PASS. `entries` counts the log's entries or, without a log, the
    summarized keys.
    """
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    counted = one if log is None else zero
    measured = summary.select("missing_offsets", "duplicate_offsets", counted.alias("entries"), one.alias("keys"))
    if log is not None:
        entries = log.select(
            zero.alias("missing_offsets"), zero.alias("duplicate_offsets"), one.alias("entries"), zero.alias("keys")
        )
        measured = measured.unionAll(entries)
    totals = measured.agg(
        *[
            F.coalesce(F.sum(name), zero).alias(alias)
            for name, alias in (
                ("missing_offsets", "total_missing"),
                ("duplicate_offsets", "total_duplicates"),
                ("entries", "entries"),
                ("keys", "keys"),
            )
        ]
    )
    status = (
        F.when((F.col("keys") == 0) | (F.col("entries") == 0), "ERROR")
        .when(F.col("total_missing") > 0, "FAIL")
        .when(F.col("total_duplicates") > 0, "WARN")
        .otherwise("PASS")
    )
    failed = F.col("status").isin("ERROR", "FAIL")
    verdict = totals.withColumn("status", status)
    return verdict.select(
        "status", "total_missing", "total_duplicates", "entries", F.when(failed, 1).otherwise(0).alias("exit_code")
    )
