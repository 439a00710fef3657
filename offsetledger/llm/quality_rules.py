"""Line-first quality rules, in DataFrame functions only.

Every line of a text is judged by itself; lines that fail are removed, and a document that loses
too much of its text that way is rejected. A few counts over the whole document come before.

A line fails by its punctuation (many symbols, a trailing ellipsis that breaks it off), as navigation (bars, links and
nothing else, a few words or a short bullet without an end mark) or as boilerplate (phrases of notices).

Words are `[^\\x20\\x09-\\x0D]+`, lines are split at `\\n`. A line without words neither fails nor
counts. Defined cases: a null text has no words and is rejected as too short, like an empty one;
repeated rows are judged each for itself; very long texts are judged whole, in n log n; columns other than
`text` are carried along unread, whatever their names; a table without rows gives none.

Windows of three words are compared by a hash that is sorted inside the row; only texts in which one
recurs have their words compared. What is judged passes through `inline`, below which the optimizer pushes no
filter: a filter on a count or verdict would otherwise repeat the counts for every word.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offsetledger.llm.tables import SPACES

_SPACE_RUN = "[\\x20\\x09-\\x0D]+"
_SYMBOLS = "#*$%&|<>"

#: Phrases of menus, consent notes and page footers.
BOILERPLATE = (
    "accept cookies|all rights reserved|back to top|click here to|cookie policy|enable javascript|follow us on|"
    "powered by|privacy policy|share this|sign up for our|skip to content|subscribe to our|terms of service|terms of use"
)
#: Lines broken off by an ellipsis, and lines of links only.
BROKEN_OR_LINKS = (
    "(\\.\\.\\.|\u2026)[\\x20\\x09-\\x0D]*$|"
    "^[\\x20\\x09-\\x0D]*((https?://|www\\.)[^\\x20\\x09-\\x0D]+[\\x20\\x09-\\x0D]*)+$"
)
BULLET = "^[\\x20\\x09-\\x0D]*[\u2022\u25aa\u00b7*-][\\x20\\x09]"
#: Marks that end a sentence, as the last character but closing ones.
END_MARK = "[.!?:;\u2026\u3002\uff01\uff1f][\"')\\]\u201d\u2019\u00bb\u300d]*[\\x20\\x09-\\x0D]*$"


@dataclass(frozen=True)
class Rules:
    """Thresholds. Shares are exact ratios of integers: `a * numerator > b * denominator`."""

    min_words: int = 50
    repeat_percent: int = 50  # of a text's words may lie in repeated 3-word windows
    words_per_symbol: int = 4  # a line with more symbols or `!` than one per so many words fails
    words_per_bar: int = 3  # a line with a `|` for fewer words than this is a menu
    menu_words: int = 4  # a line of fewer words and characters than these, without an end mark, is a menu entry
    menu_chars: int = 30
    bullet_words: int = 6  # so is a bullet of fewer words
    lost_percent: int = 50  # a document losing more than this of its word characters is rejected


def _count_chars(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _line_fails(line: Column, n_words: Column, rules: Rules) -> Column:
    punctuation = _count_chars(line, "#*$%&<>!") * rules.words_per_symbol > n_words
    bars = _count_chars(line, "|") * rules.words_per_bar > n_words
    entry = (n_words < rules.menu_words) & (F.length(line) < rules.menu_chars)
    bullet = (n_words < rules.bullet_words) & line.rlike(BULLET)
    unended = (entry | bullet) & ~line.rlike(END_MARK)
    return punctuation | bars | unended | line.rlike(BROKEN_OR_LINKS) | F.lower(line).rlike(BOILERPLATE)


def _barrier(df: DataFrame, *kept: str, **columns: Column) -> DataFrame:
    """`kept` and new columns, computed once and below which no filter or expression moves."""
    row = F.struct(*[F.col(name) for name in kept], *[value.alias(name) for name, value in columns.items()])
    return df.select(F.inline(F.array(row)))


def _covered_words(words: Column, hashes: Column) -> Column:
    """Number of words in windows whose hash and words occur twice: sorted by hash, equal ones are neighbours."""
    placed = F.sort_array(F.transform(hashes, lambda h, at: F.struct(h.alias("h"), at.alias("at"))))

    def same(x: Column, y: Column) -> Column:
        words_equal = [F.get(words, x["at"] + k) == F.get(words, y["at"] + k) for k in range(3)]
        return (x["h"] == y["h"]) & words_equal[0] & words_equal[1] & words_equal[2]

    # Each place with the one before it in that order; a match marks both.
    pairs = F.arrays_zip(F.slice(placed, 2, F.size(placed)).alias("x"), placed.alias("y"))
    hits = F.filter(pairs, lambda z: same(z["x"], z["y"]))
    places = F.flatten(F.transform(hits, lambda z: F.array(z["x"]["at"], z["y"]["at"])))
    # A window covers three words; of overlapping ones only the part beyond the last one counts.
    begin = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
    added = F.aggregate(
        F.array_sort(F.array_distinct(places)),
        begin,
        lambda acc, at: F.struct((acc["n"] + F.least(F.lit(3), at - acc["last"])).alias("n"), at.alias("last")),
    )
    return added["n"]


def judge(docs: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """`docs` with a struct column `rules`: the counts, `clean_text`, `base_failed` and `kept`.

    `clean_text` holds the lines that passed. Nothing is shuffled.
    """
    names = docs.columns
    whole = F.coalesce(F.col(text), F.lit(""))
    df = docs.select(F.struct(*[F.col(f"`{name}`").alias(f"c{at}") for at, name in enumerate(names)]).alias("row"), whole.alias("text"))
    # Each line with its words; one without words holds nothing.
    line = lambda x: F.struct(x.alias("line"), F.filter(F.split(x, _SPACE_RUN), lambda word: word != "").alias("words"))
    lines = F.filter(F.transform(F.split("text", "\n"), line), lambda x: F.size(x["words"]) > 0)
    df = _barrier(df, "row", "text", lines=lines)
    good = F.filter("lines", lambda x: ~_line_fails(x["line"], F.size(x["words"]), rules))
    df = _barrier(df, "row", "text", "lines", words=F.flatten("lines.words"), good=good["line"])
    window = lambda x, at: F.xxhash64(x, F.get("words", at + 1), F.get("words", at + 2))
    # The last two entries lack a second or third word.
    hashes = F.slice(F.transform("words", window), F.lit(1), F.greatest(F.size("words") - 2, F.lit(0)))
    df = _barrier(df, "row", "text", "lines", "words", "good", hashes=hashes)
    recurs = F.size(F.array_distinct("hashes")) < F.size("hashes")
    n_repeat = F.when(recurs, _covered_words(F.col("words"), F.col("hashes"))).otherwise(F.lit(0).cast("long"))
    df = _barrier(
        df,
        "row",
        clean_text=F.array_join("good", "\n"),
        n_words=F.size("words").cast("long"),
        word_chars=F.length(F.translate("text", SPACES, "")).cast("long"),
        n_symbols=_count_chars(F.col("text"), _SYMBOLS).cast("long"),
        n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines.line"))).cast("long"),
        n_repeat_words=n_repeat,
        n_failed_lines=(F.size("lines") - F.size("good")).cast("long"),
        good_chars=F.length(F.translate(F.array_join("good", ""), SPACES, "")).cast("long"),
    )
    lost = F.col("word_chars") - F.col("good_chars")
    base_failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words")
    )
    too_much_lost = 100 * lost > rules.lost_percent * F.col("word_chars")
    counts = ["clean_text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_failed_lines"]
    verdict = F.struct(*counts, lost.alias("lost_chars"), base_failed.alias("base_failed"), (~base_failed & ~too_much_lost).alias("kept"))
    kept = [F.col("row")[f"c{at}"].alias(name) for at, name in enumerate(names)]
    return df.select(*kept, verdict.alias("rules"))


def quality_rules(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row of counts and verdict per document."""
    judged = judge(docs.select("doc_id", "text"), rules)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select("doc_id", *[f"rules.{c}" for c in counts], "rules.n_failed_lines", "rules.lost_chars")


def kept_documents(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of `docs` that pass, with their columns and texts as they were."""
    names = docs.columns
    judged = judge(docs.select(F.struct("*").alias("doc"), F.col("text").alias("text")), rules)
    return judged.where("rules.kept").select("doc.*").toDF(*names)
