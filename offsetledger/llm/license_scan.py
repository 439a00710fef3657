"""Licence scan with a trained paragraph classifier, in DataFrame functions and Spark's ML only.

Every line of a text is a paragraph, and every paragraph is scored in overlapping windows of WINDOW words,
BLOCK words apart, so that a notice is found wherever it stands. A window's words and word pairs, counted,
are hashed features of a multinomial logistic regression over licence families, `unknown` (a licence, but
none of these) and `none`. It is trained on the templates below, on variants of them alone and inside
ordinary words, and on windows of a bounded sample of the corpus's own lines as `none`. A temperature that
fits held-out variants best calibrates the probabilities. A prediction of a family is confirmed by comparing
the window with the templates; one that no template confirms, or that is too unsure, is reported
as unknown. Of each family a paragraph has its best window; `unknown` counts only in windows that overlap
no window of a confirmed family.

Scoring stays inside the row: a first pass sums, for each feature, what it can at most give any family
over `none`, by blocks, and only windows that could win get all the sums. Nothing is shuffled.

Defined cases: a null or empty text has no paragraphs; repeated rows are scanned each for itself; tables
without rows give none; extra columns are not read.
"""

from __future__ import annotations

import json
import random
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offsetledger.llm.tables import drawn, written

FEATURES = 2048
#: Words from the start of one window to that of the next, and words of a window; a notice of up to
#: WINDOW - BLOCK + 1 words lies whole in one.
BLOCK, WINDOW = 8, 32
NONE, UNKNOWN = "none", "unknown"
#: Share of a template's words that a paragraph must hold to confirm its family.
CONFIRM = 0.6
#: Least calibrated probability of a family.
SURE = 0.5

#: Usual notices of public licences.
TEMPLATES = {
    "agpl": ("licensed under the gnu affero general public license version", "gnu affero general public license as published by the free software foundation"),
    "apache": ("licensed under the apache license version", "you may not use this file except in compliance with the apache license"),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted", "released under the bsd license", "licensed under the bsd 3 clause license"),
    "cc0": ("dedicated to the public domain under cc0", "released under the creative commons zero cc0 universal public domain dedication"),
    "cc-by": ("licensed under cc by", "this work is licensed under a creative commons attribution international license"),
    "cc-by-nc": ("licensed under cc by nc", "this work is licensed under a creative commons attribution noncommercial license"),
    "cc-by-sa": ("licensed under cc by sa", "this work is licensed under a creative commons attribution sharealike license"),
    "gpl": ("this work is licensed under the gnu general public license version", "free software you can redistribute it under the terms of the gnu general public license"),
    "lgpl": ("licensed under the gnu lesser general public license version", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    "mit": ("released under the mit license", "permission is hereby granted free of charge to any person obtaining a copy of this software", "licensed under the mit license"),
    "mpl": ("subject to the terms of the mozilla public license", "licensed under the mozilla public license version"),
    "proprietary": ("all rights reserved", "copyright all rights reserved no part may be reproduced without permission"),
}
_UNKNOWN = (
    "licensed under the terms of the agreement that came with this product",
    "see the license file for the terms of this license",
    "use of this software is subject to the license of its vendor",
    "released under a license of its own",
    "distributed under the community license version",
    "licensed under the terms and conditions of the sample public license",
)
CLASSES = (*sorted(TEMPLATES), UNKNOWN, NONE)


@dataclass(frozen=True)
class Training:
    variants: int = 30
    inside: int = 30  # variants of each template that stand inside ordinary words
    corpus_docs: int = 1500
    windows_per_doc: int = 40
    prose: int = 600  # of these windows, those that surround variants
    held_out: float = 0.25
    seed: int = 3


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _words(paragraph: Column) -> Column:
    """Words in small letters; one that is repeated at once counts once."""
    split = F.split(F.lower(paragraph), "[^\\p{L}\\p{N}]+")
    return _let(split, lambda words: F.filter(words, lambda w, i: (w != "") & ((i == 0) | (w != F.get(words, i - 1)))))


def _features(words: Column) -> Column:
    """For each of an array of words: the numbers of the word and of it with the next, or FEATURES."""
    following = F.slice(words, 2, F.greatest(F.size(words), F.lit(1)))

    def number(*parts: Column) -> Column:
        return F.pmod(F.xxhash64(*parts), F.lit(FEATURES)).cast("int")

    return F.zip_with(
        words, following, lambda a, b: F.struct(number(a).alias("one"), F.when(b.isNull(), F.lit(FEATURES)).otherwise(number(a, b)).alias("two"))
    )


def _examples(training: Training, prose: list[str]) -> list[tuple[str, str]]:
    """Templates and variants: words left out, others around them (of `prose` as well), version numbers."""
    dice, out = random.Random(training.seed), []
    filler = "this file document work program is the and of to a for by in with from project page text".split()
    for family, texts in {**TEMPLATES, UNKNOWN: _UNKNOWN}.items():
        for text in texts:
            out.append((text, family))
            for at in range(training.variants + (training.inside if prose else 0)):
                words = text.split()
                if len(words) > 4:
                    words = [w for w in words if dice.random() > 0.08] or words
                if words[-1] == "version" or dice.random() < 0.3:
                    words += [str(dice.randint(1, 4)), str(dice.randint(0, 3))][: dice.randint(1, 2)]
                if at >= training.variants:
                    room = max(WINDOW - len(words), 0)
                    around = (dice.choice(prose).split() + dice.choice(prose).split())[: dice.randint(min(4, room), room)]
                    cut = dice.randint(0, len(around))
                    out.append((" ".join(around[:cut] + words + around[cut:]), family))
                    continue
                before = [dice.choice(filler) for _ in range(dice.choice((0, 0, 0, 2, 5)))]
                after = [dice.choice(filler) for _ in range(dice.choice((0, 0, 0, 3, 8)))]
                out.append((" ".join(before + words + after), family))
    for _ in range(4 * training.variants):
        out.append((" ".join(dice.choice(filler) for _ in range(dice.randint(1, 15))), NONE))
    return out


def _pieces(words: Column) -> Column:
    """An array of words as texts of WINDOW words each."""
    starts = F.sequence(F.lit(0), F.floor((F.greatest(F.size(words), F.lit(1)) - 1) / WINDOW).cast("int"))
    return F.transform(starts, lambda n: F.array_join(F.slice(words, n * WINDOW + 1, WINDOW), " "))


@dataclass
class Classifier:
    weights: np.ndarray  # (classes, features)
    shift: np.ndarray
    temperature: float


def _literal(values) -> Column:
    return F.from_json(F.lit(json.dumps([round(float(v), 6) for v in values])), "array<double>")


def train(docs: DataFrame, training: Training = Training()) -> Classifier:
    """A classifier, the same for the same table."""
    spark: SparkSession = docs.sparkSession
    texts = drawn(docs.where("text is not null").select("doc_id", "text"), training.corpus_docs, training.seed, "doc_id", "text")
    split = F.flatten(F.transform(F.split("text", "\n"), lambda x: _let(_words(x), _pieces)))
    # Windows with a licence's words are left to the templates.
    telling = r"licen[cs]e|copyright|rights reserved|creative commons|public domain|redistribut|permission is"
    split = F.filter(split, lambda x: (x != "") & ~x.rlike(telling))
    ordered = F.array_sort(F.transform(split, lambda x: F.struct(F.xxhash64(x).alias("h"), x.alias("text"))))
    windows = texts.select(F.explode(F.slice(ordered, 1, training.windows_per_doc)).alias("x")).select("x.h", "x.text")
    windows = written(windows, "windows")
    prose = [row.text for row in windows.orderBy("h", "text").limit(training.prose).collect()]
    literal = F.lit(json.dumps([{"text": text, "label": label} for text, label in _examples(training, prose)]))
    examples = spark.range(1).select(F.inline(F.from_json(literal, "array<struct<text:string,label:string>>")))
    examples = examples.union(windows.select("text", F.lit(NONE).alias("label")))
    number = F.array_position(F.array(*[F.lit(c) for c in CLASSES]), F.col("label")) - 1
    on = _let(_let(_words(F.col("text")), _features), lambda x: F.concat(x["one"], x["two"]))
    examples = examples.select(number.cast("double").alias("label"), on.alias("on"), F.xxhash64("text").alias("h"))
    examples = examples.withColumn("names", F.col("on").cast("array<string>"))
    counts = CountVectorizerModel.from_vocabulary([str(n) for n in range(FEATURES)], "names", "features")
    examples = counts.transform(examples)
    out = F.pmod("h", F.lit(1000)) < int(1000 * training.held_out)
    fit = LogisticRegression(family="multinomial", regParam=0.0005, maxIter=60).fit(examples.where(~out).select("label", "features"))
    weights, shift = fit.coefficientMatrix.toArray(), np.array(fit.interceptVector)
    held = [(int(row.label), [n for n in row.on if n < FEATURES]) for row in examples.where(out).select("label", "on").collect()]
    logits = np.array([weights[:, on].sum(axis=1) + shift for _, on in held])
    labels = np.array([label for label, _ in held])

    def loss(t: float) -> float:
        z = logits / t
        return float((np.logaddexp.reduce(z, axis=1) - z[np.arange(len(z)), labels]).mean())

    return Classifier(weights, shift, float(min(np.geomspace(0.25, 8, 41), key=loss)))


def _total(numbers: Column, start: float, weights: np.ndarray) -> Column:
    weight = _literal([*weights, 0.0])  # the last for a word without a next one
    return F.aggregate(numbers, F.lit(start), lambda total, x: total + F.get(weight, x["one"]) + F.get(weight, x["two"]))


def _sums(numbers: Column, model: Classifier) -> Column:
    def of_class(c: int) -> Column:
        return _total(numbers, float(model.shift[c]), model.weights[c])

    return F.array(*[of_class(c) for c in range(len(CLASSES))])


def _verdict(words: Column, exps: Column) -> Column:
    """Family, probability and best template share, from a window's words and unscaled probabilities."""
    family = F.element_at(F.array(*[F.lit(c) for c in CLASSES]), F.array_position(exps, F.array_max(exps)).cast("int"))
    sure = F.array_max(exps) / F.aggregate(exps, F.lit(0.0), lambda a, b: a + b)

    def compared(family_name: str, text: str) -> Column:
        own = list(dict.fromkeys(text.split()))
        held = F.size(F.array_intersect(words, F.array(*[F.lit(w) for w in own])))
        return F.struct((2 * held - len(own)).alias("points"), F.lit(family_name).alias("family"), (held / len(own)).alias("share"))

    def named(found: Column) -> Column:
        confirmed = (found["share"] >= CONFIRM) & (found["sure"] >= SURE)
        name = F.when(confirmed | (found["family"] == NONE), found["family"]).otherwise(UNKNOWN)
        return F.struct(name.alias("family"), found["sure"].alias("probability"), found["share"].alias("template_share"))

    def with_share(name: Column) -> Column:
        # Of families with much the same notice, the one whose template has more words found and fewer missed.
        templates = F.array(*[compared(family_name, text) for family_name, texts in TEMPLATES.items() for text in texts])

        def closest(found: Column) -> Column:
            own = F.array_max(F.transform(F.filter(found, lambda t: t["family"] == name), lambda t: t["share"]))
            near = F.filter(found, lambda t: t["share"] >= CONFIRM)
            key = F.transform(near, lambda t: F.struct(t["points"].alias("points"), (t["family"] == name).alias("own"), t["family"].alias("family"), t["share"].alias("share")))
            return _let(F.array_max(key), lambda t: F.struct(F.coalesce(t["family"], name).alias("family"), sure.alias("sure"), F.coalesce(t["share"], own, F.lit(0.0)).alias("share")))

        unnamed = F.struct(name.alias("family"), sure.alias("sure"), F.lit(0.0).alias("share"))
        return F.when(name.isin(NONE, UNKNOWN), unnamed).otherwise(_let(templates, closest))

    return _let(_let(family, with_share), named)


def _best(windows: Column) -> Column:
    """The best window of each family in a paragraph, in their order; `unknown` as the last resort."""
    per_window = WINDOW // BLOCK
    named = F.filter(windows, lambda x: x["found"]["family"] != UNKNOWN)
    near = F.array_distinct(F.flatten(F.transform(named, lambda x: F.sequence(x["w"] - per_window + 1, x["w"] + per_window - 1))))

    def free(taken: Column) -> Column:
        return F.filter(windows, lambda x: (x["found"]["family"] != UNKNOWN) | ~F.array_contains(taken, x["w"]))

    def surest(left: Column) -> Column:
        def of_family(family: Column) -> Column:
            own = F.filter(left, lambda x: x["found"]["family"] == family)
            key = F.transform(own, lambda x: F.struct(x["found"]["template_share"].alias("s"), x["found"]["probability"].alias("p"), (-x["w"]).alias("w"), x.alias("hit")))
            return F.array_max(key)["hit"]

        return F.transform(F.array_distinct(F.transform(left, lambda x: x["found"]["family"])), of_family)

    def kin(x: Column) -> Column:
        family = x["found"]["family"]
        return F.when(family.isin("agpl", "gpl", "lgpl"), "gnu").when(family.startswith("cc-by"), "cc-by").otherwise(family)

    def whole(hits: Column) -> Column:
        def fuller(x: Column, y: Column) -> Column:
            return (kin(x) == kin(y)) & (F.abs(x["w"] - y["w"]) < per_window) & (y["found"]["template_share"] > x["found"]["template_share"])

        # The end of a window may cut a notice down to what its relatives share with it.
        return F.filter(hits, lambda x: ~F.exists(hits, lambda y: fuller(x, y)))

    return F.array_sort(_let(_let(_let(near, free), surest), whole))


def findings(docs: DataFrame, model: Classifier) -> DataFrame:
    """`doc_id`, `n_paragraphs`, and `hits`: paragraph and window number, family, probability, share, of each licence."""
    others = np.delete(model.weights, CLASSES.index(NONE), axis=0) - model.weights[-1]
    gain = np.ceil(others.max(axis=0) * 1e5) / 1e5
    start = float((model.shift[:-1] - model.shift[-1]).max())
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("at"), _words(x).alias("words")))
    df = df.select("doc_id", F.filter(lines, lambda x: F.size(x["words"]) > 0).alias("lines"))
    numbered = F.transform("lines", lambda x: F.struct(x["at"].alias("at"), x["words"].alias("words"), _features(x["words"]).alias("on")))

    def in_blocks(x: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(x["words"]) - 1) / BLOCK).cast("int"))
        sums = F.transform(blocks, lambda b: _total(F.slice(x["on"], b * BLOCK + 1, BLOCK), 0.0, gain))
        return F.struct(x["at"].alias("at"), x["words"].alias("words"), x["on"].alias("on"), sums.alias("sums"))

    # The sum of what each feature can at most give a family over `none`; weights are rounded up.
    def possible(x: Column) -> Column:
        per_window = WINDOW // BLOCK
        starts = F.sequence(F.lit(0), F.greatest(F.size(x["sums"]) - per_window, F.lit(0)))
        likely = F.filter(starts, lambda w: F.aggregate(F.slice(x["sums"], w + 1, per_window), F.lit(start), lambda a, b: a + b) > -0.01)
        of_words = lambda w, what: F.slice(x[what], w * BLOCK + 1, WINDOW).alias(what)
        return F.transform(likely, lambda w: F.struct(x["at"].alias("at"), w.alias("w"), of_words(w, "words"), of_words(w, "on")))

    windows = F.filter(F.transform(F.transform(numbered, in_blocks), possible), lambda x: F.size(x) > 0)
    df = df.select("doc_id", F.size("lines").cast("long").alias("n_paragraphs"), windows.alias("possible"))

    def judged(x: Column) -> Column:
        z = _sums(x["on"], model)
        exps = _let(z, lambda z: _let(F.array_max(z), lambda top: F.transform(z, lambda v: F.exp((v - top) / model.temperature))))
        return F.struct(x["at"].alias("at"), x["w"].alias("w"), _let(exps, lambda e: _verdict(x["words"], e)).alias("found"))

    of_line = F.transform("possible", lambda line: F.filter(F.transform(line, judged), lambda h: h["found"]["family"] != NONE))
    df = df.select("doc_id", "n_paragraphs", F.filter(of_line, lambda x: F.size(x) > 0).alias("judged"))
    return df.select("doc_id", "n_paragraphs", F.flatten(F.transform("judged", _best)).alias("hits"))


def scan(docs: DataFrame, training: Training = Training()) -> DataFrame:
    """One row per document: its paragraphs, the licences in them, unknown ones, and the families found."""
    found = findings(docs, train(docs, training))
    families = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["found"]["family"])))
    return found.select(
        "doc_id",
        "n_paragraphs",
        F.size("hits").cast("long").alias("n_licences"),
        F.size(F.filter("hits", lambda h: h["found"]["family"] == UNKNOWN)).cast("long").alias("n_unknown"),
        F.array_join(families, ",").alias("families"),
        F.round(F.array_min(F.transform("hits", lambda h: h["found"]["probability"])), 4).alias("least_probability"),
    )
