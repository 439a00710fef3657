import hashlib
import random
import re
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from offsetledger.llm import jaccard_join as J
from offsetledger.llm import suffix_dedup as S
from offsetledger.llm import tables
from offsetledger.llm.components import components

WORDS = [f"w{n}" for n in range(400)]


def removed(raws, window):
    """Per text: the flags of its removed bytes, by counting every window."""
    seen = Counter(raw[at : at + window] for raw in raws for at in range(len(raw) - window + 1))
    flags = []
    for raw in raws:
        mine = bytearray(len(raw))
        for at in range(len(raw) - window + 1):
            if seen[raw[at : at + window]] > 1:
                mine[at : at + window] = b"\1" * window
        flags.append(mine)
    return flags


def corpus(seed, n=60):
    dice = random.Random(seed)

    def text(low, high):
        return "".join(dice.choice("abcdé \n") for _ in range(dice.randint(low, high)))

    shared = [text(300, 900) for _ in range(4)] + ["ab" * 500, "x" * 900]
    texts = [None, "", "x", "x" * 400, "x" * 401, text(5000, 6000) * 2]
    for _ in range(n):
        parts = [text(0, 500)]
        for _ in range(dice.randint(0, 3)):
            passage = dice.choice(shared)
            cut = dice.randrange(len(passage) // 2)
            parts += [passage[cut : cut + dice.randint(350, 900)], text(0, 300)]
        texts.append("".join(parts))
    return texts + texts[10:14]


@pytest.mark.parametrize("seed,most", [(1, 20_000), (2, 1), (3, 4)])
def test_repeated_bytes_equal_brute_force(documents, seed, most):
    texts = corpus(seed)
    raws = [(text or "").encode() for text in texts]
    flags = removed(raws, 400)
    rows = {row.doc_id: row for row in S.digests(documents(texts), max_segments=most).collect()}
    assert len(rows) == len(texts)
    for at, (raw, mine) in enumerate(zip(raws, flags)):
        kept = bytes(byte for byte, gone in zip(raw, mine) if not gone)
        spans = len(re.findall(b"\1+", bytes(mine)))
        row = rows[at]
        assert (row.n_bytes, row.n_removed, row.n_spans) == (len(raw), sum(mine), spans)
        assert row.kept_sha256 == hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("window", [4, 33, 256])
def test_other_windows(documents, window):
    texts = corpus(window, 20)
    flags = removed([(text or "").encode() for text in texts], window)
    rows = {row.doc_id: row for row in S.digests(documents(texts), window).collect()}
    for at, (text, mine) in enumerate(zip(texts, flags)):
        kept = bytes(byte for byte, gone in zip((text or "").encode(), mine) if not gone)
        assert rows[at].n_removed == sum(mine) and rows[at].text == kept.decode("utf-8", "ignore")
    with pytest.raises(ValueError, match="window"):
        S.gram_of(5000)


def test_texts_longer_than_a_piece(documents, monkeypatch):
    """Texts are taken in pieces; passages lie across their borders."""
    monkeypatch.setattr(S, "PIECE", 1 << 10)
    texts = corpus(9, 20)
    texts += [texts[5] + texts[20] + texts[5][:3000]]
    flags = removed([(text or "").encode() for text in texts], 400)
    rows = {row.doc_id: row for row in S.digests(documents(texts)).collect()}
    assert [rows[at].n_removed for at in range(len(texts))] == [sum(mine) for mine in flags]


def test_a_text_of_over_four_megabytes(documents):
    dice = random.Random(12)
    text = "".join(dice.choices("abcdefgh ", k=S.PIECE + 100_000))
    part = text[S.PIECE - 500 : S.PIECE + 300]
    rows = {row.doc_id: row for row in S.digests(documents([text, "x" + part + "y"])).collect()}
    assert (rows[0].n_bytes, rows[0].n_removed, rows[1].n_removed, rows[1].text) == (len(text), 800, 800, "xy")


def test_cut_texts_and_other_columns(documents):
    passage = "é" * 300
    docs = documents(["a" + passage, "b" + passage, None], [(0, "a" + passage, "x", "y", 1), (None, "z" * 10, None, None, None)])
    docs = docs.selectExpr("*", "1 AS key", "2 AS id", "3 AS row", "4 AS runs", "5 AS `left`")
    rows = S.deduplicated(docs)
    assert rows.columns == docs.columns and rows.count() == 5
    # The two rows with the same text repeat each other whole.
    assert sorted(str(row.text) for row in rows.collect()) == sorted(["", "", "b", "None", "z" * 10])
    assert S.deduplicated(docs.limit(0)).count() == 0


def sets_of(texts):
    out = []
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out.append(frozenset(tuple(words[at : at + 5]) for at in range(max(1, len(words) - 4))) if words else frozenset())
    return out


def brute_components(texts):
    sets, name = sets_of(texts), list(range(len(texts)))

    def root(at):
        while name[at] != at:
            at = name[at]
        return at

    for a in range(len(texts)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((root(a), root(b)))
                name[high] = low
    return [len(s) for s in sets], [root(at) for at in range(len(texts))]


def near_corpus(seed, n=150):
    dice = random.Random(seed)
    bases = [[dice.choice(WORDS) for _ in range(dice.randint(3, 200))] for _ in range(12)]
    passage = [dice.choice(WORDS) for _ in range(60)]
    texts = [None, "", " \n", "One two", "one TWO", "one two three four", "one two three four five"]
    for _ in range(n):
        words = list(dice.choice(bases))
        for _ in range(dice.randint(0, max(1, len(words) // 25))):
            words[dice.randrange(len(words))] = dice.choice(WORDS)
        if dice.random() < 0.3:
            words += passage
        texts.append(" ".join(words).upper() if dice.random() < 0.2 else " ".join(words))
    return texts


@pytest.mark.parametrize("seed,frequent,group", [(1, 32, 50_000), (2, 3, 4), (3, 5, 50_000)])
def test_components_equal_brute_force(documents, monkeypatch, seed, frequent, group):
    monkeypatch.setattr(J, "FREQUENT", frequent)
    monkeypatch.setattr(J, "GROUP", group)
    texts = near_corpus(seed)
    sizes, names = brute_components(texts)
    rows = {row.doc_id: row for row in J.near_duplicates(documents(texts)).collect()}
    assert [rows[at].n_shingles for at in range(len(texts))] == sizes
    assert [rows[at].component_id for at in range(len(texts))] == names


def test_pairs_exactly_at_the_share_beside_a_larger_set(documents):
    dice, texts = random.Random(7), []
    for at in range(2500):
        words = [f"t{at}w{n}" for n in range(60)]
        begin = dice.randint(2, 17)
        # 22 and 23 shingles, 20 in common (20 / 25); the third has 26, some of the common ones among them.
        a, b = words[:26], words[2:26] + words[26:29]
        c = words[begin : begin + dice.randint(5, 9)]
        texts += [" ".join(x) for x in (a, b, c + words[30 : 60 - len(c)])]
    assert brute_components(texts[:3]) == ([22, 23, 26], [0, 0, 2])
    found = {row.doc_id: row.component_id for row in J.near_duplicates(documents(texts)).collect()}
    lost = [at for at in range(0, len(texts), 3) if found[at + 1] != at]
    assert not lost and all(found[at + k] == at + k for at in range(0, len(texts), 3) for k in (0, 2))


def test_least_needed_is_the_least_of_all_partner_sizes(spark):
    sizes = spark.sql(f"select n, h from (select explode(sequence(1, 260)) n) lateral view explode(sequence(n, 100 * n div {J.SHARE})) as h")
    each = sizes.selectExpr("n", "explode(sequence(n, h)) as x", "h").withColumn("m", J._needed(F.col("n"), F.col("x")))
    least = each.groupBy("n", "h").agg(F.min("m").alias("m")).withColumn("found", J._least_needed(F.col("n"), F.col("n"), F.col("h")))
    assert least.where("found <> m").count() == 0 and least.count() > 8000


def test_a_hot_group_without_similar_texts(documents, monkeypatch):
    """Every text has one line of its words in common with all others, and most of its shingles are frequent."""
    monkeypatch.setattr(J, "FREQUENT", 4)
    monkeypatch.setattr(J, "GROUP", 16)
    dice = random.Random(8)
    line = " ".join(WORDS[:12])
    texts = [f"{line} {' '.join(dice.choice(WORDS) for _ in range(8))}" for _ in range(300)] + [f"{line} x{n}" for n in range(40)]
    sizes, names = brute_components(texts)
    rows = {row.doc_id: row for row in J.near_duplicates(documents(texts)).collect()}
    assert [rows[at].component_id for at in range(len(texts))] == names and len(set(names)) > 300


def test_pairs_of_a_large_group_grow_with_its_size(documents, monkeypatch):
    """Copies of one text that are just similar to it, and seldom to each other: the text joins them, not their pairs."""
    pairs, dice = [], random.Random(21)
    monkeypatch.setattr(J, "VOTES", J.LEAST_VALUES + 1)  # no stars by least values
    all_pairs = J._all_pairs
    monkeypatch.setattr(J, "_all_pairs", lambda *rows: pairs.append(all_pairs(*rows).count()) or all_pairs(*rows))
    base = [dice.choice(WORDS) for _ in range(140)]
    texts = [" ".join(base)]
    for at in range(150):
        words = list(base)
        for place in dice.sample(range(5, 135), 2):
            words[place] = f"x{at}y{place}"
        texts.append(" ".join(words))
    sizes, names = brute_components(texts)
    rows = {row.doc_id: row for row in J.near_duplicates(documents(texts)).collect()}
    assert [rows[at].component_id for at in range(len(texts))] == names == [0] * len(texts)
    assert pairs[0] < 2 * len(texts)


def test_a_pair_is_made_where_it_meets_first(spark):
    """Every pair shares its telling shingles in a row; with one in two of them lost no pair is."""
    dice, tokens = random.Random(4), range(60)
    sets = {at: sorted(dice.sample(tokens, 45)) if at % 2 else list(tokens) for at in range(40)}
    rows = [(token, at, 60, 30, len(own), 5, at) for at, own in sets.items() for token in own]
    rows = spark.createDataFrame(rows, "token long, class_id long, n long, needed long, c long, k long, component long")
    told = {at: set(own[: len(own) - 30 + 1]) for at, own in sets.items()}
    wanted = {(a, b) for a in sets for b in sets if a < b and told[a] & told[b]}
    found = [tuple(row) for row in J._meetings(rows).collect()]
    assert set(found) == wanted and len(found) < 1.5 * len(wanted)
    assert sum(len(told[a] & told[b]) for a, b in wanted) > 8 * len(wanted)


def test_rows_under_one_id_are_one_node_and_tables_on_the_way_go(documents, monkeypatch, tmp_path):
    a, b, c = (" ".join(WORDS[at : at + 40]) for at in (0, 50, 100))
    docs = documents([a, b, c], [(5, a, "x", "y", 1), (5, b, "x", "y", 1), (7, c, "x", "y", 1), (7, "", "x", "y", 1), (None, "alone " * 9, "x", "y", 1)])
    monkeypatch.setattr(tables, "work_dir", lambda spark, purpose: str(tmp_path / f"{purpose}-{uuid.uuid4().hex}"))
    rows = sorted((str(row.doc_id), row.n_shingles, row.component_id) for row in J.near_duplicates(docs).collect())
    assert rows == [("0", 36, 0), ("1", 36, 0), ("2", 36, 2), ("5", 36, 0), ("5", 36, 0), ("7", 0, 2), ("7", 36, 2), ("None", 1, None)]
    assert [path.name.rpartition("-")[0] for path in tmp_path.iterdir()] == ["near-duplicates"]


def test_nulls_repeats_and_no_rows(documents):
    text = " ".join(WORDS[:40])
    docs = documents([text, text, None], [(0, text, "x", "y", 1), (None, text, None, None, None), (2, text, None, None, None)])
    rows = sorted((row.doc_id is None, row.doc_id, row.n_shingles, row.component_id) for row in J.near_duplicates(docs).collect())
    assert len(rows) == 6 and all(row[3] == 0 for row in rows if row[2])
    assert J.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    edges = [(n, n + 1) for n in range(100, 160)] + [(7, n) for n in range(8, 30)] + [(3, 3), (50, 51), (51, 50)]
    found = {row.node: row.component for row in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[n] == 100 for n in range(100, 161)) and all(found[n] == 7 for n in range(7, 30))
    assert found[50] == found[51] == 50
