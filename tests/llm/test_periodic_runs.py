import hashlib
import random
import zlib

import pytest

from offsetledger.llm import periodic_runs, queries

SF_DIR = "/root/testdata/sf0.001"


def brute_runs(words, exponent, length):
    """Every stretch that a period goes on through, named by its smallest period."""
    smallest = {}
    for period in range(1, len(words)):
        at = 0
        while at + period < len(words):
            end = at
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            if end - at >= period:
                smallest.setdefault((at, end + period - at), period)
            at = max(end, at) + 1
    found = [(start, n, period) for (start, n), period in smallest.items() if n >= max(length, exponent * period)]
    return sorted(found, key=lambda run: (run[0], run[2]))


def brute_lyndon(symbols):
    def lyndon(word):
        return all(word < word[at:] for at in range(1, len(word)))

    n = len(symbols)
    return [max(end - at for end in range(at + 1, n + 1) if lyndon(symbols[at:end])) for at in range(n)]


def random_words(dice, longest):
    kinds = dice.randint(1, 4)
    words = [dice.randrange(kinds) for _ in range(dice.randint(0, longest))]
    if dice.random() < 0.6:
        words = words[: dice.randint(0, 9)] + words[: dice.randint(1, 6)] * dice.randint(2, 8) + words[len(words) // 2 :]
    return words


def test_lyndon_arrays_under_both_orders():
    dice = random.Random(1)
    for _ in range(400):
        words = random_words(dice, 20)
        kinds = sorted(set(words))
        symbols = [kinds.index(word) for word in words]
        for order in (symbols, [len(kinds) - 1 - symbol for symbol in symbols]):
            # A symbol that does not occur is an empty group.
            assert periodic_runs.lyndon_array(order) == brute_lyndon(order)
    assert periodic_runs.lyndon_array([2, 0, 2]) == [1, 2, 1]


@pytest.mark.parametrize("exponent, length", [(4, 6), (2, 2), (3, 6), (3, 2), (4, 4)])
def test_runs_against_brute_force(exponent, length):
    dice = random.Random(exponent * 10 + length)
    for _ in range(400):
        words = [b"%d" % word for word in random_words(dice, 40)]
        assert periodic_runs.runs_in(words, exponent, length) == brute_runs(words, exponent, length), words


def test_long_loops_take_linear_time():
    assert periodic_runs.runs_in([b"a"] * 300_000) == [(0, 300_000, 1)]
    words = [b"%d" % at for at in range(700)] * 300
    assert periodic_runs.runs_in([b"x", *words, b"y"]) == [(1, 210_000, 700)]


def planted(doc_id, text):
    words = [word for word in (text or "").replace("\n", " ").replace("\t", " ").replace("\x0b", " ").split(" ") if word]
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if n and h is not None and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def expected(doc_id, text):
    words = planted(doc_id, text)
    runs = brute_runs(words, 4, 6)
    best = max(runs, key=lambda run: (run[1] / run[2], -run[0], -run[2]), default=None)
    dropped = {at for start, n, period in runs for at in range(start + period, start + n)}
    kept = " ".join(word for at, word in enumerate(words) if at not in dropped)
    lines = "".join(f"{start},{n},{period}\n" for start, n, period in runs)
    strong = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *strong, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    short = {row.doc_id: row.text for row in docs if len(row.text) < 8000}
    got = {row.doc_id: tuple(row) for row in queries.op13_periodic_runs(spark, SF_DIR).collect()}
    assert len(got) == len(docs) and sum(row[1] > 0 for row in got.values()) >= 10
    assert {key: got[key] for key in short} == {key: expected(key, text) for key, text in short.items()}


def test_defined_cases(spark, documents):
    loop = "zero " + "one two\n" * 4 + "\x0btwo three"
    frame = documents([None, "", " \t\n", loop, loop, "un deux " * 9, "a a a a a", "x " * 6], [(None, loop, "en", "s", 1), (3, "b", "en", "s", 1)])
    frame = frame.selectExpr("*", "1 as runs", "2 as best", "3 as collapsed", "4 as h", "5 as w")
    rows = [tuple(row) for row in periodic_runs.digests(periodic_runs.with_planted_loops(frame)).collect()]
    assert sorted(rows, key=str) == sorted((expected(row.doc_id, row.text) for row in frame.collect()), key=str)
    found = {(row.doc_id, row.collapsed) for row in periodic_runs.find_runs(frame).collect()}
    assert (None, "zero one two two three") in found and (7, "x") in found and (0, "") in found
    assert periodic_runs.digests(periodic_runs.with_planted_loops(frame.limit(0))).count() == 0
