import base64
import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from offsetledger.llm import fingerprints as fp
from offsetledger.llm import queries
from offsetledger.llm.shingles import mix

SF_DIR = "/root/testdata/sf0.001"


def brute_entropies(raw):
    whole = round(64 * math.log2(64) * (1 << 20))
    out = []
    for at in range(len(raw) - 63):
        part = sum(round(n * math.log2(n) * (1 << 20)) for n in Counter(raw[at : at + 64]).values())
        out.append(1000 * (whole - part) // whole)
    return out


def brute_rank(counts):
    order = sorted(range(1001), key=lambda value: (counts[value], value))
    rank = {value: at for at, value in enumerate(order)}
    return {value: rank[value] if value >= 100 else None for value in rank}


def brute_fingerprint(raw, rank):
    if not raw:
        return "0:"
    ranks = [1001 if rank[value] is None else rank[value] for value in brute_entropies(raw)]
    points = Counter()
    for begin in range(len(ranks) - 63):
        some = ranks[begin : begin + 64]
        points[begin + some.index(min(some))] += 1
    chosen = [at for at in sorted(points) if points[at] >= 16 and ranks[at] <= 1000]
    hashes = []
    for at in chosen:
        total = sum(int(fp._VALUE[byte]) * int(place) for byte, place in zip(raw[at : at + 64], fp._PLACE))
        hashes.append(int(mix(np.array([total % (1 << 64)], dtype=np.uint64))[0]))
    if not hashes:
        hashes = [int(mix(np.array([xxhash.xxh3_64_intdigest(raw)], dtype=np.uint64))[0])]
    hashes = list(dict.fromkeys(hashes))
    packed = b""
    for begin in range(0, len(hashes), 160):
        bits = {(value >> 11 * k) % 2048 for value in hashes[begin : begin + 160] for k in range(5)}
        packed += bytes(sum((8 * at + k in bits) << (7 - k) for k in range(8)) for at in range(256))
    return f"{len(hashes)}:{base64.b64encode(packed).decode()}"


def brute_likeness(x, y):
    if x == y:
        return 1.0

    def chain(text):
        n, _, packed = text.partition(":")
        raw = base64.b64decode(packed)
        filters = [{at for at in range(2048) if raw[begin + at // 8] >> (7 - at % 8) & 1} for begin in range(0, len(raw), 256)]
        return int(n), filters

    def alike(a, b):
        most, chance = min(len(a), len(b)), len(a) * len(b) / 2048
        floor = chance + 0.3 * (most - chance)
        return max(0.0, min(1.0, (len(a & b) - floor) / (most - floor))) if most > floor else 0.0

    def one_way(n, a, b):
        weights = [min(160, n - 160 * at) for at in range(len(a))]
        return sum(w * max(alike(one, other) for other in b) for w, one in zip(weights, a)) / n

    (n, a), (m, b) = chain(x), chain(y)
    if not n or not m:
        return 0.0
    if n == m:
        return (one_way(n, a, b) + one_way(m, b, a)) / 2
    return one_way(n, a, b) if n < m else one_way(m, b, a)


def brute_query(docs):
    """Rows as sorted reprs; docs are (doc_id, text)."""
    texts = [(key, text or "") for key, text in docs]
    raws = {text: text.encode() for _, text in texts}
    counts = Counter(value for _, text in texts for value in brute_entropies(raws[text]))
    rank = brute_rank(counts)
    order = sorted({key for key, _ in texts}, key=lambda key: (key is not None, key))
    after = dict(zip(order, order[1:] + order[:1]))
    out = []
    for key, text in texts:
        candidates = [t for k, t in texts if k == after[key]]
        assert len(set(candidates)) == 1
        following = candidates[0]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        own, other, near = (brute_fingerprint(x.encode(), rank) for x in (text, edited, following))
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out.append((key, len(text), sha, own, other, round(brute_likeness(own, other), 9), round(brute_likeness(own, near), 9)))
    return sorted(out, key=str)


def rounded(rows):
    return sorted(((*row[:5], round(row[5], 9), round(row[6], 9)) for row in rows), key=str)


def test_entropies_against_counting():
    dice = random.Random(3)
    for size in (0, 1, 63, 64, 65, 200, 700):
        raw = bytes(dice.choice(b"abcdefgh ") if dice.random() < 0.8 else dice.randrange(256) for _ in range(size))
        assert fp.entropies(np.frombuffer(raw, dtype=np.uint8)).tolist() == brute_entropies(raw)
    assert set(fp.entropies(np.zeros(100, dtype=np.uint8)).tolist()) == {0}
    assert fp.entropies(np.arange(64, dtype=np.uint8)).tolist() == [1000]


@pytest.mark.parametrize("piece", [1 << 20, 700, 130])
def test_fingerprints_do_not_depend_on_pieces(monkeypatch, piece):
    dice = random.Random(4)
    words = ["".join(dice.choice("abcdefghijklmnop") for _ in range(dice.randint(1, 9))) for _ in range(300)]
    texts = [" ".join(dice.choices(words, k=k)).encode() for k in (0, 3, 13, 20, 30, 400, 60, 1, 15, 18)] + [b"a" * 500, b"ab" * 300]
    counts = Counter(value for raw in texts for value in brute_entropies(raw))
    monkeypatch.setattr(fp, "PIECE", piece)
    rank = fp.rarity(np.array([counts[value] for value in range(1001)]))
    assert fp.fingerprints_of(texts, rank) == [brute_fingerprint(raw, brute_rank(counts)) for raw in texts]


def test_likeness_against_sets():
    dice = random.Random(5)
    words = ["".join(dice.choice("abcdefghijklmnop") for _ in range(dice.randint(1, 9))) for _ in range(300)]
    texts = [" ".join(dice.choices(words, k=k)) for k in (5, 60, 800, 4000)]
    texts += [text[: len(text) // 2] for text in texts] + ["", "x"]
    counts = Counter(value for text in texts for value in brute_entropies(text.encode()))
    found = fp.fingerprints_of([text.encode() for text in texts], fp.rarity(np.array([counts[v] for v in range(1001)])))
    for x in found:
        for y in found:
            assert fp.likeness_of(x, y) == pytest.approx(brute_likeness(x, y), abs=1e-9)
            assert fp.likeness_of(x, y) == fp.likeness_of(y, x)
    assert fp.likeness_of(found[3], found[7]) > 0.5 > 0.2 > fp.likeness_of(found[2], found[3])


def test_following_over_all_group_borders(spark):
    dice = random.Random(6)
    ids = {dice.choice((1, -1)) * dice.randrange(1 << dice.randint(1, 62)) for _ in range(400)} | set(range(16_380, 16_390)) | {-(1 << 63)}
    frame = spark.createDataFrame([(x,) for x in ids], "id long")
    order = sorted(ids)
    assert {tuple(row) for row in fp.following(frame).collect()} == set(zip(order, order[1:] + order[:1]))


def test_query_against_brute_force(spark, documents, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("length(text) < 2500").orderBy("doc_id").limit(60)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = [(row.doc_id, row.text) for row in docs.collect()]
    got = queries.op11_fingerprints(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert rounded(got.collect()) == brute_query(rows)


def test_whole_table(spark):
    rows = queries.op11_fingerprints(spark, SF_DIR).collect()
    docs = {row.doc_id: row.text for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert sorted(row.doc_id for row in rows) == sorted(docs)
    by_text = {}
    for row in rows:
        assert row.n_chars == len(docs[row.doc_id]) and by_text.setdefault(docs[row.doc_id], row.fingerprint) == row.fingerprint
    long = [row for row in rows if row.n_chars > 1000]
    assert np.mean([row.near_edited for row in long]) > 0.5 > 0.15 > np.mean([row.near_next for row in long])


def test_defined_cases(spark, documents, monkeypatch):
    texts = [None, "", "kurz", "añb" * 40, "word and other " * 30]
    frame = documents(texts, [(None, "no id " * 40, "en", "s", 1), (4, "word and other " * 30, "en", "s", 1)])
    frame = frame.selectExpr("*", "1 as id", "2 as part", "3 as head", "4 as need", "5 as key")
    rows = [(row.doc_id, row.text) for row in frame.collect()]
    assert rounded(fp.digests(frame).collect()) == brute_query(rows)
    monkeypatch.setattr(fp, "MAX_BROADCAST_IDS", 0)
    monkeypatch.setattr(fp, "ROWS_PER_PART", 1)
    assert rounded(fp.digests(frame).collect()) == brute_query(rows)
    assert fp.digests(frame.limit(0)).count() == 0
    one = fp.digests(documents(["alone " * 100])).first()
    assert one.near_next == 1.0
