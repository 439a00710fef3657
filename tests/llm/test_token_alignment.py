import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer
from tokenizers.decoders import ByteLevel

from offsetledger.llm import queries
from offsetledger.llm import token_alignment as ta

SF_DIR = "/root/testdata/sf0.001"
A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pair():
    return ta.Pair(A_PATH, B_PATH)


def spans(sizes):
    ends = np.cumsum(sizes).tolist()
    return list(zip([0, *ends[:-1]], ends))


def brute_align(a, b):
    """Groups by common ends, links by overlap of every pair."""
    common = sorted({end for _, end in a} & {end for _, end in b})
    cuts = [sum(end <= stop for _, end in side) for side in (a, b) for stop in common]
    links = [(i, j) for i, (lo, hi) in enumerate(a) for j, (low, high) in enumerate(b) if lo < high and low < hi]
    return cuts[: len(common)], cuts[len(common) :], links


def brute_rows(docs, pair):
    a_tokenizer = Tokenizer.from_file(A_PATH)
    a_tokenizer.encode_special_tokens = True
    b_tokenizer = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    found = []
    for key, text in docs:
        text = text or ""
        a = a_tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tokenizer.encode(text)
        raw = (" " + text).encode()
        if not text or b"".join(pair.a_bytes[x] for x in a) != raw or b"".join(pair.b_bytes[x] for x in b) != raw:
            a, b = [], []
        a_cuts, b_cuts, links = brute_align(spans([len(pair.a_bytes[x]) for x in a]), spans([len(pair.b_bytes[x]) for x in b]))
        groups, low, down = [], 0, 0
        for i, j in zip(a_cuts, b_cuts):
            groups.append(",".join(map(str, a[low:i])) + "|" + ",".join(map(str, b[down:j])))
            low, down = i, j
        found.append((key, a, b, ";".join(groups), len(groups), [(a[i], b[j]) for i, j in links]))
    counts = Counter(link for *_, links in found for link in set(links))
    most = Counter()
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    return sorted(
        (
            (
                key,
                len(a),
                len(b),
                n,
                len(links),
                sum(counts[link] == most[link[0]] for link in links),
                sum(counts[link] for link in links),
                hashlib.sha256(text.encode()).hexdigest() if a else "",
            )
            for key, a, b, text, n, links in found
        ),
        key=str,
    )


def test_alignment_against_all_pairs():
    dice = random.Random(2)
    for _ in range(600):
        size = dice.randint(1, 60)
        sides = []
        for _ in range(2):
            share = dice.choice((0.1, 0.5, 0.9, 1.0))
            sides.append(np.array(sorted({size, *(at for at in range(1, size) if dice.random() < share)})))
        a_cuts, b_cuts, a_links, b_links = ta.align(*sides)
        wanted = brute_align(*(spans(np.diff(np.r_[0, side])) for side in sides))
        assert (a_cuts, b_cuts, list(zip(a_links, b_links))) == wanted
    assert ta.align(np.zeros(0, dtype=int), np.zeros(0, dtype=int)) == ([], [], [], [])


def test_long_one_to_one_stretches_are_jumped():
    ends = np.arange(1, 500_001)
    a, b = np.r_[ends[:250_000], ends[250_001:]], np.r_[ends[:250_002], ends[250_003:]]
    a_cuts, b_cuts, a_links, b_links = ta.align(a, b)
    assert len(a_cuts) == len(np.intersect1d(a, b)) and len(a_links) == len(a) + len(b) - len(a_cuts)
    assert a_cuts[-1] == len(a) and b_cuts[-1] == len(b)


def test_token_bytes(pair):
    decoder = ByteLevel()
    by_id = {at: token for token, at in pair.a.get_vocab().items()}
    for at in range(0, 50_000, 97):
        assert decoder.decode([by_id[at]]) == pair.a_bytes[at].decode("utf-8", "replace")
    text = "añ ✓ <|endoftext|> <s>\n\t<0x41>  x"
    (a, b), (none, also_none) = pair.encode([text, "a ▁ mark"])
    assert b"".join(pair.a_bytes[x] for x in a) == b"".join(pair.b_bytes[x] for x in b) == (" " + text).encode()
    assert none == also_none == [] and 50_256 not in a


def test_chunks_are_put_together_as_the_whole_text_is_encoded(pair, monkeypatch):
    texts = ["a\nb", "a\n\nb", " a", "a ", "a  b", "a\tb c", "\na b", "a \nb", "a\u00a0 b", "x\u3000y z", "é\nü ", "<|endoftext|> a", "a▁b c"]
    texts += ["don't 'll x's\n's", "1 23\n45 6", "\x1c a", "a \x1cb", "ﬁ ｘ a", "a\r\nb c\x0b d", "a\u2028 b\n\u0085c", "", "\n", "x" * 5000]
    dice = random.Random(3)
    texts += ["".join(dice.choices("ab1.,' \n\té✓", k=60)) for _ in range(300)]
    monkeypatch.setattr(ta, "MAX_CHUNKS", 50)
    for at in range(0, len(texts), 7):
        some = texts[at : at + 7]
        for text, (a, b) in zip(some, pair.encode(some)):
            whole = (pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text))
            raw = [b"".join(side[x] for x in ids) for side, ids in zip((pair.a_bytes, pair.b_bytes), whole)]
            sound = text and raw[0] == raw[1] == (" " + text).encode()
            assert (a.tolist(), b.tolist()) == (whole if sound else ([], [])), text


def test_query_against_brute_force(spark, pair, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("length(text) < 1500").orderBy("doc_id").limit(60)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op12_token_alignment(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_rows([(row.doc_id, row.text) for row in docs.collect()], pair)


def test_whole_table(spark):
    rows = queries.op12_token_alignment(spark, SF_DIR).collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(row.n_links == row.n_a + row.n_b - row.n_groups >= row.n_best for row in rows)


@pytest.mark.parametrize("max_broadcast", [0, 1_000])
def test_defined_cases(spark, documents, pair, max_broadcast):
    texts = [None, "", " ", "▁", "one two", "one two", "<|endoftext|>", "ｘ ▁ mark", "naïve ✓\n\n\tcafé", "a" * 3000]
    frame = documents(texts, [(None, "one three", "en", "s", 1), (4, "else", "en", "s", 1)])
    frame = frame.selectExpr("*", "1 as pairs", "2 as times", "3 as pair", "4 as row", "5 as n_a")
    rows = [(row.doc_id, row.text) for row in frame.collect()]
    got = ta.digests(frame, A_PATH, B_PATH, max_broadcast)
    assert sorted(map(tuple, got.collect()), key=str) == brute_rows(rows, pair)
    assert ta.digests(frame.limit(0), A_PATH, B_PATH, max_broadcast).count() == 0


def test_pairs_table(spark, documents, pair):
    aligned = ta.alignments(documents(["one two", "one"]), A_PATH, B_PATH)
    size = len(pair.b_bytes)
    found = ta.pair_ids(ta.pair_counts(aligned, size), size).collect()
    assert {(pair.a_bytes[row.a_id], pair.b_bytes[row.b_id], row.n_docs, row.best) for row in found} == {
        (b" one", b" one", 2, True),
        (b" two", b" two", 1, True),
    }
