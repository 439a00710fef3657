import random
import zlib

import numpy as np
import pytest

from offsetledger.llm import html_extract as H
from offsetledger.llm import license_scan as L
from offsetledger.llm import packing as P
from offsetledger.llm import sentencepiece_codec as C
from offsetledger.llm.dom import parse
from offsetledger.llm.queries import tokenizer_file

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>if (a<b) x("</p>");</script></head><body>
<nav><ul><li><a href="/a">Home</a><li><a href="/b">About us</a></ul></nav><div class="cookie-notice">We use cookies. <button>OK</button></div>
<article><h1>A  title &amp; more</h1><p>First <b>para</b>graph,\n with <a href="x">a link</a> and more words in it.<p>Second one<br>goes on &copy;
and has a few words too.</p><div class="ad">Buy this now</div></article>
<div id="comments"><h3>2 comments</h3><p>I like it very much, thank you.</p></div><form><label>Mail</label><input></form>
<footer>&copy; site &middot; all of it</footer></body></html>"""


def test_a_page_by_hand(spark):
    pages = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (3, "u", ""), (1, "u", PAGE), (None, "u", "<p>")], "page_id long, url string, html string")
    rows = H.main_texts(pages.selectExpr("*", "1 AS text", "2 AS n_chars")).collect()
    text = "A title & more First paragraph, with a link and more words in it. Second one goes on © and has a few words too."
    assert sorted((row.page_id or 0, row.text, row.n_chars) for row in rows) == sorted(
        [(1, text, len(text)), (1, text, len(text)), (2, "", 0), (3, "", 0), (0, "", 0)]
    )
    assert H.main_texts(pages.limit(0)).count() == 0


def test_made_pages_that_were_not_trained_on(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    model, dice = H.train(pages), random.Random(77)
    texts = [" ".join(t for b in parse(row.html) for _, t in b.parts) for row in pages.limit(50).collect()]
    good = bad = lost = 0
    for _ in range(100):
        blocks = parse(H._made_page(dice, texts))
        labels = H._labels(blocks)
        keep = H.decode([b.parent for b in blocks], model.trees.log_odds(H.features(blocks, model.odds)))
        for block, y, k in zip(blocks, labels, keep):
            size = sum(len(t) for _, t in block.parts)
            good, bad, lost = good + size * (y and k), bad + size * (k and not y), lost + size * (y and not k)
    assert good / (good + bad) > 0.98 and good / (good + lost) > 0.98


def test_decoding_is_consistent_and_best():
    dice = np.random.default_rng(3)
    for _ in range(30):
        parent = [-1] + [int(dice.integers(0, at)) for at in range(1, 9)]
        odds = dice.normal(0, 2, 9)
        keep = H.decode(parent, odds)
        assert all(not keep[at] or keep[parent[at]] for at in range(1, 9))

        def value(labels):
            return sum(-np.logaddexp(0, -z if y else z) for y, z in zip(labels, odds))

        legal = [
            labels
            for labels in (tuple(code >> bit & 1 for bit in range(9)) for code in range(512))
            if all(not labels[at] or labels[parent[at]] for at in range(1, 9))
        ]
        assert abs(value(keep) - max(map(value, legal))) < 1e-9


@pytest.mark.parametrize("broken", ["<", "<a", "<a href='x", "<!--", "<script>x", "</p></p><b>x", "a<1", "<p/>x", "<td>a<td>b<tr>c"])
def test_broken_pages_are_read(broken):
    assert parse(broken) and parse(broken * 200)


# --- SentencePiece --------------------------------------------------------------------

ODD = ["", " ", "  a  b ", "▁x▁▁y", "日本語 テスト 😀", "\n\n x\ty", "<s> </s> <unk> <0x41>", "é́ à", "a" * 500, "\x00 b", "trail "]


def test_sentencepiece_parity(spark, documents):
    path = tokenizer_file("piece_bpe_32k.model")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").unionByName(documents([*ODD, None]))
    rows = C.digests(docs, path).collect()
    assert len(rows) == docs.count() and all(row.parity for row in rows)
    codec = C.Codec.of(path)
    for text, ids in zip(ODD, codec.encode(ODD)):
        assert codec.decode(ids) == codec.library.decode(np.frombuffer(ids, dtype="<u4").tolist())
    back = {row.doc_id: row.text for row in C.decode(C.encode(documents(ODD), path), path).collect()}
    assert back[4] == ODD[4] and back[0] == ""
    assert C.digests(docs.limit(0), path).count() == 0


def test_unigram_models_are_rebuilt(tmp_path):
    """A made unigram model file, against the library."""
    import struct

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    def message(number, data):
        return varint(number << 3 | 2) + varint(len(data)) + data

    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *[(f"<0x{n:02X}>", 0.0, 6) for n in range(256)]]
    pieces += [("▁", -2.0, 1), ("▁the", -3.0, 1), ("th", -4.1, 1), ("e", -4.3, 1), ("t", -5.2, 1), ("h", -5.4, 1), ("▁a", -3.7, 1), ("he", -4.6, 1)]
    data = b""
    for piece, score, kind in pieces:
        data += message(1, message(1, piece.encode()) + b"\x15" + struct.pack("<f", score) + b"\x18" + varint(kind))
    data += message(2, b"\x18\x01" + varint(35 << 3) + b"\x01" + varint(40 << 3) + b"\x00") + message(3, message(1, b"identity"))
    (tmp_path / "made.model").write_bytes(data)
    codec = C.Codec(str(tmp_path / "made.model"))
    texts = ["the heat", "a  then", "hé the", "", "thethe ▁a"]
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in codec.encode(texts)] == [codec.library.encode(t) for t in texts]


# --- packing --------------------------------------------------------------------------


def test_packing_is_exact_and_without_padding(spark, documents):
    path = tokenizer_file("word_bpe_49k.json")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").unionByName(documents([None, "", "İ ΣΑΣ don't, x.. <|endoftext|>y", "hi " * 9000]))
    docs = docs.withColumn("doc_id", docs.doc_id + docs.n_chars.isNull().cast("int") * 10**6).repartition(3)
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)
    texts = {}
    for row in docs.collect():
        texts.setdefault(row.doc_id, []).append([*plain.encode(row.text or "", add_special_tokens=False).ids, 1])
    pieces = P.pack(docs, path).collect()
    sequences = {}
    for p in pieces:
        assert any(
            p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], dtype="<u4").tobytes()) for ids in texts[p.doc_id]
        )
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert sum(p.length for p in pieces) == sum(len(ids) for own in texts.values() for ids in own)
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 2048 and end & (end - 1) == 0
    assert P.pack(docs.limit(0), path).count() == 0


def test_the_level_of_least_squares_is_chosen():
    dice, levels = random.Random(5), P.Levels(12)
    for _ in range(300):
        size = dice.randint(1, 11)
        before = levels.counts.copy()

        def cost(level):
            after = before.copy()
            after[level] -= level > 0
            after[level + size] += level + size < 12
            return int((after[1:12] ** 2).sum())

        possible = [level for level in range(12 - size + 1) if level == 0 or before[level]]
        assert cost(levels.choose(size)) == min(map(cost, possible))
        levels.place(size, ("doc", 0, b"", size))


# --- licences -------------------------------------------------------------------------


def test_licences_of_documents(spark, documents):
    corpus = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [
        "Plain words here.\nReleased under the MIT License.\nMore words.",
        "Licensed under the Apache License, Version 2.0.",
        "This work is licensed under the GNU General Public License, version 3.\nAll rights reserved.",
        "Licensed under CC BY-NC 4.0.",
        "Licensed under the Frobnitz License of its vendor, see the license terms.",
        "Nothing to see, only a few ordinary words.\n" * 50,
        None,
        "",
    ]
    model = L.train(corpus)
    found = {row.doc_id: [hit.found.family for hit in row.hits] for row in L.findings(documents(texts), model).collect()}
    assert [found[n] for n in range(8)] == [["mit"], ["apache"], ["gpl", "proprietary"], ["cc-by-nc"], ["unknown"], [], [], []]
    rows = L.scan(corpus)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Exchange" not in plan
    hits = rows.where("families <> ''").count()
    assert hits == corpus.where("text rlike '(?i)licen[cs]e|rights reserved'").count()
    assert L.scan(corpus.limit(0)).count() == 0


def test_licences_inside_long_lines(spark, documents):
    corpus = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lines = [line for row in corpus.orderBy("doc_id").collect() for line in row.text.split("\n")]
    prose = [w for line in lines if "icen" not in line and "rights" not in line for w in line.split()]
    notices = {
        "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "apache": "Licensed under the Apache License, Version 2.0",
        "gpl": "This work is licensed under the GNU General Public License, version 3",
        "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    }
    dice, texts, wanted = random.Random(4), [], []
    for family, notice in notices.items():
        for size in (20, 50, 500, 5000):
            for _ in range(4 if size < 5000 else 1):
                begin = dice.randrange(len(prose) - size)
                words, at = prose[begin : begin + size], dice.randint(0, size)
                texts.append(" ".join(words[:at] + [notice] + words[at:]))
                wanted.append((size, [family]))
    # Two of them in one line.
    texts.append(" ".join([*prose[:100], notices["mit"], *prose[100:300], notices["gpl"], *prose[300:400]]))
    wanted.append((400, ["gpl", "mit"]))
    rows = L.findings(documents(texts), L.train(corpus)).collect()
    found = {row.doc_id: sorted(hit.found.family for hit in row.hits) for row in rows}
    assert [(size, found[n]) for n, (size, _) in enumerate(wanted)] == wanted
