"""Main-text extraction with gradient-boosted trees over the nodes of a page.

Every block element gets features of its subtree (length, link and tag density), its attribute tokens,
its depth, its siblings and its place; the trees give it log odds of being content. Decoding is
hierarchical: of all labellings in which no content stands inside something that is not content,
the one with the greatest likelihood is taken, found from the leaves up.

There are no labels for pages, so the trees are trained here, on pages that a small grammar composes
from known parts (articles, menus, headers, footers, sidebars, notices, adverts, forms, comments; with
semantic elements or plain ones with telling attributes), with texts of a bounded sample of the corpus.

The text: character references decoded, white space inside a block made one space, blocks joined by one
space in page order. Defined cases: a null or empty page, or one without content, gives an empty text;
repeated rows are extracted each for itself; extra columns are not read.
"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offsetledger.llm.dom import Block, parse
from offsetledger.llm.tables import drawn

_GROUPS = (
    "#page body", "article", "main", "section", "div", "p", "h1 h2 h3 h4 h5 h6", "ul ol menu dl", "li dt dd", "nav", "aside",
    "header", "footer", "form fieldset button select textarea", "table tbody thead tr td th", "blockquote pre figure figcaption",
)
_GROUP_OF = {tag: at for at, tags in enumerate(_GROUPS) for tag in tags.split()}
FEATURES = 22 + 2 * (len(_GROUPS) + 1)


class TokenOdds:
    """Log odds of content for attribute tokens, from the training pages."""

    def __init__(self, seen: list[tuple[set[str], int]]) -> None:
        total, good = Counter(), Counter()
        for tokens, label in seen:
            total.update(tokens)
            if label:
                good.update(tokens)
        self.odds = {t: float(np.log((good[t] + 0.5) / (n - good[t] + 0.5))) for t, n in total.items() if n > 1}

    def of(self, block: Block) -> float:
        return sum(self.odds.get(token, 0.0) for token in block.tokens())


def features(blocks: list[Block], odds: TokenOdds) -> np.ndarray:
    """One row per block."""
    n = len(blocks)
    parent = np.array([b.parent for b in blocks])
    own = np.array([[sum(len(t) for _, t in b.parts), b.link_chars, b.links, b.controls, 1, len(b.parts)] for b in blocks], dtype=float)
    words = np.array([[sum(t.count(" ") + 1 for _, t in b.parts), sum(t.count(c) for _, t in b.parts for c in ".,;:!?")] for b in blocks], dtype=float)
    total = np.concatenate([own, words], axis=1)
    start = np.cumsum(own[:, 0]) - own[:, 0]
    for at in range(n - 1, 0, -1):  # children come after their parents
        total[parent[at]] += total[at]
    chars, link_chars, links, controls, elements, parts, n_words, marks = total.T
    group = np.array([_GROUP_OF.get(b.tag, len(_GROUPS)) for b in blocks])
    token = np.array([odds.of(b) for b in blocks])
    above = np.zeros((n, 4))  # least and greatest token odds above; inside something telling by its tag
    index, siblings, same, kin_links = np.zeros(n), np.ones(n), np.ones(n), np.zeros(n)
    children: dict[int, list[int]] = {}
    for at in range(1, n):
        up = parent[at]
        children.setdefault(up, []).append(at)
        above[at] = above[up]
        above[at, 0] = min(above[up, 0], token[up])
        above[at, 1] = max(above[up, 1], token[up])
        above[at, 2] = max(above[up, 2], blocks[up].tag in ("article", "main"))
        above[at, 3] = max(above[up, 3], blocks[up].tag in ("nav", "aside", "footer", "form", "header"))
    for kin in children.values():
        alike = Counter(blocks[k].tag for k in kin)
        density = link_chars[kin].sum() / max(chars[kin].sum(), 1)
        for place, k in enumerate(kin):
            index[k], siblings[k], same[k], kin_links[k] = place / len(kin), len(kin), alike[blocks[k].tag] / len(kin), density
    page = max(chars[0], 1)
    up = np.maximum(parent, 0)
    plain = [
        np.log1p(chars), link_chars / np.maximum(chars, 1), elements / (chars + 20), np.log1p(links), controls,
        chars / page, chars / np.maximum(chars[up], 1), n_words / np.maximum(parts, 1), marks / np.maximum(n_words, 1), np.log1p(own[:, 0]),
        np.array([b.depth for b in blocks]), index, siblings, same, kin_links, start / page,
        token, above[:, 0], above[:, 1], above[:, 2], above[:, 3], np.array([len(children.get(k, ())) for k in range(n)]),
    ]
    kinds = np.arange(len(_GROUPS) + 1)
    return np.concatenate([np.stack(plain, axis=1), group[:, None] == kinds, group[up][:, None] == kinds], axis=1).astype(np.float32)


@dataclass
class Boosted:
    """Boosted trees of one depth: split features and thresholds per inner node, values per leaf."""

    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray
    value: np.ndarray  # (trees, leaves)
    base: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows, depth = np.arange(len(x)), int(np.log2(self.value.shape[1]))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - len(feature)]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 4, rate: float = 0.25, bins: int = 32, least: float = 2.0) -> Boosted:
    """Newton boosting on the logistic loss, with splits at quantiles; each tree sees a third of the features.

    So no single telling feature, such as the place in the page, keeps the others from being learned.
    """
    draw = np.random.default_rng(trees)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    coded = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    inner = 2**depth - 1
    feature, threshold = np.zeros((trees, inner), dtype=np.int64), np.full((trees, inner), np.inf, dtype=np.float32)
    value = np.zeros((trees, inner + 1))
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    score = np.full(len(y), base)
    for tree in range(trees):
        p = 1 / (1 + np.exp(-score))
        slope, curve = y - p, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        seen = draw.permutation(x.shape[1])[: x.shape[1] // 3]
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local = node - first
            best = np.zeros(width)
            cell = local[:, None] * bins + coded
            for f in seen:
                if not len(cuts[f]):
                    continue
                g = np.bincount(cell[:, f], slope, width * bins).reshape(width, bins)
                h = np.bincount(cell[:, f], curve, width * bins).reshape(width, bins)
                gl, hl = g.cumsum(axis=1)[:, :-1], h.cumsum(axis=1)[:, :-1]
                gt, ht = g.sum(axis=1)[:, None], h.sum(axis=1)[:, None]
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                gain[(hl < least) | (ht - hl < least)] = 0
                at = gain.argmax(axis=1)
                better = gain[np.arange(width), at] > best + 1e-9
                for k in np.flatnonzero(better):
                    if at[k] < len(cuts[f]):
                        best[k] = gain[k, at[k]]
                        feature[tree, first + k], threshold[tree, first + k] = f, cuts[f][at[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[tree, node]] > threshold[tree, node])
        leaf = node - inner
        g, h = np.bincount(leaf, slope, inner + 1), np.bincount(leaf, curve, inner + 1)
        value[tree] = rate * g / (h + 1)
        score += value[tree, leaf]
    return Boosted(feature, threshold, value, base)


def decode(parent: list[int], log_odds: np.ndarray) -> np.ndarray:
    """Per block whether it is content: the likeliest labelling without content inside non-content."""
    n = len(parent)
    yes = -np.logaddexp(0, -log_odds)
    none = -np.logaddexp(0, log_odds)  # the whole subtree left out
    for at in range(n - 1, 0, -1):
        none[parent[at]] += none[at]
        yes[parent[at]] += max(yes[at], none[at])
    keep = yes > none
    for at in range(1, n):
        keep[at] &= keep[parent[at]]
    return keep


@dataclass
class Extractor:
    odds: TokenOdds
    trees: Boosted

    def texts(self, pages: list) -> list[str]:
        trees = [parse(page) if page else [] for page in pages]
        rows = [features(blocks, self.odds) for blocks in trees if blocks]
        scores = self.trees.log_odds(np.concatenate(rows)) if rows else np.zeros(0)
        out, at = [], 0
        for blocks in trees:
            keep = decode([b.parent for b in blocks], scores[at : at + len(blocks)]) if blocks else ()
            at += len(blocks)
            parts = sorted(part for block, k in zip(blocks, keep) if k for part in block.parts)
            out.append(" ".join(text for _, text in parts))
        return out


# --- training pages -------------------------------------------------------------------

_SIDE = {
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs topnav toc pagination pager",
    "header": "header masthead banner topbar site-header logo branding",
    "footer": "footer site-footer copyright colophon bottom credits legal",
    "aside": "sidebar aside widget related recommended popular trending rail more-stories tags archive",
    "notice": "cookie notice consent gdpr alert banner popup modal overlay message",
    "ad": "ad ads advert advertisement sponsored promo promotion banner-ad sponsor adsense",
    "form": "newsletter subscribe signup search login contact form subscription",
    "comments": "comments comment discussion replies respond comment-list reader-comments disqus",
    "share": "share social sharing follow toolbar share-buttons",
}
_MAIN = "content article post entry story main body-text article-body post-content entry-content text page-content"


def _made_page(random: random.Random, texts: list[str]) -> str:
    """A page of known parts; `data-y` is 1 on content. Text is passed on escaped."""

    wide = 1

    def words(low: int, high: int) -> str:
        text = random.choice(texts).split()
        high *= wide
        begin = random.randrange(max(1, len(text) - low))
        return " ".join(text[begin : begin + random.randint(low, high)]).replace("&", "&amp;").replace("<", "&lt;")

    def name(said: str) -> str:
        kind = random.choice(("class", "class", "id"))
        return f'{kind}="{random.choice(said.split())}"'

    def items(low: int, high: int, n: int) -> str:
        return "".join(f'<li><a href="/{i}">{words(low, high)}</a></li>' for i in range(n))

    def side(kind: str) -> str:
        nonlocal wide
        wide = random.choice((1, 1, 1, 4))
        made = _side(kind)
        wide = 1
        return made

    def _side(kind: str) -> str:
        tag = kind if kind in ("nav", "header", "footer", "aside") and random.random() < 0.5 else random.choice(("div", "div", "section"))
        said = name(_SIDE[kind]) if tag in ("div", "section") or random.random() < 0.3 else ""
        if kind == "nav":
            inner = f"<ul>{items(1, 3, random.randint(3, 12))}</ul>"
        elif kind == "header":
            inner = f'<div>{words(1, 4)}</div><a href="/">{words(1, 2)}</a>'
        elif kind == "footer":
            inner = f"&copy; {words(2, 4)} &middot; {words(3, 20)}" if random.random() < 0.6 else f"<p>&copy; {words(3, 12)}</p><ul>{items(1, 2, 4)}</ul>"
        elif kind == "aside":
            inner = f"<h3>{words(1, 4)}</h3><ul>{items(2, 9, random.randint(2, 8))}</ul>" if random.random() < 0.6 else f"<h4>{words(1, 3)}</h4><p>{words(5, 60)}</p>"
        elif kind == "notice":
            inner = f"<p>{words(6, 40)}</p><button>{words(1, 2)}</button>" if random.random() < 0.6 else words(5, 30)
        elif kind == "ad":
            inner = words(3, 25) if random.random() < 0.6 else f'<p>{words(4, 30)}</p><a href="/x">{words(1, 4)}</a>'
        elif kind == "form":
            tag = "form" if random.random() < 0.6 else tag
            inner = f"<p>{words(3, 20)}</p><label>{words(1, 2)}</label><input><button>{words(1, 2)}</button>"
        elif kind == "comments":
            one = random.choice(("<div class=\"comment\"><p>{}</p></div>", "<li><b>user</b> <p>{}</p></li>", "<p>{}</p>", "<article><p>{}</p></article>"))
            inner = f"<h3>{words(1, 3)}</h3>" + "".join(one.format(words(4, 70)) for _ in range(random.randint(1, 6)))
        else:
            inner = "".join(f'<a href="/{i}">{words(1, 2)}</a> ' for i in range(random.randint(2, 6)))
        return f'<{tag} {said} data-y="0">{inner}</{tag}>'

    def body() -> str:
        parts = [f"<h1>{words(2, 12)}</h1>"] if random.random() < 0.85 else []
        if random.random() < 0.2:  # a short page, where the rest outweighs the article
            return "".join([*parts, f"<p>{words(1, 12)}</p>"])
        for _ in range(random.randint(1, 14)):
            roll = random.random()
            if roll < 0.7:
                text = words(1, 120)
                parts.append(random.choice((f"<p>{text}</p>", f"<p>{text}</p>", f"<p><b>{text}<br>", f'<p>{text} <a href="/l">{words(1, 3)}</a></p>')))
            elif roll < 0.78:
                parts.append(f"<h2>{words(1, 7)}</h2>")
            elif roll < 0.84:
                parts.append(f"<ul>{''.join(f'<li>{words(1, 25)}</li>' for _ in range(random.randint(2, 6)))}</ul>")
            elif roll < 0.88:
                parts.append(f"<blockquote><p>{words(5, 50)}</p></blockquote>")
            elif roll < 0.9:
                parts.append(f"<table><tr><td>{words(1, 6)}</td><td>{words(1, 6)}</td></tr></table>")
            elif roll < 0.92:
                parts.append(f"<figure><img src=x><figcaption>{words(2, 12)}</figcaption></figure>")
            else:
                parts.append(side(random.choice(("ad", "share", "aside", "form", "notice"))))
        return "".join(parts)

    tag, said = random.choice((("article", ""), ("article", ""), ("article", name(_MAIN)), ("main", ""), ("div", name(_MAIN)), ("div", name(_MAIN)), ("section", name(_MAIN))))
    main = f'<{tag} {said} data-y="1">{body()}{side("comments") if random.random() < 0.25 else ""}</{tag}>'
    if random.random() < 0.4:
        main = f'<{random.choice(("div", "main"))} {name("wrapper container page layout row content-area")} data-y="1">{main}{side("aside") if random.random() < 0.5 else ""}</div>'
    above = [side(k) for k in ("notice", "header", "nav", "ad", "share", "form") if random.random() < 0.5]
    below = [side(k) for k in ("aside", "comments", "ad", "form", "share", "nav", "footer") if random.random() < 0.5]
    return f"<html><head><title>{words(2, 9)}</title></head><body>{''.join(above)}{main}{''.join(below)}</body></html>"


def _labels(blocks: list[Block]) -> np.ndarray:
    """Labels by the nearest marked block above; what is above a content block is content."""
    label = np.full(len(blocks), -1)
    for at, block in enumerate(blocks):
        said = block.attributes.pop("data-y", None)
        label[at] = int(said) if said else (label[block.parent] if at else -1)
    for at in range(len(blocks) - 1, 0, -1):
        if label[at] == 1 and label[blocks[at].parent] < 0:
            label[blocks[at].parent] = 1
    return np.maximum(label, 0)


_FALLBACK = ["Some words of a plain text, without any meaning, that fill a page from its top to its end. " * 20]


def train(pages: DataFrame, sample_pages: int = 100, made_pages: int = 700, seed: int = 5) -> Extractor:
    """Trees for pages made with texts of at most `sample_pages` corpus pages, the same for the same table."""
    some = pages.where("html is not null").select("page_id", "html")
    sample = drawn(some, sample_pages, seed, "page_id", "html").collect()
    texts = [" ".join(t for b in parse(row.html) for _, t in b.parts) for row in sample]
    texts = [t for t in texts if t.count(" ") > 50] or _FALLBACK
    dice = random.Random(seed)
    made = [parse(_made_page(dice, texts)) for _ in range(made_pages)]
    labels = [_labels(blocks) for blocks in made]
    odds = TokenOdds([(b.tokens(), y) for blocks, ys in zip(made, labels) for b, y in zip(blocks, ys) if b.tokens()])
    x = np.concatenate([features(blocks, odds) for blocks in made])
    return Extractor(odds, boost(x, np.concatenate(labels).astype(float)))


def extract(pages: DataFrame, extractor: Extractor) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 128):
                some = batch.iloc[at : at + 128]
                texts = extractor.texts(some["html"].tolist())
                yield some[["page_id", "url"]].assign(text=texts, n_chars=[len(t) for t in texts])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInPandas(
        run, "page_id long, url string, text string, n_chars long"
    )


def main_texts(pages: DataFrame) -> DataFrame:
    return extract(pages, train(pages))
