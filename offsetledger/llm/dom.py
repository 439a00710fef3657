"""A small HTML reader: block elements with their text, for feature extraction."""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+))|([^\s=/\"']+)")
_WORDS = re.compile(r"[a-z0-9]+")
_CASES = re.compile(r"([a-z])([A-Z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never shown as text of the page.
HIDDEN = frozenset("head title script style template noscript iframe object svg math canvas audio video".split())
RAW = frozenset("script style template iframe textarea title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br".split()
)
#: A start tag of the key ends an open element of these kinds, up to the nearest of the last set.
_ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
_PARAGRAPH_ENDS = frozenset(
    "address article aside blockquote details dialog div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
_SCOPES = frozenset("table td th button object".split())


@dataclass
class Block:
    """A block element; `parts` are its own pieces of text, with their place in page order."""

    tag: str
    attributes: dict[str, str]
    parent: int
    depth: int
    parts: list[tuple[int, str]] = field(default_factory=list)
    links: int = 0
    link_chars: int = 0
    controls: int = 0

    def tokens(self) -> set[str]:
        """Words of class, id and role."""
        said = " ".join(self.attributes.get(name, "") for name in ("class", "id", "role"))
        return set(_WORDS.findall(_CASES.sub(r"\1 \2", said).lower()))


def _attributes(raw: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c, alone in _ATTRIBUTE.findall(raw):
        found.setdefault((name or alone).lower(), entities.unescape(a or b or c))
    return found


def squeeze(text: str) -> str:
    return " ".join(text.split())


def parse(source: str) -> list[Block]:
    """Blocks in page order, the first being the page itself."""
    blocks = [Block("#page", {}, -1, 0)]
    stack: list[tuple[str, int]] = [("#page", 0)]  # open elements and the block each belongs to
    hidden = in_link = 0
    pending: list[str] = []
    order = 0

    def flush() -> None:
        nonlocal order
        text = squeeze("".join(pending))
        pending.clear()
        if text:
            blocks[stack[-1][1]].parts.append((order, text))
            order += 1

    def say(text: str) -> None:
        if hidden or not text:
            return
        text = entities.unescape(text)
        pending.append(text)
        if in_link:
            blocks[stack[-1][1]].link_chars += len(squeeze(text))

    def close(at: int) -> None:
        nonlocal hidden, in_link
        for tag, _ in stack[at:]:
            hidden -= tag in HIDDEN
            in_link -= tag == "a"
        if any(tag not in INLINE for tag, _ in stack[at:]):
            flush()
        del stack[at:]

    def nearest(tags: frozenset, stop: frozenset) -> int:
        for at in range(len(stack) - 1, 0, -1):
            if stack[at][0] in tags:
                return at
            if stack[at][0] in stop:
                break
        return 0

    at = 0
    while at < len(source):
        match = _TOKEN.search(source, at)
        if not match:
            say(source[at:])
            break
        say(source[at : match.start()])
        at = match.end()
        tag = (match[2] or match[5] or "").lower()
        if not tag:
            continue
        if match[1] or match[4]:
            if tag == "br" or tag == "p" and not nearest(frozenset(["p"]), frozenset()):
                pending.append(" ")
                continue
            opened = nearest(frozenset([tag]), frozenset())
            if opened:
                close(opened)
            continue
        if tag in _PARAGRAPH_ENDS and (opened := nearest(frozenset(["p"]), _SCOPES)):
            close(opened)
        if tag in _ENDS and (opened := nearest(*_ENDS[tag])):
            close(opened)
        raw = match[3] if match[2] else match[6]
        block = stack[-1][1]
        if tag in INLINE:
            if tag == "br":
                pending.append(" ")
            blocks[block].links += tag == "a"
        else:
            flush()
            if tag in ("input", "button", "select", "textarea"):
                blocks[block].controls += 1
            if tag not in VOID and not hidden and tag not in HIDDEN:
                blocks.append(Block(tag, _attributes(raw), block, blocks[block].depth + 1))
                block = len(blocks) - 1
        if tag in VOID or raw.endswith("/") and tag in ("path", "circle", "rect", "use", "line"):
            continue
        stack.append((tag, block))
        hidden += tag in HIDDEN
        in_link += tag == "a"
        if tag in RAW:
            end = re.compile(f"</{tag}(?=[\\s/>]|\\Z)", re.IGNORECASE).search(source, at)
            stop = end.start() if end else len(source)
            if tag == "textarea":
                say(source[at:stop])
            at = stop
    flush()
    return blocks
