"""HTML cut into leaf blocks of text with the tag path that leads to each."""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass

PATH_BUCKETS = 1024

# Elements of HTML by how they are parsed and laid out.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
_BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li"
    " main menu nav noscript object ol optgroup option p pre search section select summary table tbody td"
    " template tfoot th thead tr ul".split()
)
_CLOSES_P = _BLOCK - frozenset("body button caption head html label noscript object option optgroup select tbody td"
                               " template tfoot th thead tr".split())  # fmt: skip
# A start tag ends these open elements, unless one of the second kind stands between.
_ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table", "tbody", "thead", "tfoot")),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",)),
    "option": (("option",), ("select", "optgroup")),
}
_P_SCOPE = frozenset("button caption html object table td template th".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)(?:>|\Z)"
    r"|<[/!?][^>]*+(?:>|\Z)",
    re.S,
)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in _RAW}
_NAMED = re.compile(r"(?:^|[\s\"'/])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass(frozen=True)
class Block:
    """White space is single and trimmed; ``linked`` counts the characters inside links."""

    text: str
    path: tuple[frozenset[int], frozenset[int]]
    linked: int


def bucket(word: str) -> int:
    return zlib.crc32(word.encode()) % PATH_BUCKETS


def element_buckets(name: str, attributes: str) -> frozenset[int]:
    """An element's name and the words of its class, id and role, without a plural s."""
    found = {name}
    for values in _NAMED.findall(attributes):
        for word in _WORD.findall(html.unescape("".join(values))):
            found.add(word.lower())
    return frozenset(bucket(w[:-1] if len(w) > 3 and w.endswith("s") else w) for w in found)


def blocks(page: str) -> list[Block]:
    """The texts between the boundaries of block-level elements, in page order.

    Comments, declarations, scripts, styles, titles, text areas and frames give nothing. Elements
    may lack their end tags; end tags that nothing opened are passed over. A line break is white
    space.
    """
    out: list[Block] = []
    # Name, buckets of it and all around it, own buckets, whether it is a block or a link.
    stack: list[tuple] = [("", frozenset(), frozenset(), True, False)]
    parts: list[str] = []
    open_names: dict[str, int] = {}
    known: dict[tuple[str, str], frozenset[int]] = {}
    links = linked = at = 0

    def cut() -> None:
        nonlocal linked
        if parts:
            text = "".join(parts)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                inner = next(e for e in reversed(stack) if e[3])
                out.append(Block(text, (inner[1], inner[2]), min(linked, len(text))))
            parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            linked += len(text) if links else 0

    def leave(down_to: int) -> None:
        nonlocal links
        if any(e[3] for e in stack[down_to:]):
            cut()
        for e in stack[down_to:]:
            open_names[e[0]] -= 1
            links -= e[4]
        del stack[down_to:]

    def last(names, but) -> int | None:
        if not any(open_names.get(n) for n in names):
            return None
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                return i
            if stack[i][0] in but:
                return None
        return None

    while match := _TOKEN.search(page, at):
        add(page[at : match.start()])
        at = match.end()
        name = match["name"]
        if name is None:
            continue
        name = name.lower()
        if match["end"]:
            if name == "br":
                add(" ")
            elif open_names.get(name):
                # An inline end tag does not close the blocks around it.
                i = last((name,), () if name in _BLOCK else _BLOCK)
                if i is not None:
                    leave(i)
            elif name in _BLOCK:
                cut()
            continue
        if name in _RAW:
            if name == "textarea":
                cut()
            ending = _RAW_END[name].search(page, at)
            at = ending.start() if ending else len(page)
            continue
        is_block = name in _BLOCK
        if name in _CLOSES_P and (i := last(("p",), _P_SCOPE)) is not None:
            leave(i)
        if name in _ENDS:
            closing, but = _ENDS[name]
            while (i := last(closing, but)) is not None:
                leave(i)
        if is_block:
            cut()
        if name in _VOID:
            add(" " if name in ("br", "img", "input") else "")
            continue
        if match["attributes"].endswith("/") and not is_block:
            continue
        key = (name, match["attributes"])
        own = known.get(key)
        if own is None:
            own = known[key] = element_buckets(*key)
        around = stack[-1][1]
        is_link = name == "a"
        stack.append((name, around if own <= around else around | own, own, is_block, is_link))
        open_names[name] = open_names.get(name, 0) + 1
        links += is_link
    add(page[at:])
    cut()
    return out
