"""Texts of web pages, by a stack machine over tags: nested furniture goes whole, nested blocks give their joined text.

A page is cut into tags and texts once; a stack of open elements nests them, with the ends that HTML lets authors leave out.
Work grows with a page's length. Pages come in Arrow batches; what the texts mean is judged by columns (``html``).
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from html import unescape as _decoded
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, StringType, StructType

# Furniture of pages (elements, classes, parts of class names), most nodes of embedded data that are looked at, elements that make a text a page.
UNWANTED_ELEMENTS = ("script", "style", "noscript", "nav", "footer", "aside", "form")
UNWANTED_CLASSES = ("advertisement", "ad", "related", "recommended", "newsletter", "social-share", "author-bio", "comments")
UNWANTED_CLASS_PARTS = ("side-widget", "sidebar", "nav-article", "people-on-the-move", "industry-moves", "view-count", "viewcount")
MAX_NODES = 64
PAGE_LIKE = re.compile(r"<(?:article|main|h[1-6]|p|div|table|li)\b", re.I)
# Fixed values of HTML: elements without content, elements whose content is no markup, and what ends an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style template textarea title".split())
SILENT = frozenset("script style template".split())
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Elements that an opening one of the same kind ends, and how far up the stack that reaches.
ENDS_OPEN = {"li": (("li",), ("ul", "ol", "table")), "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
             "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "option": (("option",), ("select",))}
BLOCKS = frozenset("h1 h2 h3 h4 h5 h6 p li pre blockquote tr".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/<>]*)(?:(?P<attrs>(?:[^<>"']|"[^"]{0,4000}"|'[^']{0,4000}'){0,200}+)|(?P<rest>[^<>]*))>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_COMPOUND = re.compile(r"""([a-zA-Z][\w-]*|\*)?((?:[.#][\w-]+|\[[\w-]+(?:[*^$]?=(?:'[^']*'|"[^"]*"|[\w-]+))?\])*)""")
_CONDITION = re.compile(r"""([.#])([\w-]+)|\[([\w-]+)(?:([*^$]?=)(?:'([^']*)'|"([^"]*)"|([\w-]+)))?\]""")


_REFERENCE = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);")


def unescape(text: str) -> str:
    """Character references decoded; one without its semicolon stays as written (a title cut inside of one, say)."""
    return _REFERENCE.sub(lambda m: _decoded(m[0]), text) if "&" in text else text


class Node(NamedTuple):
    """An element (tag, attributes) or a text (tag ""); ``end`` is the place after its last descendant, ``up`` its parent's."""

    tag: str
    attrs: dict[str, str]
    text: str
    end: int
    up: int


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), unescape(next((v for v in values if v), "")))
    return out


def parse(page: str) -> list[Node]:
    """Elements and texts in the order of the page."""
    nodes: list[Node] = []
    open_: list[int] = []
    n_open: Counter[str] = Counter()

    def close_down_to(depth: int) -> None:
        while len(open_) > depth:
            at = open_.pop()
            n_open[nodes[at].tag] -= 1
            nodes[at] = nodes[at]._replace(end=len(nodes))

    def close(tags: tuple[str, ...] | frozenset[str], bounds: tuple[str, ...]) -> None:
        if not any(n_open[tag] for tag in tags):
            return
        for depth in range(len(open_) - 1, -1, -1):
            tag = nodes[open_[depth]].tag
            if tag in tags:
                close_down_to(depth)
                return
            if tag in bounds:
                return

    def add(tag: str, attrs: dict[str, str], text: str) -> None:
        nodes.append(Node(tag, attrs, text, len(nodes) + 1, open_[-1] if open_ else -1))

    at = 0
    while at < len(page):
        token = _TOKEN.search(page, at)
        text = page[at : token.start() if token else len(page)]
        if text:
            add("", {}, unescape(text))
        if not token:
            break
        at = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        if token["end"]:
            close((tag,), ("td", "th", "table") if tag not in ("td", "th", "tr", "table", "tbody", "thead", "body", "html") else ())
            continue
        if tag in ENDS_PARAGRAPH:
            close(("p",), ("table", "td", "th", "button", "object"))
        if tag in ENDS_OPEN:
            close(*ENDS_OPEN[tag])
        add(tag, _attributes(token["attrs"] or token["rest"] or ""), "")
        if tag in VOID:
            continue
        open_.append(len(nodes) - 1)
        n_open[tag] += 1
        if tag in RAW:
            ending = re.compile(rf"</{tag}\b[^>]*>|\Z", re.I).search(page, at)
            if ending.start() > at:
                inner = page[at : ending.start()]
                add("", {}, inner if tag in SILENT else unescape(inner))
            close_down_to(len(open_) - 1)
            at = ending.end()
    close_down_to(0)
    return nodes


Test = Callable[[list[Node], int], bool]


def selector(text: str) -> Test | None:
    """A test for a CSS selector of element names, classes, ids and attributes, with descent by blanks and commas between choices; None if it is not one."""
    choices = []
    for choice in text.split(","):
        steps = []
        for part in choice.split():
            m = _COMPOUND.fullmatch(part)
            if not m or not m[0]:
                return None
            steps.append(((m[1] or "*").lower(), _CONDITION.findall(m[2])))
        if not steps:
            return None
        choices.append(steps)

    def fits(node: Node, step: tuple[str, list[tuple[str, ...]]]) -> bool:
        tag, conditions = step
        if not node.tag or tag not in ("*", node.tag):
            return False
        for mark, name, attr, how, *values in conditions:
            if mark == ".":
                ok = name in node.attrs.get("class", "").split()
            elif mark == "#":
                ok = node.attrs.get("id") == name
            else:
                has, want = node.attrs.get(attr.lower()), next((v for v in values if v), "")
                ok = has is not None and (not how or {"=": has == want, "*=": want in has, "^=": has.startswith(want), "$=": has.endswith(want)}[how])
            if not ok:
                return False
        return True

    def test(nodes: list[Node], at: int) -> bool:
        for steps in choices:
            left, k = len(steps) - 1, at
            if not fits(nodes[at], steps[-1]):
                continue
            while left and k >= 0:
                k = nodes[k].up
                left -= k >= 0 and fits(nodes[k], steps[left - 1])
            if not left:
                return True
        return False

    return test


def _unwanted(nodes: list[Node], at: int) -> bool:
    node = nodes[at]
    if node.tag in UNWANTED_ELEMENTS:
        return True
    name = node.attrs.get("class", "")
    return bool(name) and (any(c in UNWANTED_CLASSES for c in name.split()) or any(p in name for p in UNWANTED_CLASS_PARTS))


def _kept(nodes: list[Node], first: int, end: int, tests: list[Test]) -> Iterator[int]:
    at = first
    while at < end:
        if nodes[at].tag and any(t(nodes, at) for t in tests):
            at = nodes[at].end
            continue
        yield at
        at += 1


def _words(text: str) -> str:
    """A text's lines without blanks at their ends, without empty ones, single blanks inside."""
    lines = (re.sub(r"[ \t]+", " ", line).strip() for line in text.replace("\xa0", " ").splitlines())
    return "\n".join(line for line in lines if line)


def clean(text: str) -> str:
    """The texts of a fragment, each piece between tags a line of its own."""
    nodes = parse(unescape(text))
    silent = {k for k, n in enumerate(nodes) if n.tag in SILENT}
    return _words("\n".join(n.text for n in nodes if not n.tag and n.up not in silent))


def blocks(nodes: list[Node], first: int, end: int, exclude: list[Test]) -> str:
    """Headings (marked ##), paragraphs, items, quotes and rows between two places, one a line; an outer one has the text of those inside. The plain text where there are none."""
    found: list[list[str]] = []
    open_: list[tuple[int, int]] = []  # end of an open block, its place in ``found``
    texts = []
    for at in _kept(nodes, first, end, [_unwanted, *exclude]):
        node = nodes[at]
        while open_ and open_[-1][0] <= at:
            open_.pop()
        if node.tag in BLOCKS:
            open_.append((node.end, len(found)))
            found.append([node.tag])
        elif not node.tag and (node.up < 0 or nodes[node.up].tag not in SILENT):
            texts.append(node.text)
            piece = node.text.strip()
            if piece:
                for _, k in open_:
                    found[k].append(piece)
    lines: list[str] = []
    for tag, *pieces in found:
        line = " ".join(pieces)
        line = f"## {line}" if re.fullmatch("h[1-6]", tag) else line
        if line and (not lines or lines[-1] != line):
            lines.append(line)
    return "\n".join(lines) if lines else _words("\n".join(texts))


def body(text: str) -> str:
    """A feed's or a candidate's text: that of its blocks if it looks like a page, else its plain text."""
    if PAGE_LIKE.search(text):
        nodes = parse(unescape(text))
        return blocks(nodes, 0, len(nodes), [])
    return clean(text)


def embedded_bodies(nodes: list[Node]) -> Iterator[str]:
    """articleBody texts of the page's embedded data, breadth first through @graph lists, in at most MAX_NODES nodes a script."""
    for at, node in enumerate(nodes):
        if node.tag != "script" or node.attrs.get("type") != "application/ld+json":
            continue
        try:
            data = json.loads("".join(n.text for n in nodes[at + 1 : node.end]))
        except (ValueError, RecursionError):
            continue
        queue = list(data) if isinstance(data, list) else [data]
        seen = 0
        for item in queue:  # grows while it is read
            if seen >= MAX_NODES:
                break
            if not isinstance(item, dict):
                continue
            seen += 1
            graph = item.get("@graph")
            if isinstance(graph, list):
                queue += graph[: max(0, MAX_NODES - len(queue))]
            if isinstance(item.get("articleBody"), str):
                yield clean(item["articleBody"])


def candidates(page: str, selectors: list[str], exclude: list[str]) -> list[tuple[str, str]]:
    """(method, text) of all that may be the page's body, in the order tried: the site's own selectors, embedded data, then the usual elements."""
    nodes = parse(page)
    unwanted = [t for t in map(selector, exclude) if t]

    def element(method: str, wanted: str) -> Iterator[tuple[str, str]]:
        test = selector(wanted)
        at = next((k for k, n in enumerate(nodes) if test and n.tag and test(nodes, k)), None)
        if at is not None:
            yield f"{method}:{wanted}", blocks(nodes, at, nodes[at].end, unwanted)

    found = [c for s in selectors for c in element("site-selector", s)]
    found += [("json-ld:articleBody", b) for b in embedded_bodies(nodes)]
    found += [c for s in ("article", "main", "[role='main']") for c in element("semantic-selector", s)]
    return [(method, body(text)) for method, text in found]


_CANDIDATES = ArrayType(StructType().add("method", StringType()).add("text", StringType()))


@arrow_udf(_CANDIDATES)
def page_candidates(pages: pa.Array, selectors: pa.Array, exclude: pa.Array) -> pa.Array:
    rows = zip(pages.to_pylist(), selectors.to_pylist(), exclude.to_pylist(), strict=True)
    found = [[{"method": m, "text": t} for m, t in candidates(p or "", s or [], e or [])] for p, s, e in rows]
    return pa.array(found, pa.list_(pa.struct([("method", pa.string()), ("text", pa.string())])))


def _each(f: Callable[[str], str], texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else f(t) for t in texts.to_pylist()], pa.string())


@arrow_udf(StringType())
def clean_text(texts: pa.Array) -> pa.Array:
    """``clean`` of a column; null for null."""
    return _each(clean, texts)


@arrow_udf(StringType())
def page_text(pages: pa.Array) -> pa.Array:
    """Blocks of a whole page or fragment; null for null."""
    def whole(page: str) -> str:
        nodes = parse(page)
        return blocks(nodes, 0, len(nodes), [])

    return _each(whole, pages)


@arrow_udf(ArrayType(StringType()))
def body_texts(fields: pa.Array) -> pa.Array:
    """``body`` of every text of an array."""
    return pa.array([None if f is None else [None if t is None else body(t) for t in f] for f in fields.to_pylist()], pa.list_(pa.string()))
