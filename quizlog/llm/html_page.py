"""One HTML page as a tree of blocks and text runs (no Spark)."""

from __future__ import annotations

import html
import re

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(["script", "style", "textarea", "title", "noscript", "iframe", "xmp"])
#: Elements that end a text run; the others are inline.
BLOCK = frozenset(
    "html head body title article main section nav header footer aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody "
    "tfoot tr caption blockquote pre figure figcaption form fieldset address details summary center hr menu dialog template "
    "script style noscript iframe object svg canvas button select textarea video audio hgroup search option".split()
)
#: An opening tag that closes an open element of these, up to a barrier.
CLOSES = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"},
    "thead": {"tr"}, "tbody": {"tr", "thead", "tbody"}, "tfoot": {"tr", "tbody"}, "body": {"head"},
}
BARRIER = {"li": {"ul", "ol", "menu"}, "tr": {"table"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}
_ENDS_P = BLOCK - {"html", "head", "body", "script", "style", "noscript", "template", "button", "option"}
_CONTAINER = {"body", "article", "main", "section", "div", "table", "li", "td", "th", "blockquote", "aside", "nav", "header", "footer", "form", "figure"}

#: Blocks nested deeper stay at this depth; their text is kept.
MAX_DEPTH = 128

_TAG = re.compile(
    r"<!--(?:.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTR = re.compile(r"([^\s=\"'/>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


class Node:
    """An element; children are nodes and text runs ``(text, link chars)``."""

    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(raw):
        out.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return out


def parse(page: str) -> Node:
    """The page's blocks.  Never fails: what is not a tag is text, unclosed
    elements close with their container, stray end tags are ignored."""
    root = Node("#root", {})
    stack = [root]
    run: list[str] = []
    links = 0  # open <a> elements
    link_chars = 0

    def end_run() -> None:
        nonlocal link_chars
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            stack[-1].children.append((text, min(link_chars, len(text))))
        link_chars = 0

    def add_text(raw: str) -> None:
        nonlocal link_chars
        if raw:
            text = html.unescape(raw)
            run.append(text)
            if links:
                link_chars += len(text.strip())

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            add_text(page[at:])
            break
        m = _TAG.match(page, lt)
        if not m:
            add_text(page[at : lt + 1])
            at = lt + 1
            continue
        add_text(page[at:lt])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue  # comment, doctype or processing instruction
        closing, rest = m[1] or m[4], m[3] or m[6] or ""
        if name not in BLOCK:
            if name == "a":
                links = max(0, links - 1) if closing else links + 1
            elif name in ("br", "td", "th", "img", "input", "wbr"):
                run.append(" " if name != "wbr" else "")
            if name in RAW and not closing:
                end = re.compile(f"</{name}", re.I).search(page, at)
                at = end.start() if end else n
            continue
        end_run()
        links = 0
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == name:
                    del stack[k:]
                    break
            continue
        closes = CLOSES.get(name, set()) | ({"p"} if name in _ENDS_P else set())
        if closes:
            stop = BARRIER.get(name, _CONTAINER)
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in closes:
                    del stack[k:]
                    break
                if stack[k].tag in stop:
                    break
        node = Node(name, attributes(rest) if rest and rest != "/" else {})
        stack[-1].children.append(node)
        if name in RAW:
            end = re.compile(f"</{name}", re.I).search(page, at)
            stop_at = end.start() if end else n
            if name == "title":
                node.children.append((" ".join(html.unescape(page[at:stop_at]).split()), 0))
            at = stop_at
            stack.append(node)
        elif name not in VOID and len(stack) < MAX_DEPTH:
            stack.append(node)  # "/>" means nothing on such elements
    end_run()
    return root
