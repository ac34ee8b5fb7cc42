"""Main-text extraction by union-free wrapper inference (operator 4).

The pages of a host come from few templates.  A wrapper is a union-free
regular expression over a page's block tokens: a sequence of elements (tag
with class and id), text constants and text slots, where an element or group
may be optional or repeated.  A page is its own wrapper; two wrappers are
aligned block by block, and mismatches are resolved as

* different texts at one place: a text slot,
* a block that only one side has: an optional,
* equal neighbours, or neighbouring groups of equal blocks: a repeated group;
* more than ``MAX_ITEMS`` blocks in one sequence, which follow no order: a
  repeated group in which each kind of block is optional.

Each task folds its pages of a host into one wrapper as it reads them; then
wrappers meet per host in two rounds (dealt by host and a salt, then by
host), one at a time in a stream, so a host with a third of all pages is
never gathered in one group.  Alignment is cheap because repeats collapse: a
wrapper's size follows the template, not the pages, also where pages are long
and irregular.

From a host's wrapper follow the places of its main text: articles, else
the main element, else the region that holds most slot text outside links.
Menus, headers, footers, sidebars, notices, adverts, forms, reader comments
and invisible elements are left out by element and by words of class and id.
Nothing is left out for being the same on many pages: a place inside the main
text is content, so a page reads the same whatever number of pages its host has.

Every page is then read by its host's rules: blocks in page order, character
references decoded, white space inside a block one space, blocks joined by
an empty line.

Defined results: null html is empty; a page without main text has text ``''``;
null urls form a host of their own; repeated rows each get a row.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlog.llm.html_page import Node, parse
from quizlog.llm.shared import batches, cut, table

MAX_GROUP = 4
MAX_ITEMS = 64
MAX_TABLE = 1 << 14  # cells of an exact alignment
SALTS = 64
BROADCAST_BYTES = 16 << 20

# Fixed lists: elements and class or id words that never hold main text.
DROP_TAGS = frozenset(
    "head title nav footer aside form script style noscript template iframe object svg canvas button select textarea dialog menu "
    "option search video audio fieldset".split()
)
DROP_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar footer cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription "
    "share sharing social related recommended recommendations comment comments commentlist disqus respond reply replies pagination "
    "pager toolbar widget widgets masthead skip login signup search".split()
)
KEEP_TAGS = frozenset(["html", "body", "main", "article", "#root"])
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6", "hgroup"])
_WORD = re.compile(r"[A-Za-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@lru_cache(maxsize=100_000)
def _names(cls: str, id_: str) -> tuple[str, frozenset[str]]:
    words = [w.lower() for w in _WORD.findall(_CAMEL.sub(" ", f"{cls} {id_}"))]
    return ".".join(words), frozenset(words)


def dropped(node: Node, in_article: bool) -> bool:
    """Whether an element can hold no main text."""
    a = node.attrs
    if node.tag in DROP_TAGS:
        return True
    if not a or node.tag in KEEP_TAGS:
        return node.tag == "header" and not in_article
    if "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", "").lower():
        return True
    if a.get("role") in ("navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog"):
        return True
    if node.tag == "header" and not in_article:
        return True
    return bool(_names(a.get("class", ""), a.get("id", ""))[1] & DROP_WORDS)


def key(node: Node) -> str:
    a = node.attrs
    names = _names(a.get("class", ""), a.get("id", ""))[0] if a else ""
    return node.tag + ("." + names if names else "")


# A wrapper item is a list: [key, optional, repeated, children] for an
# element or a group (key "()"), ["#", optional, repeated, constant or None
# for a slot, chars, link chars] for a text.


def _sign(item: list) -> str:
    return item[0] if item[0] != "()" else "(" + " ".join(_sign(x) for x in item[3]) + ")"


def wrap(node: Node, in_article: bool = False) -> list:
    """A page's block as a wrapper item; dropped elements leave only a mark."""
    inside = in_article or node.tag == "article"
    out: list = []
    for child in node.children:
        if isinstance(child, tuple):
            _append(out, ["#", 0, 0, child[0], len(child[0]), child[1]])
        elif not dropped(child, inside):
            _append(out, wrap(child, inside))
    return [key(node), 0, 0, out]


def _append(out: list, item: list) -> None:
    """Add an item; neighbours that repeat collapse into a repeated group."""
    out.append(item)
    signs = [_sign(x) for x in out[-2 * MAX_GROUP :]]
    for k in range(1, MAX_GROUP + 1):
        if len(signs) >= k + 1 and k > 1 and out[-k - 1][0] == "()":
            group = out[-k - 1]
            if [_sign(x) for x in group[3]] == signs[-k:]:
                group[3] = [merge(x, y) for x, y in zip(group[3], out[-k:])]
                del out[-k:]
                return
        if len(signs) >= 2 * k and signs[-k:] == signs[-2 * k : -k]:
            both = [merge(x, y) for x, y in zip(out[-2 * k : -k], out[-k:])]
            del out[-2 * k :]
            if k == 1:
                both[0][2] = 1
                out.append(both[0])
            else:
                out.append(["()", 0, 1, both])
            return


def merge(a: list, b: list) -> list:
    """The wrapper of two items with equal signs."""
    opt, rep = a[1] | b[1], a[2] | b[2]
    if a[0] == "#":
        return ["#", opt, rep, a[3] if a[3] == b[3] else None, a[4] + b[4], a[5] + b[5]]
    if a[0] == "()":
        return ["()", opt, rep, [merge(x, y) for x, y in zip(a[3], b[3])]]
    return [a[0], opt, rep, align(a[3], b[3])]


def _pairs(sa: list[str], sb: list[str]) -> list[tuple[int, int]]:
    """Places of a common subsequence of two sign sequences: a longest one
    where the differing part is short, else by the signs that stand once on
    either side, else by the next equal sign; in linear space."""
    n, m = len(sa), len(sb)
    start = 0
    while start < min(n, m) and sa[start] == sb[start]:
        start += 1
    end = 0
    while end < min(n, m) - start and sa[n - 1 - end] == sb[m - 1 - end]:
        end += 1
    head = [(i, i) for i in range(start)]
    tail = [(n - end + i, m - end + i) for i in range(end)]
    a, b = sa[start : n - end], sb[start : m - end]
    if not a or not b:
        return head + tail
    if len(a) * len(b) <= MAX_TABLE:
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) - 1, -1, -1):
            row, below = best[i], best[i + 1]
            for j in range(len(b) - 1, -1, -1):
                row[j] = below[j + 1] + 1 if a[i] == b[j] else max(below[j], row[j + 1])
        mid, i, j = [], 0, 0
        while i < len(a) and j < len(b):
            if a[i] == b[j]:
                mid.append((i, j))
                i, j = i + 1, j + 1
            elif best[i + 1][j] >= best[i][j + 1]:
                i += 1
            else:
                j += 1
    else:
        ca, cb = Counter(a), Counter(b)
        at = {x: j for j, x in enumerate(b) if cb[x] == 1}
        once = [(i, at[x]) for i, x in enumerate(a) if ca[x] == 1 and x in at]
        mid = []
        if once:
            chain = _rising(once)
            for (i, j), (i2, j2) in zip([(-1, -1), *chain], [*chain, (len(a), len(b))]):
                mid += [(i + 1 + x, j + 1 + y) for x, y in _pairs(a[i + 1 : i2], b[j + 1 : j2])]
                mid += [(i2, j2)] if i2 < len(a) else []
        else:
            places: dict[str, list[int]] = {}
            for j, x in enumerate(b):
                places.setdefault(x, []).append(j)
            j = 0
            for i, x in enumerate(a):
                k = bisect_left(places.get(x, []), j)
                if k < len(places.get(x, [])):
                    mid.append((i, places[x][k]))
                    j = places[x][k] + 1
    return head + [(start + i, start + j) for i, j in mid] + tail


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest run of pairs (by rising i) with rising j."""
    ends: list[int] = []  # least last j of a run of each length
    last: list[int] = []
    before: list[int] = []
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(ends, j)
        ends[at:] = [j, *ends[at + 1 :]]
        last[at:] = [k, *last[at + 1 :]]
        before.append(last[at - 1] if at else -1)
    out, k = [], last[-1]
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def align(a: list, b: list) -> list:
    """Align two item sequences; what only one side has becomes optional."""
    sa, sb = [_sign(x) for x in a], [_sign(x) for x in b]
    if sa == sb:
        return [merge(x, y) for x, y in zip(a, b)]
    out: list = []

    def add(item: list) -> None:
        # optionals of one kind side by side are a repeated optional
        if out and _sign(out[-1]) == _sign(item) and (out[-1][1] or item[1]):
            out[-1] = merge(out[-1], item)
            out[-1][2] = 1
        else:
            out.append(item)

    i = j = 0
    for i2, j2 in [*_pairs(sa, sb), (len(a), len(b))]:
        for x in a[i:i2] + b[j:j2]:
            add([x[0], 1, *x[2:]])
        if i2 < len(a):
            add(merge(a[i2], b[j2]))
        i, j = i2 + 1, j2 + 1
    return out if len(out) <= MAX_ITEMS else [_unordered(out)]


def _unordered(items: list) -> list:
    """Blocks in no order: a repeated group of each kind once, optional."""
    kinds: dict[str, list] = {}
    todo = list(reversed(items))
    while todo:
        x = todo.pop()
        if x[0] == "()":
            todo += reversed(x[3])
            continue
        had = kinds.get(x[0])
        kinds[x[0]] = [x[0], 1, 1, *(merge(had, x) if had else x)[3:]]
    return ["()", 1, 1, list(kinds.values())]


def _mass(item: list) -> tuple[float, float]:
    """(slot characters outside links, all characters) below an item."""
    if item[0] == "#":
        return (float(item[4] - item[5]) if item[3] is None else 0.0, float(item[4]))
    got = [_mass(x) for x in item[3]]
    return sum(g[0] for g in got), sum(g[1] for g in got)


def _find(item: list, tag: str, path: tuple, out: list) -> None:
    if item[0] == "#":
        return
    here = path if item[0] == "()" else path + (item[0],)
    if item[0].split(".")[0] == tag:
        out.append((here, item))
        return
    for x in item[3]:
        _find(x, tag, here, out)


def rules(wrapper: list) -> dict:
    """Where the main text is: paths of elements from the root."""
    found: list = []
    for tag in ("article", "main"):
        _find(wrapper, tag, (), found)
        found = [f for f in found if _mass(f[1])[1] > 0]
        if found:
            break
    if not found:
        at, path = wrapper, ()
        # go down while one child holds most of the text
        while at[0] != "#":
            path = path if at[0] == "()" else path + (at[0],)
            found = [(path, at)]
            scored = sorted(((_mass(x)[0] or _mass(x)[1] * 1e-3, k) for k, x in enumerate(at[3]) if x[0] != "#"), reverse=True)
            whole = sum(s for s, _ in scored) + sum(x[4] - x[5] for x in at[3] if x[0] == "#")
            if not scored or scored[0][0] < 0.8 * whole or at[3][scored[0][1]][2] or at[3][scored[0][1]][0].split(".")[0] in ("p", "li", "tr"):
                break
            at = at[3][scored[0][1]]
    return {"paths": sorted({p[1:] if p and p[0] == "#root" else p for p, _ in found})}


def _collect(node: Node, in_article: bool, header: bool, out: list[str]) -> None:
    """Texts of the blocks below a main element, in page order."""
    stack = [(iter(node.children), in_article, header)]
    while stack:
        it, inside, head = stack[-1]
        child = next(it, None)
        if child is None:
            stack.pop()
        elif isinstance(child, tuple):
            if not head:
                out.append(child[0])
        elif not dropped(child, inside):
            # of an article's own header only the headings are text
            is_head = (head or child.tag == "header") and child.tag not in HEADINGS
            stack.append((iter(child.children), inside or child.tag == "article", is_head))


def extract(page: str, where: dict | None) -> str:
    """Main text of a page by its host's rules, or by its own if they meet
    nothing on it."""
    root = parse(page)

    def by(rule: dict) -> list[str]:
        paths = {tuple(p) for p in rule["paths"]}
        out: list[str] = []
        stack: list[tuple[Node, tuple, bool]] = [(root, (), False)]
        while stack:
            node, path, inside = stack.pop()
            here = path if node.tag == "#root" else path + (key(node),)
            inside = inside or node.tag == "article"
            if here in paths:
                _collect(node, inside, False, out)
                continue
            stack.extend((c, here, inside) for c in reversed(node.children) if isinstance(c, Node) and not dropped(c, inside))
        return out

    texts = by(where) if where else []
    if not texts:
        texts = by(rules(wrap(root)))
    return "\n\n".join(texts)


# Distribution ---------------------------------------------------------------

WRAPPER = "host string, n_pages long, wrapper string"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    host, n, wrapper = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(n, pa.int64()), pa.array(wrapper, pa.string())],
                                      [c.split()[0] for c in WRAPPER.split(", ")])


def _infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[int, list]] = {}
    for batch in batches:
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            w = wrap(parse(page or ""))
            n, had = held.get(host, (0, None))
            held[host] = (n + 1, merge(had, w) if had else w)
            if len(held) > 5_000:
                yield _batch([(h, n, json.dumps(w)) for h, (n, w) in held.items()])
                held.clear()
    if held:
        yield _batch([(h, n, json.dumps(w)) for h, (n, w) in held.items()])


def _combine(final: bool):
    """Merge wrappers of one host that follow one another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, n, w, seen = None, 0, None, False
        out: list[tuple] = []

        def close() -> None:
            out.append((host, n, json.dumps(rules(w) if final else w)))

        for batch in batches:
            for h, k, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if seen and h == host:
                    n, w = n + k, merge(w, json.loads(raw))
                else:
                    if seen:
                        close()
                    host, n, w, seen = h, k, json.loads(raw), True
            if len(out) > 1_000:
                yield _batch(out)
                out.clear()
        if seen:
            close()
        if out:
            yield _batch(out)

    return run


def host_rules(pages: DataFrame) -> DataFrame:
    """``(host, n_pages, wrapper)`` with each host's rules as JSON."""
    each = pages.select("host", "html").transform(batches, _infer, WRAPPER)
    salted = each.withColumn("_salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS))).repartition("host", "_salt")
    some = salted.sortWithinPartitions("host", "_salt").drop("_salt").transform(batches, _combine(False), WRAPPER)
    return some.repartition("host").sortWithinPartitions("host", "wrapper").transform(batches, _combine(True), WRAPPER)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row per page."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    p = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("host"))
    found = cut(host_rules(p)).select("host", F.col("wrapper").alias("rules"))
    size = found.agg(F.sum(F.length("rules") + F.length("host"))).first()[0] or 0
    # the number of hosts grows with the corpus: broadcast only when measured small
    joined = p.join(F.broadcast(found) if size <= BROADCAST_BYTES else found, "host", "left")
    kinds = f"page_id {joined.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict] = {}
        for batch in batches:
            texts = []
            for page, rule in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if rule is not None and rule not in known:
                    if len(known) > 10_000:
                        known.clear()
                    known[rule] = json.loads(rule)
                texts.append(extract(page or "", known.get(rule)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return joined.select("page_id", "url", "html", "rules").transform(batches, run, kinds)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
