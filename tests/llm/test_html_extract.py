import random

import pytest

from quizlog.llm import html_extract as H
from quizlog.llm.html_page import parse


def page(r, host, i, layout):
    paras = [" ".join(r.choice("stone river & garden < lamp über wind".split()) + str(r.randrange(99)) for _ in range(r.randint(5, 25))) for _ in range(r.randint(1, 6))]
    esc = lambda s: s.replace("&", "&amp;").replace("<", "&lt;")
    body = "".join(f"<p>{esc(p)}</p>" if k % 2 else f"<p>{esc(p)}<br>" for k, p in enumerate(paras))
    title = f"Title {i} of {host}"
    menu = "<nav><ul>" + "".join(f'<li><a href="/{k}">item {k}</a></li>' for k in range(r.randint(2, 6))) + "</ul></nav>"
    extra = '<div class="ad-box">buy now</div>' if i % 3 else ""
    if layout == "article":
        main = f"<article><h1>{title}</h1>{body}{extra}</article>"
    elif layout == "main":
        main = f"<main><h1>{title}</h1><div class='story'>{body}</div></main>"
    else:
        main = f"<div id='content'><h1>{title}</h1>{extra}{body}</div>"
    html = (f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{a:b}}</style><script>var x='</p>';</script></head><body class='has-sidebar'>"
            f"<header><h2>{host}</h2></header>{menu}<!-- c -->{main}<form><p>mail me</p></form><aside><p>side {i}</p></aside>"
            f"<section id='comments'><p>great post {i}</p></section><footer>&copy; {host} {i}</footer></body></html>")
    return html, "\n\n".join([title, *paras])


@pytest.fixture(scope="module")
def site():
    r = random.Random(8)
    rows, want = [], {}
    for i in range(150):
        layout = ["article", "main", "div"][i % 3]
        host = {"article": "big.example", "main": f"m{i % 9}.example", "div": f"d{i % 6}.example"}[layout]
        html, text = page(r, host, i, layout)
        rows.append((i, f"https://{host}/p{i}?q=1" if i % 5 else f"HTTP://user@{host.upper()}:80/x", html))
        want[i] = text
    rows += [(900, None, None), (901, "", ""), (902, "no url", "plain &amp; simple"), (903, "http://big.example/", rows[0][2]), (903, "http://big.example/", rows[0][2]),
             (None, "http://x.example", "<p>a<p>b"), (904, "http://y.example", "<div>" * 3000 + "deep"), (905, "http://z.example", "<p>" + "long text " * 50000),
             (906, "http://big.example/", "<<<p <!-- <script> x")]
    want |= {900: "", 901: "", 902: "plain & simple", 903: want[0], None: "a\n\nb", 904: "deep", 905: ("long text " * 50000).strip()}
    return rows, want


def test_main_text_of_three_layouts(spark, site):
    from pyspark.sql import functions as F

    rows, want = site
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    for table in (pages, pages.withColumn("host", F.lit(1)).withColumn("rules", F.lit("x")).withColumn("text", F.lit("y"))):
        got = H.extract_pages(table).collect()
        assert len(got) == len(rows)
        for r in got:
            if r["page_id"] in want:
                assert r["text"] == want[r["page_id"]], r["page_id"]
            assert r["n_chars"] == len(r["text"])
    assert sum(r["page_id"] == 903 for r in got) == 2


def test_empty(spark):
    assert H.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_wrapper_has_slots_optionals_and_repeats():
    a = H.wrap(parse("<div><h1>one</h1><p>x<p>y<ul><li>1<li>2</ul><p>same</div>"))
    b = H.wrap(parse("<div><h1>two</h1><p>z<h3>extra</h3><ul><li>3</ul><p>same</div>"))
    w = H.merge(a, b)[3][0]
    kinds = [(x[0], x[1], x[2]) for x in w[3]]
    assert kinds == [("h1", 0, 0), ("p", 0, 1), ("h3", 1, 0), ("ul", 0, 0), ("p", 0, 0)]
    assert w[3][0][3][0][3] is None and w[3][4][3][0][3] == "same"  # a slot and a constant
    again = H.wrap(parse("<div>" + "<h2>a</h2><p>b</p>" * 5 + "</div>"))[3][0]
    assert [x[0] for x in again[3]] == ["()"] and again[3][0][2] == 1


def test_wrapper_size_follows_the_template():
    long = H.wrap(parse("<div>" + "<p>text</p>" * 5000 + "</div>"))
    assert len(str(long)) < 500


def merged(pages):
    w = None
    for p in pages:
        x = H.wrap(parse(p))
        w = H.merge(w, x) if w else x
    return w


def test_article_text_does_not_depend_on_the_number_of_pages():
    """A line that stands on every page is content inside an article, and so
    is a block that quotes it."""
    pages = [f'<body><div class="notice">We value your privacy</div><article><h1>T{i}</h1><p class="lead">Staff reporter, Lisbon.</p>'
             f'<div><p>Body {i}</p><blockquote>Staff reporter, Lisbon.</blockquote></div></article></body>' for i in range(40)]
    want = "T3\n\nStaff reporter, Lisbon.\n\nBody 3\n\nStaff reporter, Lisbon."
    for n in (4, 19, 20, 40):
        assert H.extract(pages[3], H.rules(merged(pages[:n]))) == want


def test_long_irregular_pages_keep_a_small_wrapper():
    """Blocks in no order: the wrapper stops growing and alignment ends."""
    import time

    r = random.Random(3)
    tags = [f"{t} class='{c}'" for t in ("p", "div", "h3", "ul", "pre", "table") for c in ("a", "b", "c")]

    def page(n):
        return "<article><h1>t</h1>" + "".join(f"<{t}>{r.random()}</{t.split()[0]}>" for t in (r.choice(tags) for _ in range(n))) + "</article>"

    pages = [page(400) for _ in range(30)] + [page(20_000) for _ in range(2)]
    at = time.monotonic()
    few, many = len(str(merged(pages[:5]))), len(str(merged(pages)))
    assert many < 1.5 * few and many < 20_000
    assert time.monotonic() - at < 60
    assert H.extract(pages[0], H.rules(merged(pages))).count("\n\n") == 400


def test_pairs_are_a_common_subsequence():
    r = random.Random(9)
    for n, alphabet in ((8, 3), (30, 5), (300, 4), (300, 2000), (400, 60)):
        for _ in range(6):
            a, b = ([str(r.randrange(alphabet)) for _ in range(r.randint(0, n))] for _ in range(2))
            got = H._pairs(a, b)
            assert all(a[i] == b[j] for i, j in got)
            assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))
            if len(a) * len(b) <= 900:
                best = [0] * (len(b) + 1)
                for x in a:
                    row = [0]
                    for j, y in enumerate(b):
                        row.append(best[j] + 1 if x == y else max(best[j + 1], row[j]))
                    best = row
                assert len(got) == best[-1]
