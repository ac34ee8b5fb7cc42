import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import brute
import pytest
from quizlog.llm import url_filter as U

SCHEMA = "page_id long, url string, html string"


def urls(n=160, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        host = r.choice(["", "www.", "m.", "blog."]) + r.choice(["example.com", "site.net", "place.org", "Example.COM", "a.example.net"])
        out.append(f"http{r.choice(['', 's'])}://{host}/{r.choice(['en', 'es', 'fr', 'de'])}/{r.choice(['buy-pills', 'garden', 'win-cash', 'river'])}{i % 7}")
    return out


ODD = [None, "", "no scheme", "http://", "http://com", "http://com/", "://x.com/en", "ftp://WWW.example.com/en/a?b=://c", "x://net/es/#://",
       "http://notcom/", "http://a.b.www.example.com/en/", "http://example.com?/en/", "http://é😀.com/ü", "a://b://c.com/", "http://x.net/" + "ab" * 20_000,
       "http://x.com/\x02\x03", "http://y.com/line\nbreak?q"]


def want(rows, order):
    def parse(u):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u)
        return (brute.lower(m[1]), m[2]) if m else ("", "")

    def rule(h, p):
        fit = [(len(rh + rp), rh + rp, v) for v, rh, rp in U.RULES if (h == rh or h.endswith("." + rh)) and p.startswith(rp)]
        return max(fit)[1:] if fit else (None, None)

    d = []
    for i, u in rows:
        u = u or ""
        h, p = parse(u)
        d.append((i, u, h, p, *rule(h, p), hashlib.md5(u.encode()).hexdigest()[0] in U.KEPT_OUT))

    def grams(u):
        t = U.START * order + brute.lower(u) + U.END
        return [t[k : k + order + 1] for k in range(len(t) - order)]

    alphabet = len({g[-1] for x in d for g in grams(x[1])}) + 1
    model = {}
    for v in ("allow", "block"):
        n, after = Counter(), defaultdict(Counter)
        for x in d:
            if x[5] == v and not x[6]:
                for g in grams(x[1]):
                    for k in range(order + 1):
                        after[g[order - k : -1], k][g[-1]] += 1
        model[v] = after

    def prob(v, g):
        p = 1.0 / alphabet
        for k in range(order + 1):
            c = model[v][g[order - k : -1], k]
            if c:
                p = (c[g[-1]] + len(c) * p) / (sum(c.values()) + len(c))
        return p

    cache = {}

    def value(g):
        if g not in cache:
            cache[g] = math.floor((math.log(prob("allow", g)) - math.log(prob("block", g))) * 1e6 + 0.5)
        return cache[g]

    sums = [(sum(map(value, grams(x[1]))), len(grams(x[1]))) for x in d]
    held = Counter()
    for x, (s, n) in zip(d, sums):
        if x[6] and x[5]:
            held[math.floor(s / (n * 1000.0)), x[5]] += 1
    steps = sorted({k for k, _ in held})
    na, nr = (sum(c for (k, v), c in held.items() if v == w) for w in ("allow", "block"))
    cut = 0
    if na and nr:
        def errors(t):
            return (sum(c for (k, v), c in held.items() if v == "allow" and k < t) * nr
                    + sum(c for (k, v), c in held.items() if v == "block" and k >= t) * na)
        cut = min(range(min(steps[0], 0), max(steps[-1] + 1, 0) + 1), key=lambda t: (errors(t), abs(t), t))
    return sorted([(x[0], x[2], x[3], x[4], x[5] or ("allow" if math.floor(s / (n * 1000.0)) >= cut else "block"), round(s / n / 1e6, 9))
                   for x, (s, n) in zip(d, sums)], key=str)


def got(df):
    return sorted([(*r[:5], round(r[5], 9)) for r in map(tuple, df.collect())], key=str)


@pytest.fixture(scope="module")
def rows():
    return [(k, u) for k, u in enumerate(urls())] + [(1000 + k, u) for k, u in enumerate(ODD)] + [(3, urls()[3]), (None, urls()[5])]


@pytest.mark.parametrize("order, hot", [(4, 1 << 16), (4, 20), (2, 0)])
def test_against_brute_force(spark, rows, order, hot):
    df = spark.createDataFrame([(i, u, "") for i, u in rows], SCHEMA).repartition(3)
    out = got(U.judge(df, order=order, hot_grams=hot))
    assert out == want(rows, order)
    assert {r[4] for r in out if r[3] is None} == {"allow", "block"}


def test_learned_classes_carry_over(spark):
    """URLs without a rule are judged by their words."""
    r = random.Random(2)
    rows = []
    for i in range(400):
        good = i % 2 == 0
        word = r.choice(["garden", "river", "library"] if good else ["cheap-pills", "casino-win", "free-cash"])
        rows.append((i, f"http://host{i % 9}.{'com' if good else 'net'}/{'en' if good else 'es'}/{word}/{i}", ""))
    probe = [(1000, "http://other.org/x/library/5", ""), (1001, "http://other.org/x/casino-win/5", "")]
    out = {x[0]: x[4] for x in got(U.judge(spark.createDataFrame(rows + probe, SCHEMA)))}
    assert out[1000] == "allow" and out[1001] == "block"


def test_without_a_class_clashing_and_empty(spark, rows):
    plain = spark.createDataFrame([(i, u, "") for i, u in rows], SCHEMA)
    extra = plain
    for c in ("uid", "g", "v", "host", "rule", "by_rule", "kept_out", "n", "size"):
        extra = extra.selectExpr("*", f"7 AS {c}")
    assert got(U.judge(extra)) == got(U.judge(plain))
    assert U.judge(plain.limit(0)).count() == 0
    alone = U.judge(spark.createDataFrame([(1, "http://a.org/x", ""), (2, None, "")], SCHEMA)).collect()
    assert {(r["verdict"], r["score"]) for r in alone} == {("allow", 0.0)}


def test_no_python_in_the_plan(spark, sf_dir, rows, tmp_path):
    spark.createDataFrame([(i, u, "") for i, u in rows], SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    d = U.query(spark, str(tmp_path))
    plan = d._jdf.queryExecution().executedPlan().toString()
    counts = U.gram_counts(spark.createDataFrame([("u", "allow", False)], "url string, by_rule string, kept_out boolean"))
    plan += U.gram_values(counts)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"):
        assert word not in plan
