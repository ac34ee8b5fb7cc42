"""URL filter by a ratio of character language models (operator 11, native).

Everything is DataFrame expressions; no Python runs on the executors.

Rules decide first: a rule (verdict, host, path) fits its host and every
subdomain of it, if the URL's path starts with the rule's; of several the
longest (host and path together) wins, then the earlier in the list.

The URLs that a rule accepts or rejects teach two Markov models over the
characters of the whole URL, with an end mark.  Contexts have variable
order, from ``ORDER`` characters down to none: a context counts as far as it
was seen, and each order is smoothed with the next shorter one by
Witten-Bell weights,

    p_k(c | h) = (n(hc) + t(h) p_{k-1}(c | h')) / (n(h) + t(h)),

t(h) the number of different characters seen after h, down to a uniform
share of the corpus' alphabet.  A URL's score is the difference of the two
log-likelihoods per character.  The threshold is calibrated on URLs that the
models have not seen: by a digest of the URL 3/16 of them are kept out, and
the cut (in steps of 1/1000) with the least sum of the two error rates on
them is taken, of equal ones that next to zero.  Where a class has none kept
out, the cut is zero.

Scale: what a character adds depends on its last ``ORDER`` characters only,
so each distinct (ORDER + 1)-gram is counted and given its value once: all
shorter contexts are sums over that table.  Texts are never joined.  Grams
that are more than 1/``HOT_GRAMS`` of all (at most that many, by counting)
are looked up in a broadcast table; the others are aggregated per URL and
joined, so no join key has more than that share of the rows.  Values are
whole millionths, so sums do not depend on their order.

Defined results: a null URL is empty; a URL without ``://`` has empty host
and path and fits no rule; every row is judged by itself, repeated ones alike; very
long URLs are cut nowhere; without a learned class both models are alike,
scores are 0 and the method's verdict is allow; an empty table has no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlog.llm.shared import cut, store, table

# Fixed values of the contract: verdict, host, path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

ORDER = 4
HOT_GRAMS = 1 << 16
KEPT_OUT = "012"  # first hex digits of the digest of a URL kept out of training
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
START, END = "\x02", "\x03"
UNIT = 1_000_000  # score values are whole millionths
STEPS = 1_000  # cuts are whole thousandths

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def parse(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL."""
    url = F.coalesce(url, F.lit(""))
    return _lower(F.regexp_extract(url, PARTS, 1)), F.regexp_extract(url, PARTS, 2)


def by_length(rules: list[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    return sorted(rules, key=lambda r: -len(r[1] + r[2]))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in reversed(by_length(rules)):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def _grams(order: int) -> Column:
    """The (order + 1)-grams of the column ``_c`` of characters."""
    padded = F.col("_c")
    return F.transform(F.sequence(F.lit(1), F.size(padded) - order), lambda i: F.array_join(F.slice(padded, i, order + 1), ""))


def _exploded(d: DataFrame, order: int, keep: list[str]) -> DataFrame:
    """One row per character: ``keep`` and its gram ``g``."""
    chars = F.filter(F.split(_lower(F.col("url")), ""), lambda c: c != "")
    padded = F.concat(F.array(*[F.lit(START)] * order), chars, F.array(F.lit(END)))
    return d.select(*keep, padded.alias("_c")).select(*keep, F.explode(_grams(order)).alias("g"))


def gram_counts(d: DataFrame, order: int = ORDER) -> DataFrame:
    """``g, n, a, r``: how often each gram stands in all URLs, and in the
    accepted and rejected ones that the models learn from."""
    learn = ~F.col("kept_out")
    one = lambda v: F.coalesce((learn & (F.col("by_rule") == v)).cast("long"), F.lit(0))
    marked = d.select("url", one("allow").alias("a1"), one("block").alias("r1"))
    return _exploded(marked, order, ["a1", "r1"]).groupBy("g").agg(
        F.count("*").alias("n"), F.sum("a1").alias("a"), F.sum("r1").alias("r"))


def gram_values(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """``g, n, v``: log of the accepted model's probability of the gram's last
    character over the rejected model's, in whole millionths."""
    first = counts.groupBy(F.substring("g", order + 1, 1).alias("s")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    alphabet = first.count() + 1
    prob = None
    for k in range(order + 1):
        grams = counts.groupBy(F.substring("g", order - k + 1, k + 1).alias("s")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        grams = grams.withColumn("h", F.substring("s", 1, k))
        seen = grams.groupBy("h").agg(
            F.sum("a").alias("na"), F.sum("r").alias("nr"),
            F.count_if(F.col("a") > 0).alias("ta"), F.count_if(F.col("r") > 0).alias("tr"))
        j = grams.join(seen, "h")
        if prob is None:
            j = j.withColumns({"pa": F.lit(1.0) / alphabet, "pr": F.lit(1.0) / alphabet})
        else:
            j = j.withColumn("tail", F.substring("s", 2, k)).join(prob.withColumnRenamed("s", "tail"), "tail")
        p = lambda x: F.when(F.col(f"n{x}") > 0, (F.col(x) + F.col(f"t{x}") * F.col(f"p{x}")) / (F.col(f"n{x}") + F.col(f"t{x}"))).otherwise(F.col(f"p{x}"))
        prob = j.select("s", p("a").alias("pa"), p("r").alias("pr"))
    value = F.floor((F.log("pa") - F.log("pr")) * UNIT + 0.5)
    return counts.join(prob.select(F.col("s").alias("g"), value.alias("v")), "g").select("g", "n", "v")


def cut_of(held: list[tuple[int, int, int]]) -> int:
    """The cut from ``(step, accepted, rejected)`` counts of URLs kept out."""
    held = sorted(held)
    accepted, rejected = sum(x[1] for x in held), sum(x[2] for x in held)
    if not accepted or not rejected:
        return 0
    best, lost, passed, low = None, 0, rejected, None
    for step, a, r in [*held, (None, 0, 0)]:
        # all cuts above ``low`` up to ``step`` decide alike: the one next to zero
        t = 0 if low is None or low < 0 else low + 1
        t = t if step is None else min(t, step)
        key = (lost * rejected + passed * accepted, abs(t), t)  # error rates, without their denominators
        best = key if best is None else min(best, key)
        lost, passed, low = lost + a, passed - r, step
    return best[2]


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None, order: int = ORDER, hot_grams: int = HOT_GRAMS,
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every row."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    host, path = parse(F.col("url"))
    name, verdict = rule_of(F.col("host"), F.col("path"), RULES if rules is None else rules)
    d = pages.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("page_id"), url.alias("url"))
    d = d.withColumns({"host": host, "path": path}).withColumns({
        "rule": name, "by_rule": verdict, "kept_out": F.substring(F.md5("url"), 1, 1).isin(*KEPT_OUT)})
    d = store(d)  # the row numbers are read twice
    values = cut(gram_values(cut(gram_counts(d, order)), order))
    total = values.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    is_hot = F.col("n") * hot_grams > F.lit(total)
    hot = F.broadcast(values.where(is_hot).select("g", "v"))  # at most hot_grams rows: each has more than that share
    grams = _exploded(d, order, ["uid"]).join(hot, "g", "left")
    known = grams.groupBy("uid").agg(F.coalesce(F.sum("v"), F.lit(0)).alias("v"), F.count("*").alias("size"))
    other = grams.where(F.col("v").isNull()).groupBy("uid", "g").agg(F.count("*").alias("k"))
    other = other.join(values.where(~is_hot).select("g", "v"), "g").groupBy("uid").agg(F.sum(F.col("k") * F.col("v")).alias("more"))
    sums = known.join(other, "uid", "left").select("uid", "size", (F.col("v") + F.coalesce("more", F.lit(0))).alias("v"))
    step = F.floor(F.col("v") / (F.col("size") * F.lit(UNIT / STEPS)))
    scored = cut(d.drop("url").join(sums, "uid").withColumn("step", step))
    held = scored.where("kept_out AND by_rule IS NOT NULL").groupBy("step").agg(
        F.count_if(F.col("by_rule") == "allow").alias("a"), F.count_if(F.col("by_rule") == "block").alias("r"))
    least = cut_of([tuple(x) for x in held.collect()])  # at most some ten thousand steps: logs of ratios of counts
    by_model = F.when(F.col("step") >= least, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_model).alias("verdict"),
                         (F.col("v") / F.col("size") / UNIT).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
