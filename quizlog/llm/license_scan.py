"""License scans by an exact set-similarity join (operator 6, native).

Everything is DataFrame expressions; no Python runs on the executors.

Base labels come from fixed phrases found as consecutive words.  The
method's labels come from joining text blocks (lines) with license
templates: a block gets a template's label when it holds at least
``CONTAINMENT`` of the template's distinct words.  The join is exact:

* the templates' words are ordered by how often they stand in the corpus,
  rarest first (one scan; words of no template cannot add to an overlap);
* prefix filter: a template of n words that needs k of them must share one
  of its n - k + 1 rarest words with the block;
* length filter: a block with fewer than k template words cannot qualify;
* positional filter: after the first shared word, what is left on either
  side bounds the overlap;
* the pairs left are verified by intersecting the word sets.

The templates are a parameter; their words are broadcast, and their number
does not grow with the data.

Defined results: a null or empty text has no words, labels ``''`` and score
0.  Score is 1 with a base phrase, else the largest containment of the
templates found, else 0.  Repeated rows each get a row.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlog.llm.shared import table

CONTAINMENT = 0.9

# Fixed values of the contract: base phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Default templates: (label, text).  Notices shorter than ten words must
#: stand whole; longer ones may lack a tenth of their words.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license"),
    ("cc-by", "creative commons attribution 4 0 international license"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-3", "either version 3 of the license or at your option any later version gnu general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
]

_SEP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _phrase(words: str) -> str:
    """Pattern of consecutive words; (?i) without (?u) folds A-Z only."""
    return "(?:" + f"{_SEP}+".join(words.split()) + f")(?!{_WORD})"


def _base(text: Column) -> dict[str, Column]:
    """n_words, n_base, first_word, last_word and base label array."""
    start = f"(?<!{_WORD})"
    counts = {label: F.regexp_count(text, F.lit(f"(?i){start}{_phrase(words)}")) for words, label in PHRASES.items()}
    any_of = start + "(?:" + "|".join(_phrase(w) for w in PHRASES) + ")"
    words_in = lambda c: F.regexp_count(c, F.lit(f"{_WORD}+"))
    # every phrase holds "license" or "cc": a cheap first look
    lower = F.lower(text)
    may = F.contains(lower, F.lit("license")) | F.contains(lower, F.lit("cc"))
    n_base = F.when(may, sum(counts.values(), F.lit(0))).otherwise(0)
    return {
        "n_words": words_in(text).cast("long"),
        "n_base": n_base.cast("long"),
        "first_word": F.when(F.col("n_base") > 0, words_in(F.regexp_extract(text, f"(?is)^(.*?){any_of}", 1)).cast("long")),
        "last_word": F.when(F.col("n_base") > 0, words_in(F.regexp_extract(text, f"(?is)^(.*){any_of}", 1)).cast("long")),
        "base": F.when(F.col("n_base") > 0, F.filter(F.array(*[F.when(n > 0, label) for label, n in counts.items()]), lambda x: x.isNotNull()))
        .otherwise(F.array().cast("array<string>")),
    }


def word_order(docs: DataFrame, words: list[str], text_col: str = "text") -> list[str]:
    """``words`` by their frequency in the corpus, rarest first."""
    found = (
        docs.select(F.explode(F.split(F.lower(F.col(text_col)), f"{_SEP}+")).alias("w"))
        .where(F.col("w").isin(words)).groupBy("w").agg(F.count("*").alias("n")).collect()  # one row per template word
    )
    n = {r["w"]: r["n"] for r in found}
    return sorted(words, key=lambda w: (n.get(w, 0), w))


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] | None = None, containment: float = CONTAINMENT,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document; columns as in the module text."""
    templates = TEMPLATES if templates is None else templates
    spark = docs.sparkSession
    sets = [(label, set(text.split())) for label, text in templates]
    order = word_order(docs, sorted(set().union(*(s for _, s in sets))), text_col)
    rank = {w: i for i, w in enumerate(order)}
    rows, prefixes = [], set()
    for k, (label, words) in enumerate(sets):
        sorted_words = sorted(words, key=rank.get)
        need = ceil(containment * len(words) - 1e-9)
        for pt, w in enumerate(sorted_words[: len(words) - need + 1]):
            prefixes.add(w)
            rows.append(F.struct(
                F.lit(w).alias("w"), F.lit(k).alias("template"), F.lit(label).alias("label"), F.lit(need).alias("need"),
                F.lit(pt).alias("pt"), F.array(*[F.lit(x) for x in sorted_words]).alias("tt")))
    index = spark.range(1).select(F.inline(F.array(*rows)))
    prefix_lit = F.array(*[F.lit(w) for w in sorted(prefixes)])
    order_lit = F.array(*[F.lit(w) for w in order])

    text = F.coalesce(F.col("_text"), F.lit(""))
    d = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    base = _base(text)
    d = d.withColumns({k: base[k] for k in ("n_words", "n_base")}).withColumns({k: base[k] for k in ("first_word", "last_word", "base")})
    blocks = F.filter(F.split(text, "\n"), lambda b: F.arrays_overlap(F.split(F.lower(b), f"{_SEP}+"), prefix_lit))
    keep = ["uid", "doc_id", "n_words", "n_base", "first_word", "last_word", "base"]
    d = d.select(*keep, F.posexplode_outer(blocks).alias("block_no", "block"))
    held = F.array_intersect(order_lit, F.split(F.translate("block", _UPPER, _LOWER), f"{_SEP}+"))
    d = d.select(*keep, "block_no", held.alias("bt"))
    d = d.select(*keep, "block_no", "bt", F.posexplode_outer("bt").alias("pb", "w"))
    j = d.join(F.broadcast(index), "w", "left")
    first_shared = ~F.arrays_overlap(F.expr("slice(tt, 1, pt)"), F.col("bt")) | (F.col("pt") == 0)
    long_enough = F.size("bt") >= F.col("need")
    reach = F.least(F.size("tt") - F.col("pt"), F.size("bt") - F.col("pb")) >= F.col("need")
    overlap = F.size(F.array_intersect("tt", "bt"))
    hit = F.coalesce(first_shared & long_enough & reach & (overlap >= F.col("need")), F.lit(False))
    j = j.select(*keep, F.when(hit, F.col("label")).alias("label"), F.when(hit, overlap / F.size("tt")).alias("share"))
    whole = j.groupBy("uid").agg(*[F.first(c).alias(c) for c in keep[1:]], F.collect_set("label").alias("found"), F.max("share").alias("share"))
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return whole.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", joined(F.col("base")).alias("base_labels"),
        joined(F.concat("base", "found")).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
