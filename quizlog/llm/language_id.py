"""Language identification by word-first backoff (operator 3).

Learning counts every word of the training texts per language.  A text's
score for a language is the sum over its words: a known word (one that the
training texts hold) adds its log frequency in that language; an unseen word
falls back to its character 4-grams, and where none of them was ever seen to
3-grams, 2-grams and single characters.  N-gram counts come from all
training words, word ends included, in a distributed table with a row for
each n-gram (keyed by a 64-bit hash, as words are).  Its ``HOT_NGRAMS`` most
frequent rows are looked up in the scan of the unseen words; the other
n-grams of these words are joined with the rest of the table.  Overlapping
n-grams of length n each count 1/n.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z in
lower case; words without a letter add nothing.

Defined results: a null text, or one without a letter, is ``und`` with score
0; so is every text if nothing could be learned.  Otherwise the score is the
best language's share of the likelihoods; ties go to the first name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlog.llm import bytetext as B
from quizlog.llm import wordstats
from quizlog.llm.shared import batches, crc_mod, store, table
from quizlog.operators.keyed import checked_broadcast

ORDERS = (4, 3, 2, 1)
HOT_NGRAMS = 1 << 19  # frequent n-grams in the broadcast table, whatever the corpus
SMOOTH = 0.1
UNKNOWN = "und"
MIN_SCORE = 0.4


def word_ngrams(words: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length of ORDERS: (word index, key) of every n-gram of every
    word with a mark at both ends."""
    texts = ["\x02" + (x or "") + "\x03" for x in words.to_pylist()]
    chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(B.U64)
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), lens)
    mark = (chars == 2) | (chars == 3)
    out = []
    for n in ORDERS:
        if chars.size < n:
            out.append((np.zeros(0, np.int64), np.zeros(0, np.int64)))
            continue
        m = chars.size - n + 1
        h = np.full(m, B.U64(n), B.U64)
        for k in range(n):
            h = B.mix(h + chars[k : k + m] * B.U64(0x9E3779B97F4A7C15))
        ok = owner[:m] == owner[n - 1 :]
        if n == 1:
            ok &= ~mark
        at = np.flatnonzero(ok)
        out.append((owner[at], h[at].view(np.int64)))
    return out


def has_letter(words: pa.Array) -> np.ndarray:
    return np.fromiter((any(map(str.isalpha, x or "")) for x in words.to_pylist()), bool, len(words))


def ngram_table(known: DataFrame, n_langs: int) -> DataFrame:
    """``(h, o, c0 .. c{L-1}, n)``: how often each n-gram of length
    ``ORDERS[o]`` stands in the training texts of each language, and in all."""
    cols = [f"c{k}" for k in range(n_langs)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(has_letter(batch.column(0))))
            counts = [np.asarray(batch.column(1 + k)) for k in range(n_langs)]
            for o, (owner, key) in enumerate(word_ngrams(batch.column(0))):
                if not key.size:
                    continue
                uniq, inverse = np.unique(key, return_inverse=True)
                total = [np.bincount(inverse, c[owner], uniq.size).astype(np.int64) for c in counts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uniq), pa.array(np.full(uniq.size, o, np.int32)), *map(pa.array, total)], ["h", "o", *cols])

    each = known.select("word", *cols).transform(batches, run, "h long, o int, " + ", ".join(f"{c} long" for c in cols))
    whole = each.groupBy("h", "o").agg(*[F.sum(c).alias(c) for c in cols])
    return whole.withColumn("n", sum((F.col(c) for c in cols), F.lit(0)))


def backoff(unseen: DataFrame, ngrams: DataFrame, n_langs: int, hot_ngrams: int = HOT_NGRAMS) -> DataFrame:
    """``(h, v0 .. v{L-1})`` of the words of ``unseen(h, word)`` that hold an
    n-gram of ``ngrams``: the sum over those of the greatest length seen."""
    cols = [f"c{k}" for k in range(n_langs)]
    vals = [f"v{k}" for k in range(n_langs)]
    # one row per length
    sizes = {r["o"]: r for r in ngrams.groupBy("o").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in cols]).collect()}

    def log(k: int) -> Column:
        out = F.lit(0.0)
        for o, r in sizes.items():
            room = float(r[f"c{k}"] + SMOOTH * r["n"] + 1)
            out = F.when(F.col("o") == o, F.log((F.col(f"c{k}") + SMOOTH) / room) / ORDERS[o]).otherwise(out)
        return out

    logs = ngrams.select("h", "n", *[log(k).alias(f"v{k}") for k in range(n_langs)])
    hot, least = wordstats._hot(logs, hot_ngrams)
    got = hot.select("h", *vals).toArrow().sort_by("h").combine_chunks()
    hot_keys = got.column("h").to_numpy()
    hot_vals = np.stack([got.column(c).to_numpy() for c in vals], 1)
    whole = hot_keys.size == sum(r["n"] for r in sizes.values())
    shared = unseen.sparkSession.sparkContext.broadcast((hot_keys, hot_vals))  # hot_ngrams rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = shared.value
        for batch in batches:
            batch = batch.filter(pa.array(has_letter(batch.column(1))))
            word = np.asarray(batch.column(0))
            m = word.size
            left = np.ones(m, bool)  # words that met no longer n-gram
            for o, (owner, key) in enumerate(word_ngrams(batch.column(1))):
                on = left[owner]
                owner, key = owner[on], key[on]
                at = np.searchsorted(keys, key)
                at[at == keys.size] = 0
                hit = keys[at] == key if keys.size else np.zeros(key.size, bool)
                hits = np.bincount(owner[hit], minlength=m)
                sums = [np.bincount(owner[hit], values[at[hit], k], m) for k in range(n_langs)]
                some = np.flatnonzero(hits)
                if some.size:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(word[some]), pa.array(np.full(some.size, o, np.int32)), pa.nulls(some.size, pa.int64()),
                         pa.array(hits[some].astype(np.int64)), *[pa.array(x[some]) for x in sums]], names)
                if not whole and not hit.all():
                    owner, key = owner[~hit], key[~hit]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(word[owner]), pa.array(np.full(owner.size, o, np.int32)), pa.array(key),
                         pa.array(np.zeros(owner.size, np.int64)), *[pa.array(np.zeros(owner.size)) for _ in vals]], names)
                left &= hits == 0

    names = ["word_h", "o", "h", "hits", *vals]
    rows = unseen.select("h", "word").transform(
        batches, run, "word_h long, o int, h long, hits long, " + ", ".join(f"{v} double" for v in vals))
    if not whole:
        rest = logs.where(F.col("n") < least).select("h", F.lit(1).alias("met"), *[F.col(v).alias(f"r{v}") for v in vals])
        here = rows.where(F.col("h").isNull())
        met = rows.where(F.col("h").isNotNull()).join(rest, "h").select(
            "word_h", "o", "h", F.lit(1).cast("long").alias("hits"), *[F.col(f"r{v}").alias(v) for v in vals])
        rows = here.select(*names).unionByName(met)
    each = rows.groupBy("word_h", "o").agg(*[F.sum(v).alias(v) for v in vals])
    return each.groupBy(F.col("word_h").alias("h")).agg(F.min_by(F.struct(*vals), "o").alias("v")).select("h", "v.*")


def word_scores(words: DataFrame, n_langs: int, hot_ngrams: int = HOT_NGRAMS) -> DataFrame:
    """``(h, n, v0 .. v{L-1}, v{L})`` of a word table whose groups 0..L-1 are
    the languages' training texts and L everything else: the log frequency
    of a known word or the backoff of an unseen one per language, and 1 for
    a word with a letter."""
    cols = [f"c{k}" for k in range(n_langs)]
    seen = sum((F.col(c) for c in cols), F.lit(0))
    known = words.where(seen > 0)
    tot = known.agg(F.count("*").alias("v"), *[F.sum(c).alias(c) for c in cols]).first()
    totals, vocab = np.array([tot[c] or 0 for c in cols], float), float(tot["v"])
    unseen = backoff(words.where(seen == 0), store(ngram_table(known, n_langs)), n_langs, hot_ngrams)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = np.stack([np.asarray(batch.column(3 + k)) for k in range(n_langs)], 1).astype(float)
            value = np.log((c + SMOOTH) / (totals + SMOOTH * vocab))
            open_ = c.sum(axis=1) == 0
            letters = has_letter(batch.column(1))
            value[~letters | open_] = 0
            value[open_] += np.stack([np.asarray(batch.column(3 + n_langs + k)) for k in range(n_langs)], 1)[open_]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *[pa.array(value[:, k]) for k in range(n_langs)], pa.array(letters.astype(float))],
                ["h", "n", *[f"v{k}" for k in range(n_langs + 1)]])

    n_all = seen + F.col(f"c{n_langs}")
    joined = words.select("h", "word", n_all.alias("n"), *cols).join(unseen, "h", "left")
    vals = [F.coalesce(f"v{k}", F.lit(0.0)).alias(f"b{k}") for k in range(n_langs)]
    return joined.select("h", "word", "n", *cols, *vals).transform(
        batches, run, "h long, n long, " + ", ".join(f"v{k} double" for k in range(n_langs + 1)))


def identify(docs: DataFrame, train: Column, passing: list[str] | None = None, lang_col: str = "lang") -> DataFrame:
    """``passing`` columns, ``lang_pred`` and ``score`` of every row of
    ``docs``; learns from the rows where ``train`` holds and the language is
    known.  Only ``text`` is an input of a prediction."""
    passing = passing or ["doc_id"]
    taught = F.coalesce(train, F.lit(False)) & F.col(lang_col).isNotNull() & F.col("text").isNotNull()
    langs = sorted(r[0] for r in docs.where(taught).select(F.col(lang_col)).distinct().collect())
    if not langs:
        return docs.select(*passing, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    n = len(langs)
    group = F.lit(n)
    for k, name in enumerate(langs):
        group = F.when(taught & (F.col(lang_col) == name), k).otherwise(group)
    words = store(wordstats.word_table(docs, group, n + 1, B.ALNUM_WORDS))
    vectors = store(word_scores(words, n))
    sums = wordstats.word_sums(docs, passing, vectors, n + 1, B.ALNUM_WORDS)
    best = F.greatest(*[F.col(f"s{k}") for k in range(n)]) if n > 1 else F.col("s0")
    pred = F.lit(langs[-1])
    for k in range(n - 2, -1, -1):
        pred = F.when(F.col(f"s{k}") >= best, langs[k]).otherwise(pred)
    share = 1 / sum((F.exp(F.col(f"s{k}") - best) for k in range(n)), F.lit(0.0))
    letters = F.col(f"s{n}") > 0
    return sums.select(*passing, F.when(letters, pred).otherwise(UNKNOWN).alias("lang_pred"),
                       F.when(letters, share).otherwise(0.0).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", (crc_mod("doc_id", 4) == 2).alias("held_out"))
    return identify(docs, ~F.col("held_out"), ["doc_id", "held_out"])


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised with at least ``MIN_SCORE``
    stay.  Learns from all documents with a known language, as in the query."""
    text_key = F.xxhash64(F.coalesce("text", F.lit("")))
    held = docs.select("doc_id", "text", "lang", (crc_mod("doc_id", 4) == 2).alias("held_out"), text_key.alias("text_key"))
    found = identify(held, ~F.col("held_out"), ["doc_id", "text_key"])
    rejected = found.where((F.col("lang_pred") == UNKNOWN) | (F.col("score") < MIN_SCORE))
    # joined by broadcast while the list is measured small, else by shuffle
    drop = checked_broadcast(rejected.select(F.col("doc_id").alias("__q_drop"), F.col("text_key").alias("__q_key")).distinct())
    return docs.join(drop, F.col("doc_id").eqNullSafe(F.col("__q_drop")) & (text_key == F.col("__q_key")), "left_anti")
