"""Ranked lexical search by NRA (operator 12).

A document's score for a query is a sum over the query's terms of the term's
weight times its impact in the document, all in 64-bit integers (the formula
stands at ``weights`` and ``impacts``).  The search is NRA, the threshold
method without random access: every term has a list of documents sorted by
falling contribution, lists are only read onwards, and every document has an
interval.  Its lower end is the sum of the contributions read; its upper end
adds, for every list in which the document was not met, the contribution at
which that list's reading stands.  A query ends when

* no unread document can reach the k-th best lower end (a tie included), and
* every document whose upper end reaches it has lower end = upper end,

so membership, ties (by document id) and final scores are all settled.

Spark's part: one scan of the texts finds the queries' terms and writes
documents as (length, term numbers, term counts), a small share of the text;
corpus statistics are aggregates over that table; each task then takes its
documents in shards of about ``SHARD_POSTINGS`` postings, sorts the shard's
lists by impact and runs NRA for every query on them.  Shards are
disjoint, and weights and lengths use the corpus statistics, so the best k of
the corpus are among the shards' best k; they are merged in two rounds of
group limits (per query and salt, then per query), so no task sees more than
k rows of each other task.  Queries are a stated set, taken in blocks of about
``BLOCK_WORDS`` words: a larger set means more passes, not more memory.

Terms are matched by a 64-bit hash of their bytes.

Defined results: null and empty texts have no term and are not counted; a
repeated row is a document of its own; a null document id sorts after the
others of its score; every row of the query table is ranked by itself, with
null or equal ids too; a query without a scoring document has no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quizlog.llm import bytetext as B
from quizlog.llm.shared import batches, cut, store, table

TOP = 50
BLOCK_WORDS = 1 << 18
SHARD_POSTINGS = 4 << 20
SALTS = 256
#: Contributions that a round reads down to, as a share of the round before.
STEP = 0.5

POSTINGS = "doc_id long, n long, terms array<int>, tfs array<int>"
HITS = "query int, item_id long, doc_id long, score long"


# ---------------------------------------------------------------- the formula

def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2df + 1))) of each term."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def impacts(tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 20 m), m = 50 + (50 length N) div L."""
    m = 50 + (50 * length * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


# ---------------------------------------------------------------- NRA on one shard

def nra(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best documents and their scores, best first.

    ``lists``: per term the documents (numbers below ``n_docs``) and their
    contributions, positive and falling.  ``ids`` orders equal scores."""
    lists = [x for x in lists if x[0].size]
    lower = np.zeros(n_docs, np.int64)
    seen = np.zeros((len(lists), n_docs), bool)
    at = [0] * len(lists)
    level = max((int(c[0]) for _, c in lists), default=0)
    while True:
        edge = np.zeros(len(lists), np.int64)  # what the next read of each list gives
        for t, (docs, c) in enumerate(lists):
            to = at[t]
            if to < c.size and c[to] >= level:
                to += int(np.searchsorted(-c[to:], -level, side="right"))
                got = docs[at[t] : to]
                lower[got] += c[at[t] : to]  # a document stands once in a list
                seen[t, got] = True
                at[t] = to
            edge[t] = c[to] if to < c.size else 0
        rest = int(edge.sum())  # upper end of a document not met at all
        best = int(np.partition(lower, n_docs - k)[n_docs - k]) if n_docs > k else 0
        if rest < best or rest == 0:
            alive = np.flatnonzero((lower > 0) & (lower + rest >= best))
            open_ = edge > 0
            missing = edge[open_] @ ~seen[np.ix_(open_, alive)] if rest else np.zeros(alive.size, np.int64)
            alive, missing = alive[lower[alive] + missing >= best], missing[lower[alive] + missing >= best]
            if not missing.any():
                order = np.lexsort((ids[alive], -lower[alive]))[:k]
                return alive[order], lower[alive[order]]
        level = int(min(level * STEP, edge.max()))


class Shard:
    """Impact-sorted lists of some documents."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int):
        order = np.lexsort((-impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.first = np.searchsorted(term[order], np.arange(n_terms + 1))

    def lists(self, terms: np.ndarray, weight: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        out = []
        for t in terms.tolist():
            a, b = self.first[t], self.first[t + 1]
            if weight[t] > 0 and b > a:
                c = weight[t] * self.impact[a:b]
                scoring = int(np.searchsorted(-c, 0))  # contributions of 0 are at the end
                out.append((self.doc[a : a + scoring], c[:scoring]))
        return out


# ---------------------------------------------------------------- Spark

def _postings(docs: DataFrame, keys: np.ndarray) -> DataFrame:
    """``POSTINGS`` of every document with a term; ``terms`` are places in
    ``keys``, the sorted hashes of the queries' terms."""
    shared = docs.sparkSession.sparkContext.broadcast(keys)  # at most BLOCK_WORDS, or one item's words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = shared.value
        for batch in batches:
            for part in B.slices(batch, "text"):
                w = B.scan(part.column(1), B.ALNUM_WORDS)
                some = np.flatnonzero(w.counts)
                h = B.word_hashes(w)
                place = np.minimum(np.searchsorted(keys, h), max(keys.size - 1, 0))
                hit = np.flatnonzero(keys[place] == h) if keys.size else np.zeros(0, np.int64)
                pair = w.text_of_word()[hit] * np.int64(max(keys.size, 1)) + place[hit]
                pair, tf = np.unique(pair, return_counts=True)
                text, term = np.divmod(pair, np.int64(max(keys.size, 1)))
                off = np.searchsorted(text, np.append(some, len(w.counts))).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(off), pa.array(x.astype(np.int32))) for x in (term, tf)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(some)), pa.array(w.counts[some].astype(np.int64)), *lists],
                    ["doc_id", "n", "terms", "tfs"])

    return docs.transform(batches, run, POSTINGS)


def _search(postings: DataFrame, queries: list[np.ndarray], names: pa.Array, weight: np.ndarray, n_docs: int, n_terms: int,
            k: int, shard_postings: int) -> DataFrame:
    """The ``k`` best documents of every shard for every query (``HITS``)."""
    shared = postings.sparkSession.sparkContext.broadcast((queries, names, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, names, weight = shared.value

        def answers(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = pa.Table.from_batches(held).combine_chunks()
            ids, n = part.column("doc_id"), np.asarray(part.column("n"))
            terms, tfs = (part.column(c).combine_chunks() for c in ("terms", "tfs"))
            size = np.asarray(terms.value_lengths()).astype(np.int64)
            doc = np.repeat(np.arange(n.size), size)
            term, tf = np.asarray(terms.flatten()), np.asarray(tfs.flatten()).astype(np.int64)
            shard = Shard(doc, term, impacts(tf, n[doc], n_docs, n_terms), weight.size)
            order = np.empty(n.size, np.int64)  # place of each document by id, null ids last
            order[np.asarray(pa.compute.sort_indices(ids))] = np.arange(n.size)
            for q, of in enumerate(queries):
                best, score = nra(shard.lists(of, weight), n.size, k, order)
                if best.size:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(best.size, q, np.int32)), names.take(pa.array(np.full(best.size, q))),
                         ids.take(pa.array(best)).combine_chunks(), pa.array(score)], ["query", "item_id", "doc_id", "score"])

        held, size = [], 0
        for batch in batches:
            at = 0
            ends = np.cumsum(np.asarray(batch.column(2).value_lengths()).astype(np.int64))
            while at < batch.num_rows:
                done = int(ends[at - 1]) if at else 0
                to = max(int(np.searchsorted(ends, done + shard_postings - size, side="right")), at + (not held))
                held += [batch.slice(at, to - at)] if to > at else []
                size += (int(ends[to - 1]) if to else 0) - done
                if to < batch.num_rows:
                    yield from answers(held)
                    held, size = [], 0
                at = to
        if held:
            yield from answers(held)

    return postings.transform(batches, run, HITS)


def _best(hits: DataFrame, k: int, by: list[str]) -> DataFrame:
    """The ``k`` best rows of each group, with their rank."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", item_col: str = "item_id",
           block_words: int = BLOCK_WORDS, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each row
    of ``items``, both tables with a ``text`` column."""
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), "text")
    words = F.size(F.split(F.coalesce("text", F.lit("")), r"\s+"))
    items = cut(items.select(F.col(item_col).cast("long").alias("item_id"), "text").withColumn("_w", words))
    n_blocks = max(1, -(-int(items.agg(F.sum("_w")).first()[0] or 0) // block_words))
    items = items.withColumn("_block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)))
    out = []
    for b in range(n_blocks):
        block = items.where(F.col("_block") == b).select("item_id", "text").toArrow()  # about block_words words
        w = B.scan(block.column("text"), B.ALNUM_WORDS)
        h = B.word_hashes(w)
        keys, place = np.unique(h, return_inverse=True)
        queries = [np.unique(place[a:z]) for a, z in zip(w.first[:-1], w.first[1:])]
        postings = store(_postings(chosen, keys))
        n_docs, n_terms = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(keys.size, np.int64)
        # one row per term of the block
        for row in postings.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():
            df[row["t"]] = row["df"]
        names = block.column("item_id").combine_chunks()
        hits = _search(postings, queries, names, weights(n_docs, df), n_docs, max(n_terms, 1), k, shard_postings)
        salted = _best(hits.withColumn("salt", F.spark_partition_id() % SALTS), k, ["query", "salt"])
        out.append(_best(salted, k, ["query"]).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return reduce(DataFrame.unionByName, out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
