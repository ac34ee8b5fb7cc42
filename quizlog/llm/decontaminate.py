"""Benchmark decontamination by spaced-seed hashing (operator 1).

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z in
lower case; in scripts written without spaces every character is a word.  A
mask selects some of ``span`` consecutive words and ignores the others, so a
hash over the selected words still meets when words at the ignored places were
substituted.  Every position of every benchmark item is hashed under each
mask, every position of every document likewise, and equal hashes are hits.  A
hit fixes an alignment of document and item, which is verified word by word:
the longest stretch that starts and ends with equal words and has at least
``IDENTITY`` of its words equal.  It counts if it has at least ``MIN_WORDS``
words, or the whole item if that is shorter.  Items of fewer than
``MIN_ITEM_WORDS`` words are met by a hash over all their words and must stand
whole.  The longest overlap of each document and item is reported.

Repeated words: hits are counted per document and item before they are turned
into alignments.  Where there are more hits than alignments could exist (a
text of equal words against an item of equal words), all alignments are
verified instead, in blocks; equal patterns are verified once.  Nothing is
left out, and memory follows the text.

The benchmark is a stated query set: it is cut into blocks of about
``BLOCK_WORDS`` words, and every block is matched against all documents in
one scan (a block's hashes are broadcast, so a benchmark of any size needs
no more memory, only more scans).  Documents are never shuffled.

Defined results: null texts hold no words, items without words are never met;
a null item id is an item of its own; repeated rows each give their rows; of
equally long overlaps of a document and an item the one with most equal words,
then the first in the document, then in the item.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlog.llm import bytetext as B
from quizlog.llm.shared import batches, cut, table
from quizlog.operators.keyed import checked_broadcast

#: Selected places are 1.  Wherever at least 80 % of ten or more consecutive
#: words are equal, one of these masks meets only equal words (the tests go
#: through all such patterns), so no overlap that counts is missed.
MASKS = ("11011", "10111", "110011")
MIN_WORDS = 12
MIN_ITEM_WORDS = 8
IDENTITY = 0.8
BLOCK_WORDS = 1 << 20
#: The pipeline's stage does not remove documents for holding an item of one
#: to three words (an answer such as a name or a number).
MIN_STAGE_WORDS = 4
CELLS = 1 << 21  # words compared at once

#: Unicode blocks of scripts without spaces between words (Thai
#: and Lao, Myanmar, Khmer, kana, Han), as the first bytes of a character:
#: lowest and highest first byte, lowest and highest second byte.
UNSPACED = [
    (0xE0, 0xE0, 0xB8, 0xBB), (0xE1, 0xE1, 0x80, 0x81), (0xE1, 0xE1, 0x9E, 0x9F), (0xE3, 0xE3, 0x81, 0x83), (0xE3, 0xE3, 0x90, 0xBF),
    (0xE4, 0xE9, 0x80, 0xBF), (0xEF, 0xEF, 0xA4, 0xAB), (0xF0, 0xF0, 0xA0, 0xB3),
]
#: The same as ranges of characters.
UNSPACED_CHARS = [(0xE00, 0xEFF), (0x1000, 0x107F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x33FFF)]


def words(texts: pa.Array) -> B.Words:
    """The words of a slice of texts."""
    w = B.scan(texts, B.ALNUM_WORDS)
    lead = np.flatnonzero(w.data[:-1] >= 0xE0) if w.data.size else np.zeros(0, np.int64)
    one, two = w.data[lead], w.data[lead + 1]
    alone = np.zeros(lead.size, bool)
    for lo, hi, lo2, hi2 in UNSPACED:
        alone |= (one >= lo) & (one <= hi) & (two >= lo2) & (two <= hi2)
    if not alone.any():
        return w
    at = lead[alone]
    after = at + np.where(w.data[at] >= 0xF0, 4, 3)
    start = np.union1d(w.start, np.concatenate([at, np.setdiff1d(after, w.end)]))
    end = np.union1d(w.end, np.concatenate([after, np.setdiff1d(at, w.start)]))
    return B.Words(w.data, w.offsets, start, end, np.searchsorted(start, w.offsets))


def seeds(h: np.ndarray, doc_of: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of every place where the mask fits inside a text."""
    span = len(mask)
    n = h.size - span + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, B.U64)
    out = np.full(n, B.U64(int(mask, 2)), B.U64)
    for k, c in enumerate(mask):
        if c == "1":
            out = (out ^ h[k : k + n]) * B.U64(0x9E3779B97F4A7C15)
            out ^= out >> B.U64(29)
    at = np.flatnonzero(doc_of[:n] == doc_of[span - 1 :])
    return at, out[at]


def longest(equal: np.ndarray, identity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row of ``equal``, (start, end) of the longest stretch that starts
    and ends with a match and has a share of matches of at least the row's
    ``identity``, the first of equally long ones; (0, 0) without a match."""
    rows, n = equal.shape
    place = np.arange(n + 1)
    count = np.zeros((rows, n + 1))
    np.cumsum(equal, axis=1, out=count[:, 1:])
    level = count - identity[:, None] * place  # a..z counts if level[z + 1] >= level[a]
    low = np.minimum.accumulate(np.where(equal, level[:, :-1], np.inf), axis=1)
    high = np.maximum.accumulate(np.where(equal, level[:, 1:], -np.inf)[:, ::-1], axis=1)[:, ::-1] + 1e-9
    start, end = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    i, j, live = np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.flatnonzero(equal.any(1))
    while live.size:
        a, z = i[live], j[live]
        ok = high[live, z] >= low[live, a]
        better = ok & (z + 1 - a > end[live] - start[live])
        start[live[better]], end[live[better]] = a[better], z[better] + 1
        j[live[ok]] += 1
        i[live[~ok]] += 1
        live = live[(i[live] < n) & (j[live] < n)]
    return start, end


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, number inside the owner) of counts[k] copies of each k."""
    owner = np.repeat(np.arange(counts.size), counts)
    return owner, np.arange(owner.size) - np.repeat(np.cumsum(counts) - counts, counts)


class Index:
    """Seeds of a block of benchmark items."""

    def __init__(self, texts: pa.Array, masks: tuple[str, ...], min_item_words: int):
        w = words(texts)
        self.hash = B.word_hashes(w)
        self.first = w.first
        self.size = w.counts
        doc_of = w.text_of_word()
        self.short = self.size < min_item_words
        whole = {int(n): "1" * int(n) for n in np.unique(self.size[self.short]) if n}
        self.tables = []
        for mask, fits in [(m, ~self.short) for m in masks] + [(m, self.short & (self.size == n)) for n, m in whole.items()]:
            at, h = seeds(self.hash, doc_of, mask)
            keep = fits[doc_of[at]] if at.size else np.zeros(0, bool)
            at, h = at[keep], h[keep]
            order = np.lexsort((at, h))  # by hash, then item, then place
            at, h, item = at[order], h[order], doc_of[at[order]]
            new = np.ones(at.size, bool)
            new[1:] = (h[1:] != h[:-1]) | (item[1:] != item[:-1])
            group = np.append(np.flatnonzero(new), at.size)  # one hash in one item
            keys, of_key = np.unique(h[group[:-1]], return_index=True)
            if keys.size:
                self.tables.append((mask, keys, np.append(of_key, group.size - 1), group, item[group[:-1]], at))

    def _alignments(self, h: np.ndarray, w: B.Words) -> np.ndarray:
        """Rows (text, item, where the item's first word would stand)."""
        doc_of = w.text_of_word()
        met = []  # per mask: hits in order of (text, hash), and those meeting each item
        for mask, keys, of_key, group, item, places in self.tables:
            at, s = seeds(h, doc_of, mask)
            k = np.minimum(np.searchsorted(keys, s), keys.size - 1)
            hit = np.flatnonzero(keys[k] == s)
            if not hit.size:
                continue
            at, k = at[hit], k[hit]
            order = np.lexsort((k, doc_of[at]))
            at, k = at[order], k[order]
            text = doc_of[at]
            new = np.ones(at.size, bool)
            new[1:] = (text[1:] != text[:-1]) | (k[1:] != k[:-1])
            run = np.append(np.flatnonzero(new), at.size)
            u, nth = _spread(of_key[k[run[:-1]] + 1] - of_key[k[run[:-1]]])
            g = of_key[k[run[u]]] + nth
            met.append((at, run, places, group, u, g, text[run[u]], item[g]))
        if not met:
            return np.zeros((0, 3), np.int64)
        pair = np.concatenate([m[6] * self.size.size + m[7] for m in met])
        hits = np.concatenate([(m[1][m[4] + 1] - m[1][m[4]]) * (m[3][m[5] + 1] - m[3][m[5]]) for m in met])
        pairs, of = np.unique(pair, return_inverse=True)
        text, item = np.divmod(pairs, self.size.size)
        possible = w.counts[text] + self.size[item]
        hot = np.bincount(of, hits, pairs.size) > possible
        found = []
        done = 0
        for at, run, places, group, u, g, _, _ in met:
            cold = ~hot[of[done : done + u.size]]
            done += u.size
            u, g = u[cold], g[cold]
            p, q = run[u + 1] - run[u], group[g + 1] - group[g]
            x, nth = _spread(p * q)
            here, there = at[run[u[x]] + nth // q[x]], places[group[g[x]] + nth % q[x]]
            item_ = np.searchsorted(self.first, there, side="right") - 1
            found.append(np.stack([np.searchsorted(w.first, here, side="right") - 1, item_, here - there + self.first[item_]], 1))
        for t, i in zip(text[hot].tolist(), item[hot].tolist()):
            zero = np.arange(w.first[t] - self.size[i] + 1, w.first[t + 1])
            found.append(np.stack([np.full(zero.size, t), np.full(zero.size, i), zero], 1))
        return np.unique(np.concatenate(found), axis=0)

    def search(self, w: B.Words, min_words: int, identity: float) -> list[tuple[int, int, int, int, int, int]]:
        """(text, item, first word in text, in item, words, equal words): the
        longest overlap of each text and item."""
        h = B.word_hashes(w)
        rows = self._alignments(h, w)
        if not len(rows):
            return []
        rows = rows[np.argsort(self.size[rows[:, 1]], kind="stable")]
        size, short = self.size[rows[:, 1]], self.short[rows[:, 1]]
        share = np.where(short, 1.0, identity)
        need = np.where(short, size, np.minimum(min_words, size))
        out, k = [], 0
        while k < len(rows):
            # the rows that share a block have items of nearly one length
            end = min(len(rows), k + max(1, CELLS // int(size[k])))
            end = min(end, max(k + 1, int(np.searchsorted(size, 2 * size[k], side="right"))))
            text, item, zero = rows[k:end].T
            step = np.arange(int(size[end - 1]))
            at = zero[:, None] + step
            ok = (step < size[k:end, None]) & (at >= w.first[text][:, None]) & (at < w.first[text + 1][:, None])
            equal = ok & (h[np.clip(at, 0, h.size - 1)] == self.hash[np.clip(self.first[item][:, None] + step, 0, self.hash.size - 1)])
            may = np.flatnonzero(equal.sum(1) >= share[k:end] * need[k:end] - 1e-9)
            if may.size:
                packed = np.concatenate([np.packbits(equal[may], axis=1), short[k:end][may, None].astype(np.uint8)], 1)
                _, one, back = np.unique(packed, axis=0, return_index=True, return_inverse=True)
                a, z = longest(equal[may[one]], share[k:end][may[one]])
                same = np.cumsum(equal[may[one]], 1)
                same = same[np.arange(one.size), z - 1] - np.where(a > 0, same[np.arange(one.size), a - 1], 0)
                back = back.ravel()
                a, z, same = a[back], z[back], same[back]
                fine = z - a >= need[k:end][may]
                m = may[fine]
                out.append(np.stack([text[m], item[m], zero[m] + a[fine] - w.first[text[m]], a[fine], (z - a)[fine], same[fine]], 1))
            k = end
        if not out:
            return []
        got = np.concatenate(out)
        got = got[np.lexsort((got[:, 3], got[:, 2], -got[:, 5], -got[:, 4], got[:, 1], got[:, 0]))]
        first = np.ones(len(got), bool)
        first[1:] = (got[1:, :2] != got[:-1, :2]).any(1)
        return [tuple(r) for r in got[first].tolist()]


OVERLAP = "doc_id long, item_id long, doc_word long, item_word long, n_words long, n_equal long"


def _blocks(benchmark: DataFrame, id_col: str, block_words: int) -> tuple[DataFrame, int]:
    """The items with a block number; blocks hold about ``block_words``."""
    size = F.size(F.split(F.coalesce("text", F.lit("")), r"\s+"))
    items = cut(benchmark.select(F.col(id_col).cast("long").alias("item_id"), "text").withColumn("_w", size))
    total = items.agg(F.sum("_w")).first()[0] or 0
    n = max(1, -(-int(total) // block_words))
    return items.withColumn("_block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)).cast("int")), n


def overlaps(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, min_words: int = MIN_WORDS,
             identity: float = IDENTITY, min_item_words: int = MIN_ITEM_WORDS, block_words: int = BLOCK_WORDS,
             item_col: str = "item_id", passing: str = "doc_id") -> DataFrame:
    """Verified overlaps, the longest of each document and item."""
    spark = docs.sparkSession
    items, n_blocks = _blocks(benchmark, item_col, block_words)
    chosen = docs.select(F.col(passing).cast("long").alias("doc_id"), "text")
    out = None
    for k in range(n_blocks):
        block = items.where(F.col("_block") == k).select("item_id", "text").toArrow()  # about block_words words
        ids = block.column("item_id").to_pylist()
        shared = spark.sparkContext.broadcast((Index(block.column("text").combine_chunks(), masks, min_item_words), ids))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, ids = shared.value
            for batch in batches:
                for part in B.slices(batch, "text"):
                    names = part.column(0)
                    rows = index.search(words(part.column(1)), min_words, identity)
                    if rows:
                        text, item, *rest = zip(*rows)
                        yield pa.RecordBatch.from_arrays(
                            [names.take(pa.array(text)), pa.array([ids[i] for i in item], pa.int64()), *[pa.array(x, pa.int64()) for x in rest]],
                            [c.split()[0] for c in OVERLAP.split(", ")])

        got = chosen.transform(batches, run, OVERLAP)
        out = got if out is None else out.unionByName(got)
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified overlap stay.  With one block of items the
    decision is made row by row inside the scan; with several, each block's
    scan gives the digests of the texts that go (one index in a task at a
    time).  Texts are not shuffled."""
    items, n_blocks = _blocks(table(spark, sf_dir, "benchmark"), "item_id", BLOCK_WORDS)
    at = docs.columns.index("text")

    def held(k: int):
        block = items.where(F.col("_block") == k).select("text").toArrow()
        return spark.sparkContext.broadcast(Index(block.column("text").combine_chunks(), MASKS, MIN_ITEM_WORDS))

    def met(index: Index, part: pa.RecordBatch, column: int) -> np.ndarray:
        hit = np.zeros(part.num_rows, bool)
        for row in index.search(words(part.column(column)), MIN_WORDS, IDENTITY):
            hit[row[0]] |= bool(index.size[row[1]] >= MIN_STAGE_WORDS)
        return hit

    if n_blocks == 1:
        shared = held(0)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                named = batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])
                for part in B.slices(named, f"c{at}"):
                    yield part.filter(pa.array(~met(shared.value, part, at))).rename_columns(batch.schema.names)

        return docs.transform(batches, run, docs.schema)

    digest = [F.xxhash64("text").alias("__q_a"), F.hash("text", F.lit(7)).alias("__q_b")]
    gone = None
    for k in range(n_blocks):
        shared = held(k)

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in B.slices(batch, "text"):
                    yield part.filter(pa.array(met(shared.value, part, 0))).select(["__q_a", "__q_b"])

        got = cut(docs.select("text", *digest).transform(batches, find, "__q_a long, __q_b int").distinct())
        gone = got if gone is None else gone.unionByName(got)
    gone = checked_broadcast(gone.distinct())
    return docs.select("*", *digest).join(gone, ["__q_a", "__q_b"], "left_anti").select(*docs.columns)
