"""Corpus word statistics and sums of per-word values over texts.

``word_table`` counts every word of every text.  Tasks count their own words
first, so what is shuffled is distinct words per task.  ``word_sums`` adds up
a vector per word over each text without shuffling the texts: the most
frequent words (a table of fixed size) are looked up inside the scan, and
only the other words of a text travel, joined with the full table.  Words
are keyed by a 64-bit hash; with 10**9 distinct words the chance that any
two collide is about 3 %, and such a pair would share its counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizlog.llm import bytetext as B
from quizlog.llm.shared import batches

HOT_WORDS = 1 << 19  # frequent words in the broadcast table, whatever the corpus
_FLUSH = 400_000  # distinct words a task holds before it sends them on


def word_strings(w: B.Words, index: np.ndarray) -> pa.Array:
    """The words at ``index`` as an Arrow string array."""
    start = w.start[index]
    lens = w.end[index] - start
    to = np.cumsum(lens)
    data = w.data[np.repeat(start - (to - lens), lens) + np.arange(to[-1] if to.size else 0)]
    off = np.concatenate([[0], to])
    return pa.LargeStringArray.from_buffers(len(index), pa.py_buffer(off.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def word_table(docs: DataFrame, group: Column, n_groups: int, table: np.ndarray) -> DataFrame:
    """``(h, word, c0 .. c{n_groups-1})``: how often each word stands in the
    texts of each group (an int column from 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            h, g, n = (np.concatenate([x[k] for x in held]) for k in range(3))
            words = pa.concat_arrays([x[3] for x in held])
            held.clear()
            key, first, inverse = np.unique(B.mix(h + g.astype(B.U64) * B.U64(0x9E37)), return_index=True, return_inverse=True)
            total = np.bincount(inverse, n).astype(np.int64)
            got = pa.RecordBatch.from_arrays(
                [pa.array(h[first].view(np.int64)), words.take(pa.array(first)), pa.array(g[first].astype(np.int32)), pa.array(total)],
                ["h", "word", "g", "n"])
            for i in range(0, got.num_rows, 50_000):
                yield got.slice(i, 50_000)

        size = 0
        for batch in batches:
            for part in B.slices(batch, "text"):
                w = B.scan(part.column(1), table)
                if not w.start.size:
                    continue
                h = B.word_hashes(w)
                g = np.repeat(np.asarray(part.column(0)).astype(np.int64), w.counts)
                _, first, n = np.unique(B.mix(h + g.astype(B.U64) * B.U64(0x9E37)), return_index=True, return_counts=True)
                held.append((h[first], g[first], n, word_strings(w, first)))
                size += first.size
                if size > _FLUSH:
                    yield from flush()
                    size = 0
        yield from flush()

    counted = docs.select(group.cast("int").alias("g"), F.col("text")).transform(batches, run, "h long, word string, g int, n long")
    return counted.groupBy("h", "word").agg(
        *[F.sum(F.when(F.col("g") == k, F.col("n")).otherwise(0)).alias(f"c{k}") for k in range(n_groups)])


def _hot(vectors: DataFrame, room: int) -> tuple[DataFrame, int]:
    """The words above the lowest count that keeps the table within
    ``room`` words, and that count."""
    step = F.floor(F.log2(F.col("n") + 0.5) * 8).cast("int")
    # at most 8 * 64 rows
    sizes = sorted(((r["k"], r["m"], r["words"]) for r in vectors.where("n > 0").groupBy(step.alias("k")).agg(
        F.min("n").alias("m"), F.count("*").alias("words")).collect()), reverse=True)
    least, total = 1 << 62, 0
    for _, m, words in sizes:
        if total + words > room:
            break
        least, total = m, total + words
    return vectors.where(F.col("n") >= least), least


@dataclass
class Found:
    """The words of a slice: the distinct ones (by a place each) and which of
    them every word is; ``hot`` is a distinct word's row in the table of
    frequent words, or -1."""

    texts: pa.Array
    words: B.Words
    place: np.ndarray
    inverse: np.ndarray
    hot: np.ndarray


def word_sums(docs: DataFrame, passing: list[str], vectors: DataFrame, dims: int, table: np.ndarray,
              extra: Callable[[Found], list] | None = None, extra_schema: list[tuple[str, str]] = (),
              hot_words: int = HOT_WORDS, on_hot: Callable[[pa.Table], None] | None = None) -> DataFrame:
    """``passing`` columns, ``n_tokens``, ``s0 .. s{dims-1}`` (sums over the
    text's words of ``v0 ..`` from ``vectors(h, n, v0 ..)``) and the columns
    that ``extra`` returns for a slice of texts; one row per row of ``docs``.
    A word that ``vectors`` lacks adds nothing.  ``on_hot`` is called once on
    the driver with the table of frequent words, in the order ``Found.hot``
    refers to, with a ``word`` column if ``vectors`` has one."""
    rows, least = word_rows(docs, passing, vectors, dims, table, extra, extra_schema, hot_words, on_hot)
    return sum_rows(rows, least, passing, vectors, dims, [c for c, _ in extra_schema])


def word_rows(docs: DataFrame, passing: list[str], vectors: DataFrame, dims: int, table: np.ndarray,
              extra: Callable[[Found], list] | None = None, extra_schema: list[tuple[str, str]] = (),
              hot_words: int = HOT_WORDS, on_hot: Callable[[pa.Table], None] | None = None) -> tuple[DataFrame, int]:
    """The scan of ``word_sums``: one row per text (``tf`` 0) with the sums of
    its frequent words, one per other word of a text; and the count that
    frequent words reach."""
    spark = docs.sparkSession
    hot, least = _hot(vectors, hot_words)
    names = [f"v{k}" for k in range(dims)]
    also = ["word"] if on_hot else []
    got = hot.select("h", *also, *[F.col(c).cast("double").alias(c) for c in names]).toArrow().sort_by("h").combine_chunks()
    keys = got.column("h").to_numpy()
    values = np.stack([got.column(c).to_numpy() for c in names], 1)
    if on_hot:
        on_hot(got)
    shared = spark.sparkContext.broadcast((keys, values))  # hot_words rows at most
    chosen = docs.select(*[F.col(c) for c in passing], F.col("text").alias("_text"))
    kinds = [(c, chosen.schema[c].dataType.simpleString()) for c in passing]
    schema = [("uid", "bigint"), ("h", "bigint"), ("tf", "bigint"), *kinds, ("n_tokens", "bigint"),
              *[(f"s{k}", "double") for k in range(dims)], *extra_schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        hot_keys, hot_vals = shared.value
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in B.slices(batch, "_text"):
                texts = part.column(part.num_columns - 1)
                n = part.num_rows
                w = B.scan(texts, table)
                uniq, place, inverse = np.unique(B.word_hashes(w).view(np.int64), return_index=True, return_inverse=True)
                at = np.searchsorted(hot_keys, uniq)
                at[at == hot_keys.size] = 0
                is_hot = hot_keys[at] == uniq if hot_keys.size else np.zeros(uniq.size, bool)
                found = Found(texts, w, place, inverse, np.where(is_hot, at, -1))
                val = np.zeros((uniq.size, dims))
                val[is_hot] = hot_vals[at[is_hot]]
                sums = [B.per_text(val[inverse, k], w.first, np.float64) for k in range(dims)]
                rare = np.flatnonzero(~is_hot[inverse])
                text_of = w.text_of_word()
                pair, tf = np.unique(text_of[rare] * np.int64(max(1, uniq.size)) + inverse[rare], return_counts=True)
                ids = uid + np.arange(n)
                uid += n
                base = [pa.array(ids), pa.array(B.mix(ids.astype(B.U64)).view(np.int64)), pa.array(np.zeros(n, np.int64)),
                        *[part.column(i) for i in range(part.num_columns - 1)], pa.array(w.counts.astype(np.int64)),
                        *[pa.array(s) for s in sums], *(pa.array(x) for x in (extra(found) if extra else []))]
                names_ = [c for c, _ in schema]
                yield pa.RecordBatch.from_arrays(base, names_)
                if pair.size:
                    types = [x.type for x in base]
                    cols = [pa.array(ids[pair // uniq.size]), pa.array(uniq[pair % uniq.size]), pa.array(tf.astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(cols + [pa.nulls(pair.size, t) for t in types[3:]], names_)

    return chosen.transform(batches, run, ", ".join(f"`{c}` {t}" for c, t in schema)), least


def sum_rows(rows: DataFrame, least: int, passing: list[str], vectors: DataFrame, dims: int, extra: list[str]) -> DataFrame:
    """The sums of ``word_sums`` from the rows of its scan."""
    names = [f"v{k}" for k in range(dims)]
    # a text's own row has tf 0 and a key spread by its number, so no key is hot
    others = vectors.where(F.col("n") < least).select(F.col("h"), *[F.col(c).cast("double").alias(c) for c in names])
    joined = rows.join(others, "h", "left")
    whole = joined.groupBy("uid").agg(
        *[F.max(c).alias(c) for c in passing], F.max("n_tokens").alias("n_tokens"),
        *[F.sum(F.coalesce(f"s{k}", F.lit(0.0)) + F.col("tf") * F.coalesce(f"v{k}", F.lit(0.0))).alias(f"s{k}") for k in range(dims)],
        *[F.max(c).alias(c) for c in extra])
    return whole.drop("uid")
