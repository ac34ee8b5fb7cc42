"""SimHash near-duplicate detection by tiled exact comparison (operator 9).

Fingerprints are computed once per text (Arrow batches, numpy); copies meet as
one distinct fingerprint.  Fingerprints within ``radius`` bits agree on at
least two of ``radius + 2`` parts of the word, so each is laid into one bucket
per pair of parts (six for a radius of 2), and only fingerprints of a bucket
are compared: work and shuffle follow the number of fingerprints, not its
square.  Buckets of one fingerprint are dropped.

Inside a bucket the comparison is exact, by exclusive-or and bit counts.
Fingerprints stand in order of their population count; those whose counts
differ by more than the radius are not compared.  A bucket of more than
``TILE`` fingerprints is cut into tiles by population count and hash; pairs of
tiles whose counts differ beyond the radius are skipped, every other pair is a
unit of work of its own, so no task holds a hot bucket.  Each comparison
reports a spanning star (every fingerprint with the smallest linked to it
there), not all pairs, and connected components join the stars.  Nodes are
fingerprints; documents only name the components.

Defined results: a null or empty text has fingerprint 0 and links like any
other; repeated rows each get a row; documents with a null id link like any
other, get the component of their fingerprint (null if no document of the
component has an id) and never name a component; an id on several texts names
each of their components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quizlog.llm import bytetext as B
from quizlog.llm.components import components
from quizlog.llm.shared import batches, cut, table
from quizlog.operators.keyed import checked_broadcast

SHINGLE = 3
RADIUS = 2
TILE = 1024
HELD_PAIRS = 1 << 17


def text_fingerprints(texts: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """Unsigned 64-bit fingerprint of each text: bit set if set in over half
    of the XXH64 hashes (seed 42) of its shingles, repeats included."""
    w = B.scan(texts, B.SPACE_WORDS)
    data, start, end = B.collapsed(w)
    counts = w.counts
    n_sh = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    out = np.zeros(len(counts), B.U64)
    has = n_sh > 0
    if not has.any():
        return out
    sh_first = np.concatenate([[0], np.cumsum(n_sh)])
    a = np.repeat(w.first[:-1] - sh_first[:-1], n_sh) + np.arange(sh_first[-1])
    b = a + np.repeat(np.minimum(counts, shingle), n_sh) - 1
    h = B.xxh64(data, start[a], end[b] - start[a])
    step = 1 << 18
    ones = np.zeros((len(counts), 64), np.int64)
    owner = np.repeat(np.arange(len(counts)), n_sh)
    for i in range(0, h.size, step):
        part = h[i : i + step]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = owner[i : i + step]
        cut_at = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        ones[own[cut_at]] += np.add.reduceat(bits, cut_at, axis=0, dtype=np.int32)
    majority = 2 * ones > n_sh[:, None]
    out[has] = np.packbits(majority[has], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, key, fp)`` of every document: fp is the signed view, key a
    64-bit hash of the text that Spark computes alike wherever it reads it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in B.slices(batch, "text"):
                fp = text_fingerprints(part.column(2), shingle)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fp.view(np.int64))], ["doc_id", "key", "fp"])

    text = F.col(text_col)
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), _text_key(text).alias("key"), text.alias("text"))
    return chosen.transform(batches, run, "doc_id long, key long, fp long")


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def part_masks(radius: int) -> list[int]:
    """Masks of every pair of ``radius + 2`` nearly equal parts of a word."""
    n = radius + 2
    edges = [64 * i // n for i in range(n + 1)]
    parts = [(1 << z) - (1 << a) for a, z in zip(edges, edges[1:])]
    return [a | b for a, b in combinations(parts, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node linked to it) for linked pairs of fingerprints."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    x, y = at[: u.size], at[u.size :]
    label = np.arange(nodes.size)
    while True:
        low = np.minimum(label[x], label[y])
        if (label[x] == low).all() and (label[y] == low).all():
            break
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        label = label[label]
    far = np.flatnonzero(label != np.arange(nodes.size))
    return nodes[far], nodes[label[far]]


class _Held:
    """Linked pairs, reduced to stars whenever many are held: what is kept
    follows the number of fingerprints, however many pairs are linked."""

    def __init__(self):
        self.pairs, self.size = [], 0

    def add(self, u: np.ndarray, v: np.ndarray) -> None:
        if u.size:
            self.pairs.append((u, v))
            self.size += u.size
            if self.size > HELD_PAIRS:
                self._reduce()

    def _reduce(self) -> None:
        self.pairs = [_stars(*(np.concatenate([p[k] for p in self.pairs]) for k in range(2)))]
        self.size = 0

    def edges(self) -> Iterator[pa.RecordBatch]:
        if self.pairs:
            self._reduce()
            u, v = self.pairs[0]
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def _bucket_links(radius: int):
    """Links inside buckets that come sorted by (bucket, population count)."""

    def compare(b: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
        word = f.view(np.uint64)
        count = np.bitwise_count(word).astype(np.int16)
        held, i, d = _Held(), np.arange(f.size - 1), 1
        while i.size:
            i = i[(b[i + d] == b[i]) & (count[i + d] - count[i] <= radius)]
            near = i[np.bitwise_count(word[i] ^ word[i + d]) <= radius]
            held.add(f[near], f[near + d])
            d += 1
            i = i[i + d < f.size]
        yield from held.edges()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, f = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            b, f = np.concatenate([b, np.asarray(batch.column(0))]), np.concatenate([f, np.asarray(batch.column(1))])
            whole = int(np.searchsorted(b, b[-1])) if b.size else 0  # the last bucket may go on
            if whole:
                yield from compare(b[:whole], f[:whole])
                b, f = b[whole:], f[whole:]
        yield from compare(b, f)

    return run


def _tile_links(radius: int):
    """Links between the two tiles of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # ``values`` is the whole child array, which the offsets index
            sides = [(np.asarray(batch.column(c).values), np.asarray(batch.column(c).offsets)) for c in ("fa", "fb")]
            for i in range(batch.num_rows):
                a, b = (v[o[i] : o[i + 1]] for v, o in sides)
                held = _Held()
                for k in range(0, a.size, 64):
                    x, y = np.nonzero(np.bitwise_count(a[k : k + 64, None].view(np.uint64) ^ b[None, :].view(np.uint64)) <= radius)
                    x += k
                    other = a[x] != b[y]
                    held.add(a[x[other]], b[y[other]])
                yield from held.edges()

    return run


def links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges ``(u, v)`` between fingerprints that connect exactly what links of
    at most ``radius`` bits connect.  ``prints``: distinct ``fp``."""
    keys = F.array(*[F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for k, m in enumerate(part_masks(radius))])
    laid = prints.select(F.explode(keys).alias("b"), "fp", F.bit_count("fp").alias("pc"))
    sizes = cut(laid.groupBy("b").agg(F.count("*").alias("n")).where("n > 1"))
    laid = laid.join(checked_broadcast(sizes), "b")
    cool = laid.where(F.col("n") <= tile).select("b", "fp", "pc").repartition("b").sortWithinPartitions("b", "pc")
    out = cool.select("b", "fp").transform(batches, _bucket_links(radius), "u long, v long")
    if sizes.where(F.col("n") > tile).isEmpty():
        return out
    hot = laid.where(F.col("n") > tile)
    cells = cut(hot.groupBy("b", "pc").agg(F.ceil(F.count("*") / tile).cast("int").alias("parts")))
    dealt = hot.join(checked_broadcast(cells), ["b", "pc"]).withColumn("sub", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    tiles = cut(dealt.groupBy("b", "pc", "sub").agg(F.collect_list("fp").alias("f")))
    one = cells.select("b", F.col("pc").alias("pa"), F.explode(F.expr("sequence(0, parts - 1)")).alias("sa"))
    # the counts a tile's partner may have: the same up to ``radius`` more
    one = one.withColumn("pb", F.explode(F.array(*[F.col("pa") + d for d in range(radius + 1)])))
    two = cells.select("b", F.col("pc").alias("pb"), F.explode(F.expr("sequence(0, parts - 1)")).alias("sb"))
    pairs = one.join(two, ["b", "pb"]).where("pa < pb or sa <= sb")
    left = tiles.select("b", F.col("pc").alias("pa"), F.col("sub").alias("sa"), F.col("f").alias("fa"))
    right = tiles.select("b", F.col("pc").alias("pb"), F.col("sub").alias("sb"), F.col("f").alias("fb"))
    work = pairs.join(left, ["b", "pa", "sa"]).join(right, ["b", "pb", "sb"]).select("fa", "fb")
    return out.unionByName(work.transform(batches, _tile_links(radius), "u long, v long"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per document."""
    fps = cut(fingerprints(docs, shingle, id_col, text_col))
    groups = cut(print_groups(fps, radius, tile))
    return fps.join(groups.select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def print_groups(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``(fp, component, component_id, first_fp)`` of every distinct
    fingerprint: its component, that component's smallest document id and the
    smallest fingerprint that this document has in it."""
    # copies of a text meet here once, summed on the map side first
    prints = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    comp = components(links(prints.select("fp"), radius, tile))
    of = cut(prints.join(comp, F.col("fp") == F.col("node"), "left").select("fp", "rep", F.coalesce("component", "fp").alias("component")))
    # the smallest (id, fingerprint), without an id last
    first = F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "fp"))
    names = of.groupBy("component").agg(first.alias("first"))
    return of.join(names, "component").select(
        "fp", "component", F.col("first.rep").alias("component_id"), F.col("first.fp").alias("first_fp"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest (id,
    fingerprint), documents without an id last; of several rows with that id
    and fingerprint one.  A text is decided by its own fingerprint, whatever
    other texts have its id."""
    fps = cut(fingerprints(docs))
    groups = cut(print_groups(fps))
    seen = fps.join(groups, "fp").groupBy("key", "doc_id", "fp", "component_id", "first_fp").agg(F.count("*").alias("n"))
    stays = (F.col("fp") == F.col("first_fp")) & F.col("doc_id").eqNullSafe(F.col("component_id"))
    # of several texts with the id and fingerprint that stay, one
    first = F.min("key").over(Window.partitionBy("doc_id", "fp"))
    seen = seen.where(stays).withColumn("stays", F.col("key") == first).unionByName(seen.where(~stays).withColumn("stays", F.lit(False)))
    seen = cut(seen.select(F.col("doc_id").alias("__q_id"), F.col("key").alias("__q_text"), "stays", "n"))
    here = F.col("doc_id").cast("long").eqNullSafe(F.col("__q_id")) & (F.col("__q_key") == F.col("__q_text"))
    # joined by broadcast while the lists are measured small, else by shuffle
    drop = checked_broadcast(seen.where("NOT stays").select("__q_id", "__q_text"))
    whole = docs.withColumn("__q_key", _text_key(F.col("text"))).join(drop, here, "left_anti")
    many = checked_broadcast(seen.where("stays AND n > 1").select("__q_id", "__q_text"))
    if many.isEmpty():
        return whole.drop("__q_key")
    # rows alike: a group limit keeps one a task before the shuffle
    alike = F.row_number().over(Window.partitionBy("doc_id", "__q_key").orderBy(F.lit(0)))
    one = whole.join(many, here, "left_semi").withColumn("__q_row", alike).where("__q_row = 1").drop("__q_row")
    return whole.join(many, here, "left_anti").unionByName(one).drop("__q_key")
