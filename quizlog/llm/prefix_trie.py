"""Prefix trie of conversations by union-find over LCP edges (operator 13).

A conversation is its sequence of turns (role, text); every distinct
sequence of first d turns is a node.  The trie is built from sorted
sequences: equal sequences are grouped first (an aggregate, so copies meet
as counts), the distinct ones are dealt by range and sorted, and neighbours
are linked by an edge that weighs the number of turns they share (LCP).
Inside a range the edges are taken in descending depth: union-find merges
the two components, and every merge creates the branching node at that
depth; the nodes between it and a component's last one are the unary chain
of that component (``forest``).

A range's forest is contracted: nodes whose prefix also lies in a
neighbouring range (known from the LCP of the ranges' first and last
sequences, one row per range) are emitted as pieces under the prefix's
digest, all others are final.  Every figure of a node is a sum over pieces
(or a minimum), because a turn that spans ranges is owned by the first of
them; so one aggregate over the pieces, at most two times the depth per
range, merges the partition forests across their boundaries.

``saved_tokens`` of a subtree is the words of all members' turns from the
node's depth on, less the words of the distinct turns among them; both are
prefix sums over sorted sequences.

Scale: texts are only sorted within their conversation and never collected;
a turn travels as a digest (md5 of role and text) and a word count.  One
conversation's digests are one row, so a conversation may have some millions
of turns.  ``ends_sha256`` is sequential by its definition: members' ids are
sorted by the shuffle and streamed through the digest in constant memory,
also where a third of all conversations are copies of one.  Ranges hold
about ``PART_TURNS`` turns at most; range numbers are written once before
they are read twice.

Defined results: null roles and texts are empty; equal turn numbers are
ordered by role, then text, and all kept; rows without a conversation id
belong to no conversation; a conversation without turns ends at the root; an
empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quizlog.llm.shared import batches, cut, store, table
from quizlog.operators.keyed import checked_broadcast

GROUP = 20  # conversations that borrow from one
BORROW = 4  # a conversation borrows crc32(id) % BORROW turns
PART_TURNS = 500_000
PART_ROWS = 1_000  # fewer rows than this do not make a range worth while
NOTHING = hashlib.sha256(b"").hexdigest()

PIECES = ("key string, pkey string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
          "n_leaves long, saved_tokens long, ends_sha256 string")


# ---------------------------------------------------------------- sequences

def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: each conversation's turns in order, as an array of
    (digest, words)."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    t = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    at = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    turn = F.struct(
        at.alias("at"),
        F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")).alias("digest"),
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    got = t.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return got.select("conv_id", F.transform("t", lambda x: F.struct(x.digest.alias("digest"), x.words.alias("words"))).alias("turns"))


def borrowed(seqs: DataFrame) -> DataFrame:
    """The sequences with their first h turns replaced by the first h of the
    conversation whose id is the next lower multiple of ``GROUP``."""
    lead = seqs.where(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("_lender"), F.slice("turns", 1, BORROW - 1).alias("_lead"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % BORROW).cast("int")
    none = F.slice("turns", 1, 0)
    both = seqs.withColumn("_lender", F.col("conv_id") - F.col("conv_id") % GROUP).join(lead, "_lender", "left")
    return both.select("conv_id", F.concat(
        F.slice(F.coalesce("_lead", none), F.lit(1), h), F.slice("turns", h + 1, F.size("turns"))).alias("turns"))


def ends(members: DataFrame) -> DataFrame:
    """``seq_key, ends_sha256`` of ``members(seq_key, conv_id)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            keys, ids = batch.column(0), batch.column(1).to_pylist()
            if not ids:
                continue
            change = np.flatnonzero(pa.compute.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)) + 1
            done = []
            for a, z in zip([0, *change.tolist()], [*change.tolist(), len(ids)]):
                text = ",".join(map(str, ids[a:z]))
                name = keys[a].as_py()
                if name == key:
                    digest.update(("," + text).encode())
                    continue
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = name, hashlib.sha256(text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*done)], ["seq_key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], ["seq_key", "ends_sha256"])

    dealt = members.select("seq_key", "conv_id").repartition("seq_key").sortWithinPartitions("seq_key", "conv_id")
    return dealt.transform(batches, run, "seq_key string, ends_sha256 string")


# ---------------------------------------------------------------- one range

def lcp(a: list, b: list) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


class Component:
    """Neighbouring sequences that share a prefix: rows ``first`` .. ``last``.
    ``depth`` is that of its topmost node, which has ``children`` children;
    ``waiting`` are emitted nodes whose parent it is."""

    __slots__ = ("first", "last", "depth", "children", "n", "words", "own", "leaves", "conv", "waiting")

    def __init__(self, row: int, depth: int, n: int, words: int, own: int, leaf: bool, conv: int):
        self.first = self.last = row
        self.depth, self.children, self.waiting = depth, 0, []
        self.n, self.words, self.own, self.leaves, self.conv = n, words, own, int(leaf), conv


def forest(keys: list[list[str]], words: list[list[int]], counts: list[int], convs: list[int], ends_: list[str],
           before: int, after: int) -> list[tuple]:
    """``PIECES`` of the nodes over one range's sorted, distinct sequences.
    ``before`` and ``after`` are the turns that the first and the last share
    with the neighbouring ranges, -1 without one."""
    rows = len(keys)
    shared = [before, *[lcp(keys[i - 1], keys[i]) for i in range(1, rows)], after]
    sums = []  # words of the first d turns
    for w in words:
        s = [0]
        for x in w:
            s.append(s[-1] + x)
        sums.append(s)
    # what a row adds to the distinct turns: those after the ones shared with the row before
    parts = [Component(i, len(keys[i]), counts[i], counts[i] * sums[i][-1], sums[i][-1] - sums[i][max(shared[i], 0)],
                       shared[i + 1] < len(keys[i]), convs[i]) for i in range(rows)]

    def digests(seq: list[str], depth: int) -> list[str]:
        out, h = [], hashlib.md5()
        for d in range(depth + 1):
            if d:
                h.update(seq[d - 1].encode())
            out.append(h.hexdigest())
        return out

    left, right = digests(keys[0], before), digests(keys[-1], after)
    out: list[list] = []

    def emit(c: Component, down_to: int) -> None:
        """The nodes of ``c`` from its top to just below ``down_to``."""
        s, f = sums[c.first], c.first
        have = s[max(shared[f], 0)]
        for d in range(c.depth, down_to, -1):
            from_left, to_right = f == 0 and d <= before, c.last == rows - 1 and d <= after
            key = left[d] if from_left else right[d] if to_right else None
            children = c.children if d == c.depth else 1
            if f == 0 and d < before:
                children -= 1  # this child began in an earlier range
            above = s[max(d - 1, 0)]
            saved = (c.words - c.n * above) - (c.own - max(0, above - have))
            for k in c.waiting:
                out[k][1], out[k][4] = key, None if key else c.conv
            end = ends_[f] if d == len(keys[f]) else None
            c.waiting = [len(out)]
            out.append([key, None, c.conv, d, None, c.n, children, c.leaves, saved, end if key or end else NOTHING])
        c.children, c.depth = (1, down_to) if c.depth > down_to else (c.children, c.depth)

    root = list(range(rows))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in sorted(range(1, rows), key=lambda i: -shared[i]):
        a, b = find(i - 1), find(i)
        x, y = parts[a], parts[b]
        emit(x, shared[i])
        emit(y, shared[i])
        x.last = y.last
        x.children += y.children
        x.n, x.words, x.own, x.leaves, x.conv = x.n + y.n, x.words + y.words, x.own + y.own, x.leaves + y.leaves, min(x.conv, y.conv)
        long, short = (x.waiting, y.waiting) if len(x.waiting) >= len(y.waiting) else (y.waiting, x.waiting)
        long += short
        x.waiting = long
        root[b] = a
        parts[b] = None
    emit(parts[find(0)], -1)
    return out


# ---------------------------------------------------------------- all ranges

def _lcp(a: Column, b: Column) -> Column:
    differ = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False))
    return F.when(differ == 0, F.least(F.size(a), F.size(b))).otherwise(differ - 1).cast("int")


def trie(seqs: DataFrame, parts: int | None = None) -> DataFrame:
    """One row per node of ``seqs(conv_id, turns)``; columns as in ``nodes``."""
    spark = seqs.sparkSession
    keyed = store(seqs.select(F.md5(F.concat_ws("", "turns.digest")).alias("seq_key"), "conv_id", "turns"))
    distinct = keyed.groupBy("seq_key").agg(
        F.first("turns").alias("turns"), F.count("*").alias("n"), F.min("conv_id").alias("conv_id")).join(ends(keyed), "seq_key")
    if parts is None:
        size, turns = keyed.agg(F.approx_count_distinct("seq_key"), F.sum(F.size("turns"))).first()
        wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
        parts = max(1, min(wide, size // PART_ROWS), -(-int(turns or 0) // PART_TURNS))
    rows = distinct.select(
        F.col("turns.digest").alias("digests"), F.col("turns.words").alias("words"), "n", "conv_id", "ends_sha256")
    rows = cut(rows.repartitionByRange(parts, "digests").sortWithinPartitions("digests").withColumn("part", F.spark_partition_id()))
    # one row per range from here to ``near``
    by_part = Window.orderBy("part")
    edges = rows.groupBy("part").agg(F.min("digests").alias("low"), F.max("digests").alias("high"))
    edges = edges.select("part", _lcp(F.lag("high").over(by_part), F.col("low")).alias("before"),
                         _lcp(F.col("high"), F.lead("low").over(by_part)).alias("after"))
    near = {r["part"]: (-1 if r["before"] is None else r["before"], -1 if r["after"] is None else r["after"]) for r in edges.collect()}
    shared = spark.sparkContext.broadcast(near)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held)
        part = t.column("part")[0].as_py()
        got = forest(*[t.column(c).to_pylist() for c in ("digests", "words", "n", "conv_id", "ends_sha256")], *shared.value[part])
        names = [c.split()[0] for c in PIECES.split(", ")]
        types = [pa.string() if c.endswith("string") else pa.int64() for c in PIECES.split(", ")]
        for i in range(0, len(got), 20_000):
            yield pa.RecordBatch.from_arrays([pa.array(x, ty) for x, ty in zip(zip(*got[i : i + 20_000]), types)], names)

    pieces = store(rows.transform(batches, run, PIECES))
    total = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    merged = cut(pieces.where(F.col("key").isNotNull()).groupBy("key", "pkey", "depth").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in total],
        F.coalesce(F.max("ends_sha256"), F.lit(NOTHING)).alias("ends_sha256")))
    columns = ["conv_id", "depth", "parent_conv_id", *total, "ends_sha256"]
    inner = pieces.where(F.col("key").isNull())
    below = inner.where(F.col("pkey").isNotNull()).drop("key").unionByName(merged.drop("key").withColumn("parent_conv_id", F.lit(None).cast("long")))
    parents = checked_broadcast(merged.select(F.col("key").alias("pkey"), F.col("conv_id").alias("_parent")))
    below = below.join(parents, "pkey", "left").withColumn("parent_conv_id", F.col("_parent"))
    return inner.where(F.col("pkey").isNull()).select(columns).unionByName(below.select(columns))


def nodes(conversations: DataFrame, parts: int | None = None) -> DataFrame:
    """The trie's nodes: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``."""
    return trie(borrowed(sequences(conversations)), parts)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes(table(spark, sf_dir, "conversations"))
