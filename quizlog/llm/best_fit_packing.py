"""Best-fit packing of documents into training sequences (operator 8).

Documents become subword ids plus an end id; one longer than ``CAPACITY``
is cut into full pieces and a last shorter one.  Only the pieces' lengths
and checksums travel: a full piece is a sequence of its own, and the others
are dealt by hash into groups of about ``GROUP`` pieces, each packed in one
task by bin completion.  Sequences left under ``DISSOLVE`` full are taken
apart and packed again over fewer groups until one group holds them all, so
what the split into groups wastes is at most a few sequences in total.

Packing a group: best-fit decreasing gives the incumbent; if it meets
Martello and Toth's lower bound it is optimal.  Otherwise bin completion goes
over all under-filled bins, emptiest first, in subproblems of about
``SEARCH_ITEMS`` pieces: the largest piece opens a bin, the undominated fillings
around it are enumerated fullest first, and a branch is pruned when its waste
or the bound on the rest reaches the incumbent.  Every better solution
replaces the incumbent; of solutions with as many bins the one with the
emptiest bin is kept, and that bin joins the next subproblem, so the room of
all subproblems comes together.  A subproblem ends at its bound or after
``SEARCH_NODES`` fillings.  Passes are repeated while they save a bin in a
thousand.  A group of any size is packed this way.

Defined results: a null or empty text is one piece holding the end id alone;
repeated rows are separate pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlog.llm import bytetext as B
from quizlog.llm import subwords
from quizlog.llm.shared import batches, cut, table

CAPACITY = 2048
GROUP = 50_000
DISSOLVE = 0.98
SEARCH_ITEMS = 200
SEARCH_NODES = 400

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of every document."""
    path = vocabulary or subwords.default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in B.slices(batch, "text"):
                ids, off = subwords.document_ids(part.column(1), path, end_id)
                raw = memoryview(ids.astype("<u4").tobytes())
                lens = np.diff(off)
                n = -(-lens // capacity)
                doc = np.repeat(np.arange(lens.size), n)
                piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(capacity, lens[doc] - start)
                at = (off[doc] + start) * 4
                crc = [zlib.crc32(raw[a : a + 4 * k]) for a, k in zip(at.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start),
                     pa.array(length), pa.array(crc, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").transform(batches, run, PIECES)


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices: each item, largest first, goes to the open bin it
    fills best."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by free room
    rooms: list[int] = []  # the free rooms that occur, sorted
    bins: list[list[int]] = []
    for i in order:
        at = bisect_left(rooms, sizes[i])
        if at < len(rooms):
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
            bins[b].append(i)
            left = room - sizes[i]
        else:
            b = len(bins)
            bins.append([i])
            left = capacity - sizes[i]
        if not by_room[left]:
            rooms.insert(bisect_left(rooms, left), left)
        by_room[left].append(b)
    return bins


def lower_bound(sizes: list[int], capacity: int) -> int:
    """Martello and Toth's bound: for a threshold k, pieces over capacity - k
    are alone, pieces over half need a bin each, and those of k or more that
    the second kind has no room for need further bins; the best over all k."""
    n = np.bincount(np.asarray(sizes, np.int64), minlength=capacity + 1)
    count = np.concatenate([[0], np.cumsum(n)])  # pieces below a size
    total = np.concatenate([[0], np.cumsum(n * np.arange(capacity + 1))])
    half = capacity // 2
    k = np.arange(half + 1)
    big = count[-1] - count[half + 1]  # over half, with or without room for k
    room = (count[capacity - k + 1] - count[half + 1]) * capacity - (total[capacity - k + 1] - total[half + 1])
    small = total[half + 1] - total[k]
    return int(big + np.maximum(0, -(-(small - room) // capacity)).max()) if len(sizes) else 0


def fillings(values: list[int], counts: list[int], room: int, least: int, budget: list[int]) -> Iterator[tuple[int, tuple[int, ...]]]:
    """Undominated fillings of ``room`` from the multiset (values descending)
    with a sum of at least ``least``: (sum, count per value), fullest first.

    The sums that the values from each place on can reach are a bit set, so
    the search for an exact sum has no dead ends, whatever the number of
    pieces.  Every filling looked at takes one from the budget."""
    n = len(values)
    mask = (1 << (room + 1)) - 1
    reach = [1] * (n + 1)
    for k in range(n - 1, -1, -1):
        r, v, c, step = reach[k + 1], values[k], min(counts[k], room // values[k]), 1
        while c > 0:  # one, two, four ... copies at once
            take = min(step, c)
            r |= (r << (v * take)) & mask
            c, step = c - take, step * 2
        reach[k] = r
    for target in range(reach[0].bit_length() - 1, max(least, 0) - 1, -1):
        if not reach[0] >> target & 1:
            continue
        used = [0] * n
        k, left, down = 0, target, True
        while True:
            if down:  # as many of the larger values as the rest allows
                while left:
                    v = values[k]
                    t = min(counts[k], left // v)
                    while not reach[k + 1] >> (left - t * v) & 1:
                        t -= 1
                    used[k], left, k = t, left - t * v, k + 1
                budget[0] -= 1
                if not _dominated(values, counts, used, room - target):
                    yield target, tuple(used)
                if budget[0] <= 0:
                    return
            # the last place that can take fewer
            down = False
            k -= 1
            while k >= 0 and not used[k]:
                k -= 1
            if k < 0:
                break
            v, t = values[k], used[k]
            left += t * v
            t -= 1
            while t >= 0 and not reach[k + 1] >> (left - t * v) & 1:
                t -= 1
            if t < 0:
                used[k] = 0
                continue
            used[k], left, k, down = t, left - t * v, k + 1, True


def _dominated(values: list[int], counts: list[int], used: list[int], free: int) -> bool:
    """Whether an unused piece fits beside a filling, or fits in place of a
    smaller piece of it: the filling with that piece is as good."""
    if not free:
        return False
    larger = 0  # the last, that is smallest, larger value with an unused piece
    for v, c, u in zip(values, counts, used):
        if u and larger and larger - v <= free:
            return True
        if u < c:
            if v <= free:
                return True
            larger = v
    return False


def bin_completion(sizes: list[int], capacity: int, incumbent: list[list[int]], nodes: int = SEARCH_NODES) -> list[list[int]]:
    """Branch and bound: the packing with the fewest bins that the search
    finds, of equal ones that with the emptiest bin; or the incumbent."""
    lower = lower_bound(sizes, capacity)
    have = Counter(sizes)
    values = sorted(have, reverse=True)
    total = sum(sizes)
    best: list[tuple[int, ...]] | None = None
    best_n = len(incumbent)
    least_fill = min(sum(sizes[i] for i in b) for b in incumbent)
    budget = [nodes]
    # one level a bin: (fillings to try, what is left, its sum, waste so far)
    levels: list[tuple[Iterator, list[int], int, int]] = []
    done: list[tuple[int, ...]] = []
    first = True

    def open_level(counts: list[int], left: int, waste: int) -> None:
        k = next(i for i, c in enumerate(counts) if c)
        rest = list(counts)
        rest[k] -= 1
        room = capacity - values[k]
        # more waste than this and no bin can be saved; the first descent may tie
        allowed = (best_n - (0 if first else 1)) * capacity - total - waste
        at = [i for i in range(k, len(values)) if rest[i] and values[i] <= room]
        got = fillings([values[i] for i in at], [rest[i] for i in at], room, room - allowed, budget)
        levels.append((((k, at, s, f) for s, f in got), rest, left - values[k], waste))

    open_level([have[v] for v in values], total, 0)
    while levels:
        tries, rest, left, waste = levels[-1]
        step = next(tries, None)
        if step is None:
            levels.pop()
            if done:
                done.pop()
            continue
        k, at, s, f = step
        counts = list(rest)
        whole = [0] * len(values)
        whole[k] = 1
        for i, u in zip(at, f):
            counts[i] -= u
            whole[i] += u
        done.append(tuple(whole))
        if left == s:  # all packed
            fill = min(sum(v * u for v, u in zip(values, b)) for b in done)
            if len(done) < best_n or (len(done) == best_n and fill < least_fill):
                best, best_n, least_fill = list(done), len(done), fill
            first = False
            if best_n <= lower:
                break
            done.pop()
        elif len(done) + -(-(left - s) // capacity) > best_n - (0 if first else 1):
            done.pop()
        else:
            open_level(counts, left - s, waste + capacity - values[k] - s)
        if budget[0] <= 0:
            break
    if best is None:
        return incumbent
    pools: dict[int, list[int]] = {}
    for i, x in enumerate(sizes):
        pools.setdefault(x, []).append(i)
    return [[pools[v].pop() for v, u in zip(values, b) for _ in range(u)] for b in best]


def pack(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of item indices, as few as the search finds."""
    bins = best_fit_decreasing(sizes, capacity)
    bound = lower_bound(sizes, capacity)
    while len(bins) > bound:
        fill = lambda b: sum(sizes[i] for i in b)
        open_ = sorted((b for b in bins if fill(b) < capacity), key=fill)
        done, carry = [b for b in bins if fill(b) == capacity], []
        at = 0
        while at < len(open_):
            part, n = list(carry), sum(map(len, carry))
            while at < len(open_) and (len(part) < 2 or n + len(open_[at]) <= SEARCH_ITEMS):
                n += len(open_[at])
                part.append(open_[at])
                at += 1
            items = [i for b in part for i in b]
            place_of = {i: k for k, i in enumerate(items)}
            again = bin_completion([sizes[i] for i in items], capacity, [[place_of[i] for i in b] for b in part])
            again = sorted(([items[k] for k in b] for b in again), key=fill)
            carry = again[:1]  # its room meets the next bins
            done += again[1:]
        saved = len(bins) - len(done) - len(carry)
        bins = done + carry
        if saved * 1000 < len(bins):
            break
    return bins


PLACED = PIECES + ", sequence_id long, offset long, fill long"


def _pack_group(capacity: int, level: int):
    def run(key, pdf):
        pdf = pdf.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        sizes = pdf["length"].tolist()
        seq, offset, fill = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        for b, items in enumerate(pack(sizes, capacity)):
            at = 0
            for i in items:
                seq[i], offset[i] = b, at
                at += sizes[i]
            fill[items] = at
        # level, group and bin: numbers of different groups never meet
        base = ((level * (1 << 28)) + int(key[0])) << 28
        out = pdf.drop(columns=["_group"])
        return out.assign(sequence_id=seq + base, offset=offset, fill=fill)

    return run


def place(rows: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of at most ``capacity``."""
    rows = cut(rows)
    full = rows.where(F.col("length") == capacity).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    todo, result, level, was = rows.where(F.col("length") < capacity), full, 1, None
    n = todo.count()
    while n:
        groups = -(-n // group)
        # every row a hash of its own values; equal rows are dealt apart by the salt
        salt = F.monotonically_increasing_id() if level == 1 else F.col("sequence_id")
        dealt = todo.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", salt), F.lit(groups)))
        if level > 1:
            dealt = dealt.drop("sequence_id", "offset", "fill")
        placed = cut(dealt.groupBy("_group").applyInPandas(_pack_group(capacity, level), PLACED))
        good = F.col("fill") >= int(DISSOLVE * capacity)
        first = F.col("offset") == 0
        used, again, n = placed.agg(F.count_if(first), F.count_if(first & ~good), F.count_if(~good)).first()
        if groups == 1 or (was is not None and was - used < groups):
            return result.unionByName(placed.drop("fill"))
        result = result.unionByName(placed.where(good).drop("fill"))
        todo, level, was = placed.where(~good), level + 1, again
    return result


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY,
                   group: int = GROUP, end_id: int = 0) -> DataFrame:
    """One row per piece, with its sequence and its place there."""
    return place(pieces(docs, vocabulary, capacity, end_id), capacity, group)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)
