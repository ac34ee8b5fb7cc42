"""Token-id output in packed binary matrices (operator 7).

Documents become subword ids plus an end id.  One longer than ``CAPACITY``
is cut losslessly into consecutive pieces.  Each task packs its own pieces
in buffers of ``BUFFER_TOKENS`` ids by best-fit decreasing; the open bin
with the least sufficient room is found in a segment tree over the room
values, in ``log2(capacity)`` steps.  No ids are shuffled: a task reads
texts and writes packed rows, and a buffer's waste is a part of one row.

A packed row holds ``ids`` (``CAPACITY`` little-endian ids, padded),
``cu_seqlens`` (int32 ends of the segments, from 0: the cumulative segment
lengths), ``positions`` (per id, its place in its own document piece; resets
at each segment, 0 in the padding), and which documents' pieces the
segments are.  ``write`` stores the rows as Parquet, ``read_pieces`` reads
them back.

Defined results: a null or empty text is one piece that holds the end id
alone; a null id stays null; repeated rows are separate pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlog.llm import bytetext as B
from quizlog.llm import subwords
from quizlog.llm.shared import batches, scratch_path, table

CAPACITY = 2048
BUFFER_TOKENS = 4 << 20
PAD_ID = 0

PACKED = ("sequence_id long, n_tokens int, ids binary, cu_seqlens binary, positions binary, "
          "doc_ids array<bigint>, pieces array<int>, starts array<bigint>")


class RoomTree:
    """How many open bins have each free room, as a segment tree of counts;
    finds the smallest room of at least a size."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(self.leaves)]

    def _change(self, room: int, by: int) -> None:
        i = self.leaves + room
        while i:
            self.count[i] += by
            i >>= 1

    def add(self, room: int, bin_: int) -> None:
        self.bins[room].append(bin_)
        self._change(room, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """(room, bin) with the least room >= size, removed; None if none."""
        i = self.leaves + size
        if not self.count[i]:
            # climb until a subtree to the right holds a bin
            while i & 1 or not self.count[i + 1]:
                i >>= 1
                if i <= 1:
                    return None
            i += 1
        while i < self.leaves:
            i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.leaves
        self._change(room, -1)
        return room, self.bins[room].pop()


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of indices, each in placement order."""
    tree, bins = RoomTree(capacity), []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        got = tree.take(size)
        if got is None:
            got = (capacity, len(bins))
            bins.append([])
        room, b = got
        bins[b].append(i)
        tree.add(room - size, b)
    return bins


def _rows(ids: np.ndarray, off: np.ndarray, doc: np.ndarray, piece: np.ndarray, start: np.ndarray,
          first: int, capacity: int, id_type: str) -> pa.RecordBatch:
    """Pack pieces ids[off[i]:off[i+1]] into rows."""
    sizes = np.diff(off)
    bins = best_fit_decreasing(sizes, capacity)
    out = {k: [] for k in ("ids", "cu", "pos", "doc", "piece", "start", "n")}
    for b in bins:
        n = sizes[b]
        total = int(n.sum())
        row = np.full(capacity, PAD_ID, id_type)
        row[:total] = np.concatenate([ids[off[i] : off[i + 1]] for i in b])
        cu = np.concatenate([[0], np.cumsum(n)])
        pos = np.zeros(capacity, id_type)
        pos[:total] = np.arange(total) - np.repeat(cu[:-1], n)
        out["ids"].append(row.tobytes())
        out["cu"].append(cu.astype("<i4").tobytes())
        out["pos"].append(pos.tobytes())
        out["doc"].append([None if doc[i] is None else int(doc[i]) for i in b])
        out["piece"].append([int(piece[i]) for i in b])
        out["start"].append([int(start[i]) for i in b])
        out["n"].append(total)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(first, first + len(bins))), pa.array(out["n"], pa.int32()), pa.array(out["ids"], pa.binary()),
         pa.array(out["cu"], pa.binary()), pa.array(out["pos"], pa.binary()), pa.array(out["doc"], pa.list_(pa.int64())),
         pa.array(out["piece"], pa.list_(pa.int32())), pa.array(out["start"], pa.list_(pa.int64()))],
        [c.split()[0] for c in PACKED.split(", ")])


def pack_ids(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = 0,
             buffer_tokens: int = BUFFER_TOKENS, id_type: str = "<u2") -> DataFrame:
    """Packed rows of all documents (columns of ``PACKED``).  ``id_type`` is
    the ids' and positions' number type; ``<u2`` holds ids below 65,536."""
    path = vocabulary or subwords.default_path()
    if capacity > np.iinfo(id_type).max + 1:
        raise ValueError(f"positions up to {capacity - 1} do not fit {id_type}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        next_row = TaskContext.get().partitionId() << 33
        held: list[tuple] = []
        n_held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, n_held, next_row
            if held:
                ids = np.concatenate([h[0] for h in held])
                sizes = np.concatenate([h[1] for h in held])
                off = np.concatenate([[0], np.cumsum(sizes)])
                doc = [d for h in held for d in h[2]]
                piece, start = (np.concatenate([h[k] for h in held]) for k in (3, 4))
                got = _rows(ids, off, doc, piece, start, next_row, capacity, id_type)
                next_row += got.num_rows
                held, n_held = [], 0
                for i in range(0, got.num_rows, 1024):
                    yield got.slice(i, 1024)

        for batch in batches:
            for part in B.slices(batch, "text"):
                ids, off = subwords.document_ids(part.column(1), path, end_id)
                if ids.size and int(ids.max()) > np.iinfo(id_type).max:
                    raise ValueError(f"an id does not fit {id_type}")
                lens = np.diff(off)
                n = -(-lens // capacity)
                doc = np.repeat(np.arange(lens.size), n)
                piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                names = part.column(0).to_pylist()
                held.append((ids.astype(id_type), np.minimum(capacity, lens[doc] - start), [names[i] for i in doc], piece, start))
                n_held += ids.size
                if n_held >= buffer_tokens:
                    yield from flush()
        yield from flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").transform(batches, run, PACKED)


def write(packed: DataFrame, path: str) -> None:
    packed.write.option("compression", "zstd").parquet(path)


PIECE = ("doc_id long, piece int, start long, length long, ids_crc32 long, positions_ok boolean, "
         "sequence_id long, offset long, n_segments int")


def read_pieces(spark: SparkSession, path: str, id_type: str = "<u2") -> DataFrame:
    """One row per piece, read back from the packed matrices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                ids, pos = np.frombuffer(r["ids"], id_type), np.frombuffer(r["positions"], id_type)
                cu = np.frombuffer(r["cu_seqlens"], "<i4").tolist()
                for k, (a, b) in enumerate(zip(cu, cu[1:])):
                    crc = zlib.crc32(ids[a:b].astype("<u4").tobytes())
                    ok = bool((pos[a:b] == np.arange(b - a)).all())
                    rows.append((r["doc_ids"][k], r["pieces"][k], r["starts"][k], b - a, crc, ok, r["sequence_id"], a, len(cu) - 1))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32()]
            cols = list(zip(*rows)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [c.split()[0] for c in PIECE.split(", ")])

    return spark.read.schema(PACKED).parquet(path).transform(batches, run, PIECE)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the packed matrices of all documents to the shared folder and
    returns what they hold, one row per piece."""
    path = scratch_path(spark)
    write(pack_ids(table(spark, sf_dir, "documents")), path)
    return read_pieces(spark, path)
