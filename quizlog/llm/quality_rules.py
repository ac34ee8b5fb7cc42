"""Quality rules (operator 10): fixed counting rules, and a hashed word and
character n-gram logistic regression trained on labelled rows.

Features of a text: word unigrams and bigrams and character 3- and 4-grams,
hashed into ``BUCKETS`` bins, ``log(1 + count)`` and scaled to unit length.
The model is fitted in numpy on at most ``TRAIN_ROWS`` labelled rows of each
class (a documented bound; the rows with the smallest hash of their id, so
the choice does not depend on file order), and calibrated (Platt) on a
quarter of them that the fit never saw, weighted back to the labels' real
class shares.  All rows are scored in Arrow batches against the fixed
threshold ``KEEP_AT``.

Defined results: a null or empty text has no words and fails the rules.
Without labels of both classes there is no model and the rules alone decide
(probability null).  Conflicting labels of one id: the smallest counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlog.llm import bytetext as B
from quizlog.llm.shared import batches, table

BUCKETS = 1 << 14
TRAIN_ROWS = 1500
KEEP_AT = 0.5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
CHUNK_ROWS = 128  # training rows at a time
FEATURE_BYTES = 256 << 10  # text per slice: its features take about 200 times as much memory
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1
_ODD = [B.U64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def _window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of h[i:i+n] for every i (ordered)."""
    out = np.zeros(max(0, h.size - n + 1), B.U64)
    for k in range(n):
        out += B.mix(h[k : k + out.size] + _ODD[k])  * _ODD[(k + 2) % 5]
    return B.mix(out)


def rule_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words per text."""
    raw, off = B.buffers(texts)
    w = B.scan(texts, B.RAW_WORDS)
    in_word = (w.data != 32) & ((raw & 0xC0) != 0x80)
    out = {
        "n_words": w.counts.astype(np.int64),
        "word_chars": B.per_text(in_word, off),
        "n_symbols": B.per_text(_SYMBOL[raw], off),
    }
    h = B.word_hashes(w)
    text_of = w.text_of_word()
    n = WINDOW
    rep = np.zeros(h.size, bool)
    if h.size >= n:
        whole = text_of[: h.size - n + 1] == text_of[n - 1 :]
        at = np.flatnonzero(whole)
        keys = B.mix(_window_hashes(h, n)[at] + text_of[at].astype(B.U64) * _ODD[0])
        order = np.argsort(keys, kind="stable")
        k = keys[order]
        twice = np.zeros(k.size, bool)
        same = k[1:] == k[:-1]
        twice[1:] |= same
        twice[:-1] |= same
        covered = np.zeros(h.size + 1, np.int64)
        hit = at[order[twice]]
        np.add.at(covered, hit, 1)
        np.add.at(covered, hit + n, -1)
        rep = np.cumsum(covered)[:-1] > 0
    out["n_repeat_words"] = B.per_text(rep, w.first)
    # lines: cut at \n and at text ends; a line counts if a word starts in it
    breaks = np.flatnonzero(raw == 10)
    start = np.sort(np.concatenate([off[:-1], breaks + 1]), kind="stable")
    order_text = np.searchsorted(off[1:], start, side="right")
    # the starts of empty texts stand at the next text's start: such lines hold nothing
    end = np.append(start[1:], raw.size)
    end = np.minimum(end, np.where(np.isin(end - 1, breaks) & (end > start), end - 1, end))
    words_in = np.searchsorted(w.start, end) - np.searchsorted(w.start, start)
    live = np.flatnonzero((words_in > 0) & (end > start))
    dup = np.zeros(len(off) - 1, np.int64)
    if live.size:
        keys = B.mix(B.range_hashes(raw, start[live], end[live]) + order_text[live].astype(B.U64) * _ODD[1])
        order = np.argsort(keys, kind="stable")
        again = np.concatenate([[False], keys[order][1:] == keys[order][:-1]])
        dup = np.bincount(order_text[live][order[again]], minlength=len(off) - 1).astype(np.int64)
    out["n_dup_lines"] = dup
    return out


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])


def features(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows: (row, bucket, value), row-major, unit length."""
    raw, off = B.buffers(texts)
    w = B.scan(texts, B.RAW_WORDS)
    h = B.word_hashes(w)
    text_of = w.text_of_word()
    rows, keys = [text_of], [h]
    if h.size > 1:
        ok = np.flatnonzero(text_of[1:] == text_of[:-1])
        rows.append(text_of[ok])
        keys.append(_window_hashes(h, 2)[ok])
    byte_text = np.repeat(np.arange(len(off) - 1), np.diff(off))
    wide = raw.astype(B.U64)
    for n in (3, 4):
        if raw.size < n:
            continue
        gram = np.full(raw.size - n + 1, B.U64(n) << B.U64(56), B.U64)
        for k in range(n):
            gram |= wide[k : k + gram.size] << B.U64(8 * k)
        ok = np.flatnonzero(byte_text[: gram.size] == byte_text[n - 1 :])
        rows.append(byte_text[ok])
        keys.append((gram[ok] * _ODD[2]) ^ (gram[ok] >> B.U64(17)))
    row = np.concatenate(rows)
    if not row.size:
        return row, row, np.zeros(0, np.float32)
    bucket = (np.concatenate(keys) * _ODD[0] >> B.U64(64 - buckets.bit_length() + 1)).astype(np.int64)
    cell, count = np.unique(row * buckets + bucket, return_counts=True)
    row, value = cell // buckets, np.log1p(count)
    norm = np.sqrt(np.bincount(row, value * value, minlength=len(off) - 1))
    return row, cell % buckets, (value / norm[row]).astype(np.float32)


def fit(first: np.ndarray, col: np.ndarray, val: np.ndarray, y: np.ndarray, weight: np.ndarray,
        buckets: int = BUCKETS, steps: int = 150, l2: float = 1e-5) -> dict:
    """Logistic regression by full-batch Adam, class-balanced, then Platt
    scaling on every fourth row of each class with the true class weights.
    Row i holds col[first[i]:first[i+1]]; rows go through in chunks, so the
    fit needs little more memory than its input."""
    place = np.zeros(y.size, np.int64)
    for c in (0, 1):
        place[y == c] = np.arange((y == c).sum())
    held = place % 4 == 3
    if not (held & (y == 1)).any() or not (held & (y == 0)).any():
        held = np.zeros(y.size, bool)
    share = np.where(y == 1, 0.5 / max(1, (y[~held] == 1).sum()), 0.5 / max(1, (y[~held] == 0).sum())) * ~held
    chunks = []
    for i in range(0, y.size, CHUNK_ROWS):
        f = first[i : i + CHUNK_ROWS + 1]
        chunks.append((slice(i, i + f.size - 1), slice(int(f[0]), int(f[-1])), f - f[0]))

    beta, bias = np.zeros(buckets, np.float32), 0.0
    m, s = np.zeros(buckets + 1), np.zeros(buckets + 1)
    for t in range(1, steps + 1):
        grad = np.append(l2 * beta.astype(float), 0.0)
        for rows, cells, f in chunks:
            if not share[rows].any():
                continue
            c, v = col[cells], val[cells]
            z = B.per_text(v * beta[c], f, np.float64) + bias
            g = (1 / (1 + np.exp(-z)) - y[rows]) * share[rows]
            grad[:-1] += np.bincount(c, v * np.repeat(g, np.diff(f)), buckets)
            grad[-1] += g.sum()
        m = 0.9 * m + 0.1 * grad
        s = 0.999 * s + 0.001 * grad * grad
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-12)
        beta -= step[:-1].astype(np.float32)
        bias -= step[-1]
    z = np.concatenate([B.per_text(val[cells] * beta[col[cells]], f, np.float64) + bias for _, cells, f in chunks])
    cal = held if held.any() else ~held
    a, b = 1.0, 0.0
    zc, yc, wc = z[cal], y[cal], weight[cal] / weight[cal].sum()
    soft = np.where(yc == 1, ((yc == 1).sum() + 1) / ((yc == 1).sum() + 2), 1 / ((yc == 0).sum() + 2))

    def loss(a: float, b: float) -> float:
        t = a * zc + b
        return float((wc * (np.logaddexp(0, t) - soft * t)).sum())

    for _ in range(100):  # Newton on two parameters, targets smoothed as by Platt
        p = 1 / (1 + np.exp(-np.clip(a * zc + b, -30, 30)))
        g = np.array([(wc * (p - soft) * zc).sum(), (wc * (p - soft)).sum()])
        if np.abs(g).max() < 1e-9:
            break
        q = wc * p * (1 - p)
        hess = np.array([[(q * zc * zc).sum(), (q * zc).sum()], [(q * zc).sum(), q.sum()]]) + 1e-10 * np.eye(2)
        d, now, part = np.linalg.solve(hess, g), loss(a, b), 1.0
        while part > 1e-8 and loss(a - part * d[0], b - part * d[1]) > now - 1e-4 * part * float(g @ d):
            part /= 2
        a, b = a - part * d[0], b - part * d[1]
    return {"beta": beta.astype(np.float32), "bias": float(bias), "a": float(a), "b": float(b)}


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, buckets: int = BUCKETS) -> dict | None:
    """Fit on at most ``rows`` labelled documents of each class; None if a
    class is missing."""
    lab = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("y"))
    size = {r["y"]: r["n"] for r in lab.groupBy("y").agg(F.count("*").alias("n")).collect()}
    picked = None
    for c in (0, 1):
        some = lab.where(F.col("y") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        picked = some if picked is None else picked.unionByName(some)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in B.slices(batch, "text", FEATURE_BYTES):
                row, col, val = features(part.column(2), buckets)
                cuts = np.searchsorted(row, np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1),
                     pa.array([col[i:j].astype("<u4").tobytes() for i, j in zip(cuts, cuts[1:])], pa.binary()),
                     pa.array([val[i:j].astype("<f4").tobytes() for i, j in zip(cuts, cuts[1:])], pa.binary())],
                    ["doc_id", "y", "col", "val"])

    # at most 2 * rows ids: a fixed bound, so the join may broadcast them
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(picked.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("y").cast("int").alias("y"))), "doc_id"
    ).select("doc_id", "y", "text").transform(batches, run, "doc_id long, y int, col binary, val binary")
    # rows that repeat an id count once, so the bound holds
    got = found.groupBy("doc_id", "y").agg(F.min(F.struct("col", "val")).alias("f")).select(
        "doc_id", "y", "f.col", "f.val").toArrow().sort_by("doc_id").combine_chunks()
    y = got.column("y").to_numpy().astype(np.int64)
    if len(set(y.tolist())) < 2:
        return None
    col, off = B.buffers(got.column("col"))
    val, _ = B.buffers(got.column("val"))
    weight = np.array([size[c] for c in (0, 1)], float)[y] / np.bincount(y, minlength=2)[y]
    return fit(off // 4, col.view("<u4").astype(np.int32), val.view("<f4"), y, weight, buckets)


RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, quality_probability double, kept boolean")


def score(docs: DataFrame, model: dict | None, keep_at: float = KEEP_AT, passing: list[str] | None = None) -> DataFrame:
    """Rule counts, calibrated probability and verdict of every row, beside
    the columns named in ``passing`` (``doc_id`` by default)."""
    passing = passing or ["doc_id"]
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # BUCKETS floats, a fixed size
    schema = docs.select(*[F.col(f"`{c}`") for c in passing]).schema.simpleString()[len("struct<"):-1]
    names = [p.strip().split()[0] for p in RESULT.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in B.slices(batch, "_text", FEATURE_BYTES):
                texts = part.column(part.num_columns - 1)
                counts = rule_counts(texts)
                failed = base_failed(counts)
                if m is None:
                    prob, kept = pa.nulls(part.num_rows, pa.float64()), ~failed
                else:
                    row, col, val = features(texts, m["beta"].size)
                    z = np.bincount(row, val * m["beta"][col], minlength=part.num_rows) + m["bias"]
                    p = 1 / (1 + np.exp(-np.clip(m["a"] * z + m["b"], -30, 30)))
                    prob, kept = pa.array(p), ~failed & (p >= keep_at)
                cols = [counts["n_words"], counts["word_chars"], counts["n_symbols"], counts["n_dup_lines"], counts["n_repeat_words"], failed]
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(part.num_columns - 1)] + [pa.array(c) for c in cols] + [prob, pa.array(kept)],
                    part.schema.names[:-1] + names)

    chosen = docs.select(*[F.col(f"`{c}`") for c in passing], F.col("text").alias("_text"))
    return chosen.transform(batches, run, ", ".join([_ddl(docs, c) for c in passing]) + ", " + RESULT)


def _ddl(df: DataFrame, name: str) -> str:
    return f"`{name}` {df.schema[name].dataType.simpleString()}"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and reach the threshold stay."""
    return filter_documents(docs, train(docs, table(spark, sf_dir, "labels")))


def filter_documents(docs: DataFrame, model: dict | None, keep_at: float = KEEP_AT) -> DataFrame:
    """The rows of ``docs``, unchanged, that the rules and the model keep."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            named = batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])
            for part in B.slices(named, f"c{at}", FEATURE_BYTES):
                texts = part.column(at)
                kept = ~base_failed(rule_counts(texts))
                if m is not None:
                    row, col, val = features(texts, m["beta"].size)
                    z = np.bincount(row, val * m["beta"][col], minlength=part.num_rows) + m["bias"]
                    kept &= 1 / (1 + np.exp(-np.clip(m["a"] * z + m["b"], -30, 30))) >= keep_at
                yield part.filter(pa.array(kept)).rename_columns(batch.schema.names)

    return docs.transform(batches, run, docs.schema)
