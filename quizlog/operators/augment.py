"""Window augmentation of sequences.

Windows are built in row form: every row learns its 0-based position ``p``
and its sequence length ``L`` (from ``ordered_scan``), is sent to the windows
that contain it, and rows are then grouped by (sequence, window).  A group
never holds more than ``n`` rows, however long the history is, and no
sequence is ever collected whole.

Randomness is replaced by md5 of (sequence, window/draw, copy, position,
seed): reproducible on any partitioning (Q17).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sequences import SEQ_FIELDS
from .windows import ordered_scan


def _field(name):
    return lambda r: r[name]


def _positions(df: DataFrame, seq: str, ts: str, tie: str, scan_kw: dict | None = None) -> DataFrame:
    # a row without a sequence is in no window
    s = ordered_scan(df.where(F.col(seq).isNotNull()), value=None, user=seq, ts=ts, tie=tie, **(scan_kw or {}))
    return s.withColumn("_p", (F.col("_rn") - 1).cast("long")).withColumn("_L", F.col("_len").cast("long"))


def hash_int(*parts: Column | str) -> Column:
    """Non-negative 32-bit integer from md5 of the parts joined by ``|``."""
    s = F.concat_ws("|", *[F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("long")


def _collect(rows: DataFrame, keys: Sequence[str], order: Column, fields: dict[str, str], ts: str, tie: str) -> DataFrame:
    parts = [order.alias("_o"), F.col(tie).alias("event_id_"), *[F.col(src).alias(name) for name, src in fields.items()]]
    g = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*parts))).alias("_rows"))
    out = [F.col(k) for k in keys]
    out.append(F.transform("_rows", lambda r: r["event_id_"]).alias("event_ids"))
    out += [F.transform("_rows", _field(name)).alias(name) for name in fields]
    return g.select(*out)


def sliding_windows(
    df: DataFrame,
    n: int = 20,
    stride: int = 1,
    shuffle: bool = False,
    shuffle_n: int = 2,
    seed: int = 0,
    seq: str = "userID",
    fields: dict[str, str] | None = None,
    ts: str = "Timestamp",
    tie: str = "event_id",
    scan_kw: dict | None = None,
) -> DataFrame:
    """Sliding windows of size ``n`` and step ``stride`` (G1), the tail window
    when the steps miss the end (G2), and with ``shuffle`` the shuffled
    copies (G3, Q13).  A sequence of at most ``n`` rows stays one window.

    Output: ``seq, window, copy`` (``-1`` = not shuffled), ``event_ids`` and
    one array per field.  The tail window has index ``T`` (number of full
    windows).  ``scan_kw`` tunes the hot-learner split of ``ordered_scan``.
    """
    if stride < 1:
        raise ValueError("stride must be >= 1 (Q12)")
    fields = fields or SEQ_FIELDS
    r = _positions(df, seq, ts, tie, scan_kw)
    p, L = F.col("_p"), F.col("_L")
    long_seq = L > n
    T = F.when(long_seq, F.floor((L - n) / stride) + 1).otherwise(F.lit(1))
    lo = F.when(long_seq, F.greatest(F.lit(0), F.ceil((p - n + 1) / stride))).otherwise(F.lit(0))
    hi = F.when(long_seq, F.least(T - 1, F.floor(p / stride))).otherwise(F.lit(0))
    has_tail = long_seq & (L != F.lit(n) + F.lit(stride) * (T - 1))
    regular = F.when(lo <= hi, F.sequence(lo.cast("long"), hi.cast("long"))).otherwise(F.array().cast("array<long>"))
    wins = F.when(has_tail & (p >= L - n), F.concat(regular, F.array(T.cast("long")))).otherwise(regular)
    r = r.withColumn("_T", T.cast("long")).withColumn("window", F.explode(wins))
    is_tail = has_tail & (F.col("window") == F.col("_T"))
    pos = F.when(is_tail, p - (L - n)).otherwise(p - F.col("window") * stride)
    r = r.withColumn("_pos", pos)
    shuffled = F.lit(shuffle) & long_seq & (F.col("window") < F.col("_T") - 1) & ~is_tail
    copies = F.when(shuffled, F.sequence(F.lit(0), F.lit(shuffle_n - 1))).otherwise(F.array(F.lit(-1)))
    r = r.withColumn("copy", F.explode(copies))
    key = F.when(
        F.col("copy") >= 0, F.md5(F.concat_ws("|", F.col(seq).cast("string"), "window", "copy", "_pos", F.lit(str(seed))))
    ).otherwise(F.lpad(F.col("_pos").cast("string"), 12, "0"))
    return _collect(r, [seq, "window", "copy"], key, fields, ts, tie)


def crop_windows(
    df: DataFrame,
    n: int = 20,
    crop_type: str = "tiled",
    seed: int = 0,
    add_tail: bool = False,
    seq: str = "userID",
    fields: dict[str, str] | None = None,
    ts: str = "Timestamp",
    tie: str = "event_id",
    scan_kw: dict | None = None,
) -> DataFrame:
    """Cropped windows of size ``n`` (G4-G6).  Sequences of at most ``n`` rows
    stay whole.

    * ``tiled``: starts 0, n, 2n, ...; the last tile may be short (G4).
    * ``random``: ``L // n + 1`` draws from ``[0, L - n]``, distinct (G5).
    * any other value: draws from ``[1 - n, L - 2]``, a crop may overhang
      either end and is clipped to the sequence (G6).

    The tail crop starting at ``L - n`` is added only with ``add_tail`` (Q14).
    Output: ``seq, start, event_ids`` and one array per field.
    """
    fields = fields or SEQ_FIELDS
    r = _positions(df, seq, ts, tie, scan_kw)
    p, L = F.col("_p"), F.col("_L")
    block = F.floor(p / n)
    if crop_type == "tiled":
        start = F.when(L > n, block * n).otherwise(F.lit(0))
        starts = F.array(start.cast("long"))
        if add_tail:
            tail = L - n
            in_tail = (L > n) & (p >= tail) & (F.pmod(tail, F.lit(n)) != 0)
            starts = F.when(in_tail, F.concat(starts, F.array(tail.cast("long")))).otherwise(starts)
        r = r.withColumn("start", F.explode(starts))
        return _collect(r, [seq, "start"], F.col("_p"), fields, ts, tie)

    # Random starts: one small row per draw, then an equi-join on
    # (sequence, block): a crop of length n touches at most two blocks.
    lengths = df.where(F.col(seq).isNotNull()).groupBy(seq).agg(F.count(F.lit(1)).alias("_L"))
    draws = lengths.where(F.col("_L") > n).withColumn("_j", F.explode(F.sequence(F.lit(0), F.floor(F.col("_L") / n))))
    h = hash_int(seq, "_j", F.lit(seed))
    if crop_type == "random":
        start = F.pmod(h, F.col("_L") - n + 1)
    else:
        start = F.lit(1 - n) + F.pmod(h, F.col("_L") + n - 2)
    starts = draws.select(seq, start.alias("start"), "_L")
    if add_tail:
        starts = starts.unionByName(lengths.where(F.col("_L") > n).select(seq, (F.col("_L") - n).alias("start"), "_L"))
    starts = starts.select(seq, "start").distinct()
    by_block = starts.withColumn(
        "_blk", F.explode(F.array_distinct(F.array(F.floor(F.col("start") / n), F.floor((F.col("start") + n - 1) / n))))
    )
    # A short sequence is one crop that starts at 0, found by the same join.
    short = lengths.where(F.col("_L") <= n).select(
        seq, F.lit(0).cast("long").alias("start"), F.explode(F.sequence(F.lit(0), F.floor((F.col("_L") - 1) / n))).alias("_blk")
    )
    crops = by_block.select(seq, F.col("start").cast("long"), "_blk").unionByName(short.select(seq, "start", "_blk"))
    rows = r.withColumn("_blk", block).join(crops, [seq, "_blk"], "inner").where((p >= F.col("start")) & (p < F.col("start") + n))
    return _collect(rows, [seq, "start"], F.col("_p"), fields, ts, tie)


def augment(df: DataFrame, kind: str, **kw) -> DataFrame:
    """Dispatch (G7): ``slide`` -> ``sliding_windows``, ``crop`` ->
    ``crop_windows``.  Apply to training sequences only."""
    if kind == "slide":
        return sliding_windows(df, **kw)
    if kind == "crop":
        return crop_windows(df, **kw)
    raise ValueError(f"unknown augmentation {kind!r}")
