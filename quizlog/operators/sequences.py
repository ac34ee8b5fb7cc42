"""Per-sequence arrays: truncate, collect, pad, mask, shift.

A sequence is one row per ``seq`` key with aligned arrays in time order.
Rows are cut to the most recent ``max_len`` *before* they are collected
(O3), so no array ever holds more than ``max_len`` entries; Spark plans the
``row_number() <= N`` filter as a per-partition group limit ahead of the
shuffle, so a very long history sends at most N rows per map task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Sequence field name -> source column, in the reference's tuple order.
SEQ_FIELDS = {"test": "testId", "question": "assessmentItemID", "tag": "KnowledgeTag", "correct": "answerCode"}
CONT_COLS = ("test_mean", "assessment_mean", "tag_mean")


def _field(name):
    return lambda r: r[name]


def keep_last(
    df: DataFrame, n: int, seq: str = "userID", ts: str = "Timestamp", tie: str = "event_id"
) -> DataFrame:
    """Most recent ``n`` rows of each sequence (O3, Y2)."""
    w = Window.partitionBy(seq).orderBy(F.col(ts).desc(), F.col(tie).desc())
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def collect_sequences(
    df: DataFrame,
    seq: str = "userID",
    max_len: int = 20,
    fields: dict[str, str] | None = None,
    conts: Sequence[str] | None = None,
    ts: str = "Timestamp",
    tie: str = "event_id",
    keep: Sequence[str] = (),
    is_cut: bool = False,
) -> DataFrame:
    """One row per ``seq``: arrays of ``fields`` in (ts, tie) order (Y1, Y8),
    holding the most recent ``max_len`` rows (default 20, the reference's
    ``max_seq_len``).

    With ``conts`` a ``conts array<array<float>>`` column holds one vector of
    the continuous columns per position.  ``keep`` names per-sequence columns
    (constant within a sequence) to carry along.  ``is_cut`` says that
    ``keep_last`` was applied before (and the survivors enriched since).
    """
    if not max_len or max_len < 1:
        # A whole history would land in one row of one task; use the sliding
        # windows of ``augment`` to cover every row in groups of at most N.
        raise ValueError("max_len must be >= 1")
    fields = fields or SEQ_FIELDS
    if not is_cut:
        df = keep_last(df, max_len, seq, ts, tie)
    parts = [F.col(ts).alias("_ts"), F.col(tie).alias("_tie")]
    parts += [F.col(src).alias(name) for name, src in fields.items()]
    if conts:
        parts.append(F.array(*[F.col(c).cast("float") for c in conts]).alias("conts"))
    rows = F.array_sort(F.collect_list(F.struct(*parts))).alias("_rows")
    g = df.groupBy(seq, *keep).agg(rows)
    out = [F.col(seq), *[F.col(k) for k in keep]]
    out += [F.transform("_rows", _field(name)).alias(name) for name in fields]
    if conts:
        out.append(F.transform("_rows", lambda r: r["conts"]).alias("conts"))
    return g.select(*out)


def _left_pad(arr: Column, n: int, fill: Column) -> Column:
    return F.concat(F.array_repeat(fill, F.lit(n) - F.size(arr)), arr)


def pad_sequences(seqs: DataFrame, n: int, fields: Sequence[str] = tuple(SEQ_FIELDS), n_cont: int | None = None) -> DataFrame:
    """Left-pad every array to exactly ``n`` (Y4) and add the right-aligned
    validity ``mask array<tinyint>`` (Y3).  Arrays longer than ``n`` keep
    their last ``n`` entries (Y2)."""
    cut = {f: F.when(F.size(f) > n, F.slice(f, -n, n)).otherwise(F.col(f)) for f in fields}
    has_conts = "conts" in seqs.columns
    if has_conts:
        cut["conts"] = F.when(F.size("conts") > n, F.slice("conts", -n, n)).otherwise(F.col("conts"))
    s = seqs.select(*[c for c in seqs.columns if c not in cut], *[v.alias(k) for k, v in cut.items()])
    length = F.size(fields[0])
    out = [F.col(c) for c in s.columns if c not in cut]
    for f in fields:
        out.append(_left_pad(F.col(f), n, F.lit(0).cast(s.schema[f].dataType.elementType)).alias(f))
    if has_conts:
        width = n_cont if n_cont is not None else len(CONT_COLS)
        zero_vec = F.array_repeat(F.lit(0.0).cast("float"), width)
        out.append(_left_pad(F.col("conts"), n, zero_vec).alias("conts"))
    mask = F.concat(
        F.array_repeat(F.lit(0).cast("tinyint"), F.lit(n) - length), F.array_repeat(F.lit(1).cast("tinyint"), length)
    )
    out.append(mask.alias("mask"))
    return s.select(*out)


def model_input(seqs: DataFrame, n: int, n_cont: int | None = None) -> DataFrame:
    """Model input row per sequence (Y5-Y7) from unpadded code arrays.

    ``test/question/tag`` are ``code + 1`` with 0 for padding (Y6);
    ``interaction`` is the previous answer + 1, 0 at the first kept position
    and on padding (Y5, Q6); ``correct`` and ``mask`` are float arrays;
    ``gather_index`` is the last valid position (Y7).
    """
    trimmed = seqs
    for f in list(SEQ_FIELDS) + (["conts"] if "conts" in seqs.columns else []):
        trimmed = trimmed.withColumn(f, F.when(F.size(f) > n, F.slice(f, -n, n)).otherwise(F.col(f)))
    length = F.size("correct")
    shifted = {f: F.transform(f, lambda x: x + 1) for f in ("test", "question", "tag")}
    inter = F.concat(F.array(F.lit(0)), F.slice(F.transform("correct", lambda x: x + 1), 1, length - 1))
    cols = [F.col(c) for c in trimmed.columns if c not in (*SEQ_FIELDS, "conts")]
    for f, v in shifted.items():
        cols.append(_left_pad(v, n, F.lit(0)).alias(f))
    cols.append(_left_pad(F.transform("correct", lambda x: x.cast("float")), n, F.lit(0.0).cast("float")).alias("correct"))
    cols.append(
        F.concat(
            F.array_repeat(F.lit(0.0).cast("float"), F.lit(n) - length),
            F.array_repeat(F.lit(1.0).cast("float"), length),
        ).alias("mask")
    )
    cols.append(_left_pad(inter, n, F.lit(0)).alias("interaction"))
    cols.append((length - 1).cast("int").alias("gather_index"))
    if "conts" in trimmed.columns:
        width = n_cont if n_cont is not None else len(CONT_COLS)
        cols.append(_left_pad(F.col("conts"), n, F.array_repeat(F.lit(0.0).cast("float"), width)).alias("conts"))
    return trimmed.select(*cols)


def last_position(arr: str | Column) -> Column:
    """Element at the last position of an array (O2)."""
    return F.element_at(F.col(arr) if isinstance(arr, str) else arr, -1)
