"""Vocabularies: fit, apply, sizes.

A vocabulary is a DataFrame ``(column string, label string, code int)``.
Codes are 0-based ranks in binary string order and ``unknown`` is an
ordinary member (Q5).  Labels are always compared as strings, so an integer
tag finds its code (Q4).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keyed import BROADCAST_MAX_BYTES, materialize, row_bytes
from .rank import global_rank

CATEGORICAL = ("assessmentItemID", "testId", "KnowledgeTag")
UNKNOWN = "unknown"


def fit_vocabulary(df: DataFrame, columns: Sequence[str] = CATEGORICAL) -> DataFrame:
    """Sorted distinct labels of each column plus ``unknown``.

    The distinct step is a partial aggregate over one scan.  The result is
    materialised in the shared checkpoint folder (it is the reference's saved
    label file).
    """
    # One scan: every row yields one (column, label) pair per column.
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("label")) for c in columns]))
    labels = df.select(pairs.alias("p")).select("p.column", "p.label")
    return vocabulary_from_labels(labels, columns)


def vocabulary_from_labels(labels: DataFrame, columns: Sequence[str] = CATEGORICAL) -> DataFrame:
    """Codes for ``(column, label)`` pairs plus ``unknown`` per column.

    ``labels`` may repeat pairs; it can come from the log or from any table
    that already holds the distinct keys (such as fitted key statistics).  A
    code is the distributed rank in (column, label) order minus the column's
    first rank, whatever the number of labels.
    """
    labels = labels.where(F.col("label").isNotNull())
    unknowns = labels.sparkSession.createDataFrame([(c, UNKNOWN) for c in columns], "column string, label string")
    labels = labels.unionByName(unknowns).distinct()
    ranked = global_rank(labels, ["column", "label"], "_r")
    first = ranked.groupBy("column").agg(F.min("_r").alias("_r0"))  # one row per column
    out = ranked.join(F.broadcast(first), "column").select(
        "column", "label", (F.col("_r") - F.col("_r0")).cast("int").alias("code")
    )
    return materialize(out)


def apply_vocabulary(
    df: DataFrame,
    vocab: DataFrame,
    columns: Sequence[str] = CATEGORICAL,
    suffix: str = "",
    materialized: bool = True,
) -> DataFrame:
    """Replace each column by its code; labels missing from ``vocab`` map to
    the code of ``unknown`` (E2, J5).  With ``suffix`` the codes go to new
    columns ``<col><suffix>`` and the labels stay.  ``vocab`` is a stored
    table (from ``fit_vocabulary`` or ``load_vocabulary``); pass
    ``materialized=False`` for a vocabulary still defined by a plan."""
    if not materialized:
        vocab = materialize(vocab)
    used = vocab.where(F.col("column").isin(list(columns)))
    # The code of ``unknown`` per column, inlined below as a literal, and the
    # size of all columns together, from one job.
    unknown = F.col("label") == UNKNOWN
    codes = [F.max(F.when(unknown & (F.col("column") == c), F.col("code"))).alias(f"_c{i}") for i, c in enumerate(columns)]
    stats = used.agg(F.coalesce(F.sum(row_bytes(used)), F.lit(0)).alias("_bytes"), *codes).first()
    unknown_code = {c: stats[f"_c{i}"] for i, c in enumerate(columns)}
    if missing := [c for c in columns if unknown_code[c] is None]:
        raise ValueError(f"the vocabulary has no column {', '.join(missing)}")
    small = stats["_bytes"] <= BROADCAST_MAX_BYTES
    out = df
    for c in columns:
        v = vocab.where(F.col("column") == c)
        table = v.select(F.col("label").alias("_label"), F.col("code").alias("_code"))
        table = F.broadcast(table) if small else table
        target = f"{c}{suffix}" if suffix else c
        out = (
            out.withColumn("_label", F.col(c).cast("string"))
            .join(table, "_label", "left")
            .withColumn(target, F.coalesce(F.col("_code"), F.lit(unknown_code[c]).cast("int")))
            .drop("_label", "_code")
        )
    return out


def vocabulary_sizes(vocab: DataFrame) -> DataFrame:
    """Number of codes per column, ``unknown`` included."""
    return vocab.groupBy("column").agg(F.count(F.lit(1)).alias("n_codes"))


def save_vocabulary(vocab: DataFrame, path: str) -> None:
    """Write the vocabulary as Parquet partitioned by column."""
    vocab.write.mode("overwrite").partitionBy("column").parquet(path)


def load_vocabulary(spark, path: str) -> DataFrame:
    """Read a vocabulary written by ``save_vocabulary``."""
    return spark.read.parquet(path).select("column", "label", F.col("code").cast("int"))
