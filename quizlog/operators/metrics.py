"""Evaluation.

All metrics are aggregates.  AUROC is exact with ties: rows are first reduced
to one row per distinct score (a partial aggregate), then the negatives
below each score come from a distributed prefix sum.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import binarize
from .rank import prefix_sums

LOG_FLOOR = -100.0  # the clamp of the binary cross-entropy's log terms


def auroc(
    df: DataFrame, score: str = "prediction", target: str = "target", by: Sequence[str] = ()
) -> DataFrame:
    """Area under the ROC curve, ties counted one half (M6).

    AUC = sum over distinct scores of pos * (neg below + neg / 2) / (P * N).
    Null when a group has only one class (Q21).
    """
    by = list(by)
    y = F.col(target).cast("double")
    per_score = df.where(F.col(score).isNotNull() & F.col(target).isNotNull()).groupBy(*by, score).agg(
        F.sum(y).alias("_pos"), F.sum(1.0 - y).alias("_neg")
    )
    ps = prefix_sums(per_score, [*by, score], {"_cum": "_neg"})
    if by:
        # The prefix runs over (groups, score); remove what earlier groups add.
        start = ps.groupBy(*by).agg(F.min("_cum").alias("_start"))
        # Null group keys are a group like any other.
        same = reduce(lambda a, b: a & b, [F.col(f"ps.{c}").eqNullSafe(F.col(f"st.{c}")) for c in by])
        ps = ps.alias("ps").join(start.alias("st"), same).select("ps.*", "_start").withColumn("_cum", F.col("_cum") - F.col("_start"))
    agg = ps.groupBy(*by).agg(
        F.sum(F.col("_pos") * (F.col("_cum") + 0.5 * F.col("_neg"))).alias("_s"),
        F.sum("_pos").alias("_P"),
        F.sum("_neg").alias("_N"),
    )
    auc = F.when((F.col("_P") > 0) & (F.col("_N") > 0), F.col("_s") / (F.col("_P") * F.col("_N")))
    return agg.select(*by, auc.alias("auc"))


def accuracy(df: DataFrame, score: str = "prediction", target: str = "target", by: Sequence[str] = ()) -> DataFrame:
    """Share of rows whose binarised score (>= 0.5) equals the target (M7)."""
    hit = (binarize(score) == F.col(target)).cast("double")
    return df.groupBy(*by).agg(F.avg(hit).alias("acc"))


def log_loss(df: DataFrame, score: str = "prediction", target: str = "target", by: Sequence[str] = ()) -> DataFrame:
    """Mean binary cross-entropy with both log terms floored at -100 (M8)."""
    p, y = F.col(score).cast("double"), F.col(target).cast("double")

    def floored_log(x: Column) -> Column:
        return F.when(x > 0, F.greatest(F.log(x), F.lit(LOG_FLOOR))).otherwise(F.lit(LOG_FLOOR))

    loss = -(y * floored_log(p) + (1 - y) * floored_log(1 - p))
    return df.groupBy(*by).agg(F.avg(loss).alias("log_loss"))


def soft_vote(fold_preds: DataFrame, id_col: str = "id", score: str = "prediction") -> DataFrame:
    """Mean of the fold predictions per id (M5)."""
    return fold_preds.groupBy(id_col).agg(F.avg(score).alias(score))


def best_candidate(metrics: DataFrame, candidate: str = "candidate", metric: str = "auc") -> DataFrame:
    """The candidate with the highest metric; on ties the smallest candidate
    name wins (M9).  One row."""
    # min over (-metric, candidate): the highest metric, then the smallest name.
    best = metrics.where(F.col(metric).isNotNull()).agg(
        F.min(F.struct((-F.col(metric)).alias("k"), F.col(candidate).alias("c"))).alias("_b")
    )
    return best.select(F.col("_b.c").alias(candidate), (-F.col("_b.k")).alias(metric))
