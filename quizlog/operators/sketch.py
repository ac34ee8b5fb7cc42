"""One-pass profiles from mergeable sketches (A19, A20 at scale).

``profile.describe`` is exact: it writes the distinct values once and looks
ranks up.  Here everything comes from one aggregate over one scan, without a
write, for any number of columns and groups:

* count, mean, squared deviations, min and max, exact and mergeable;
* quantiles from a KLL sketch: a returned value's rank is within
  ``rank_error(k)`` of the asked one with 99 % confidence (0.13 % of the rows
  for the default ``k``), exact while a group has at most ``k`` values;
* the mode from a frequent-items sketch: its count is at most
  ``mode_error(tracked)`` of the rows too high, and exact while the column has
  no more than three quarters of ``tracked`` different values.

A sketch is one row of some tens of kilobytes per column and group, whatever
the number of rows.  Sketches of parts (days, partitions of a table) are
merged by ``merge``, so a profile is kept up to date by adding the new
part's sketch, without reading the old rows.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 4096
TRACKED = 4096


def rank_error(k: int = K) -> float:
    """Rank error of one KLL quantile, as a share of the rows, at 99 %."""
    return 2.296 / k**0.9021


def mode_error(tracked: int = TRACKED) -> float:
    """How much of all rows a frequent value's count may be too high."""
    return 3.5 / tracked


def _one(x: str, k: int, tracked: int) -> Column:
    """Sketch of one column, nulls and NaNs left out."""
    v = F.col(x).cast("double")
    v = F.when(~F.isnan(v), v)
    # the frequent-items aggregate counts nulls, hence its filter
    top = F.expr(f"approx_top_k_accumulate(cast(`{x}` AS double), {tracked}) FILTER (WHERE `{x}` IS NOT NULL AND NOT isnan(cast(`{x}` AS double)))")
    return F.struct(
        F.lit(x).alias("column"),
        F.count(v).alias("n"),
        F.avg(v).alias("mean"),
        (F.var_pop(v) * F.count(v)).alias("m2"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.kll_sketch_agg_double(v, F.lit(k)).alias("kll"),
        top.alias("top"),
    )


def sketch(df: DataFrame, xs: Sequence[str], by: Sequence[str] = (), k: int = K, tracked: int = TRACKED) -> DataFrame:
    """``by, column, n, mean, m2, min, max, kll, top``: one row per group and
    column of ``xs``, from one aggregate."""
    parts = [_one(x, k, tracked).alias(f"_s{i}") for i, x in enumerate(xs)]
    got = df.select(*by, *xs).groupBy(*by).agg(*parts)
    return got.select(*by, F.inline(F.array(*[F.col(f"_s{i}") for i in range(len(xs))])))


def merge(sketches: DataFrame | Sequence[DataFrame], by: Sequence[str] = (), k: int = K, tracked: int = TRACKED) -> DataFrame:
    """Sketches of several parts as the sketch of all their rows.  ``by`` may
    name fewer groups than the parts have: the others are merged too."""
    rows = sketches if isinstance(sketches, DataFrame) else reduce(DataFrame.unionByName, sketches)
    # squared deviations add up around the common mean
    w = Window.partitionBy(*by, "column")
    mean = F.sum(F.col("n") * F.col("mean")).over(w) / F.nullif(F.sum("n").over(w), F.lit(0))
    rows = rows.withColumn("_mean", mean)
    spread = F.col("m2") + F.col("n") * (F.col("mean") - F.col("_mean")) * (F.col("mean") - F.col("_mean"))
    return rows.groupBy(*by, "column").agg(
        F.sum("n").alias("n"),
        F.first("_mean").alias("mean"),
        F.sum(spread).alias("m2"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.kll_merge_agg_double("kll", F.lit(k)).alias("kll"),
        F.expr(f"approx_top_k_combine(top, {tracked})").alias("top"),
    )


def quantile(q: float) -> Column:
    """The value at share ``q`` of a sketch row; null without values."""
    return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("kll", F.lit(float(q))))


def describe(sketches: DataFrame, by: Sequence[str] = (), qs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """count, mean, std (sample), min, quantiles ``p25`` ..., max (A19) and
    mode, mode_share (A20; the smallest of equally frequent values), one row
    per sketch."""
    top = F.expr("approx_top_k_estimate(top, 100)")
    most = F.array_max(F.transform("_top", lambda t: t["count"]))
    mode = F.array_min(F.transform(F.filter("_top", lambda t: t["count"] == F.col("_most")), lambda t: t["item"]))
    rows = sketches.withColumn("_top", F.when(F.col("n") > 0, top)).withColumn("_most", most)
    return rows.select(
        *by, "column",
        F.col("n").alias("count"),
        "mean",
        F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("std"),
        "min",
        *[quantile(q).alias(f"p{round(100 * q)}") for q in qs],
        "max",
        mode.alias("mode"),
        (F.col("_most") / F.col("n")).alias("mode_share"),
    )
