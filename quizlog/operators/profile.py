"""Column profiles.

Exact quantiles without collecting the column: values are reduced to a
histogram of distinct values (a partial aggregate), a distributed prefix
sum gives each distinct value its rank range, and the few ranks a quantile
needs are looked up in that table.  Quantiles interpolate linearly between
the two neighbouring ranks, like a pandas ``describe``.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import in_int_range
from .keyed import materialize
from .rank import prefix_sums

BAND_Z = 1.96


def value_histogram(df: DataFrame, x: str) -> DataFrame:
    """``(x, cnt, before)``: count of each distinct non-null value and the
    number of values strictly below it."""
    h = df.where(F.col(x).isNotNull()).groupBy(x).agg(F.count(F.lit(1)).alias("cnt"))
    return prefix_sums(h, [x], {"before": "cnt"})


def exact_quantiles(
    df: DataFrame, x: str, qs: Sequence[float], names: Sequence[str] | None = None, hist: DataFrame | None = None
) -> DataFrame:
    """One row with the linearly interpolated quantiles of ``x``; ``hist`` is
    its materialised ``value_histogram`` if the caller has it."""
    names = list(names or [f"q{int(round(q * 100))}" for q in qs])
    # Used three times below: written once (at most one row per distinct value).
    hist = materialize(value_histogram(df, x)) if hist is None else hist
    n = hist.agg(F.sum("cnt").alias("_n"))
    spark = df.sparkSession
    qdf = spark.createDataFrame([(nm, float(q)) for nm, q in zip(names, qs)], "qname string, q double")
    pos = F.col("q") * (F.col("_n") - 1)
    need = qdf.crossJoin(n).select(
        "qname",
        F.floor(pos).alias("_lo"),
        F.least(F.floor(pos) + 1, F.col("_n") - 1).alias("_hi"),
        (pos - F.floor(pos)).alias("_frac"),
    )
    # ``need`` has two rows per quantile: broadcast it against the histogram.
    def value_at(rank_col: str, out: str) -> DataFrame:
        cond = (F.col(rank_col) >= F.col("before")) & (F.col(rank_col) < F.col("before") + F.col("cnt"))
        return F.broadcast(need).join(hist, cond).select("qname", F.col(x).cast("double").alias(out))

    lo = value_at("_lo", "_vlo")
    hi = value_at("_hi", "_vhi")
    v = need.join(lo, "qname").join(hi, "qname").select(
        "qname", (F.col("_vlo") + F.col("_frac") * (F.col("_vhi") - F.col("_vlo"))).alias("v")
    )
    return v.groupBy().pivot("qname", names).agg(F.first("v"))


def describe(df: DataFrame, x: str) -> DataFrame:
    """count, mean, std (sample), min, 25%, 50%, 75%, max of ``x``."""
    base = df.agg(
        F.count(x).alias("count"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.min(x).cast("double").alias("min"),
        F.max(x).cast("double").alias("max"),
    )
    q = exact_quantiles(df, x, [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
    return base.crossJoin(q).select("count", "mean", "std", "min", "p25", "p50", "p75", "max")


def mode_value(df: DataFrame, x: str, hist: DataFrame | None = None) -> DataFrame:
    """Most frequent value, the smallest on ties (A20, Q11), and its share of
    the non-null rows.  One row: ``mode, mode_share``."""
    counts = df.where(F.col(x).isNotNull()).groupBy(x).agg(F.count(F.lit(1)).alias("cnt")) if hist is None else hist
    # min over (-count, value) picks the highest count, then the smallest value.
    best = counts.agg(F.min(F.struct((-F.col("cnt")).alias("k"), F.col(x).alias("v"))).alias("_m"), F.sum("cnt").alias("_n"))
    return best.select(F.col("_m.v").alias("mode"), (-F.col("_m.k") / F.col("_n")).alias("mode_share"))


def mode_median_share(df: DataFrame, x: str) -> DataFrame:
    """mode, median and the share of rows equal to the mode (A20), all from
    one histogram of the values."""
    hist = materialize(value_histogram(df, x))
    med = exact_quantiles(df, x, [0.5], ["median"], hist)
    return mode_value(df, x, hist).crossJoin(med).select(F.col("mode").cast("double").alias("mode"), "median", "mode_share")


def _band_bounds(df: DataFrame, x: str, methods: Sequence[str]) -> DataFrame:
    """``method, lower, upper``: one row per method, from one row of moments
    and (for median and mode) one histogram."""
    moments = df.agg(F.stddev_samp(x).alias("_s"), F.avg(x).alias("_mean"))
    centres = moments
    if set(methods) - {"mean"}:
        hist = materialize(value_histogram(df, x))
        if "median" in methods:
            centres = centres.crossJoin(exact_quantiles(df, x, [0.5], ["_median"], hist))
        if "mode" in methods:
            centres = centres.crossJoin(mode_value(df, x, hist).select(F.col("mode").cast("double").alias("_mode")))
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("method"), F.col(f"_{m}").alias("_c")) for m in methods]))
    return centres.select("_s", each.alias("_e")).select(
        F.col("_e.method").alias("method"),
        F.greatest(F.lit(0), (F.col("_e._c") - BAND_Z * F.col("_s")).cast("long")).alias("lower"),
        (F.col("_e._c") + BAND_Z * F.col("_s")).cast("long").alias("upper"),
    )


def band_bounds(df: DataFrame, x: str, method: str = "mean") -> DataFrame:
    """Integer 95 % band ``[lower, upper)`` around the centre (A21, Q10):
    ``upper = int(c + 1.96 s)``, ``lower = max(0, int(c - 1.96 s))`` with
    ``int`` truncating toward zero and ``s`` the sample deviation."""
    return _band_bounds(df, x, [method]).drop("method")


def band_filter(df: DataFrame, x: str, method: str = "mean") -> DataFrame:
    """Rows whose ``x`` is an integer in ``range(lower, upper)``."""
    b = band_bounds(df, x, method)
    return df.crossJoin(F.broadcast(b)).where(in_int_range(x, "lower", "upper")).drop("lower", "upper")


def band_coverage(df: DataFrame, x: str, method: str | Sequence[str] = "mean") -> DataFrame:
    """lower, upper and the share of all rows inside the band.

    With several methods, the bounds (one row each) are broadcast and every
    method's coverage comes from the same pass over the rows; the output
    then carries a ``method`` column."""
    methods = [method] if isinstance(method, str) else list(method)
    bounds = _band_bounds(df, x, methods)
    inside = F.coalesce(in_int_range(x, "lower", "upper"), F.lit(False)).cast("double")
    out = df.select(x).crossJoin(F.broadcast(bounds)).groupBy("method", "lower", "upper").agg(
        F.avg(inside).alias("coverage")
    )
    return out.drop("method") if isinstance(method, str) else out


def histogram(df: DataFrame, x: str, bins: int = 10) -> DataFrame:
    """Equal-width histogram over [min, max], last bin closed (A22): ``bin,
    lower_edge, upper_edge, count`` for every bin, empty ones included."""
    r = df.agg(F.min(x).cast("double").alias("_mn"), F.max(x).cast("double").alias("_mx"))
    r = r.select(
        F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("_lo"),
        F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("_hi"),
    )
    idx = F.least(F.floor((F.col(x) - F.col("_lo")) * (F.lit(float(bins)) / (F.col("_hi") - F.col("_lo")))), F.lit(bins - 1))
    counts = (
        df.where(F.col(x).isNotNull())
        .crossJoin(F.broadcast(r))
        .groupBy(idx.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).crossJoin(r)
    width = (F.col("_hi") - F.col("_lo")) / bins
    return all_bins.join(counts, "bin", "left").select(
        "bin",
        (F.col("_lo") + F.col("bin") * width).alias("lower_edge"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("upper_edge"),
        F.coalesce(F.col("count"), F.lit(0)).alias("count"),
    )


def ols(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """Least squares with intercept (A23).  One row: ``intercept`` and one
    ``coef_<x>`` per predictor.

    One predictor uses the built-in ``regr_slope`` / ``regr_intercept``
    aggregates; several use Spark ML's normal-equation solver, which
    aggregates the k x k moment matrix on the executors.
    """
    xs = list(xs)
    clean = df.where(F.col(y).isNotNull())
    for c in xs:
        clean = clean.where(F.col(c).isNotNull())
    if len(xs) == 1:
        return clean.agg(
            F.regr_intercept(F.col(y).cast("double"), F.col(xs[0]).cast("double")).alias("intercept"),
            F.regr_slope(F.col(y).cast("double"), F.col(xs[0]).cast("double")).alias(f"coef_{xs[0]}"),
        )
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    va = VectorAssembler(inputCols=xs, outputCol="_features")
    data = va.transform(clean.select(F.col(y).cast("double").alias("_label"), *[F.col(c).cast("double") for c in xs]))
    model = LinearRegression(
        featuresCol="_features", labelCol="_label", solver="normal", regParam=0.0, fitIntercept=True, standardization=False
    ).fit(data)
    row = [float(model.intercept), *[float(v) for v in model.coefficients]]
    schema = ", ".join(["intercept double", *[f"coef_{c} double" for c in xs]])
    return df.sparkSession.createDataFrame([tuple(row)], schema)


def ols_by(df: DataFrame, y: str, xs: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Least squares with intercept per group (A23): ``by``, ``n``,
    ``intercept`` and one ``coef_<x>`` per predictor.

    One aggregate: counts, means and the predictors' covariances, which Spark
    merges around the mean, so large values lose no digits.  The normal
    equations of each group are then solved by elimination written as column
    expressions, so any number of groups is solved where the rows are.  Rows
    with a null are left out; a group whose predictors are constant or
    collinear has null coefficients."""
    xs, by = list(xs), list(by)
    d = len(xs)
    v = [F.col(c).cast("double") for c in xs]
    target = F.col(y).cast("double")
    full = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [y, *xs]]))
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(target).alias("_my")]
    aggs += [F.avg(v[i]).alias(f"_m{i}") for i in range(d)]
    aggs += [F.covar_pop(v[i], v[j]).alias(f"_a{i}_{j}") for i in range(d) for j in range(i, d)]
    aggs += [F.covar_pop(v[i], target).alias(f"_a{i}_{d}") for i in range(d)]
    g = full.groupBy(*by).agg(*aggs)
    # symmetric elimination; a pivot that has lost all but rounding is none
    for i in range(d):
        g = g.withColumn(f"_d{i}", F.col(f"_a{i}_{i}"))
    for i in range(d):
        pivot = F.when(F.col(f"_a{i}_{i}") > 1e-10 * F.col(f"_d{i}"), F.col(f"_a{i}_{i}"))
        g = g.withColumn(f"_p{i}", pivot)
        g = g.withColumns({
            f"_a{r}_{c}": F.col(f"_a{r}_{c}") - F.col(f"_a{i}_{r}") * F.col(f"_a{i}_{c}") / F.col(f"_p{i}")
            for r in range(i + 1, d) for c in range(r, d + 1)})
    for i in reversed(range(d)):
        rest = sum((F.col(f"_a{i}_{j}") * F.col(f"coef_{xs[j]}") for j in range(i + 1, d)), F.lit(0.0))
        g = g.withColumn(f"coef_{xs[i]}", (F.col(f"_a{i}_{d}") - rest) / F.col(f"_p{i}"))
    intercept = F.col("_my") - sum((F.col(f"coef_{c}") * F.col(f"_m{i}") for i, c in enumerate(xs)), F.lit(0.0))
    return g.select(*by, "n", intercept.alias("intercept"), *[f"coef_{c}" for c in xs])


def user_table(log: DataFrame) -> DataFrame:
    """Per-learner summary used for regressions: accuracy, answers, active days."""
    return log.groupBy("userID").agg(
        F.avg("answerCode").alias("user_acc"),
        F.count("answerCode").cast("double").alias("n_answers"),
        F.countDistinct(F.to_date("Timestamp")).cast("double").alias("n_days"),
    )
