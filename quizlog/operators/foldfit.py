"""Logistic regression of all folds at once (M4).

k-fold models differ only in which rows they leave out.  Here every Newton
step of all k models comes from one scan: a row adds its gradient and Hessian
terms to the k - 1 models it trains, as one aggregate grouped by model, so a
cross-validation reads the examples as often as a single fit does, whatever
k is.  The k small systems are solved on the driver.

Each model is the one a separate fit would find: missing values get the mean
of the model's own training rows, features are standardised by them, and
``reg`` is an L2 penalty on the standardised coefficients.  A step that would
raise a model's loss is halved.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _per_model(values: Sequence[float]) -> Column:
    """A value that depends on the row's model ``_f``."""
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("_f") + 1)


def _moments(rows: DataFrame, features: Sequence[str], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean, deviation, label mean) of each model's training rows after
    filling: all from one aggregate per fold."""
    cols = [F.count(F.lit(1)).alias("_n"), F.sum("label").alias("_y")]
    for j, c in enumerate(features):
        v = F.col(c).cast("double")
        cols += [F.count(v).alias(f"_n{j}"), F.avg(v).alias(f"_m{j}"), (F.var_pop(v) * F.count(v)).alias(f"_d{j}")]
    d = len(features)
    n, y, nn, m, s = np.zeros(k), np.zeros(k), np.zeros((k, d)), np.zeros((k, d)), np.zeros((k, d))
    for r in rows.groupBy("fold").agg(*cols).collect():  # k rows
        f = r["fold"]
        n[f], y[f] = r["_n"], r["_y"]
        for j in range(d):
            nn[f, j], m[f, j], s[f, j] = r[f"_n{j}"], r[f"_m{j}"] or 0.0, r[f"_d{j}"] or 0.0
    mean, dev, label = np.zeros((k, d)), np.zeros((k, d)), np.zeros(k)
    for f in range(k):
        rest = np.arange(k) != f
        total = nn[rest].sum(0)
        mean[f] = np.divide((nn * m)[rest].sum(0), total, out=np.zeros(d), where=total > 0)
        spread = (s + nn * (m - mean[f]) ** 2)[rest].sum(0)  # a filled value adds none
        dev[f] = np.sqrt(spread / max(n[rest].sum() - 1, 1))
        label[f] = y[rest].sum() / max(n[rest].sum(), 1)
    return mean, dev, label


def fit_folds(
    rows: DataFrame, features: Sequence[str], k: int, max_iter: int = 50, reg: float = 0.0, tol: float = 1e-6
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(coefficients, intercepts, fills) of the k models, model f fitted on
    the rows with another ``fold`` and a ``label``; a model whose rows have
    one class only has that class' probability."""
    rows = rows.where(F.col("label").isNotNull()).select(F.col("fold").cast("int").alias("fold"), "label", *features)
    d = len(features)
    mean, dev, label = _moments(rows, features, k)
    used = dev > 1e-12
    scale = np.where(used, dev, 1.0)
    others = F.filter(F.array(*[F.lit(f) for f in range(k)]), lambda f: f != F.col("fold"))
    z = [(F.coalesce(F.col(c).cast("double"), _per_model(mean[:, j])) - _per_model(mean[:, j])) / _per_model(scale[:, j]) for j, c in enumerate(features)]
    x = rows.select("label", *features, F.explode(others).alias("_f")).select("_f", "label", *[v.alias(f"_z{j}") for j, v in enumerate(z)])
    x = x.withColumn(f"_z{d}", F.lit(1.0))

    beta = np.zeros((k, d + 1))
    two = (label > 0) & (label < 1)
    beta[two, d] = np.log(label[two] / (1 - label[two]))
    beta[~two, d] = np.where(label[~two] > 0, np.inf, -np.inf)
    step = np.zeros_like(beta)
    loss = np.full(k, np.inf)
    moving = two.copy()
    for _ in range(max_iter):
        if not moving.any():
            break
        margin = sum((_per_model(beta[:, j]) * F.col(f"_z{j}") for j in range(d)), _per_model(np.where(two, beta[:, d], 0.0)))
        at = x.where(F.col("_f").isin([int(f) for f in np.flatnonzero(moving)])).withColumn("_e", margin)
        at = at.withColumn("_p", 1.0 / (1.0 + F.exp(-F.col("_e"))))
        at = at.withColumn("_w", F.col("_p") * (1.0 - F.col("_p")))
        # log(1 + e^m) - y m, without overflow
        row_loss = F.greatest(F.col("_e"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("_e"))) - F.col("label") * F.col("_e")
        aggs = [F.count(F.lit(1)).alias("n"), F.sum(row_loss).alias("loss")]
        aggs += [F.sum((F.col("_p") - F.col("label")) * F.col(f"_z{j}")).alias(f"g{j}") for j in range(d + 1)]
        aggs += [F.sum(F.col("_w") * F.col(f"_z{i}") * F.col(f"_z{j}")).alias(f"h{i}_{j}") for i in range(d + 1) for j in range(i, d + 1)]
        for r in at.groupBy("_f").agg(*aggs).collect():  # k rows
            f = r["_f"]
            penalty = reg * np.append(used[f].astype(float), 0.0)
            now = r["loss"] / r["n"] + 0.5 * (penalty * beta[f] ** 2).sum()
            if now > loss[f] + 1e-12:
                step[f] /= 2
                beta[f] -= step[f]
            else:
                loss[f] = now
                g = np.array([r[f"g{j}"] for j in range(d + 1)]) / r["n"] + penalty * beta[f]
                h = np.zeros((d + 1, d + 1))
                for i in range(d + 1):
                    for j in range(i, d + 1):
                        h[i, j] = h[j, i] = r[f"h{i}_{j}"] / r["n"]
                step[f] = -np.linalg.pinv(h + np.diag(penalty), rcond=1e-10) @ g
                beta[f] += step[f]
            moving[f] = np.abs(step[f]).max() > tol
    coef = np.where(used, beta[:, :d], 0.0) / scale
    intercept = beta[:, d] - (coef * mean).sum(1)
    return coef, intercept, mean


def predict(features: Sequence[str], coef: np.ndarray, intercept: np.ndarray, fills: np.ndarray, fold: Column) -> Column:
    """The probability that model ``fold`` gives a row: any number of models
    scored in one pass, as an expression."""

    def of(values: Sequence[float]) -> Column:
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), fold + 1)

    margin = of(intercept)
    for j, c in enumerate(features):
        margin = margin + of(coef[:, j]) * F.coalesce(F.col(c).cast("double"), of(fills[:, j]))
    return 1.0 / (1.0 + F.exp(-margin))
