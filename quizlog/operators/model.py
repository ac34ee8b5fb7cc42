"""Fit, score and cross-validate a next-answer classifier.

The reference trains neural sequence models on one device; here a
distributed Spark ML estimator takes their place on the same prepared
features (SURVEY §2.11, re-aimed).  Training examples are the last position
of each sequence: features come from the history before it (prior accuracy,
prior count, previous answer) plus the target-encoded means of its test, item
and tag.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import types
import uuid
from dataclasses import dataclass
from typing import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import foldfit, keyed, metrics
from .rank import fold_number
from .sequences import keep_last

FEATURES = ("test_mean", "assessment_mean", "tag_mean", "user_acc", "user_total_answer", "interaction")


def standardize(df: DataFrame, cols: Sequence[str], suffix: str = "_z") -> DataFrame:
    """``(x - mean) / stddev_pop`` per column over non-null values (M1).

    The statistics are one aggregated row, broadcast to every row."""
    stats = df.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols])
    out = df.crossJoin(F.broadcast(stats))
    for c in cols:
        out = out.withColumn(f"{c}{suffix}", (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}"))
    return out.drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


def last_position_rows(
    rows: DataFrame, fit_on: DataFrame | None = None, seq: str = "userID", target: str = "answerCode"
) -> DataFrame:
    """One example per sequence: its last row with history features.

    ``rows`` is a log (one sequence per ``seq``); ``fit_on`` is the table the
    target encodings are fitted on (default ``rows`` itself, the reference's
    behaviour, Q8).  Hidden targets (-1) are kept, with a null label.
    """
    # History features never see the current answer; a hidden target (-1)
    # counts as a row but not as an answer.  Totals per sequence are a partial
    # aggregate and the order matters for two rows only, so no history is
    # sorted; the statistics are joined to the one row that is left.
    t = rows.where(F.col(seq).isNotNull()).withColumn("_y", F.when(F.col(target) >= 0, F.col(target)))
    totals = t.groupBy(seq).agg(F.count(F.lit(1)).alias("_n"), F.sum("_y").alias("_s"))
    w = Window.partitionBy(seq).orderBy(F.col("Timestamp").desc(), F.col("event_id").desc())
    two = keep_last(t, 2, seq).select("*", F.row_number().over(w).alias("_back"), F.lead("_y").over(w).alias("_prev"))
    prior_cnt = F.col("_n") - 1
    prior_sum = F.coalesce(F.col("_s"), F.lit(0)) - F.coalesce(F.col("_y"), F.lit(0))
    feats = two.where("_back = 1").join(totals, seq).select(
        *rows.columns,
        F.when(prior_cnt > 0, prior_sum / prior_cnt).alias("user_acc"),
        prior_cnt.cast("double").alias("user_total_answer"),
        F.coalesce(F.col("_prev") + 1, F.lit(0)).cast("double").alias("interaction"),
        F.when(F.col(target) >= 0, F.col(target).cast("double")).alias("label"),
    )
    return keyed.target_encode(feats, fit_on=rows if fit_on is None else fit_on)


@dataclass(frozen=True)
class Linear:
    """A logistic model by its numbers (one fold of ``foldfit``)."""

    coef: tuple[float, ...]
    intercept: float


@dataclass(frozen=True)
class Classifier:
    """A fitted model with its inputs: feature names and what stands in for a
    missing value (by default the feature's mean over the training examples,
    so an unseen item counts as an average one)."""

    model: object
    features: tuple[str, ...]
    fill: dict[str, float]

    def save(self, path: str) -> None:
        """Model and metadata under ``path``, written by Spark."""
        meta = {"features": list(self.features), "fill": self.fill}
        if isinstance(self.model, Linear):
            meta |= {"coef": list(self.model.coef), "intercept": self.model.intercept}
        else:
            self.model.write().overwrite().save(f"{path}/model")
        spark = SparkSession.getActiveSession()
        line = json.dumps(meta)
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Classifier:
        """The saved model, of whatever class it is."""
        from pyspark.ml.util import DefaultParamsReader

        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        if "coef" in meta:
            model = Linear(tuple(meta["coef"]), meta["intercept"])
        else:
            model = DefaultParamsReader.loadParamsInstance(f"{path}/model", spark)
        return Classifier(model, tuple(meta["features"]), meta["fill"])


def _assemble(df: DataFrame, features: Sequence[str], fill: dict[str, float]) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(features), outputCol="features").transform(df.fillna(fill))


def estimator(kind: str, max_iter: int = 50, reg: float = 0.0, tol: float = 1e-6, seed: int = 42, **params):
    """The Spark ML estimator of a kind: ``logistic`` regression, a decision
    ``tree``, a random ``forest`` or ``boosted`` trees (``max_iter`` of them).
    ``params`` are the estimator's own, e.g. ``maxDepth``."""
    from pyspark.ml import classification as C

    if kind == "logistic":
        return C.LogisticRegression(maxIter=max_iter, regParam=reg, tol=tol, **params)
    if kind == "boosted":
        return C.GBTClassifier(maxIter=max_iter, seed=seed, **params)
    if kind == "forest":
        return C.RandomForestClassifier(seed=seed, **params)
    if kind == "tree":
        return C.DecisionTreeClassifier(seed=seed, **params)
    raise ValueError(f"unknown kind of classifier: {kind}")


def fit_classifier(
    train_rows: DataFrame,
    features: Sequence[str] = FEATURES,
    max_iter: int = 50,
    reg: float = 0.0,
    tol: float = 1e-6,
    fill: dict[str, float] | None = None,
    kind: str = "logistic",
    **params,
) -> Classifier:
    """A classifier on last-position examples (M2); see ``estimator`` for the
    kinds."""
    rows = train_rows.where(F.col("label").isNotNull())
    if fill is None:
        means = rows.agg(*[F.avg(c).alias(c) for c in features]).first()
        fill = {c: 0.0 if means[c] is None else float(means[c]) for c in features}
    e = estimator(kind, max_iter, reg, tol, **params).setFeaturesCol("features").setLabelCol("label")
    return Classifier(e.fit(_assemble(rows, features, fill)), tuple(features), fill)


def score(clf: Classifier, rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Probability of a right answer for each example (M3)."""
    if isinstance(clf.model, Linear):
        one = (np.array([x]) for x in (clf.model.coef, clf.model.intercept, [clf.fill[c] for c in clf.features]))
        return rows.select(*keep, foldfit.predict(clf.features, *one, F.lit(0)).alias("prediction"))
    from pyspark.ml.functions import vector_to_array

    out = clf.model.transform(_assemble(rows, clf.features, clf.fill))
    return out.select(*keep, vector_to_array("probability")[1].alias("prediction"))


def cross_validate(
    examples: DataFrame,
    k: int = 5,
    seed: int = 42,
    key: str = "userID",
    features: Sequence[str] = FEATURES,
    kind: str = "logistic",
    **fit_kw,
) -> tuple[DataFrame, list[Classifier]]:
    """k models, each fitted on the other folds and scored on its own (M4).

    Returns out-of-fold predictions ``(fold, <key>, prediction, label)`` and
    the fitted models (for soft voting).  Logistic models of all folds share
    their scans (``foldfit``) and all rows are scored in one pass; other kinds
    are fitted one after another."""
    # One row per sequence: written once, read by every step of the fits.
    ex = keyed.materialize(examples)
    ex = ex.where(F.col(key).isNotNull()).withColumn("fold", fold_number(ex, key, k=k, seed=seed))
    if kind == "logistic":
        coef, intercept, fills = foldfit.fit_folds(ex, features, k, **fit_kw)
        models = [
            Classifier(Linear(tuple(map(float, coef[f])), float(intercept[f])), tuple(features), dict(zip(features, map(float, fills[f]))))
            for f in range(k)
        ]
        out = ex.select("fold", key, foldfit.predict(features, coef, intercept, fills, F.col("fold")).alias("prediction"), "label")
        return keyed.materialize(out), models
    models, parts = [], []
    for f in range(k):
        m = fit_classifier(ex.where(F.col("fold") != f), features, kind=kind, **fit_kw)
        models.append(m)
        parts.append(score(m, ex.where(F.col("fold") == f), keep=("fold", key, "label")))
    oof = parts[0]
    for p in parts[1:]:
        oof = oof.unionByName(p)
    return keyed.materialize(oof), models


def vote(models: list[Classifier], rows: DataFrame, id_col: str = "id") -> DataFrame:
    """Soft vote: mean probability of all models per id (M5)."""
    parts = [score(m, rows, keep=(id_col,)) for m in models]
    allp = parts[0]
    for p in parts[1:]:
        allp = allp.unionByName(p)
    return metrics.soft_vote(allp, id_col)


def map_score(
    df: DataFrame,
    fn: Callable[..., pd.Series],
    keep: Sequence[str],
    inputs: Sequence[str],
    out: str = "prediction",
    file: str | None = None,
    load: Callable[[str], object] | None = None,
) -> DataFrame:
    """Score rows with a user-supplied pandas function in Arrow batches.

    ``fn`` gets a pandas DataFrame of ``inputs`` and returns one score per
    row.  With ``load`` it also gets a model: ``file`` (a path the driver can
    read) is shipped to the executors once, each Python worker calls
    ``load(local path)`` once and keeps what it returns for all its later
    tasks and batches.
    """
    keep, inputs = list(keep), list(inputs)
    schema = df.select(*keep).schema.add(out, "double")
    name, key = None, None
    if load is not None:
        if file is None:
            raise ValueError("load needs a file")
        spark = df.sparkSession
        # A name of its own: files of one name and another content cannot be sent.
        folder = tempfile.mkdtemp(prefix="quizlog-model-")  # on the driver, which serves the copy
        name = f"{uuid.uuid4().hex}-{os.path.basename(file)}"
        shutil.copyfile(file, os.path.join(folder, name))
        spark.sparkContext.addFile(os.path.join(folder, name))
        key = f"{spark.sparkContext.applicationId}/{name}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        extra = ()
        if load is not None:
            # State of the worker process: a module outlives the task's function.
            state = sys.modules.setdefault("_quizlog_worker_state", types.ModuleType("_quizlog_worker_state"))
            if key not in state.__dict__:
                state.__dict__[key] = load(SparkFiles.get(name))
            extra = (state.__dict__[key],)
        for pdf in batches:
            res = pdf[keep].copy()
            res[out] = pd.Series(fn(pdf[inputs], *extra), index=pdf.index).astype("float64")
            yield res

    return df.select(*dict.fromkeys(keep + inputs)).mapInPandas(run, schema)
