"""Classifier kinds, folds in shared scans, grouped regressions, worker state."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quizlog.operators import foldfit, model, profile


@pytest.fixture(scope="module")
def examples(spark):
    r = random.Random(4)
    rows = []
    for i in range(900):
        a, b, c = r.gauss(5, 3), r.random(), float(r.randint(0, 1))
        p = 1 / (1 + np.exp(-(0.4 * (a - 5) - 2 * b + c)))
        rows.append((i, None if r.random() < 0.1 else a, b, c, 7.0, float(r.random() < p) if i % 50 else None))
    return spark.createDataFrame(rows, "userID long, a double, b double, c double, flat double, label double").cache()


FEATURES = ("a", "b", "c", "flat")


@pytest.mark.parametrize("reg", [0.0, 0.05])
def test_folds_in_one_pass_equal_separate_fits(spark, examples, reg):
    oof, models = model.cross_validate(examples, k=4, seed=3, features=FEATURES, reg=reg, tol=1e-10)
    folds = oof.select("userID", "fold")
    got = {r["userID"]: r["prediction"] for r in oof.collect()}
    assert len(got) == 900 and len(models) == 4
    ex = examples.join(folds, "userID")
    for f in range(4):
        one = model.fit_classifier(ex.where(F.col("fold") != f), FEATURES, reg=reg, tol=1e-14, max_iter=500)
        for r in model.score(one, ex.where(F.col("fold") == f), keep=("userID",)).collect():
            assert got[r["userID"]] == pytest.approx(r["prediction"], abs=1e-6)
        again = {r["userID"]: r["prediction"] for r in model.score(models[f], ex.where(F.col("fold") == f), keep=("userID",)).collect()}
        assert all(got[u] == pytest.approx(p, abs=1e-12) for u, p in again.items())


def test_scans_do_not_depend_on_k(spark, examples, monkeypatch):
    """Every Newton step is one job, for 2 folds and for 8."""
    jobs = []
    real = type(examples).collect
    monkeypatch.setattr(type(examples), "collect", lambda self: jobs.append(1) or real(self))
    used = []
    for k in (2, 8):
        jobs.clear()
        ex = examples.withColumn("fold", (F.col("userID") % k).cast("int"))
        foldfit.fit_folds(ex, FEATURES, k, tol=1e-6)
        used.append(len(jobs))
    assert used[1] <= used[0] + 2 and max(used) < 12


def test_one_class_separable_and_empty_folds(spark):
    rows = [(i, float(i), 1.0) for i in range(40)]
    ex = spark.createDataFrame(rows, "userID long, x double, label double")
    oof, models = model.cross_validate(ex, k=3, features=("x",))
    assert {r["prediction"] for r in oof.collect()} == {1.0}
    apart = spark.createDataFrame([(i, float(i), float(i >= 20)) for i in range(40)], "userID long, x double, label double")
    oof, _ = model.cross_validate(apart, k=4, features=("x",), max_iter=15)
    assert all((r["prediction"] > 0.5) == (r["label"] == 1) for r in oof.where("userID < 17 or userID > 22").collect())
    few = spark.createDataFrame([(1, 1.0, 0.0), (2, 2.0, 1.0)], "userID long, x double, label double")
    assert model.cross_validate(few, k=5, features=("x",))[0].count() == 2


@pytest.mark.parametrize("kind, params", [("logistic", {}), ("tree", {"maxDepth": 3}), ("forest", {"numTrees": 5}), ("boosted", {"max_iter": 3})])
def test_saved_models_score_alike(spark, examples, tmp_path, kind, params):
    clf = model.fit_classifier(examples, FEATURES, kind=kind, **params)
    clf.save(str(tmp_path / "m"))
    back = model.Classifier.load(spark, str(tmp_path / "m"))
    assert type(back.model) is type(clf.model) and back.features == FEATURES
    a, b = (sorted(map(tuple, model.score(m, examples, keep=("userID",)).collect())) for m in (clf, back))
    assert a == b and len(a) == 900


def test_saved_fold_models_score_alike(spark, examples, tmp_path):
    _, models = model.cross_validate(examples, k=2, features=FEATURES)
    models[1].save(str(tmp_path / "m"))
    back = model.Classifier.load(spark, str(tmp_path / "m"))
    a, b = (sorted(map(tuple, model.score(m, examples, keep=("userID",)).collect())) for m in (models[1], back))
    assert a == b


def test_unknown_kind(examples):
    with pytest.raises(ValueError):
        model.fit_classifier(examples, FEATURES, kind="oracle")


@pytest.mark.parametrize("d", [1, 2, 4])
def test_grouped_regression_equals_numpy(spark, d):
    r = np.random.default_rng(d)
    rows, want = [], {}
    for g in ["a", "b", None, "shifted"]:
        n = 60
        x = r.normal(1e5 if g == "shifted" else 0, 2, (n, d))
        y = x @ np.arange(1, d + 1) + 3 + r.normal(0, 0.5, n)
        want[g] = np.linalg.lstsq(np.c_[np.ones(n), x - x.mean(0)], y, rcond=None)[0][1:]
        rows += [(g, float(v), *map(float, q)) for q, v in zip(x, y)] + [(g, None, *[0.0] * d)]
    rows += [("flat", float(i), *[1.0] * d) for i in range(5)] + [("one", 1.0, *[2.0] * d)]
    xs = [f"x{i}" for i in range(d)]
    df = spark.createDataFrame(rows, "g string, y double, " + ", ".join(f"{c} double" for c in xs))
    got = {r["g"]: r for r in profile.ols_by(df, "y", xs, ["g"]).collect()}
    for g, coef in want.items():
        assert got[g]["n"] == 60
        assert [got[g][f"coef_{c}"] for c in xs] == pytest.approx(list(coef), rel=1e-6, abs=1e-8)
    for g in ("flat", "one"):
        assert got[g]["intercept"] is None and got[g]["coef_x0"] is None
    assert profile.ols_by(df.limit(0), "y", xs, ["g"]).count() == 0


def test_grouped_regression_of_one_group_equals_ols(spark, examples):
    a = profile.ols_by(examples.withColumn("g", F.lit(1)), "label", ["b", "c"], ["g"]).first()
    b = profile.ols(examples, "label", ["b", "c"]).first()
    for c in ("intercept", "coef_b", "coef_c"):
        assert a[c] == pytest.approx(b[c], abs=1e-9)


def test_a_model_file_is_loaded_once_a_worker(spark, tmp_path):
    file, marks = tmp_path / "model.txt", str(tmp_path / "loads")
    file.write_text("3")
    os.mkdir(marks)

    def load(path):
        import uuid

        open(f"{marks}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()
        with open(path) as f:
            return float(f.read())

    def score(pdf, factor):
        return pdf["x"] * factor

    df = spark.range(0, 4000, 1, 40).select(F.col("id").alias("k"), F.col("id").cast("double").alias("x"))
    out = model.map_score(df, score, ["k"], ["x"], file=str(file), load=load)
    for _ in range(2):
        assert all(r["prediction"] == 3.0 * r["k"] for r in out.collect())
    pids = [name.split("-")[0] for name in os.listdir(marks)]
    assert len(pids) == len(set(pids)) < 40
    file.write_text("5")  # another content under the same name is another file
    assert model.map_score(df, score, ["k"], ["x"], file=str(file), load=load).where("k = 2").first()["prediction"] == 10.0
