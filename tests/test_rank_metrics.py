"""Global rank, splits, metrics and profiles: properties and hand-made cases."""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from log_helpers import SF01
from quizlog.operators import metrics, profile, rank
from quizlog.sources.fixture import interactions


def test_global_rank_equals_row_number_for_any_bucket_count(spark):
    log = interactions(spark, SF01)
    ref = log.select("event_id", F.row_number().over(Window.orderBy("userID", "Timestamp", "event_id")).alias("r"))
    for nb in (1, 4, 37):
        got = rank.global_rank(log, ["userID", "Timestamp", "event_id"], "r", n_buckets=nb).select("event_id", "r")
        assert got.exceptAll(ref).count() == 0


def test_folds_partition_users_with_sizes_within_one(spark):
    log = interactions(spark, SF01)
    f = rank.kfold(log, "userID", k=7, seed=1)
    sizes = [r["c"] for r in f.groupBy("fold").agg(F.count("*").alias("c")).collect()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1 and sum(sizes) == 150
    assert f.select("userID").distinct().count() == 150
    # the first n % k folds hold one more key, as ntile does
    by_fold = {r["fold"]: r["c"] for r in f.groupBy("fold").agg(F.count("*").alias("c")).collect()}
    assert [by_fold[i] for i in range(7)] == [22, 22, 22, 21, 21, 21, 21]


def test_ratio_split_size(spark):
    log = interactions(spark, SF01)
    s = rank.ratio_split(log, "userID", 0.7, seed=0)
    assert s.where("is_train").count() == math.floor(150 * 0.7)


def _preds(spark, rows):
    return spark.createDataFrame(rows, "prediction double, target int")


def test_auroc_ties_and_brute_force(spark):
    log = interactions(spark, SF01)
    p = log.join(
        log.groupBy("KnowledgeTag").agg(F.avg("answerCode").alias("prediction")), "KnowledgeTag"
    ).select("prediction", F.col("answerCode").alias("target"))
    auc = metrics.auroc(p).collect()[0]["auc"]
    rows = p.collect()
    pos = [r["prediction"] for r in rows if r["target"] == 1]
    neg = [r["prediction"] for r in rows if r["target"] == 0]
    import numpy as np

    pn, nn = np.array(pos)[:, None], np.array(neg)[None, :]
    brute = ((pn > nn).sum() + 0.5 * (pn == nn).sum()) / (len(pos) * len(neg))
    assert abs(auc - brute) < 1e-12
    flipped = metrics.auroc(p.withColumn("prediction", 1 - F.col("prediction"))).collect()[0]["auc"]
    assert abs(flipped - (1 - auc)) < 1e-9


def test_auroc_single_class_is_null(spark):
    assert metrics.auroc(_preds(spark, [(0.1, 1), (0.5, 1), (0.9, 1)])).collect()[0]["auc"] is None


def test_accuracy_threshold_and_log_loss_floor(spark):
    p = _preds(spark, [(0.0, 0), (0.5, 1), (1.0, 1), (0.0, 1)])
    assert metrics.accuracy(p).collect()[0]["acc"] == 0.75
    ll = metrics.log_loss(p).collect()[0]["log_loss"]
    # rows: 0 (p=0,y=0), ln 2 (p=.5), 0 (p=1,y=1), 100 (p=0,y=1 floored)
    assert abs(ll - (math.log(2) + 100) / 4) < 1e-12


def test_soft_vote_of_one_fold_is_identity(spark):
    p = spark.createDataFrame([(0, 0.3), (1, 0.8)], "id bigint, prediction double")
    assert sorted(metrics.soft_vote(p).collect()) == sorted(p.collect())


def test_best_candidate_tie_breaks_by_name(spark):
    m = spark.createDataFrame([("b", 0.7), ("a", 0.7), ("c", 0.6)], "candidate string, auc double")
    assert metrics.best_candidate(m).collect()[0]["candidate"] == "a"


def test_band_integer_membership(spark):
    # values 1, 2, 2.5, 3 with bounds [1, 3): keeps 1 and 2
    df = spark.createDataFrame([(1.0,), (2.0,), (2.5,), (3.0,)], "x double")
    from quizlog.functions.scalar import in_int_range

    kept = [r["x"] for r in df.where(in_int_range("x", F.lit(1), F.lit(3))).collect()]
    assert sorted(kept) == [1.0, 2.0]


def test_exact_quantiles_match_pandas(spark):
    import pandas as pd

    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0, 5.0, 3.0, 5.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    d = profile.describe(df, "x").collect()[0]
    s = pd.Series(vals).describe()
    for k, pk in (("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("mean", "mean"), ("std", "std")):
        assert abs(d[k] - s[pk]) < 1e-12
    mm = profile.mode_median_share(df, "x").collect()[0]
    assert mm["mode"] == 5.0 and abs(mm["mode_share"] - 3 / 11) < 1e-12


def test_mode_ties_take_smallest(spark):
    df = spark.createDataFrame([(2.0,), (1.0,), (2.0,), (1.0,)], "x double")
    assert profile.mode_value(df, "x").collect()[0]["mode"] == 1.0


def test_histogram_matches_numpy(spark):
    import numpy as np

    vals = [0.0, 0.1, 0.25, 0.5, 0.5, 0.9, 1.0, 0.33]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r["count"] for r in profile.histogram(df, "x", 10).orderBy("bin").collect()]
    assert got == list(np.histogram(vals, bins=10)[0])


def test_ols_two_predictors_against_numpy(spark):
    import numpy as np

    rows = [(1.0, 2.0, 3.1), (2.0, 1.0, 3.9), (3.0, 5.0, 8.2), (4.0, 3.0, 8.8), (5.0, 7.0, 13.1)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    o = profile.ols(df, "y", ["a", "b"]).collect()[0]
    X = np.c_[np.ones(5), [r[0] for r in rows], [r[1] for r in rows]]
    beta = np.linalg.lstsq(X, [r[2] for r in rows], rcond=None)[0]
    assert np.allclose([o["intercept"], o["coef_a"], o["coef_b"]], beta, atol=1e-8)
