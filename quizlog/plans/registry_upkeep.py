"""Registered queries of what keeps up with a growing log: statistics store,
mergeable profiles, grouped regressions, further classifiers."""

from __future__ import annotations

import os
import tempfile

import numpy as np
from pyspark.sql import functions as F

from ..operators import keyed, model, profile, sketch, store, windows
from ..sources import layout
from . import flagship as flow
from .registry import _BINARY_FOLDS_SQL, _BINARY_SQL, _SEQ_SQL, _TESTACC_SQL, _W, BINARY, EXACT, K_FOLDS, ORACLE, _log, _te_select, _test_acc_rows, _train_test, register, rnd

# ---------------------------------------------------------------- A1-A16 from a store


def filled_store(spark, log) -> store.StatStore:
    """The log in four batches, one added twice, compacted in between."""
    s = store.StatStore(spark, f"{flow.flow_folder(spark)}/store")
    day = F.dayofmonth("Timestamp")
    for batch in range(4):
        s.add(log.where(day % 4 == batch), f"batch{batch}")
        if batch == 1:
            s.add(log.where(day % 4 == 1), "batch1")
            s.compact()
    s.add(log.where(day % 4 == 3), "batch3")
    return s


def _stats_sql() -> str:
    """All fourteen columns, each by its own group."""
    cols, joins = [], []
    for i, (name, (keys, agg)) in enumerate(keyed.FEATURE_STATS.items()):
        fn = "count(answerCode)" if agg == "count" else "avg(answerCode)"
        cols.append(f"s{i}.v AS {name}" if agg == "count" else f"round(s{i}.v, 9) AS {name}")
        on = " AND ".join(f"s{i}.{k} = l.{k}" for k in keys)
        joins.append(f"LEFT JOIN (SELECT {', '.join(keys)}, {fn} AS v FROM interactions GROUP BY {', '.join(keys)}) s{i} ON {on}")
    return f"SELECT l.event_id, {', '.join(cols)} FROM interactions l " + "\n".join(joins)


@register("a01_a14_statistics_store", _stats_sql())
def q_store(spark, sf_dir):
    log = _log(spark, sf_dir)
    out = filled_store(spark, log).add_feature_stats(log)
    return out.select("event_id", *[F.col(n) if agg == "count" else rnd(n).alias(n) for n, (_, agg) in keyed.FEATURE_STATS.items()])


@register("a15_target_encoding_from_store")
def q_store_encoder(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    return _te_select(keyed.apply_target_encoder(test, filled_store(spark, train).target_encoder()))


@register("a16_first_timestamps_from_store")
def q_store_first(spark, sf_dir):
    return filled_store(spark, _log(spark, sf_dir)).first_timestamps()


ORACLE["a15_target_encoding_from_store"] = ORACLE["a15_target_encoding_fit_train_apply_test"]
ORACLE["a16_first_timestamps_from_store"] = ORACLE["a16_first_timestamps"]


# ---------------------------------------------------------------- A19, A20 from sketches

_QS = (0.25, 0.5, 0.75)


def _inside(rows, described, by=()):
    """The exact figures, and whether each quantile's rank is inside the
    stated error (three times it: 99 % becomes all but certain)."""
    d = described.drop("column").withColumnsRenamed({b: f"_{b}" for b in by})
    on = [F.col(b).eqNullSafe(F.col(f"_{b}")) for b in by]
    j = rows.join(F.broadcast(d), on[0]) if by else rows.crossJoin(F.broadcast(d))  # one row a group
    share = {f"p{round(100 * q)}": q for q in _QS}
    err = 3 * sketch.rank_error()
    one = {p: (F.avg((F.col("x") < F.col(p)).cast("int")) - err <= q) & (F.avg((F.col("x") <= F.col(p)).cast("int")) + err >= q)
           for p, q in share.items()}
    keep = ["count", "mean", "std", "min", "max", "mode", "mode_share"]
    out = j.groupBy(*by).agg(*[F.first(c).alias(c) for c in keep], *[c.alias(f"{p}_inside") for p, c in one.items()])
    return out.select(*by, "count", *[rnd(c).alias(c) for c in keep[1:]], *[f"{p}_inside" for p in one])


@register(
    "a19_a20_merged_sketches_test_acc",
    f"""WITH {_TESTACC_SQL},
m AS (SELECT x AS mode, count(*) AS c FROM y GROUP BY x ORDER BY count(*) DESC, x LIMIT 1)
SELECT count(x) AS count, round(avg(x), 9) AS mean, round(stddev_samp(x), 9) AS std, round(min(x), 9) AS min, round(max(x), 9) AS max,
  round(any_value(m.mode), 9) AS mode, round(any_value(m.c) / count(*), 9) AS mode_share,
  true AS p25_inside, true AS p50_inside, true AS p75_inside FROM y CROSS JOIN m""",
)
def q_sketch(spark, sf_dir):
    """A sketch for each of 16 parts of the rows, merged."""
    rows = _test_acc_rows(spark, sf_dir)
    parts = sketch.sketch(rows.withColumn("part", F.pmod("event_id", F.lit(16))), ["x"], ["part"])
    return _inside(rows, sketch.describe(sketch.merge(parts)))


@register(
    "a19_a20_sketch_by_tag",
    """WITH t AS (SELECT testId, avg(answerCode) AS x FROM interactions GROUP BY testId),
y AS (SELECT KnowledgeTag, t.x FROM interactions JOIN t USING (testId)),
c AS (SELECT KnowledgeTag, x, count(*) AS c FROM y GROUP BY KnowledgeTag, x),
m AS (SELECT KnowledgeTag, arg_min(x, (-c, x)) AS mode, max(c) AS c FROM c GROUP BY KnowledgeTag)
SELECT KnowledgeTag, count(x) AS count, round(avg(x), 9) AS mean, round(coalesce(stddev_samp(x), 0), 9) AS std, round(min(x), 9) AS min,
  round(max(x), 9) AS max, round(any_value(m.mode), 9) AS mode, round(any_value(m.c) / count(*), 9) AS mode_share,
  true AS p25_inside, true AS p50_inside, true AS p75_inside FROM y JOIN m USING (KnowledgeTag) GROUP BY KnowledgeTag""",
)
def q_sketch_by(spark, sf_dir):
    rows = keyed.add_feature_stats(_log(spark, sf_dir), ["testId_acc_mean"]).select("KnowledgeTag", F.col("testId_acc_mean").alias("x"))
    d = sketch.describe(sketch.sketch(rows, ["x"], ["KnowledgeTag"]), ["KnowledgeTag"])
    return _inside(rows, d, ["KnowledgeTag"])


# ---------------------------------------------------------------- A23 per group

_TAG_USERS = """u AS (SELECT KnowledgeTag, userID, avg(answerCode) AS acc, cast(count(answerCode) AS double) AS n_answers,
  cast(count(DISTINCT testId) AS double) AS n_tests FROM interactions GROUP BY KnowledgeTag, userID)"""


def _tag_users(spark, sf_dir):
    return _log(spark, sf_dir).groupBy("KnowledgeTag", "userID").agg(
        F.avg("answerCode").alias("acc"), F.count("answerCode").cast("double").alias("n_answers"),
        F.countDistinct("testId").cast("double").alias("n_tests"))


@register(
    "a23_ols_by_tag_one_predictor",
    f"""WITH {_TAG_USERS}
SELECT KnowledgeTag, count(*) AS n, round(regr_intercept(acc, n_answers), 6) AS intercept,
  round(regr_slope(acc, n_answers), 6) AS coef_n_answers FROM u GROUP BY KnowledgeTag""",
)
def q_ols_by(spark, sf_dir):
    o = profile.ols_by(_tag_users(spark, sf_dir), "acc", ["n_answers"], ["KnowledgeTag"])
    return o.select("KnowledgeTag", "n", *[F.round(c, 6).alias(c) for c in ("intercept", "coef_n_answers")])


@register(
    "a23_ols_by_tag_two_predictors",
    f"""WITH {_TAG_USERS},
m AS (SELECT KnowledgeTag, count(*) AS n, var_pop(n_answers) AS s11, var_pop(n_tests) AS s22, covar_pop(n_answers, n_tests) AS s12,
  covar_pop(n_answers, acc) AS s1y, covar_pop(n_tests, acc) AS s2y, avg(n_answers) AS m1, avg(n_tests) AS m2, avg(acc) AS my
  FROM u GROUP BY KnowledgeTag),
b AS (SELECT *, s11 * s22 - s12 * s12 > 1e-10 * s11 * s22 AS fine FROM m),
c AS (SELECT *, CASE WHEN fine THEN (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) END AS b1,
  CASE WHEN fine THEN (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) END AS b2 FROM b)
SELECT KnowledgeTag, n, round(my - b1 * m1 - b2 * m2, 6) AS intercept, round(b1, 6) AS coef_n_answers, round(b2, 6) AS coef_n_tests FROM c""",
)
def q_ols_by2(spark, sf_dir):
    o = profile.ols_by(_tag_users(spark, sf_dir), "acc", ["n_answers", "n_tests"], ["KnowledgeTag"])
    return o.select("KnowledgeTag", "n", *[F.round(c, 6).alias(c) for c in ("intercept", "coef_n_answers", "coef_n_tests")])


# ---------------------------------------------------------------- M2 trees


def _flow(spark, sf_dir, **kw):
    train, test = _train_test(spark, sf_dir)
    path = flow.flow_folder(spark)
    flow.train(train, path, features=BINARY, **kw)
    return flow.infer(test, path).select("id", "userID", rnd("prediction", 5).alias("prediction"))


@register(
    "m2_tree_of_depth_one_submission",
    f"""WITH {_BINARY_SQL},
m AS (SELECT x, avg(label) AS m FROM ex GROUP BY x)
SELECT id, userID, round(m.m, 5) AS prediction FROM tex JOIN m USING (x)""",
)
def q_tree(spark, sf_dir):
    """One split on a binary feature: a leaf's probability is its label's mean."""
    return _flow(spark, sf_dir, kind="tree", maxDepth=1)


@register(
    "m2_boosted_tree_of_depth_one_submission",
    f"""WITH {_BINARY_SQL},
m AS (SELECT x, 1 / (1 + exp(-2 * (2 * avg(label) - 1))) AS m FROM ex GROUP BY x)
SELECT id, userID, round(m.m, 5) AS prediction FROM tex JOIN m USING (x)""",
)
def q_boosted(spark, sf_dir):
    """The first boosted tree fits labels of -1 and 1 by their mean, and twice
    its value is the log-odds."""
    return _flow(spark, sf_dir, kind="boosted", max_iter=1, maxDepth=1)


@register(
    "m4_tree_out_of_fold",
    f"""WITH {_BINARY_FOLDS_SQL}
SELECT cast(exf.fold AS int) AS fold, seq_id, cast(label AS double) AS label, round(m, 5) AS prediction
FROM exf JOIN mdl ON mdl.fold = exf.fold AND mdl.x = exf.x""",
)
def q_tree_folds(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    oof = flow.train(train, flow.flow_folder(spark), k=K_FOLDS, features=BINARY, kind="tree", maxDepth=1)
    return oof.select("fold", "seq_id", "label", rnd("prediction", 5).alias("prediction"))


# ---------------------------------------------------------------- feature versions, votes, candidates

_PLAIN_SQL = _SEQ_SQL.replace("concat(substring(assessmentItemID, 1, 3), cast(userID AS varchar)) AS seq_id", "cast(userID AS varchar) AS seq_id")


@register(
    "m2_train_examples_version0",
    _PLAIN_SQL
    + """SELECT seq_id, cast(correct[n] AS double) AS label,
       round(CASE WHEN n > 1 THEN cast(list_sum(correct[1:n - 1]) AS double) / (n - 1) END, 9) AS user_acc,
       cast(n - 1 AS double) AS user_total_answer, cast(CASE WHEN n > 1 THEN correct[n - 1] + 1 ELSE 0 END AS double) AS interaction
FROM z""",
)
def q_version0(spark, sf_dir):
    """Plain sequences: no grade split, no continuous columns."""
    train, _ = _train_test(spark, sf_dir)
    ex = flow.train_examples(train, flow.fit_encoders(train), version=0)
    return ex.select("seq_id", "label", rnd("user_acc").alias("user_acc"), "user_total_answer", "interaction")


_PLAIN_BINARY_SQL = _BINARY_SQL.replace("concat(substring(assessmentItemID, 1, 3), cast(userID AS varchar)) AS seq_id", "cast(userID AS varchar) AS seq_id")


@register(
    "m2_m3_version0_submission",
    f"""WITH {_PLAIN_BINARY_SQL},
m AS (SELECT x, avg(label) AS m FROM ex GROUP BY x)
SELECT id, userID, round(m.m, 5) AS prediction FROM tex JOIN m USING (x)""",
)
def q_flow0(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    path = flow.flow_folder(spark)
    flow.train(train, path, version=0, **EXACT)
    return flow.infer(test, path).select("id", "userID", rnd("prediction", 5).alias("prediction"))


@register(
    "m5_vote_over_folders",
    f"""WITH {_BINARY_FOLDS_SQL},
one AS (SELECT x, avg(label) AS m FROM ex GROUP BY x),
votes AS (SELECT id, userID, m FROM tex JOIN mdl USING (x) UNION ALL SELECT id, userID, m FROM tex JOIN one USING (x))
SELECT id, userID, round(avg(m), 5) AS prediction FROM votes GROUP BY id, userID""",
)
def q_folders(spark, sf_dir):
    """Five fold models of one training and the single model of another."""
    train, test = _train_test(spark, sf_dir)
    paths = [flow.flow_folder(spark) for _ in range(2)]
    flow.train(train, paths[0], k=K_FOLDS, **EXACT)
    flow.train(train, paths[1], **EXACT)
    return flow.infer(test, paths).select("id", "userID", rnd("prediction", 5).alias("prediction"))


@register(
    "m9_candidate_scores",
    f"""WITH {_BINARY_SQL},
h AS (SELECT *, row_number() OVER (ORDER BY md5(concat(seq_id, '|', '42')), seq_id) AS r, count(*) OVER () AS n FROM ex),
tr AS (SELECT * FROM h WHERE r <= floor(n * 0.7)),
v AS (SELECT 'a_previous' AS candidate, h.label AS y, t.p FROM h JOIN (SELECT x, avg(label) AS p FROM tr GROUP BY x) t USING (x) WHERE r > floor(n * 0.7)
      UNION ALL SELECT 'b_tree', h.label, t.p FROM h JOIN (SELECT x, avg(label) AS p FROM tr GROUP BY x) t USING (x) WHERE r > floor(n * 0.7)
      UNION ALL SELECT 'c_boosted', h.label, t.p FROM h JOIN (SELECT x, 1 / (1 + exp(-2 * (2 * avg(label) - 1))) AS p FROM tr GROUP BY x) t
        USING (x) WHERE r > floor(n * 0.7)),
a AS (SELECT i.candidate, sum(CASE WHEN i.p > j.p THEN 1.0 WHEN i.p = j.p THEN 0.5 ELSE 0 END) / count(*) AS auc
      FROM v i JOIN v j ON i.candidate = j.candidate AND i.y = 1 AND j.y = 0 GROUP BY i.candidate)
SELECT candidate, round(any_value(a.auc), 5) AS auc, round(avg(CASE WHEN (v.p >= 0.5) = (v.y = 1) THEN 1.0 ELSE 0.0 END), 5) AS acc,
       round(avg(-(v.y * ln(v.p) + (1 - v.y) * ln(1 - v.p))), 5) AS log_loss FROM v JOIN a USING (candidate) GROUP BY candidate""",
)
def q_candidates(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    path = flow.flow_folder(spark)
    flow.train(train, path, features=BINARY, candidates={
        "a_previous": {"tol": 1e-12, "max_iter": 200}, "b_tree": {"kind": "tree", "maxDepth": 1},
        "c_boosted": {"kind": "boosted", "max_iter": 1, "maxDepth": 1}})
    return flow.candidate_scores(spark, path).select("candidate", *[rnd(c, 5).alias(c) for c in ("auc", "acc", "log_loss")])


# ---------------------------------------------------------------- W1-W6, Y5 from one scan


@register(
    "w1_w6_histories_one_scan",
    f"""WITH i AS (SELECT event_id, userID, answerCode, "Timestamp", row_number() {_W}) - 1 AS n, lead("Timestamp") {_W}) AS nx,
  lag(answerCode) {_W}) AS pv, avg(answerCode) {_W} ROWS UNBOUNDED PRECEDING) AS cm,
  avg(answerCode) {_W} ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS rk,
  sum(answerCode) {_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM interactions),
g AS (SELECT *, ((epoch_us(nx) - epoch_us("Timestamp")) // 1000000) % 86400 AS gap FROM i)
SELECT event_id, userID, CASE WHEN gap < 80 THEN gap END AS time_diff, round(cm, 9) AS userID_acc_cummean, round(rk, 9) AS userID_acc_mean_recentK,
  cast(prior AS bigint) AS user_correct_answer, cast(n AS int) AS user_total_answer, round(CASE WHEN n > 0 THEN prior / n END, 9) AS user_acc,
  cast(coalesce(pv + 1, 0) AS int) AS interaction FROM g""",
)
def q_histories(spark, sf_dir):
    h = windows.add_histories(_log(spark, sf_dir))
    means = ("userID_acc_cummean", "userID_acc_mean_recentK", "user_acc")
    return h.select("event_id", "userID", "time_diff", "user_correct_answer", "user_total_answer", "interaction", *[rnd(c).alias(c) for c in means])


@register("w1_w6_histories_one_scan_split_learners")
def q_histories_split(spark, sf_dir):
    h = windows.add_histories(_log(spark, sf_dir), hot_rows=30, bucket_rows=11)
    means = ("userID_acc_cummean", "userID_acc_mean_recentK", "user_acc")
    return h.select("event_id", "userID", "time_diff", "user_correct_answer", "user_total_answer", "interaction", *[rnd(c).alias(c) for c in means])


ORACLE["w1_w6_histories_one_scan_split_learners"] = ORACLE["w1_w6_histories_one_scan"]


# ---------------------------------------------------------------- S1 by learner


def _laid_out(spark, sf_dir, hot_rows):
    return layout.write_layout(_log(spark, sf_dir), f"{flow.flow_folder(spark)}/layout", buckets=8, hot_rows=hot_rows)


@register(
    "s1_learner_layout_histories",
    f"""SELECT event_id, userID,
  round(avg(answerCode) {_W} ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 9) AS userID_acc_mean_recentK,
  row_number() {_W}) AS position FROM interactions""",
)
def q_layout(spark, sf_dir):
    """W3 and positions from the bucketed log; learners above 70 rows split."""
    s = _laid_out(spark, sf_dir, 70).each(windows.ordered_scan, recent_k=50, bucket_rows=30)
    mean = F.when(F.col("_rk_cnt") > 0, F.col("_rk_sum") / F.col("_rk_cnt"))
    return s.select("event_id", "userID", F.round(mean, 9).alias("userID_acc_mean_recentK"), F.col("_rn").cast("long").alias("position"))


@register("s1_learner_layout_time_diff")
def q_layout_w1(spark, sf_dir):
    return _laid_out(spark, sf_dir, 10**6).each(windows.add_time_diff, outlier_thres=80).select("event_id", "userID", "time_diff")


@register("s1_learner_layout_original_order")
def q_layout_p10(spark, sf_dir):
    return _laid_out(spark, sf_dir, 70).original_order().select("event_id", "original_order")


ORACLE["s1_learner_layout_time_diff"] = ORACLE["w1_time_diff"]
ORACLE["s1_learner_layout_original_order"] = ORACLE["p10_original_order"]


# ---------------------------------------------------------------- X1 with a model file


@register("x1_scorer_with_model_file")
def q_x1_file(spark, sf_dir):
    """The closed-form scorer, its two weights read from a file."""

    def load(path):
        return np.load(path)

    def score(pdf, w):
        return 1.0 / (1.0 + np.exp(-w[0] * (pdf["test_mean"] + pdf["tag_mean"] - w[1])))

    file = os.path.join(tempfile.mkdtemp(prefix="quizlog-weights-"), "weights.npy")  # on the driver, which ships it
    np.save(file, np.array([4.0, 1.0]))
    train, _ = _train_test(spark, sf_dir)
    s = model.map_score(keyed.target_encode(train), score, ["event_id"], ["test_mean", "tag_mean"], file=file, load=load)
    return s.select("event_id", rnd("prediction").alias("prediction"))


ORACLE["x1_scorer_with_model_file"] = ORACLE["x1_map_in_pandas_scorer"]
