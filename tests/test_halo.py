"""Frames of the last K rows on split learners: halo rows travel, the log is
not joined with itself."""

import random

import pytest
from log_helpers import LOG_SCHEMA, ts

from quizlog.operators import windows


def rows(seed):
    r = random.Random(seed)
    out = []
    for u, n in ((1, 400), (2, 90), (3, 5), (None, 60), (4, 150)):
        for i in range(n):
            out.append((len(out), u, ts(1 + r.randint(0, 20), r.randint(0, 3)), "A010001001", "A010000001", 1, r.choice([0, 1, None])))
    r.shuffle(out)
    return out


@pytest.mark.parametrize("k, bucket", [(1, 7), (2, 1), (5, 3), (7, 50), (50, 4), (500, 9)])
def test_every_bucket_size_equals_the_plain_frame(spark, k, bucket):
    log = spark.createDataFrame(rows(k), LOG_SCHEMA)
    cols = ["event_id", "_rn", "_cs", "_rk_sum", "_rk_cnt"]
    plain = windows.ordered_scan(log, recent_k=k).select(cols)
    split = windows.ordered_scan(log, recent_k=k, hot_rows=60, bucket_rows=bucket).select(cols)
    assert split.schema == plain.schema
    assert sorted(map(tuple, split.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_no_join_over_log_rows(spark):
    log = spark.createDataFrame(rows(0), LOG_SCHEMA)
    out = windows.add_recent_mean(log, k=50, hot_rows=60, bucket_rows=20)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    # the hot learners' names (out of the light rows), the bucket table, the halos
    assert plan.count("BroadcastHashJoin") == 3


def test_double_values_keep_their_type(spark):
    log = spark.createDataFrame(rows(3), LOG_SCHEMA).selectExpr("*", "answerCode / 2 AS v")
    plain = windows.ordered_scan(log, value="v", recent_k=6).select("event_id", "_rk_sum")
    split = windows.ordered_scan(log, value="v", recent_k=6, hot_rows=60, bucket_rows=20).select("event_id", "_rk_sum")
    assert split.schema == plain.schema
    assert sorted(split.collect()) == sorted(plain.collect())


@pytest.mark.parametrize("split", [{}, {"hot_rows": 60, "bucket_rows": 20}])
def test_all_histories_equal_the_single_ones(spark, split):
    """One scan gives what each operator gives on its own."""
    log = spark.createDataFrame(rows(7), LOG_SCHEMA)
    got = windows.add_histories(log, recent_k=6, **split)
    single = [
        windows.add_time_diff(log), windows.add_cummean(log), windows.add_recent_mean(log, k=6), windows.add_prior_stats(log),
        windows.add_interaction_token(log),
    ]
    for one in single:
        cols = ["event_id", *[c for c in one.columns if c not in log.columns]]
        assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, one.select(cols).collect()))
