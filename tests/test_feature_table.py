"""The feature table: one learner exchange, equal on both paths."""

import random
import re

import pytest
from log_helpers import LOG_SCHEMA, SF01, item, ts
from pyspark.sql import functions as F

from quizlog.plans.features import feature_table
from quizlog.sources.fixture import interactions


@pytest.fixture(scope="module")
def log(spark):
    """Learners of several grades, rows without learner, test, tag, item or time."""
    r = random.Random(2)
    rows = []
    for i in range(700):
        code, test = item(r.choice([1, 6, 8]), r.randint(1, 3), r.randint(1, 4))
        user = r.choice([1, 1, 1, 2, 3, None])
        when = None if r.random() < 0.02 else ts(1 + r.randint(0, 9), r.randint(0, 2))
        rows.append((i, user, when, None if r.random() < 0.05 else code, None if r.random() < 0.05 else test,
                     r.choice([1, 2, None]), r.choice([0, 1, 1, None])))
    return spark.createDataFrame(rows, LOG_SCHEMA)


def rows(df):
    kinds = dict(df.dtypes)
    cols = [F.round(c, 9).alias(c) if kinds[c] == "double" else F.col(c) for c in sorted(df.columns)]
    return sorted(str(tuple(r)) for r in df.select(*cols).collect())


@pytest.mark.parametrize("family", [True, False])
def test_split_learners_equal_ordinary_ones(log, family):
    plain = feature_table(log, recent_k=5, family=family)
    split = feature_table(log, recent_k=5, family=family, scan_kw={"hot_rows": 100, "bucket_rows": 30})
    assert plain.columns == split.columns
    got = rows(plain)
    assert len(got) == 700 and got == rows(split)


def test_rows_without_a_family_have_no_history(log):
    out = feature_table(log)
    nobody = out.where("userID IS NULL")
    assert nobody.count() > 0
    assert nobody.where("coalesce(userID_count, time_diff, user_enterDay) IS NOT NULL OR userID_acc_cummean IS NOT NULL").count() == 0
    assert out.where("familyID IS NOT NULL AND original_order IS NULL").count() == 0


def test_one_exchange_by_learner(spark):
    plan = feature_table(interactions(spark, SF01))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(userID", plan)) == 1
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
