"""Results do not depend on the number of shuffle partitions."""

import pytest

import __spark_entry__ as entry
from log_helpers import SF01

QUERIES = [
    "w1_time_diff",
    "w3_recent_mean_k5",
    "e1_vocabulary_fit",
    "d2_kfold_users",
    "p10_original_order",
    "m6_auroc_tag_score",
    "g5_crop_random_n20",
    "a19_describe_test_acc",
]


@pytest.mark.parametrize("name", QUERIES)
def test_same_result_under_1_4_37_partitions(spark, name):
    q = entry.queries()[name]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in (1, 4, 37):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            results.append(sorted(map(tuple, q(spark, SF01).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1] == results[2]


@pytest.mark.parametrize("name", ["f1_f5_time_encodings", "w1_time_diff", "a17_user_enter_day", "a23_ols_two_predictors"])
def test_same_result_under_any_session_time_zone(spark, name):
    q = entry.queries()[name]
    old = spark.conf.get("spark.sql.session.timeZone")
    results = []
    try:
        for tz in ("UTC", "America/New_York", "Asia/Seoul"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            results.append(sorted(map(tuple, q(spark, SF01).collect())))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert results[0] == results[1] == results[2]
