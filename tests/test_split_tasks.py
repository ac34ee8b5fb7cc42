"""Short buckets cost no tasks, and many buckets no broadcast: the split path
at sizes where it has one bucket for every few rows."""

import random

import pytest
from log_helpers import LOG_SCHEMA, item, ts

from quizlog.operators import augment, windows
from quizlog.plans.features import feature_table
from quizlog.sources import layout


@pytest.fixture(scope="module")
def log(spark):
    """Learners with more rows than the limits below, one short, and rows without one."""
    r = random.Random(5)
    rows = []
    for user, n in ((1, 500), (2, 200), (3, 120), (4, 5), (None, 30)):
        for _ in range(n):
            code, test = item(r.choice([1, 2]), 1, r.randint(1, 3))
            rows.append((len(rows), user, ts(1 + r.randint(0, 20), r.randint(0, 3)), code, test, r.randint(1, 3), r.choice([0, 1, None])))
    r.shuffle(rows)
    return spark.createDataFrame(rows, LOG_SCHEMA).cache()


def most_tasks(spark, group, run):
    """Tasks of the largest stage that ``run`` starts."""
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    seen = sc.statusTracker()
    stages = [seen.getStageInfo(s) for j in seen.getJobIdsForGroup(group) for s in seen.getJobInfo(j).stageIds]
    return max(s.numTasks for s in stages if s)


def rows(df):
    return sorted(str(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


SPLIT = {"hot_rows": 60, "bucket_rows": 2}
RUNS = {
    "w1": lambda log, kw: windows.add_time_diff(log, **kw),
    "w3": lambda log, kw: windows.add_recent_mean(log, k=7, **kw),
    "w4_w6": lambda log, kw: windows.add_prior_stats(log, **kw),
    "w1_w6": lambda log, kw: windows.add_histories(log, recent_k=7, **kw),
    "g1_g2": lambda log, kw: augment.sliding_windows(log, n=20, stride=7, scan_kw=kw),
    "features": lambda log, kw: feature_table(log, recent_k=7, scan_kw=kw),
}


@pytest.mark.parametrize("name", RUNS)
def test_tasks_do_not_grow_with_the_buckets(spark, log, name):
    """820 split rows in buckets of 2 rows: 410 buckets, few tasks."""
    assert most_tasks(spark, f"split {name}", lambda: RUNS[name](log, SPLIT).count()) <= 40


def test_tasks_of_the_layout_do_not_grow_with_the_buckets(spark, log, tmp_path):
    def run():
        one = layout.write_layout(log, str(tmp_path / "l"), buckets=3, hot_rows=60)
        assert one.each(windows.ordered_scan, recent_k=7, bucket_rows=2).count() == 855

    assert most_tasks(spark, "split layout", run) <= 40


@pytest.mark.parametrize("name", RUNS)
def test_joined_bucket_tables_equal_broadcast_ones(spark, log, monkeypatch, name):
    plain = rows(RUNS[name](log, {}))
    monkeypatch.setattr(windows, "EDGE_MAX_BYTES", 0)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(RUNS[name](log, SPLIT)) == plain
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_arrays_count_by_their_length(spark):
    from quizlog.operators.keyed import table_bytes

    few, many = (spark.range(50).selectExpr("id", f"transform(sequence(1, {n}), x -> struct(x AS at, 1 AS v)) AS a") for n in (2, 200))
    assert table_bytes(many) - table_bytes(few) >= 50 * 198 * 16
    assert table_bytes(spark.range(3).selectExpr("cast(null AS array<int>) AS a")) < 300
