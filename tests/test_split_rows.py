"""The split path carries what a query returns, and one array a bucket for
frames that reach over bucket edges."""

import datetime as dt
import random

import pytest
from quizlog.operators import windows
from quizlog.plans import registry
from quizlog.sources.fixture import EVENTS_SCHEMA


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    """Two learners above the queries' limit of 30 rows, one below, rows without one."""
    r = random.Random(3)
    rows = []
    for user, n in ((1, 130), (2, 70), (3, 6), (None, 9)):
        for _ in range(n):
            at = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=r.randint(0, 400))
            rows.append((len(rows), at, user, "e", float(r.choice([10, 60])), '{"k": %d}' % r.randint(0, 99)))
    r.shuffle(rows)
    folder = str(tmp_path_factory.mktemp("events"))
    spark.createDataFrame(rows, EVENTS_SCHEMA).write.parquet(f"{folder}/events.parquet")
    return folder


def written(monkeypatch, run):
    """Columns of the tables that ``run`` writes on its way."""
    seen, plain = [], windows.materialize
    monkeypatch.setattr(windows, "materialize", lambda df: seen.append(set(df.columns)) or plain(df))
    out = run()
    return out, set().union(*seen)


@pytest.mark.parametrize("name, plain", [("w4_w6_prior_stats_split_learners", "w4_w6_prior_stats"),
                                         ("w3_recent_mean_k50_split_learners", "w3_recent_mean_k50")])
def test_split_rows_hold_no_column_that_is_not_returned(spark, events, monkeypatch, name, plain):
    out, cols = written(monkeypatch, lambda: registry.QUERIES[name](spark, events))
    assert "event_id" in cols and not cols & {"assessmentItemID", "testId", "KnowledgeTag"}
    assert sorted(map(str, out.collect())) == sorted(map(str, registry.QUERIES[plain](spark, events).collect()))


def test_bucket_table_is_hashed_not_sorted(spark, events, monkeypatch):
    plans, plain = [], windows.checked_broadcast
    monkeypatch.setattr(windows, "checked_broadcast", lambda df, *a: plans.append(df) or plain(df, *a))
    registry.QUERIES["w4_w6_prior_stats_split_learners"](spark, events)
    table = next(df for df in plans if "_on" in df.columns)
    assert "SortAggregate" not in table._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("k", [1, 2, 3, 5, 8, 50])
def test_halo_is_the_values_before_a_bucket(spark, k):
    """Buckets of uneven lengths, shorter and longer than the frame."""
    r = random.Random(k)
    rows, want = [], {}
    for user in (1, 2):
        before = []
        for b in range(9):
            if before and k > 1:
                want[user, b] = before[::-1][: k - 1]
            for _ in range(r.choice([1, 1, 2, 4, 7])):
                v = r.choice([0, 1, None])
                rows.append((user, b, user * 1000 + len(before), v))
                before.append(v)
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "userID long, _b long, _row long, answerCode int")
    halos = windows._halos(df, "answerCode", "userID", k)
    assert {(x["userID"], x["_b"]): x["_halo"] for x in halos.collect()} == want
    # no row is repeated for the buckets it is near, none is joined
    plan = halos._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan
