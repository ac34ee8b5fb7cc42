"""A log by learner: scans without a shuffle, equal results."""

import pytest
from log_helpers import LOG_SCHEMA, SF01, item, ts

from quizlog.operators import rank, sequences, windows
from quizlog.plans import flagship
from quizlog.sources import layout
from quizlog.sources.fixture import interactions, logs


def rows(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.fixture(scope="module")
def log(spark):
    nobody = spark.createDataFrame(
        [(10**9 + i, None, ts(1 + i), *item(1, 1, 1), 1, 1) for i in range(5)], LOG_SCHEMA)
    return interactions(spark, SF01).unionByName(nobody)


@pytest.fixture(scope="module")
def laid(spark, log, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layout") / "l")
    return layout.write_layout(log, path, buckets=5), path


def test_no_exchange_above_the_scan(spark, laid):
    one = laid[0]
    none = one.counts.limit(0)
    for out in (
        windows.add_time_diff(one.light, counts=none),
        windows.add_cummean(one.light, counts=none),
        windows.add_recent_mean(one.light, k=50, counts=none),
        windows.add_prior_stats(one.light, counts=none),
        windows.add_interaction_token(one.light, counts=none),
        sequences.collect_sequences(one.light, seq="userID", max_len=20),
    ):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan


def test_results_equal_the_plain_log(spark, log, laid):
    one = laid[0]
    assert one.hot is None and rows(one.rows()) == rows(log)
    assert rows(one.each(windows.add_time_diff)) == rows(windows.add_time_diff(log))
    assert rows(one.original_order()) == rows(rank.original_order(log).select(*one.light.columns, "original_order"))


def test_hot_learners_stand_beside_the_buckets(spark, log, tmp_path):
    one = layout.write_layout(log, str(tmp_path / "l"), buckets=3, hot_rows=70)
    n = one.hot.select("userID").distinct().count()
    assert 0 < n < 150 and one.light.where("userID is null").count() == 5
    cols = ["event_id", "_rn", "_cs", "_rk_sum", "_next_ts"]
    got = one.each(windows.ordered_scan, recent_k=9, bucket_rows=20).select(cols)
    assert rows(got) == rows(windows.ordered_scan(log, recent_k=9).select(cols))
    assert rows(one.original_order()) == rows(rank.original_order(log).select(*one.light.columns, "original_order"))


def test_a_written_layout_is_opened_again(spark, log, laid):
    again = layout.open_layout(spark, laid[1])
    assert rows(again.each(windows.add_cummean)) == rows(windows.add_cummean(log))
    plan = windows.add_cummean(again.light, counts=again.counts.limit(0))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    with pytest.raises(ValueError):
        layout.open_layout(spark, laid[1], "no; word")


def test_empty_log(spark, tmp_path):
    one = layout.write_layout(spark.createDataFrame([], LOG_SCHEMA), str(tmp_path / "l"), buckets=2)
    assert one.each(windows.add_time_diff).count() == 0 and one.original_order().count() == 0


def test_versions_have_their_features_and_vote_together(spark, tmp_path):
    train, test = logs(spark, SF01)
    paths = []
    for version in (0, 1, 2):
        ex = flagship.train_examples(train, flagship.fit_encoders(train), version=version)
        assert ("test_mean" in ex.columns) == (version == 2)
        assert ex.where("seq_id like 'A0%'").count() == (ex.count() if version else 0)
        paths.append(str(tmp_path / str(version)))
        flagship.train(train, paths[-1], version=version, max_iter=5)
    each = [{r["userID"]: r["prediction"] for r in flagship.infer(test, p).collect()} for p in paths]
    got = {r["userID"]: r["prediction"] for r in flagship.infer(test, paths).collect()}
    assert got.keys() == each[0].keys() == each[2].keys()
    for u, p in got.items():
        assert p == pytest.approx(sum(e[u] for e in each) / 3)


def test_plain_windows_have_no_continuous_columns(spark):
    train, _ = logs(spark, SF01)
    enc = flagship.fit_encoders(train)
    ex = flagship.train_examples(train, enc, n=10, augmentation="slide", version=1, stride=5)
    assert "test_mean" not in ex.columns and ex.count() > ex.select("seq_id").distinct().count() > 0


def test_candidate_scores_are_kept(spark, tmp_path):
    train, _ = logs(spark, SF01)
    path = str(tmp_path / "m")
    flagship.train(train, path, version=0, candidates={"plain": {}, "strict": {"reg": 5.0}, "tree": {"kind": "tree", "maxDepth": 2}})
    got = {r["candidate"]: r for r in flagship.candidate_scores(spark, path).collect()}
    assert set(got) == {"plain", "strict", "tree"} and all(0 < r["log_loss"] < 2 and 0 <= r["acc"] <= 1 for r in got.values())
