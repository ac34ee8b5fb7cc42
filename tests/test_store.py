"""Statistics kept up to date: batches added = the whole log."""

import pytest
from log_helpers import LOG_SCHEMA, SF01, ts
from pyspark.sql import functions as F

from quizlog.operators import keyed, store
from quizlog.sources.fixture import interactions


def rows(df, cols):
    return sorted((str(tuple(r)) for r in df.select(*cols).collect()))


def test_batches_equal_the_whole(spark, tmp_path):
    log = interactions(spark, SF01)
    s = store.StatStore(spark, str(tmp_path / "s"))
    half = F.col("event_id") % 2 == 0
    s.add(log.where(half), "even")
    s.add(log.where("event_id < 100"), "odd")  # replaced below
    s.add(log.where(~half), "odd")
    cols = ["event_id", *[n if a == "count" else F.round(n, 9).alias(n) for n, (_, a) in keyed.FEATURE_STATS.items()]]
    want = rows(keyed.add_feature_stats(log), cols)
    assert rows(s.add_feature_stats(log), cols) == want
    s.compact()
    assert s.batches() == ["even", "odd"]
    assert rows(s.add_feature_stats(log), cols) == want
    with pytest.raises(ValueError):
        s.add(log, "odd")
    # a new day changes the figures without the old rows
    day = log.where("event_id < 500")
    s.add(day, "again")
    both = log.unionByName(day)
    assert rows(s.add_feature_stats(log), cols) == rows(keyed.add_feature_stats(log, fit_on=both), cols)


def test_first_timestamps_encoder_nulls_and_empty(spark, tmp_path):
    data = [
        (1, 1, ts(3), "A010001001", "A010000001", 1, 1), (2, 1, ts(2), "A010001001", None, None, 0), (3, None, ts(1), "A010001001", "A010000001", 2, 1),
        (4, 2, ts(5), None, "A010000001", 2, None), (5, 2, None, "A010001002", "A010000001", 2, 1),
    ]
    log = spark.createDataFrame(data, LOG_SCHEMA)
    s = store.StatStore(spark, str(tmp_path / "s"))
    assert s.batches() == [] and s.stats("test").count() == 0 and s.first_timestamps().count() == 0
    assert rows(s.add_feature_stats(log, ["testId_count"]), ["event_id", "testId_count"])[0] == "(1, None)"
    s.compact()
    s.add(log.limit(0), "nothing")
    for i in range(5):
        s.add(log.where(F.col("event_id") == i + 1), f"b{i}")
    got = {r["userID"]: r["Timestamp_start"] for r in s.first_timestamps().collect()}
    assert got == {1: ts(2), 2: ts(5)}
    enc = keyed.apply_target_encoder(log, s.target_encoder())
    assert rows(enc, sorted(enc.columns)) == rows(keyed.target_encode(log), sorted(enc.columns))
    with pytest.raises(ValueError):
        s.add(log, "")


def test_a_segment_without_a_manifest_does_not_count(spark, tmp_path):
    """What a failed job left behind is not read."""
    log = interactions(spark, SF01).limit(50)
    s = store.StatStore(spark, str(tmp_path / "s"))
    s.add(log, "one")
    before = rows(s.stats("tag"), ["KnowledgeTag", "n", "s"])
    s._write(store.partial_stats(log))
    assert rows(s.stats("tag"), ["KnowledgeTag", "n", "s"]) == before


def test_only_the_key_set_is_read(spark, tmp_path):
    s = store.StatStore(spark, str(tmp_path / "s"))
    s.add(interactions(spark, SF01).limit(50), "one")
    plan = s.stats("tag")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(set" in plan and "(set" in plan
