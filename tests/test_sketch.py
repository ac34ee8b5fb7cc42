"""Mergeable one-pass profiles."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from quizlog.operators import profile, sketch


def test_small_groups_are_exact(spark):
    rows = [("a", 1.0, 5), ("a", 2.0, 5), ("a", 2.0, None), ("b", None, 1), ("b", float("nan"), 2), ("c", 4.0, 3), (None, 7.0, 9)]
    df = spark.createDataFrame(rows, "g string, x double, y int").withColumn("column", F.lit("clash"))
    got = {(r["g"], r["column"]): r for r in sketch.describe(sketch.sketch(df, ["x", "y"], ["g"]), ["g"]).collect()}
    assert len(got) == 8
    a = got["a", "x"]
    assert (a["count"], a["mean"], a["min"], a["p50"], a["max"], a["mode"]) == (3, pytest.approx(5 / 3), 1, 2, 2, 2)
    assert a["std"] == pytest.approx(statistics.stdev([1, 2, 2])) and a["mode_share"] == pytest.approx(2 / 3)
    assert got["a", "y"]["count"] == 2 and got[None, "x"]["mode"] == 7
    b = got["b", "x"]
    assert b["count"] == 0 and all(b[c] is None for c in ("mean", "std", "min", "p25", "p50", "p75", "max", "mode", "mode_share"))
    assert got["c", "x"]["std"] is None


def test_merged_parts_equal_the_whole(spark):
    """Any split into parts, merged in any tree, has the exact figures of the
    whole and quantiles inside the stated rank error."""
    r = random.Random(1)
    xs = [r.choice([r.gauss(1e6, 1), float(r.randint(0, 20)), r.expovariate(1.0)]) for _ in range(60_000)]
    xs += [3.25] * 9_000
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i long, x double").repartition(8)
    parts = [sketch.sketch(df.where(F.col("i") % 3 == k), ["x"]) for k in range(3)]
    tree = sketch.merge([sketch.merge(parts[:2]), parts[2]])
    by_group = sketch.merge(sketch.sketch(df.withColumn("g", F.col("i") % 50), ["x"], ["g"]))
    ordered = sorted(xs)
    n = len(xs)
    for got in (sketch.describe(tree).first(), sketch.describe(by_group).first(), sketch.describe(sketch.sketch(df, ["x"])).first()):
        assert got["count"] == n and got["min"] == ordered[0] and got["max"] == ordered[-1]
        assert got["mean"] == pytest.approx(statistics.fmean(xs), rel=1e-12)
        assert got["std"] == pytest.approx(statistics.stdev(xs), rel=1e-9)
        for q in (0.25, 0.5, 0.75):
            v = got[f"p{round(100 * q)}"]
            below, upto = sum(x < v for x in xs) / n, sum(x <= v for x in xs) / n
            err = 3 * sketch.rank_error()
            assert below - err <= q <= upto + err
        assert got["mode"] == 3.25 and abs(got["mode_share"] - 9_000 / n) <= sketch.mode_error() + 20 / n


def test_one_scan_and_no_write(spark):
    """One aggregate over the rows, whatever the number of columns."""
    df = spark.range(1000).select((F.col("id") % 7).alias("a"), F.col("id").alias("b"))
    plan = sketch.describe(sketch.sketch(df, ["a", "b"]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and plan.count("Exchange SinglePartition") == 1
    assert not any(w in plan for w in ("Sort ", "Join", "ExistingRDD"))


def test_close_to_the_exact_profile(spark):
    df = spark.range(30_000).select(((F.col("id") * 7919) % 10_007).cast("double").alias("x"))
    exact, got = profile.describe(df, "x").first(), sketch.describe(sketch.sketch(df, ["x"])).first()
    assert got["count"] == exact["count"] and got["mean"] == pytest.approx(exact["mean"])
    for p in ("p25", "p50", "p75"):
        assert abs(got[p] - exact[p]) <= 10_007 * 3 * sketch.rank_error() + 1


def test_empty_table(spark):
    df = spark.range(0).select(F.col("id").cast("double").alias("x"), F.lit("g").alias("g"))
    assert sketch.sketch(df, ["x"], ["g"]).count() == 0
    assert sketch.describe(sketch.sketch(df, ["x"])).first()["count"] == 0
