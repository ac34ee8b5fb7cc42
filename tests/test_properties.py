"""Randomised properties against small pure-Python models of the semantics."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from log_helpers import item, make_log, ts
from quizlog.operators import augment, metrics

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
I1, T1 = item(1, 1, 1)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from([0.0, 0.2, 0.5, 0.7, 1.0]), st.integers(0, 1)), min_size=2, max_size=40))
def test_auroc_equals_pair_counting(spark, pairs):
    df = spark.createDataFrame(pairs, "prediction double, target int")
    got = metrics.auroc(df).collect()[0]["auc"]
    pos = [p for p, y in pairs if y == 1]
    neg = [p for p, y in pairs if y == 0]
    if not pos or not neg:
        assert got is None
        return
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    assert abs(got - wins / (len(pos) * len(neg))) < 1e-12


def _slide_model(L, n, s):
    """Windows as lists of 0-based positions."""
    if L <= n:
        return [list(range(L))]
    T = (L - n) // s + 1
    out = [list(range(w * s, w * s + n)) for w in range(T)]
    if L != n + s * (T - 1):
        out.append(list(range(L - n, L)))
    return out


@SETTINGS
@given(st.integers(1, 25), st.integers(1, 8), st.integers(1, 6))
def test_sliding_windows_match_model(spark, L, n, s):
    rows = [(i + 1, 1, ts(1) + dt.timedelta(seconds=i), I1, T1, 1, i % 2) for i in range(L)]
    got = augment.sliding_windows(make_log(spark, rows), n=n, stride=s).collect()
    windows = sorted((r["window"], [e - 1 for e in r["event_ids"]]) for r in got)
    assert [w for _, w in windows] == _slide_model(L, n, s)


@SETTINGS
@given(st.integers(1, 25), st.integers(1, 8))
def test_tiled_crop_matches_model(spark, L, n):
    rows = [(i + 1, 1, ts(1) + dt.timedelta(seconds=i), I1, T1, 1, 0) for i in range(L)]
    got = augment.crop_windows(make_log(spark, rows), n=n, crop_type="tiled").collect()
    crops = sorted((r["start"], [e - 1 for e in r["event_ids"]]) for r in got)
    if L <= n:
        model = [(0, list(range(L)))]
    else:
        model = [(i, list(range(i, min(i + n, L)))) for i in range(0, L, n)]
    assert crops == model
