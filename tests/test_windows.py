"""Per-learner window features on hand-made rows (FIXTURES §4) and the
hot-learner (bucketed) path against the plain path."""

from pyspark.sql import functions as F

from log_helpers import SF01, item, make_log, ts
from quizlog.operators import windows
from quizlog.sources.fixture import interactions

I1, T1 = item(1, 1, 1)


def _by_event(df, col):
    return {r["event_id"]: r[col] for r in df.select("event_id", col).collect()}


def test_time_diff_component_and_outliers(spark):
    # gaps: 1 day 5 s -> 5; exactly 80 s -> null; 79 s -> 79; last row -> null
    t0 = ts(1, 0, 0, 0)
    import datetime as dt

    rows = [
        (1, 7, t0, I1, T1, 1, 1),
        (2, 7, t0 + dt.timedelta(days=1, seconds=5), I1, T1, 1, 0),
        (3, 7, t0 + dt.timedelta(days=1, seconds=85), I1, T1, 1, 1),
        (4, 7, t0 + dt.timedelta(days=1, seconds=164), I1, T1, 1, 1),
    ]
    out = _by_event(windows.add_time_diff(make_log(spark, rows)), "time_diff")
    assert out == {1: 5, 2: None, 3: 79, 4: None}
    total = _by_event(windows.add_time_diff(make_log(spark, rows), mode="total", outlier_thres=10**9), "time_diff")
    assert total[1] == 86405


def test_equal_timestamps_follow_event_id(spark):
    rows = [(3, 1, ts(1), I1, T1, 1, 0), (1, 1, ts(1), I1, T1, 1, 1), (2, 1, ts(1), I1, T1, 1, 1)]
    out = windows.add_prior_stats(make_log(spark, rows))
    got = {r["event_id"]: (r["user_total_answer"], r["user_correct_answer"]) for r in out.collect()}
    assert got == {1: (0, None), 2: (1, 1), 3: (2, 2)}


def test_single_row_user_and_nulls(spark):
    rows = [
        (1, 5, ts(1), I1, T1, 1, 1),
        (2, 6, ts(1), I1, T1, 1, None),
        (3, 6, ts(1, 0, 0, 10), I1, T1, 1, 1),
    ]
    df = make_log(spark, rows)
    cm = _by_event(windows.add_cummean(df), "userID_acc_cummean")
    assert cm == {1: 1.0, 2: None, 3: 1.0}
    rk = _by_event(windows.add_recent_mean(df, k=1), "userID_acc_mean_recentK")
    assert rk == {1: 1.0, 2: None, 3: 1.0}
    td = _by_event(windows.add_time_diff(df), "time_diff")
    assert td == {1: None, 2: 10, 3: None}


def test_family_ids_interleaved_grades(spark):
    # users 2 and 10 with two grades each, interleaved in time; ids sort as
    # strings "10-1" < "2-1" but numbering is per user by first appearance.
    g3, t3 = item(3, 3, 1)
    g8, t8 = item(8, 8, 1)
    rows = [
        (1, 2, ts(1, 1), g8, t8, 1, 1),
        (2, 10, ts(1, 2), g3, t3, 1, 1),
        (3, 2, ts(1, 3), g3, t3, 1, 0),
        (4, 10, ts(1, 4), g8, t8, 1, 0),
        (5, 2, ts(1, 5), g8, t8, 1, 1),
        (6, 10, ts(1, 6), g3, t3, 1, 1),
        (7, 2, ts(1, 7), g3, t3, 1, 1),
        (8, 10, ts(1, 8), g8, t8, 1, 1),
    ]
    out = windows.family_ids(make_log(spark, rows))
    got = {r["event_id"]: (r["familyUserID"], r["school"], r["familyID"]) for r in out.collect()}
    assert got[1] == ("2-1", "middle_school", 2)
    assert got[3][0] == "2-2" and got[3][1] == "elementary_school"
    assert got[5][0] == "2-1" and got[7][0] == "2-2"
    assert got[2][0] == "10-1" and got[4][0] == "10-2" and got[6][0] == "10-1" and got[8][0] == "10-2"


def test_hot_learner_path_equals_plain_path(spark):
    log = interactions(spark, SF01)
    cols = ["event_id", "_len", "_rn", "_cs", "_cc", "_next_ts", "_prev_val", "_rk_sum", "_rk_cnt"]
    plain = windows.ordered_scan(log, recent_k=7).select(*cols)
    # Every learner above 20 rows is split into buckets of about 9 rows.
    hot = windows.ordered_scan(log, recent_k=7, hot_rows=20, bucket_rows=9).select(*cols)
    assert plain.count() == hot.count() == log.count()
    assert plain.exceptAll(hot).count() == 0
    assert hot.exceptAll(plain).count() == 0


def test_hot_path_mixed_with_light_learners(spark):
    log = interactions(spark, SF01)
    # About half the learners exceed 66 rows: both paths run and are unioned.
    a = windows.add_time_diff(log).select("event_id", "time_diff")
    b = windows.add_time_diff(log, hot_rows=66, bucket_rows=13).select("event_id", "time_diff")
    assert a.exceptAll(b).count() == 0 and b.count() == a.count()


def test_row_count_preserved_by_enrichments(spark):
    log = interactions(spark, SF01)
    n = log.count()
    for fn in (windows.add_cummean, windows.add_prior_stats, windows.add_interaction_token, windows.family_ids):
        assert fn(log).count() == n


def test_interaction_token_is_previous_answer_plus_one(spark):
    log = interactions(spark, SF01)
    t = windows.add_interaction_token(log)
    w_prev = windows.ordered_scan(log).select("event_id", "_rn")
    j = t.join(w_prev, "event_id")
    assert j.where((F.col("_rn") == 1) & (F.col("interaction") != 0)).count() == 0
    assert j.where(~F.col("interaction").isin(0, 1, 2)).count() == 0
