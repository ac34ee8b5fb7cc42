"""Vocabulary, sequence arrays and window augmentation on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from log_helpers import SF01, item, make_log, ts
from quizlog.operators import augment, sequences, vocab
from quizlog.sources.fixture import interactions

I1, T1 = item(1, 1, 1)


def _user_rows(spark, user, n, start_id=1, answers=None):
    rows = []
    for i in range(n):
        a = answers[i] if answers else i % 2
        rows.append((start_id + i, user, ts(1) + dt.timedelta(seconds=i), I1, T1, i % 5, a))
    return rows


def test_vocabulary_string_order_and_unknown(spark):
    rows = [(1, 1, ts(1), I1, T1, 2, 1), (2, 1, ts(1), I1, T1, 10, 1)]
    v = vocab.fit_vocabulary(make_log(spark, rows), ["KnowledgeTag"])
    codes = {r["label"]: r["code"] for r in v.collect()}
    # "10" < "2" < "unknown" in binary string order (Q5)
    assert codes == {"10": 0, "2": 1, "unknown": 2}
    test = make_log(spark, [(3, 2, ts(1), I1, T1, 2, 1), (4, 2, ts(1), I1, T1, 10, 1), (5, 2, ts(1), I1, T1, 99, 1),
                            (6, 2, ts(1), I1, T1, None, 1)])
    out = vocab.apply_vocabulary(test, v, ["KnowledgeTag"])
    got = {r["event_id"]: r["KnowledgeTag"] for r in out.collect()}
    # integer tags find their string labels (Q4); unseen and null -> unknown
    assert got == {3: 1, 4: 0, 5: 2, 6: 2}


def test_vocabulary_matches_string_indexer(spark):
    from pyspark.ml.feature import StringIndexer

    log = interactions(spark, SF01)
    v = vocab.fit_vocabulary(log, ["testId"]).where("label <> 'unknown'")
    si = StringIndexer(inputCol="testId", outputCol="ix", stringOrderType="alphabetAsc").fit(log)
    assert [r["label"] for r in v.orderBy("code").collect()] == list(si.labels)


def test_vocabulary_sizes_and_roundtrip(spark, tmp_path):
    log = interactions(spark, SF01)
    v = vocab.fit_vocabulary(log)
    sizes = {r["column"]: r["n_codes"] for r in vocab.vocabulary_sizes(v).collect()}
    assert sizes == {"assessmentItemID": 101, "testId": 21, "KnowledgeTag": 14}
    path = str(tmp_path / "vocab")
    vocab.save_vocabulary(v, path)
    back = vocab.load_vocabulary(spark, path)
    assert back.exceptAll(v).count() == 0 and v.exceptAll(back).count() == 0


def _mi(spark, lengths, n):
    rows = []
    eid = 1
    for u, L in enumerate(lengths):
        rows += _user_rows(spark, u, L, start_id=eid)
        eid += L
    log = make_log(spark, rows)
    coded = vocab.apply_vocabulary(log, vocab.fit_vocabulary(log))
    seqs = sequences.collect_sequences(coded, seq="userID", max_len=n)
    return {r["userID"]: r for r in sequences.model_input(seqs, n).collect()}


def test_truncate_pad_mask_shift(spark):
    n = 4
    got = _mi(spark, [n - 1, n, n + 1], n)
    short, exact, long_ = got[0], got[1], got[2]
    assert short["mask"] == [0.0, 1.0, 1.0, 1.0]
    assert exact["mask"] == [1.0] * 4 and long_["mask"] == [1.0] * 4
    # answers alternate 0,1,0,1,0 by position; the long one keeps the last 4
    assert short["correct"] == [0.0, 0.0, 1.0, 0.0]
    assert long_["correct"] == [1.0, 0.0, 1.0, 0.0]
    # interaction: 0 at the first kept position and on padding (Q6)
    assert short["interaction"] == [0, 0, 1, 2]
    assert long_["interaction"] == [0, 2, 1, 2]
    assert [r["gather_index"] for r in (short, exact, long_)] == [2, 3, 3]
    # ids shifted by one, 0 = padding
    assert short["tag"][0] == 0 and all(t >= 1 for t in short["tag"][1:])


def test_mask_sums_and_tokens_property(spark):
    log = interactions(spark, SF01)
    log = vocab.apply_vocabulary(log, vocab.fit_vocabulary(log))
    seqs = sequences.collect_sequences(log.withColumn("seq", F.concat_ws("-", "userID", "testId")), seq="seq", max_len=5)
    mi = sequences.model_input(seqs, 5)
    bad = mi.where(
        (F.aggregate("mask", F.lit(0.0), lambda a, x: a + x) != F.col("gather_index") + 1)
        | (F.size("test") != 5)
    )
    assert bad.count() == 0


def test_pad_sequences_tinyint_mask(spark):
    seqs = sequences.collect_sequences(make_log(spark, _user_rows(spark, 1, 3)), max_len=5)
    p = sequences.pad_sequences(seqs, 5).collect()[0]
    assert p["mask"] == [0, 0, 1, 1, 1] and p["correct"] == [0, 0, 0, 1, 0]


def _windows(df, key):
    return sorted((r[key], r["copy"] if "copy" in r else None, tuple(r["event_ids"])) for r in df.collect())


def test_sliding_windows_strides(spark):
    log = make_log(spark, _user_rows(spark, 1, 10))
    w3 = _windows(augment.sliding_windows(log, n=4, stride=3), "window")
    # (10-4)//3+1 = 3 windows starting 0,3,6; 6+4 = 10 reaches the end: no tail
    assert [w[2] for w in w3] == [(1, 2, 3, 4), (4, 5, 6, 7), (7, 8, 9, 10)]
    w4 = _windows(augment.sliding_windows(log, n=4, stride=4), "window")
    # 2 windows starting 0,4 + the tail window 6..9
    assert [w[2] for w in w4] == [(1, 2, 3, 4), (5, 6, 7, 8), (7, 8, 9, 10)]


def test_sliding_short_sequence_unchanged(spark):
    log = make_log(spark, _user_rows(spark, 1, 3))
    w = _windows(augment.sliding_windows(log, n=4, stride=1, shuffle=True), "window")
    assert w == [(0, -1, (1, 2, 3))]


def test_shuffle_replaces_all_but_last_full_window(spark):
    log = make_log(spark, _user_rows(spark, 1, 10))
    w = _windows(augment.sliding_windows(log, n=4, stride=4, shuffle=True, shuffle_n=2, seed=3), "window")
    # window 0 -> two shuffled copies; window 1 (last full) and tail kept
    assert [(a, b) for a, b, _ in w] == [(0, 0), (0, 1), (1, -1), (2, -1)]
    assert sorted(w[0][2]) == [1, 2, 3, 4] and sorted(w[1][2]) == [1, 2, 3, 4]
    assert w[2][2] == (5, 6, 7, 8)


def test_tiled_crop(spark):
    log = make_log(spark, _user_rows(spark, 1, 10))
    w = _windows(augment.crop_windows(log, n=4, crop_type="tiled"), "start")
    assert [(s, len(e)) for s, _, e in w] == [(0, 4), (4, 4), (8, 2)]
    wt = _windows(augment.crop_windows(log, n=4, crop_type="tiled", add_tail=True), "start")
    assert [s for s, _, _ in wt] == [0, 4, 6, 8]


def test_random_crops_in_range_and_distinct(spark):
    log = interactions(spark, SF01)
    for kind, lo_fn, hi_fn in (("random", lambda L: 0, lambda L: L - 20), ("overhang", lambda L: -19, lambda L: L - 2)):
        w = augment.crop_windows(log, n=20, crop_type=kind, seed=5)
        lens = {r["userID"]: r["c"] for r in log.groupBy("userID").agg(F.count("*").alias("c")).collect()}
        seen = set()
        for r in w.collect():
            L = lens[r["userID"]]
            assert lo_fn(L) <= r["start"] <= hi_fn(L)
            assert 1 <= len(r["event_ids"]) <= 20
            assert (r["userID"], r["start"]) not in seen
            seen.add((r["userID"], r["start"]))


def test_augment_dispatch(spark):
    log = make_log(spark, _user_rows(spark, 1, 10))
    assert augment.augment(log, "slide", n=4, stride=3).count() == 3
    assert augment.augment(log, "crop", n=4).count() == 3


def test_augmentation_identical_on_the_hot_learner_path(spark):
    log = interactions(spark, SF01)
    hot = {"hot_rows": 30, "bucket_rows": 11}
    for fn, kw in (
        (augment.sliding_windows, dict(n=20, stride=7, shuffle=True, shuffle_n=2)),
        (augment.crop_windows, dict(n=20, crop_type="random", seed=3)),
    ):
        a = fn(log, **kw).select(*[c for c in fn(log, **kw).columns])
        b = fn(log, scan_kw=hot, **kw)
        assert a.count() == b.count() and a.exceptAll(b).count() == 0
