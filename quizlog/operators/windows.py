"""Per-learner ordered features (W1-W7, Y5 row form).

Order inside a learner is (Timestamp, event_id), so every result is total
and reproducible.

Scale: a ``Window.partitionBy(userID)`` puts one learner's whole history in
one task.  That is fine for ordinary histories but not for a learner (or a
bot account) owning a large share of the log.  ``ordered_scan`` therefore
first counts rows per learner (a partial aggregate) and splits learners with
more than ``hot_rows`` rows into ordered buckets of at most ``bucket_rows``
rows: consecutive rows of range partitions, which are balanced by sampling.
How many range partitions there are follows from the rows, not from the
buckets, so short buckets cost no tasks.  The split rows are written once
with their bucket number, and everything after reads that table: a bucket
number derived twice from sampled bounds could differ.
Inside a bucket the window runs as usual; a small per-bucket table (one row
per bucket, broadcast after a size check) carries the running offsets, the
next bucket's first timestamp and the previous bucket's last answer across
bucket edges; for a frame of the last K rows also the halo, the K - 1 rows
before the bucket.  Where buckets are many, these tables are joined instead:
the rows already lie by (learner, bucket), so only the table is shuffled.
Results are identical on both paths.

Rows without a learner belong to no history: each is dealt by its own
tie-breaker, so any number of them spreads over the tasks, and every column
of the scan is null for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import micros, school as school_of, grade as grade_of, seconds_component
from .keyed import checked_broadcast, materialize

# Learners with more rows than this are split into ordered buckets.
HOT_ROWS = 2_000_000
# Most rows per bucket of a split learner, and about the rows of a range partition.
BUCKET_ROWS = 500_000
# Bytes of a per-bucket table that is broadcast.  A larger one, from many short
# buckets, meets the rows where their windows have put them, by (user, bucket).
EDGE_MAX_BYTES = 8 << 20

SCAN_COLS = ("_len", "_rn", "_cs", "_cc", "_next_ts", "_prev_val", "_rk_sum", "_rk_cnt")
_ALONE = "_alone"  # null for a learner's rows, spreads rows without a learner


def _window(user: str, ts: str, tie: str, extra: tuple[str, ...] = ()) -> Window:
    return Window.partitionBy(user, *extra).orderBy(ts, tie)


def _hot_users(counts: DataFrame, user: str, hot_rows: int) -> DataFrame | None:
    """Learners above the limit with their row counts (one evaluation)."""
    hot = materialize(counts.where((F.col("_n") > hot_rows) & F.col(user).isNotNull()).select(user, "_n"))
    return None if hot.isEmpty() else hot


# Aggregates for ``user_aggs``: name -> Column builder.
_USER_AGGS = {
    "count": F.count,
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "sum": F.sum,
}


def _user_agg_cols_window(user: str, user_aggs: dict | None) -> list[Column]:
    """Per-learner (and learner x key) aggregates as windows.  Hash
    partitioning by the learner satisfies every ``partitionBy(learner,
    key)``, so they ride on the scan's single shuffle.  A null key gets null,
    as with a group-by that drops null keys."""
    cols = []
    for name, (keys, agg, col) in (user_aggs or {}).items():
        e = _USER_AGGS[agg](F.col(col)).over(Window.partitionBy(user, _ALONE, *keys))
        has = F.col(user).isNotNull()
        for k in keys:
            has = has & F.col(k).isNotNull()
        cols.append(F.when(has, e).alias(name))
    return cols


def _light_scan(
    df: DataFrame, value: str | None, user: str, ts: str, tie: str, recent_k: int | None, user_aggs: dict | None = None
) -> DataFrame:
    alone = F.when(F.col(user).isNull(), F.xxhash64(tie))
    w = _window(user, ts, tie, (_ALONE,))
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    cols = {
        "_len": F.count(F.lit(1)).over(Window.partitionBy(user, _ALONE)),
        "_rn": F.row_number().over(w),
        "_next_ts": F.lead(ts).over(w),
    }
    if value is not None:
        cols |= {"_cs": F.sum(value).over(upto), "_cc": F.count(value).over(upto), "_prev_val": F.lag(value).over(w)}
        if recent_k:
            last_k = w.rowsBetween(-(recent_k - 1), 0)
            cols |= {"_rk_sum": F.sum(value).over(last_k), "_rk_cnt": F.count(value).over(last_k)}
    has = F.col(user).isNotNull()
    return df.withColumn(_ALONE, alone).select(
        *df.columns, *[F.when(has, c).alias(n) for n, c in cols.items()], *_user_agg_cols_window(user, user_aggs)
    )


def _halos(rows: DataFrame, value: str, user: str, k: int) -> DataFrame:
    """``user, _b, _halo``: the values of the last K - 1 rows before each
    bucket, the nearest first; buckets that start a history have none.

    They are the last rows of the bucket before (of several, where buckets
    are shorter than K).  A group limit keeps K - 1 rows of each bucket, as
    one array a bucket, and buckets take the arrays before them: of the kept
    rows, counted through a history, a frame reaches K - 1 back, so it holds
    less than 2 K values however short the buckets are."""
    last = Window.partitionBy(user, "_b").orderBy(F.col("_row").desc())
    tails = rows.select(user, "_b", "_row", F.col(value).alias("_v")).withColumn("_back", F.row_number().over(last))
    item = F.struct(F.col("_back").alias("at"), F.col("_v").alias("v"))
    tail = F.transform(F.array_sort(F.collect_list(item)), lambda x: x["v"])
    tails = tails.where(F.col("_back") < k).groupBy(user, "_b").agg(tail.alias("_tail"))
    kept = F.sum(F.size("_tail")).over(Window.partitionBy(user).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
    wk = Window.partitionBy(user).orderBy("_kept")
    reach = F.collect_list("_tail").over(wk.rangeBetween(-max(k - 2, 0), 0))
    near = tails.withColumn("_kept", kept).select(
        user, "_b", "_kept", F.slice(F.flatten(F.reverse(reach)), 1, k - 1).alias("_upto"))
    return near.select(user, "_b", F.lag("_upto").over(wk).alias("_halo")).where(F.col("_halo").isNotNull())


def _range_partitions(df: DataFrame, total: int, bucket_rows: int) -> int:
    """Range partitions for ``total`` split rows: the session's parallelism,
    more where they would exceed ``BUCKET_ROWS`` rows, no more than buckets."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(-(-total // bucket_rows), max(tasks, -(-total // BUCKET_ROWS))))


def _bucketed_scan(
    df: DataFrame, hot: DataFrame, value: str | None, user: str, ts: str, tie: str, recent_k: int | None, bucket_rows: int
) -> DataFrame:
    # Buckets are runs of ``bucket_rows`` rows of range partitions of the hot
    # rows in (user, ts, tie) order.  Spark samples the bounds, so partitions
    # are even however bursty a learner's timestamps are; their ids, and the
    # buckets in each, follow the order.  ``hot`` is materialised and holds one
    # row per hot learner, so its total is read on the driver.
    n_ranges = _range_partitions(df, int(hot.agg(F.sum("_n")).first()[0]), bucket_rows)
    # partition id in the upper bits, the row's place in the partition below:
    # one number that has the rows' order, and cheaper to sort by
    place = F.col("_row") % F.lit(1 << 33)
    rows = materialize(
        df.join(checked_broadcast(hot.select(user, F.col("_n").alias("_len"))), user, "inner")
        .repartitionByRange(n_ranges, F.col(user), F.col(ts), F.col(tie))
        .sortWithinPartitions(user, ts, tie)
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_b", F.col("_row") - place + F.floor(place / bucket_rows))
    )

    wb = Window.partitionBy(user, "_b").orderBy("_row")
    upto = wb.rowsBetween(Window.unboundedPreceding, 0)
    local = {"_lrn": F.row_number().over(wb), "_lnext": F.lead(ts).over(wb)}
    per = {"_bn": F.count(F.lit(1)), "_bfirst": F.min(ts)}
    wo = Window.partitionBy(user).orderBy("_b")
    before = wo.rowsBetween(Window.unboundedPreceding, -1)
    offset = {"_on": F.coalesce(F.sum("_bn").over(before), F.lit(0)), "_nfirst": F.lead("_bfirst").over(wo)}
    res = {
        "_len": F.col("_len"),
        "_rn": (F.col("_on") + F.col("_lrn")).cast("int"),
        "_next_ts": F.coalesce(F.col("_lnext"), F.col("_nfirst")),
    }
    halo = bool(recent_k) and value is not None
    if value is not None:
        local |= {"_lcs": F.sum(value).over(upto), "_lcc": F.count(value).over(upto), "_lprev": F.lag(value).over(wb)}
        per |= {"_bs": F.sum(value), "_bc": F.count(value), "_blast": F.max_by(F.col(value), F.col("_row"))}
        offset |= {
            "_os": F.coalesce(F.sum("_bs").over(before), F.lit(0)),
            "_oc": F.coalesce(F.sum("_bc").over(before), F.lit(0)),
            "_plast": F.lag("_blast").over(wo),
        }
        cc = F.col("_oc") + F.col("_lcc")
        res |= {
            "_cs": F.when(cc > 0, F.col("_os") + F.coalesce(F.col("_lcs"), F.lit(0))),
            "_cc": cc,
            "_prev_val": F.when(F.col("_lrn") == 1, F.col("_plast")).otherwise(F.col("_lprev")),
        }
    if halo:
        last_k = wb.rowsBetween(-(recent_k - 1), 0)
        local |= {"_lrs": F.sum(value).over(last_k), "_lrc": F.count(value).over(last_k)}
        # what the frame lacks: the nearest K - _lrn rows of the halo
        reach = F.slice("_halo", F.lit(1), F.greatest(F.lit(recent_k) - F.col("_lrn"), F.lit(0)))
        short = (F.col("_lrn") < recent_k) & F.col("_halo").isNotNull()
        kind = rows.select(F.sum(value)).schema[0].dataType
        more_s = F.when(short, F.aggregate(reach, F.lit(0).cast(kind), lambda a, x: (a + F.coalesce(x, F.lit(0))).cast(kind)))
        more_c = F.when(short, F.size(F.filter(reach, lambda x: x.isNotNull())))
        cnt = F.col("_lrc") + F.coalesce(more_c, F.lit(0))
        total = F.coalesce(F.col("_lrs"), F.lit(0)) + F.coalesce(more_s, F.lit(0))
        res |= {"_rk_sum": F.when(cnt > 0, total), "_rk_cnt": cnt}

    def named(cols: dict[str, Column]) -> list[Column]:
        return [c.alias(n) for n, c in cols.items()]

    offsets = rows.groupBy(user, "_b").agg(*named(per)).select(user, "_b", *named(offset))
    # One row per bucket: at most (#hot learners + rows / bucket_rows) rows.
    out = rows.select("*", *named(local)).join(checked_broadcast(offsets, EDGE_MAX_BYTES), [user, "_b"], "inner")
    if halo:
        # At most K - 1 rows a bucket; only the first K - 1 rows of a bucket take them.
        near = checked_broadcast(_halos(rows, value, user, recent_k), EDGE_MAX_BYTES).alias("_near")
        same = (F.col(f"_out.{user}") == F.col(f"_near.{user}")) & (F.col("_out._b") == F.col("_near._b"))
        out = out.alias("_out").join(near, same & (F.col("_out._lrn") < recent_k), "left").select("_out.*", "_near._halo")
    out = out.select(*df.columns, *named(res))
    return out


def _add_user_aggs_joined(out: DataFrame, rows: DataFrame, user: str, user_aggs: dict | None) -> DataFrame:
    """The same aggregates for split learners: group-bys over their rows
    (one per key set) joined back, after a size check."""
    by_keys: dict[tuple, list] = {}
    for name, (keys, agg, col) in (user_aggs or {}).items():
        by_keys.setdefault(tuple(keys), []).append(_USER_AGGS[agg](F.col(col)).alias(name))
    for keys, aggs in by_keys.items():
        src = rows
        for k in keys:
            src = src.where(F.col(k).isNotNull())
        stats = checked_broadcast(src.groupBy(user, *keys).agg(*aggs))
        out = out.join(stats, [user, *keys], "left")
    return out


def ordered_scan(
    df: DataFrame,
    value: str | None = "answerCode",
    user: str = "userID",
    ts: str = "Timestamp",
    tie: str = "event_id",
    recent_k: int | None = None,
    hot_rows: int = HOT_ROWS,
    bucket_rows: int = BUCKET_ROWS,
    user_aggs: dict | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Add per-learner running columns in (ts, tie) order.

    ``_len`` rows of the learner, ``_rn`` 1-based position, ``_next_ts`` next
    row's timestamp; with a ``value`` also ``_cs`` / ``_cc`` running sum /
    non-null count of it including the row, ``_prev_val`` previous row's
    value, and with ``recent_k`` the sum / count of non-null values over the
    last K rows (``_rk_sum`` / ``_rk_cnt``).

    ``user_aggs`` maps an output name to ``(extra_keys, aggregate, column)``:
    an aggregate per learner (and extra keys), e.g. ``{"n": ([], "count",
    "answerCode")}``.  Ordinary learners get them as windows on the scan's
    own partitioning; split learners from small group-bys joined back.

    ``counts`` is a table ``(user, _n)`` of rows per learner, for callers
    that have one cheaper than a count over ``df``.
    """
    if counts is None:
        counts = df.groupBy(user).agg(F.count(F.lit(1)).alias("_n"))
    hot = _hot_users(counts, user, hot_rows)
    if hot is None:
        return _light_scan(df, value, user, ts, tie, recent_k, user_aggs)
    names = checked_broadcast(hot.select(user))
    light = _light_scan(df.join(names, user, "left_anti"), value, user, ts, tie, recent_k, user_aggs)
    heavy = _bucketed_scan(df, hot, value, user, ts, tie, recent_k, bucket_rows)
    if user_aggs:
        heavy = _add_user_aggs_joined(heavy, df.join(names, user, "left_semi"), user, user_aggs)
    return light.unionByName(heavy, allowMissingColumns=True)


def _drop_scan(df: DataFrame) -> DataFrame:
    return df.drop(*SCAN_COLS)


# ---------------------------------------------------------------- W1-W6

def add_time_diff(
    df: DataFrame, outlier_thres: float = 80, mode: str = "component", **scan_kw
) -> DataFrame:
    """Gap in seconds to the learner's next event.

    ``mode='component'`` keeps only the seconds part of the gap (0..86399), as
    the reference reads it (Q2); ``'total'`` uses whole seconds.  Gaps at or
    above ``outlier_thres`` and the last row of each learner are null (Q3).
    """
    s = ordered_scan(df, **scan_kw)
    gap_us = micros("_next_ts") - micros(scan_kw.get("ts", "Timestamp"))
    secs = seconds_component(gap_us) if mode == "component" else F.floor(gap_us / 1_000_000)
    return _drop_scan(s.withColumn("time_diff", F.when(secs < outlier_thres, secs).cast("bigint")))


def add_cummean(df: DataFrame, name: str = "userID_acc_cummean", **scan_kw) -> DataFrame:
    """Expanding mean of the answer including the current row."""
    s = ordered_scan(df, **scan_kw)
    return _drop_scan(s.withColumn(name, F.when(F.col("_cc") > 0, F.col("_cs") / F.col("_cc"))))


def add_recent_mean(df: DataFrame, k: int = 50, name: str = "userID_acc_mean_recentK", **scan_kw) -> DataFrame:
    """Mean of the last ``k`` answers including the current one, at least one
    value (W3)."""
    s = ordered_scan(df, recent_k=k, **scan_kw)
    return _drop_scan(s.withColumn(name, F.when(F.col("_rk_cnt") > 0, F.col("_rk_sum") / F.col("_rk_cnt"))))


def add_prior_stats(df: DataFrame, value: str = "answerCode", **scan_kw) -> DataFrame:
    """Answers before the current one (W4-W6): ``user_correct_answer`` (sum of
    earlier answers, null on a learner's first row), ``user_total_answer``
    (0-based position) and ``user_acc`` (their ratio, null at position 0)."""
    s = ordered_scan(df, value=value, **scan_kw)
    v = F.col(value)
    prior_nonnull = F.col("_cc") - F.when(v.isNotNull(), 1).otherwise(0)
    prior_sum = F.when(prior_nonnull > 0, F.coalesce(F.col("_cs"), F.lit(0)) - F.coalesce(v, F.lit(0)))
    prior_cnt = (F.col("_rn") - 1).cast("int")
    return _drop_scan(
        s.withColumn("user_correct_answer", prior_sum.cast("bigint"))
        .withColumn("user_total_answer", prior_cnt)
        .withColumn("user_acc", F.when(prior_cnt > 0, F.col("user_correct_answer") / prior_cnt))
    )


def add_interaction_token(df: DataFrame, value: str = "answerCode", name: str = "interaction", **scan_kw) -> DataFrame:
    """Row form of the shifted interaction token (Y5): 0 on a learner's first
    row, else previous answer + 1."""
    s = ordered_scan(df, value=value, **scan_kw)
    token = F.when(F.col("_rn").isNotNull(), F.coalesce(F.col("_prev_val") + 1, F.lit(0)))
    return _drop_scan(s.withColumn(name, token.cast("int")))


def add_histories(
    df: DataFrame,
    recent_k: int = 50,
    outlier_thres: float = 80,
    mode: str = "component",
    value: str = "answerCode",
    **scan_kw,
) -> DataFrame:
    """All history features (W1-W6, Y5 row form) from one ordered scan: the
    columns of ``add_time_diff``, ``add_cummean``, ``add_recent_mean``,
    ``add_prior_stats`` and ``add_interaction_token`` with one count of the
    learners' rows and one shuffle.  Each of those on its own counts and
    shuffles the log again; they take ``counts=`` to save the count."""
    s = ordered_scan(df, value=value, recent_k=recent_k, **scan_kw)
    gap_us = micros("_next_ts") - micros(scan_kw.get("ts", "Timestamp"))
    secs = seconds_component(gap_us) if mode == "component" else F.floor(gap_us / 1_000_000)
    v = F.col(value)
    before = F.col("_cc") - F.when(v.isNotNull(), 1).otherwise(0)
    right = F.when(before > 0, F.coalesce(F.col("_cs"), F.lit(0)) - F.coalesce(v, F.lit(0))).cast("bigint")
    place = (F.col("_rn") - 1).cast("int")
    return s.select(
        *df.columns,
        F.when(secs < outlier_thres, secs).cast("bigint").alias("time_diff"),
        F.when(F.col("_cc") > 0, F.col("_cs") / F.col("_cc")).alias("userID_acc_cummean"),
        F.when(F.col("_rk_cnt") > 0, F.col("_rk_sum") / F.col("_rk_cnt")).alias("userID_acc_mean_recentK"),
        right.alias("user_correct_answer"),
        place.alias("user_total_answer"),
        F.when(place > 0, right / place).alias("user_acc"),
        F.when(F.col("_rn").isNotNull(), F.coalesce(F.col("_prev_val") + 1, F.lit(0))).cast("int").alias("interaction"),
    )


# ---------------------------------------------------------------- W7

def family_table(
    df: DataFrame, user: str = "userID", ts: str = "Timestamp", tie: str = "event_id", test_id: str = "testId"
) -> DataFrame:
    """One row per (learner, school, grade): ``familyUserID`` and its number
    of rows ``_n``.  At most nine rows per learner."""
    sg = df.select(user, ts, tie, school_of(test_id).alias("school"), grade_of(test_id).alias("grade"))
    fam = sg.groupBy(user, "school", "grade").agg(F.min(F.struct(ts, tie)).alias("_first"), F.count(F.lit(1)).alias("_n"))
    k = F.row_number().over(Window.partitionBy(user).orderBy("_first"))
    name = F.concat(F.col(user).cast("string"), F.lit("-"), k.cast("string"))
    return fam.where(F.col(user).isNotNull()).select(user, "school", "grade", name.alias("familyUserID"), "_n")


def family_ids(
    df: DataFrame,
    user: str = "userID",
    ts: str = "Timestamp",
    tie: str = "event_id",
    test_id: str = "testId",
    families: DataFrame | None = None,
) -> DataFrame:
    """Family id (W7): one id per (learner, school, grade), numbered from 1 in
    order of the pair's first (Timestamp, event_id).

    Returns ``df`` plus ``school``, ``grade``, ``familyID`` (the original
    learner id) and ``familyUserID`` (``"<user>-<k>"``, null without a
    learner).  The window runs over the family table (``families``, by
    default from ``df``), never over the log.
    """
    fam = family_table(df, user, ts, tie, test_id) if families is None else families
    with_sg = df.withColumn("school", school_of(test_id)).withColumn("grade", grade_of(test_id))
    return with_sg.join(fam.drop("_n"), [user, "school", "grade"], "left").withColumn("familyID", F.col(user))


def as_family_users(df: DataFrame, user: str = "userID") -> DataFrame:
    """The feature library's layout after W7: ``userID`` holds the family id
    (``"<user>-<k>"``) and ``familyID`` the original learner, so every
    learner-keyed feature is computed per (learner, school, grade)."""
    return df.withColumn(user, F.col("familyUserID")).drop("familyUserID")
