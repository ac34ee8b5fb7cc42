"""The feature library's full table: every row of the log with
its order, school, grade, family id and the 23 feature columns.

The log is shuffled once, by learner.  Families (learner, school, grade) lie
inside a learner, so their numbers, the history features and all learner-keyed
statistics are windows on that one exchange; the dimension statistics come
from one grouping-sets job and are broadcast.  Learners with more rows than a
window should hold take the split path, where families are joined in and each
family's history is scanned in ordered buckets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import keyed, rank, windows

RECENT_K = 50
OUTLIER_THRES = 80


def _user_aggs() -> dict:
    """The learner-keyed statistics (A3, A4, A7-A12) and first timestamp."""
    out = {"_start": ([], "min", "Timestamp")}
    for name, (keys, agg) in keyed.FEATURE_STATS.items():
        if "userID" in keys:
            out[name] = ([k for k in keys if k != "userID"], agg, "answerCode")
    return out


def _light(log: DataFrame, start: DataFrame, recent_k: int, family: bool) -> DataFrame:
    """Order, family and history columns of ordinary learners: every window's
    partition holds the learner, so all of them run on one exchange."""
    who = ["userID", windows._ALONE]
    fam = [*who, "school", "grade"] if family else who
    t = log.withColumn(windows._ALONE, F.when(F.col("userID").isNull(), F.xxhash64("event_id")))
    t = t.withColumn("school", S.school()).withColumn("grade", S.grade())
    has = F.col("userID").isNotNull()
    # a row without school or grade belongs to no family
    known = has & F.col("school").isNotNull() & F.col("grade").isNotNull() if family else has
    in_order = Window.partitionBy(*fam).orderBy("Timestamp", "event_id")
    upto = in_order.rowsBetween(Window.unboundedPreceding, 0)
    last_k = in_order.rowsBetween(-(recent_k - 1), 0)
    cols = {
        "_next_ts": F.lead("Timestamp").over(in_order),
        "_cs": F.sum("answerCode").over(upto),
        "_cc": F.count("answerCode").over(upto),
        "_rk_sum": F.sum("answerCode").over(last_k),
        "_rk_cnt": F.count("answerCode").over(last_k),
    }
    for name, (keys, agg, col) in _user_aggs().items():
        there = reduce(lambda a, k: a & F.col(k).isNotNull(), keys, known)
        cols[name] = F.when(there, windows._USER_AGGS[agg](F.col(col)).over(Window.partitionBy(*fam, *keys)))
    t = t.select(
        *log.columns, "school", "grade", windows._ALONE,
        F.when(has, F.row_number().over(Window.partitionBy(*who).orderBy("Timestamp", "event_id"))).alias("_at"),
        F.min(F.struct("Timestamp", "event_id")).over(Window.partitionBy(*who, "school", "grade")).alias("_first"),
        *[F.when(known, c).alias(n) for n, c in cols.items()],
    )
    # families of a learner in the order of their first row
    k = F.dense_rank().over(Window.partitionBy(*who).orderBy("_first"))
    named = F.col("userID").isNotNull() & F.col("school").isNotNull() & F.col("grade").isNotNull()
    name = F.when(named, F.concat(F.col("userID").cast("string"), F.lit("-"), k.cast("string")))
    t = t.withColumn("familyUserID", name).join(start, "userID", "left")
    return t.withColumn("original_order", F.col("_start_at") + F.col("_at") - 1).withColumn("familyID", F.col("userID"))


def _split(log: DataFrame, start: DataFrame, recent_k: int, family: bool, counts: DataFrame, scan_kw: dict) -> DataFrame:
    """The same columns for learners whose rows are split into buckets."""
    s = windows.ordered_scan(log, value=None, counts=counts, **scan_kw).join(start, "userID", "left")
    s = s.select(*log.columns, (F.col("_start_at") + F.col("_rn") - 1).alias("original_order"))
    families = keyed.materialize(windows.family_table(log))
    s = windows.family_ids(s, families=families)
    s = windows.as_family_users(s) if family else s
    # Rows per scan key, known from the family table: no probe of the plan.
    sizes = families.select(F.col("familyUserID").alias("userID"), "_n") if family else counts
    return windows.ordered_scan(s, recent_k=recent_k, user_aggs=_user_aggs(), counts=sizes, **scan_kw)


def feature_table(
    log: DataFrame,
    recent_k: int = RECENT_K,
    outlier_thres: float = OUTLIER_THRES,
    family: bool = True,
    scan_kw: dict | None = None,
) -> DataFrame:
    """All feature columns for every row of ``log``.

    With ``family`` (the reference's default mode) ``userID`` is replaced by
    the family id and ``familyID`` keeps the learner, so learner features are
    per (learner, school, grade); ``original_order`` is always the row's
    position in (learner, Timestamp, event_id) order of the original log.
    """
    scan_kw = scan_kw or {}
    # One row per learner: the starts of P10 and who is split.
    counts = log.where(F.col("userID").isNotNull()).groupBy("userID").agg(F.count(F.lit(1)).alias("_n"))
    ranked = rank.prefix_sums(counts, ["userID"], {"_start_at": "_n"})
    ranked = keyed.checked_broadcast(ranked)
    start = ranked.select("userID", "_start_at")
    hot = windows._hot_users(ranked, "userID", scan_kw.get("hot_rows", windows.HOT_ROWS))
    carried = ["school", "grade", "familyID", "original_order"]
    columns = [*log.columns, *carried, *([] if family else ["familyUserID"])]
    made = [*_user_aggs(), "_next_ts", "_cs", "_cc", "_rk_sum", "_rk_cnt"]
    names = None if hot is None else keyed.checked_broadcast(hot.select("userID"))
    light = log if hot is None else log.join(names, "userID", "left_anti")
    s = _light(light, start, recent_k, family)
    s = windows.as_family_users(s) if family else s
    s = s.select(*columns, *made)
    if hot is not None:
        # learners above the limit: few, since each owns many rows of the log
        rows = log.join(names, "userID", "left_semi").select(*log.columns)
        s = s.unionByName(_split(rows, start, recent_k, family, hot, scan_kw).select(*columns, *made))
    gap = S.seconds_component(S.micros("_next_ts") - S.micros("Timestamp"))
    s = s.select(
        *columns,
        *_user_aggs(),
        F.when(gap < outlier_thres, gap).cast("bigint").alias("time_diff"),
        F.when(F.col("_cc") > 0, F.col("_cs") / F.col("_cc")).alias("userID_acc_cummean"),
        F.when(F.col("_rk_cnt") > 0, F.col("_rk_sum") / F.col("_rk_cnt")).alias("userID_acc_mean_recentK"),
        S.encoded_hour().alias("encoded_hour"),
        S.encoded_dayoftheweek().alias("encoded_dayoftheweek"),
        S.encoded_dayofthemonth().alias("encoded_dayofthemonth"),
        S.encoded_month().alias("encoded_month"),
    )
    # Test, tag and item statistics: one checked, broadcast grouping-sets job
    # over the log, not over the wide plan.
    dims = [n for n, (keys, _) in keyed.FEATURE_STATS.items() if "userID" not in keys]
    stats_src = log.select("assessmentItemID", "testId", "KnowledgeTag", "answerCode")
    s = keyed.add_feature_stats(s, dims, fit_on=stats_src)
    # The global first timestamp reads one raw column of the log.
    first = log.agg(F.min("Timestamp").alias("_first"))
    day = F.lit(keyed.US_PER_DAY)
    return s.crossJoin(F.broadcast(first)).select(
        *[c for c in s.columns if c != "_start"],
        F.floor((S.micros("_start") - S.micros("_first")) / day).cast("int").alias("user_enterDay"),
        F.floor((S.micros("Timestamp") - S.micros("_start")) / day).cast("int").alias("user_day_progress"),
    )
