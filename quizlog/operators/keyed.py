"""Per-key statistics joined back to the log.

Every statistic is a partial aggregate (map-side combine, so a hot key costs
one small row per map task) followed by a left join back to the log.  The
statistic table is broadcast only after its row count was checked against a
limit; above it the join is a shuffle join whose skewed partitions AQE
splits.  A ``Window.partitionBy(key)`` is never used for these: a tag or a
learner holding a third of the log would land in a single task.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import micros
from ..session import ensure_checkpoint_dir

# Bytes a table may hold and still be broadcast (all tables of one join
# chain together).
BROADCAST_MAX_BYTES = 64 << 20


def _not_null(keys: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


# Aggregate builders: name -> value column -> Column.
AGGS = {
    "count": lambda v: F.count(v),
    "mean": lambda v: F.avg(v),
    "sum": lambda v: F.sum(v).cast("bigint"),
    "std": lambda v: F.stddev_samp(v),
    "min": lambda v: F.min(v),
    "max": lambda v: F.max(v),
}


# The same from partial counts ``_c`` and sums ``_s``.
_ROLL_UP = {
    "count": lambda: F.sum("_c"),
    "mean": lambda: F.when(F.sum("_c") > 0, F.sum("_s").cast("double") / F.sum("_c")),
    "sum": lambda: F.sum("_s").cast("bigint"),
}


def materialize(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` into the shared folder named by
    ``spark.checkpoint.dir`` and return it as a plan leaf: later plans read
    the checkpoint instead of recomputing the lineage, and a lost executor
    does not force a recomputation from the log.  Whatever a plan draws at
    run time (range bounds, partition numbers) is fixed from here on."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def row_bytes(df: DataFrame) -> Column:
    """Bytes a row takes in memory: 16, strings and arrays by their length,
    any other value by its type's default size."""
    each, fixed = F.lit(0).cast("long"), 16
    for f in df.schema.fields:
        if f.dataType.typeName() in ("string", "binary"):
            each, fixed = each + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)), fixed + 8
        elif f.dataType.typeName() == "array":
            inner = f.dataType.elementType
            item = 16 + 8 * len(inner.fields) if inner.typeName() == "struct" else 16
            # the size of a null array is -1 in a session without ANSI rules
            each, fixed = each + item * F.greatest(F.coalesce(F.size(F.col(f"`{f.name}`")), F.lit(0)), F.lit(0)), fixed + 24
        else:
            fixed += 64 if f.dataType.typeName() in ("array", "map", "struct") else 8
    return each + fixed


def table_bytes(df: DataFrame) -> int:
    """Bytes a table takes in memory; one aggregate over the table."""
    return int(df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()[0])


def checked_broadcast(stats: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Return ``stats`` marked for broadcast when it holds at most ``max_bytes``.

    The table is materialised first so the size check and the later join read
    the same rows instead of aggregating twice.  Above the limit the table is
    returned unmarked and the join shuffles.
    """
    stats = materialize(stats)
    return F.broadcast(stats) if table_bytes(stats) <= max_bytes else stats


def multi_key_stats(
    df: DataFrame,
    specs: Sequence[tuple[Sequence[str], dict[str, str]]],
    value: str = "answerCode",
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> tuple[list[DataFrame], bool]:
    """Several key statistics from one scan and one aggregation job.

    ``specs`` is a list of (keys, {name: aggregate}).  Counts, sums and means
    are first aggregated over all keys together and the groups rolled up with
    ``groupingSets``, so a log row is aggregated once however many sets there
    are; other aggregates expand each row once per set.  The result is
    materialised and its size (all sets together) checked once.  Returns one
    DataFrame per spec and whether they may be broadcast.
    """
    all_keys: list[str] = []
    for keys, _ in specs:
        all_keys += [k for k in keys if k not in all_keys]
    names: dict[str, str] = {}
    for _, aggs in specs:
        names.update(aggs)
    src, cols = df, [AGGS[a](F.col(value)).alias(n) for n, a in names.items()]
    if set(names.values()) <= set(_ROLL_UP):
        src = df.groupBy(*all_keys).agg(F.count(value).alias("_c"), F.sum(value).alias("_s"))
        cols = [_ROLL_UP[a]().alias(n) for n, a in names.items()]
    sets = [[F.col(k) for k in keys] for keys, _ in specs]
    g = src.groupingSets(sets, *all_keys).agg(*cols, F.grouping_id().alias("_gid"))
    g = materialize(g)
    small = table_bytes(g) <= max_bytes
    out = []
    n = len(all_keys)
    for keys, aggs in specs:
        gid = sum(1 << (n - 1 - i) for i, k in enumerate(all_keys) if k not in keys)
        part = g.where((F.col("_gid") == gid) & _not_null(keys)).select(*keys, *aggs)
        out.append(part)
    return out, small


# The feature library's fourteen key statistics (A1-A14): output name ->
# (keys, aggregate).
FEATURE_STATS = {
    "KnowledgeTag_count": (["KnowledgeTag"], "count"),
    "KnowledgeTag_acc_mean": (["KnowledgeTag"], "mean"),
    "KnowledgeTag_countU": (["userID", "KnowledgeTag"], "count"),
    "KnowledgeTag_acc_meanU": (["userID", "KnowledgeTag"], "mean"),
    "assessmentItemID_count": (["assessmentItemID"], "count"),
    "assessmentItemID_acc_mean": (["assessmentItemID"], "mean"),
    "assessmentItemID_countU": (["userID", "assessmentItemID"], "count"),
    "assessmentItemID_acc_meanU": (["userID", "assessmentItemID"], "mean"),
    "userID_count": (["userID"], "count"),
    "user_acc_mean": (["userID"], "mean"),
    "userID_acc_meanT": (["userID", "testId"], "mean"),
    "userID_countT": (["userID", "testId"], "count"),
    "testId_count": (["testId"], "count"),
    "testId_acc_mean": (["testId"], "mean"),
}


def _user_sets(df: DataFrame, by_keys: dict, value: str, extra: dict[str, Column] | None = None):
    """All learner-keyed statistics from one grouping-sets aggregate.

    Returns one DataFrame per key set.  They share the aggregate's exchange,
    so the log is scanned and shuffled once however many sets are joined
    back.  Their size grows with the log, so the joins are left to AQE: a
    shuffle join whose skewed partitions are split, or a broadcast when the
    materialised side turns out small at run time."""
    sets = [list(k) for k in by_keys]
    all_keys: list[str] = []
    for keys in sets:
        all_keys += [k for k in keys if k not in all_keys]
    names: dict[str, str] = {}
    for aggs in by_keys.values():
        names.update(aggs)
    cols = [AGGS[a](F.col(value)).alias(n) for n, a in names.items()]
    cols += [c.alias(n) for n, c in (extra or {}).items()]
    if len(sets) == 1:
        keys = sets[0]
        return [df.where(_not_null(keys)).groupBy(*keys).agg(*cols)]
    g = df.groupingSets([[F.col(k) for k in keys] for keys in sets], *all_keys).agg(*cols, F.grouping_id().alias("_gid"))
    n = len(all_keys)
    out = []
    for keys, aggs in by_keys.items():
        gid = sum(1 << (n - 1 - i) for i, k in enumerate(all_keys) if k not in keys)
        keep = list(aggs) + (list(extra) if list(keys) == sets[0] and extra else [])
        out.append(g.where((F.col("_gid") == gid) & _not_null(keys)).select(*keys, *keep))
    return out


def add_feature_stats(
    df: DataFrame,
    names: Sequence[str] | None = None,
    value: str = "answerCode",
    user_extra: dict[str, Column] | None = None,
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Add several A1-A14 columns.

    Dimension statistics (test, tag, item) come from one checked, broadcast
    ``groupingSets`` job; learner-keyed ones from one more aggregate shared
    by all their joins.  ``user_extra`` adds aggregates to the per-learner
    set.  Statistics are aggregated over ``fit_on`` (default ``df``); pass
    the plain log when ``df`` carries an expensive plan.
    """
    src = df if fit_on is None else fit_on
    names = list(names or FEATURE_STATS)
    by_keys: dict[tuple[str, ...], dict[str, str]] = {}
    if user_extra:
        by_keys[("userID",)] = {}
    for n in names:
        keys, agg = FEATURE_STATS[n]
        by_keys.setdefault(tuple(keys), {})[n] = agg
    out = df
    dims = [(list(k), a) for k, a in by_keys.items() if "userID" not in k]
    if dims:
        tables, small = multi_key_stats(src, dims, value)
        for (keys, _), t in zip(dims, tables):
            out = out.join(F.broadcast(t) if small else t, keys, "left")
    users = {k: a for k, a in by_keys.items() if "userID" in k}
    if users:
        for keys, t in zip(users, _user_sets(src, users, value, user_extra)):
            out = out.join(t, list(keys), "left")
    return out


# ---------------------------------------------------------------- A15 / J2

TARGET_KEYS = {"test": "testId", "tag": "KnowledgeTag", "assessment": "assessmentItemID"}


def fit_target_encoder(fit_on: DataFrame, value: str = "answerCode") -> tuple[list[DataFrame], bool]:
    """Mean and sum of ``value`` per test, tag and item from one scan of
    ``fit_on`` (A15).  Returns the statistic tables and whether they may be
    broadcast; fit once, apply to any number of logs."""
    specs = [([key], {f"{p}_mean": "mean", f"{p}_sum": "sum"}) for p, key in TARGET_KEYS.items()]
    return multi_key_stats(fit_on, specs, value)


def apply_target_encoder(df: DataFrame, encoder: tuple[list[DataFrame], bool], fill: float | None = None) -> DataFrame:
    """Left-join fitted target encodings to ``df`` (J2).  Unseen keys get
    null unless ``fill`` is set (Q9)."""
    tables, small = encoder
    out = df
    for key, t in zip(TARGET_KEYS.values(), tables):
        out = out.join(F.broadcast(t) if small else t, key, "left")
    if fill is not None:
        out = out.fillna({f"{p}_mean": fill for p in TARGET_KEYS})
    return out


def target_encode(
    df: DataFrame,
    fit_on: DataFrame | None = None,
    value: str = "answerCode",
    fill: float | None = None,
) -> DataFrame:
    """Mean and sum of ``value`` per test, tag and item, fitted on ``fit_on``
    (default ``df`` itself, the reference's behaviour, Q8) and left-joined to
    ``df`` (A15, J2)."""
    return apply_target_encoder(df, fit_target_encoder(df if fit_on is None else fit_on, value), fill)


# ---------------------------------------------------------------- A16-A18

US_PER_DAY = 86_400 * 1_000_000


def _us(c: Column) -> Column:
    return micros(c)


def first_timestamps(df: DataFrame, user: str = "userID", ts: str = "Timestamp") -> DataFrame:
    """Per-user first timestamp plus the global first timestamp."""
    per_user = df.groupBy(user).agg(F.min(ts).alias("Timestamp_start"))
    glob = df.agg(F.min(ts).alias("Timestamp_first"))
    # The global minimum is one row: a broadcast cross join of a single row.
    return per_user.crossJoin(F.broadcast(glob))


def add_user_enter_day(df: DataFrame, user: str = "userID", ts: str = "Timestamp") -> DataFrame:
    """Whole days from the global first event to the user's first event."""
    starts = first_timestamps(df, user, ts).select(
        user,
        F.floor((_us(F.col("Timestamp_start")) - _us(F.col("Timestamp_first"))) / US_PER_DAY)
        .cast("int")
        .alias("user_enterDay"),
    )
    return df.join(starts, user, "left")


def add_user_day_progress(df: DataFrame, user: str = "userID", ts: str = "Timestamp") -> DataFrame:
    """Whole days since the user's own first event."""
    starts = df.groupBy(user).agg(F.min(ts).alias("_start"))
    return (
        df.join(starts, user, "left")
        .withColumn(
            "user_day_progress",
            F.floor((_us(F.col(ts)) - _us(F.col("_start"))) / US_PER_DAY).cast("int"),
        )
        .drop("_start")
    )


# ---------------------------------------------------------------- J3

def keep_target_groups(df: DataFrame, group_keys: Sequence[str], target: Column | None = None) -> DataFrame:
    """Semi-join: keep rows whose group owns at least one target row."""
    target = target if target is not None else (F.col("answerCode") == -1)
    owners = df.where(target).select(*group_keys).distinct()
    return df.join(owners, list(group_keys), "left_semi")
