"""A log laid out by learner (S1): later scans need no shuffle.

Every history feature, sequence and position (W*, Y*, P10) is computed per
learner.  On a plain Parquet log each of them shuffles and sorts the log; a
log written once into buckets of learners, sorted inside, is read in that
layout, so the windows run where the rows are read.

A learner with more than ``HOT_ROWS`` rows does not fit a bucket: these rows
are written beside it, unbucketed, and go through the split path of
``windows.ordered_scan``.  The rows per learner are written too, so no scan
counts them again.  ``each`` applies a per-learner operator to both parts.

The bucketed part is a table of Spark's catalog over files in the layout's
folder; ``open_layout`` registers it in another session.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import keyed, rank, windows
from .io import LOG_COLUMNS, checked_log


@dataclass(frozen=True)
class LearnerLayout:
    """``light``: the bucketed rows; ``hot``: the rows of hot learners, or
    None; ``counts``: ``userID, _n`` of every learner."""

    light: DataFrame
    hot: DataFrame | None
    counts: DataFrame
    hot_rows: int

    def rows(self) -> DataFrame:
        return self.light if self.hot is None else self.light.unionByName(self.hot)

    def each(self, fn: Callable[..., DataFrame], **kw) -> DataFrame:
        """``fn(rows, counts=..., **kw)`` of both parts, for functions that
        pass ``counts`` on to ``windows.ordered_scan``."""
        few = self.counts.where(F.col("_n") <= self.hot_rows)
        # hot_rows of the light part: nothing in it is split, whatever fn's default
        out = fn(self.light, counts=few.limit(0), **{**kw, "hot_rows": self.hot_rows})
        if self.hot is None:
            return out
        many = self.counts.where(F.col("_n") > self.hot_rows)
        return out.unionByName(fn(self.hot, counts=many, **{**kw, "hot_rows": self.hot_rows}))

    def original_order(self, name: str = "original_order") -> DataFrame:
        """P10: start of each learner from the kept counts, then each row's
        place among its learner's."""
        start = rank.prefix_sums(self.counts, ["userID"], {"_start": "_n"}).select("userID", "_start")
        start = keyed.checked_broadcast(start)
        s = self.each(windows.ordered_scan, value=None).join(start, "userID", "left")
        return s.select(*LOG_COLUMNS, (F.col("_start") + F.col("_rn") - 1).alias(name))


def write_layout(
    log: DataFrame, path: str, buckets: int = 200, hot_rows: int = windows.HOT_ROWS, table: str | None = None
) -> LearnerLayout:
    """Write ``log`` by learner under ``path`` (a shared folder): one shuffle,
    one file per bucket, each sorted by learner, time and id."""
    spark, path = log.sparkSession, path.rstrip("/")
    log = checked_log(log)
    counts = log.where(F.col("userID").isNotNull()).groupBy("userID").agg(F.count(F.lit(1)).alias("_n"))
    counts.write.mode("overwrite").parquet(f"{path}/counts")
    names = spark.read.parquet(f"{path}/counts").where(F.col("_n") > hot_rows).select("userID")
    hot = not names.isEmpty()
    light = log
    if hot:
        names = keyed.checked_broadcast(names)
        light = log.join(names, "userID", "left_anti")
        log.join(names, "userID", "left_semi").select(*LOG_COLUMNS).write.mode("overwrite").parquet(f"{path}/hot")
    spark.createDataFrame([(buckets, hot_rows, hot)], "buckets int, hot_rows long, hot boolean").write.mode("overwrite").parquet(f"{path}/layout")
    name = table or f"quizlog_learners_{uuid.uuid4().hex}"
    # The bucket of a row is the shuffle partition of its learner: one file each.
    light = light.select(*LOG_COLUMNS).repartition(buckets, "userID")
    light.write.format("parquet").bucketBy(buckets, "userID").sortBy("userID", "Timestamp", "event_id").option(
        "path", f"{path}/rows").mode("overwrite").saveAsTable(name)
    return _layout(spark, path, name)


def open_layout(spark: SparkSession, path: str, table: str | None = None) -> LearnerLayout:
    """A written layout in this session."""
    path = path.rstrip("/")
    name = table or f"quizlog_learners_{uuid.uuid4().hex}"
    if not re.fullmatch(r"\w+", name) or "'" in path:
        raise ValueError("the table's name is a word, the path has no quote")
    buckets = spark.read.parquet(f"{path}/layout").first()["buckets"]
    columns = ", ".join(f"{c} {t}" for c, t in LOG_COLUMNS.items())
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        f"CLUSTERED BY (userID) SORTED BY (userID, Timestamp, event_id) INTO {buckets} BUCKETS LOCATION '{path}/rows'")
    return _layout(spark, path, name)


def _layout(spark: SparkSession, path: str, name: str) -> LearnerLayout:
    meta = spark.read.parquet(f"{path}/layout").first()
    hot = spark.read.parquet(f"{path}/hot") if meta["hot"] else None
    return LearnerLayout(spark.table(name), hot, spark.read.parquet(f"{path}/counts"), meta["hot_rows"])
