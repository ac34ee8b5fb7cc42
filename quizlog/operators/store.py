"""Statistics kept up to date (A1-A16): a log grows by days, and each day is
read once.

A store is a folder of segments.  ``add`` aggregates one batch (a day's log)
to the count and sum of the answers per key, for all key sets of the
statistics in one grouping-sets job, and writes them as a segment; the rows
of earlier batches are not read again.  Count, sum and minimum are all that
A1-A16 need, and they add up over segments: a statistic is one aggregate over
the segments' rows (one per key and segment).  ``compact`` adds them up into
one segment when there are many.

What belongs to the store is said by its newest manifest, a file of one line
written after the segment it names: a batch whose job failed is not in it, and
adding a batch again under the same name replaces it.  One writer at a time.

Learner-keyed statistics grow with the log and are shuffle-joined; those of
tests, tags and items are broadcast after a size check, as in ``keyed``.
"""

from __future__ import annotations

import json
import uuid
from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import keyed

# Key sets of the statistics, by the name of their partition in a segment.
KEY_SETS = {
    "test": ("testId",),
    "tag": ("KnowledgeTag",),
    "item": ("assessmentItemID",),
    "user": ("userID",),
    "user_tag": ("userID", "KnowledgeTag"),
    "user_item": ("userID", "assessmentItemID"),
    "user_test": ("userID", "testId"),
}
_KEYS = ("userID", "testId", "KnowledgeTag", "assessmentItemID")


def partial_stats(log: DataFrame, value: str = "answerCode") -> DataFrame:
    """``set``, the keys, ``n`` and ``s`` (count and sum of the values) and,
    per learner, the first timestamp: every key set from one aggregate."""
    sets = [[F.col(k) for k in keys] for keys in KEY_SETS.values()]
    g = log.select(*_KEYS, value, "Timestamp").groupingSets(sets, *_KEYS).agg(
        F.count(value).alias("n"), F.sum(value).cast("bigint").alias("s"), F.min("Timestamp").alias("first"), F.grouping_id().alias("_gid"))
    name, known = F.lit(None).cast("string"), F.lit(False)
    for label, keys in KEY_SETS.items():
        gid = sum(1 << (len(_KEYS) - 1 - i) for i, k in enumerate(_KEYS) if k not in keys)
        name = F.when(F.col("_gid") == gid, label).otherwise(name)
        known = known | ((F.col("_gid") == gid) & keyed._not_null(keys))  # null keys own no statistic
    first = F.when(F.col("set") == "user", F.col("first"))
    return g.where(known).withColumn("set", name).select("set", *_KEYS, "n", "s", first.alias("first"))


class StatStore:
    """The statistics of all batches added to the folder ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ------------------------------------------------------------ manifest

    def _manifest(self) -> dict:
        try:
            lines = self.spark.read.text(f"{self.path}/manifest/*").collect()  # one line a version
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            lines = []
        versions = [json.loads(r["value"]) for r in lines]
        return max(versions, key=lambda m: m["version"], default={"version": 0, "segments": {}, "compacted": []})

    def _commit(self, was: dict, segments: dict[str, str], compacted: list[str]) -> None:
        version = was["version"] + 1
        line = json.dumps({"version": version, "segments": segments, "compacted": compacted})
        one = self.spark.createDataFrame([(line,)], "value string").coalesce(1)
        one.write.text(f"{self.path}/manifest/{version:08d}")  # fails where another writer was first

    def _write(self, stats: DataFrame) -> str:
        folder = f"segments/segment={uuid.uuid4().hex}"
        stats.write.partitionBy("set").parquet(f"{self.path}/{folder}")
        return folder

    def batches(self) -> list[str]:
        """Names of the batches in the store."""
        m = self._manifest()
        return sorted([*m["compacted"], *(n for n in m["segments"] if n)])

    # ------------------------------------------------------------ writing

    def add(self, log: DataFrame, batch: str, value: str = "answerCode") -> None:
        """Add one batch; a batch of that name is replaced."""
        if not batch:
            raise ValueError("a batch needs a name")
        m = self._manifest()
        if batch in m["compacted"]:
            raise ValueError(f"batch {batch} is part of a compacted segment")
        folder = self._write(partial_stats(log, value))
        self._commit(m, {**m["segments"], batch: folder}, m["compacted"])

    def compact(self) -> None:
        """All segments as one; their batches can no longer be replaced."""
        m = self._manifest()
        if not m["segments"]:
            return
        folder = self._write(self._summed(self._rows(m)))
        self._commit(m, {"": folder}, sorted({*m["compacted"], *(n for n in m["segments"] if n)}))

    # ------------------------------------------------------------ reading

    def _rows(self, manifest: dict | None = None) -> DataFrame:
        m = manifest or self._manifest()
        kinds = "userID bigint, testId string, KnowledgeTag int, assessmentItemID string, n bigint, s bigint, first timestamp_ntz, set string"
        folders = [f"{self.path}/{f}" for f in sorted(m["segments"].values())]
        if not folders:
            return self.spark.createDataFrame([], kinds)
        read = self.spark.read.schema(kinds).option("basePath", f"{self.path}/segments")
        return read.parquet(*folders).drop("segment")

    @staticmethod
    def _summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy("set", *_KEYS).agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("first").alias("first"))

    def stats(self, key_set: str) -> DataFrame:
        """Keys, ``n``, ``s`` and ``first`` of one key set, over all batches;
        only that set's files are read."""
        keys = list(KEY_SETS[key_set])
        rows = self._rows().where(F.col("set") == key_set)
        return rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("first").alias("first"))

    def add_feature_stats(self, df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
        """A1-A14 columns of ``df``'s rows from the store: the same as
        ``keyed.add_feature_stats`` fitted on all batches together."""
        by_set: dict[str, list[str]] = {}
        for name in names or keyed.FEATURE_STATS:
            keys = tuple(keyed.FEATURE_STATS[name][0])
            by_set.setdefault(next(s for s, k in KEY_SETS.items() if k == keys), []).append(name)
        for key_set, cols in by_set.items():
            t = self.stats(key_set).select(
                *KEY_SETS[key_set],
                *[(F.col("n") if keyed.FEATURE_STATS[c][1] == "count" else F.when(F.col("n") > 0, F.col("s") / F.col("n"))).alias(c) for c in cols])
            small = not key_set.startswith("user")
            df = df.join(keyed.checked_broadcast(t) if small else t, list(KEY_SETS[key_set]), "left")
        return df

    def target_encoder(self) -> tuple[list[DataFrame], bool]:
        """A15's tables for ``keyed.apply_target_encoder``."""
        tables = []
        for prefix, key in keyed.TARGET_KEYS.items():
            key_set = next(s for s, k in KEY_SETS.items() if k == (key,))
            mean = F.when(F.col("n") > 0, F.col("s") / F.col("n"))
            tables.append(keyed.materialize(self.stats(key_set).select(key, mean.alias(f"{prefix}_mean"), F.col("s").alias(f"{prefix}_sum"))))
        return tables, sum(map(keyed.table_bytes, tables)) <= keyed.BROADCAST_MAX_BYTES

    def first_timestamps(self) -> DataFrame:
        """Each learner's first timestamp and the first of all."""
        users = self.stats("user").select("userID", F.col("first").alias("Timestamp_start"))
        # one row: a minimum over the learners' table
        return users.crossJoin(F.broadcast(users.agg(F.min("Timestamp_start").alias("Timestamp_first"))))
