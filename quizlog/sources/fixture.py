"""Interaction log built from the driver's ``events`` table.

``events.props`` carries ``{"k": 0..99}``; ``k`` plays the item.  The view
keeps every event row, so all work downstream grows with ``events``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the fixture mapping (FIXTURES.md §3): 20 tests, 13 tags,
# grade = test % 9 + 1, an answer is right when value < 35.
N_TESTS = 20
N_TAGS = 13
N_GRADES = 9
RIGHT_BELOW = 35
TEST_USER_MOD = 10


def _pad3(c: Column) -> Column:
    return F.lpad(c.cast("string"), 3, "0")


def interactions_from_events(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    e = events.select("event_id", "user_id", "ts", "value", k.alias("k"))
    test = F.col("k") % N_TESTS
    grade = (test % N_GRADES + 1).cast("string")
    number = ((F.col("k") - test) / N_TESTS).cast("int")
    return e.select(
        F.col("event_id"),
        F.col("user_id").alias("userID"),
        F.col("ts").alias("Timestamp"),
        F.concat(F.lit("A0"), grade, F.lit("0"), _pad3(test), _pad3(number)).alias("assessmentItemID"),
        F.concat(F.lit("A0"), grade, F.lit("0000"), _pad3(test)).alias("testId"),
        (F.col("k") % N_TAGS).cast("int").alias("KnowledgeTag"),
        F.when(F.col("value") < RIGHT_BELOW, 1).otherwise(0).alias("answerCode"),
    )


EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full interaction log (train and test users together)."""
    return interactions_from_events(read_events(spark, sf_dir))


def split_logs(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Training log and test log of the fixture (FIXTURES.md §3).

    Users with ``userID % 10 = 0`` form the test log, and the last row of each
    test user by (Timestamp, event_id) is the hidden target (answerCode -1).
    The last row is found with a per-user max over a struct, a partial
    aggregate, so no window ever holds one user's whole history.
    """
    is_test = (F.col("userID") % TEST_USER_MOD) == 0
    train = log.where(~is_test)
    test = log.where(is_test)
    last = test.groupBy("userID").agg(
        F.max(F.struct("Timestamp", "event_id")).getField("event_id").alias("_last_event")
    )
    test = test.join(last, "userID", "left").select(
        *[c for c in log.columns if c != "answerCode"],
        F.when(F.col("event_id") == F.col("_last_event"), F.lit(-1))
        .otherwise(F.col("answerCode"))
        .alias("answerCode"),
    )
    return train, test.select(*log.columns)


def logs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(training log, test log) of the fixture in ``sf_dir``."""
    return split_logs(interactions(spark, sf_dir))


# DuckDB twin of ``interactions_from_events`` for oracle queries.
INTERACTIONS_DUCKDB = """
SELECT event_id, user_id AS userID, ts AS "Timestamp",
       concat('A0', cast(k % 20 % 9 + 1 AS varchar), '0', lpad(cast(k % 20 AS varchar), 3, '0'),
              lpad(cast(cast((k - k % 20) / 20 AS int) AS varchar), 3, '0')) AS assessmentItemID,
       concat('A0', cast(k % 20 % 9 + 1 AS varchar), '0000', lpad(cast(k % 20 AS varchar), 3, '0')) AS testId,
       cast(k % 13 AS int) AS KnowledgeTag,
       CASE WHEN value < 35 THEN 1 ELSE 0 END AS answerCode
FROM (SELECT *, cast(props->>'$.k' AS int) AS k FROM events) e
"""

TRAIN_DUCKDB = "SELECT * FROM interactions WHERE userID % 10 <> 0"

TEST_DUCKDB = """
SELECT event_id, userID, "Timestamp", assessmentItemID, testId, KnowledgeTag,
       CASE WHEN row_number() OVER (PARTITION BY userID ORDER BY "Timestamp" DESC, event_id DESC) = 1
            THEN -1 ELSE answerCode END AS answerCode
FROM interactions WHERE userID % 10 = 0
"""


def duck_with(sql: str) -> str:
    """Prefix an oracle query with the fixture views (merging its own WITH)."""
    head = (
        f"WITH interactions AS ({INTERACTIONS_DUCKDB}),\n"
        f"train_log AS ({TRAIN_DUCKDB}),\n"
        f"test_log AS ({TEST_DUCKDB})"
    )
    body = sql.lstrip()
    if body[:5].upper() == "WITH ":
        return f"{head},\n{body[5:]}"
    return f"{head}\n{body}"
