"""Small hand-made logs for the tests."""

import datetime as dt

SF01 = "/root/testdata/sf0.01"

LOG_SCHEMA = (
    "event_id bigint, userID bigint, Timestamp timestamp_ntz, assessmentItemID string, testId string, "
    "KnowledgeTag int, answerCode int"
)


def ts(day: int, h: int = 0, m: int = 0, s: int = 0) -> dt.datetime:
    return dt.datetime(2024, 1, day, h, m, s)


def make_log(spark, rows):
    """rows: (event_id, userID, Timestamp, item, test, tag, answer)."""
    return spark.createDataFrame(rows, LOG_SCHEMA)


def item(grade: int, test: int, number: int) -> tuple[str, str]:
    return f"A0{grade}0{test:03d}{number:03d}", f"A0{grade}0000{test:03d}"
