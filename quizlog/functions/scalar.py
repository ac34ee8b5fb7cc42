"""Column expressions.

All are built-in Spark expressions and stay inside whole-stage codegen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def grade(test_id: str | Column = "testId") -> Column:
    """Grade digit at character index 2 of the test id."""
    return F.substring(_c(test_id), 3, 1).cast("int")


def school(test_id: str | Column = "testId") -> Column:
    """``elementary_school`` when grade // 7 == 0, else ``middle_school``."""
    return F.when(F.floor(grade(test_id) / 7) == 0, F.lit("elementary_school")).otherwise(
        F.lit("middle_school")
    )


def grade_prefix(item_id: str | Column = "assessmentItemID") -> Column:
    """First three characters of the item id."""
    return F.substring(_c(item_id), 1, 3)


def grade_split_id(item_id: str | Column = "assessmentItemID", user: str | Column = "userID") -> Column:
    """Grade prefix followed by the user id, one sequence per grade (P5)."""
    return F.concat(grade_prefix(item_id), _c(user).cast("string"))


def in_int_range(x: str | Column, lower: str | Column, upper: str | Column) -> Column:
    """Membership in ``range(lower, upper)``: integer values only, upper bound
    excluded (P8, Q10)."""
    x = _c(x)
    return (x == F.floor(x)) & (x >= _c(lower)) & (x < _c(upper))


def binarize(score: str | Column = "prediction", threshold: float = 0.5) -> Column:
    """1 when score >= threshold, else 0."""
    return (_c(score) >= threshold).cast("int")


def epoch_seconds(ts: str | Column = "Timestamp") -> Column:
    """Whole seconds since 1970-01-01 00:00:00 of a ``timestamp_ntz``, read
    as UTC whatever the session time zone (F1)."""
    return F.floor(micros(ts) / 1_000_000)


def cyclical(x: str | Column, period: float) -> Column:
    """``struct(sin, cos)`` of 2*pi*x/period."""
    angle = _c(x) * F.lit(2.0 * math.pi / period)
    return F.struct(F.sin(angle).alias("sin"), F.cos(angle).alias("cos"))


def encoded_hour(ts: str | Column = "Timestamp") -> Column:
    return cyclical(F.hour(_c(ts)), 24)


def encoded_dayoftheweek(ts: str | Column = "Timestamp") -> Column:
    """Monday = 0 (``weekday``), period 7."""
    return cyclical(F.weekday(_c(ts)), 7)


def encoded_dayofthemonth(ts: str | Column = "Timestamp") -> Column:
    return cyclical(F.dayofmonth(_c(ts)), 31)


def encoded_month(ts: str | Column = "Timestamp") -> Column:
    return cyclical(F.month(_c(ts)), 12)


def seconds_component(gap_us: Column) -> Column:
    """Seconds part (0..86399) of a non-negative gap in microseconds, the way
    a pandas ``Timedelta.seconds`` reads (Q2)."""
    return F.pmod(F.floor(gap_us / 1_000_000), F.lit(86_400))


def micros(ts: str | Column) -> Column:
    """Microseconds since 1970-01-01 00:00:00 of a ``timestamp_ntz``.  A
    difference of local date-times, so it does not depend on the session
    time zone (a cast to ``timestamp`` would)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, _c(ts).cast("timestamp_ntz"))
