"""Readers and writers.

Interaction logs are read with a fixed schema (no inference pass over the
data); predictions are written as ``id,prediction`` CSV with a header.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.rank import global_rank
from ..operators.vocab import load_vocabulary, save_vocabulary  # noqa: F401  (S4, S5)

# The reference's CSV layout: no event id, timestamps as text.
CSV_SCHEMA = T.StructType(
    [
        T.StructField("userID", T.LongType()),
        T.StructField("assessmentItemID", T.StringType()),
        T.StructField("testId", T.StringType()),
        T.StructField("answerCode", T.IntegerType()),
        T.StructField("Timestamp", T.TimestampNTZType()),
        T.StructField("KnowledgeTag", T.IntegerType()),
    ]
)

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


LOG_COLUMNS = {
    "event_id": "bigint",
    "userID": "bigint",
    "Timestamp": "timestamp_ntz",
    "assessmentItemID": "string",
    "testId": "string",
    "KnowledgeTag": "int",
    "answerCode": "int",
}


def checked_log(df: DataFrame, tie: str = "event_id") -> DataFrame:
    """The log's columns with their types (S1): every column must be there,
    ``tie`` names the tie-breaker (it becomes ``event_id``), and NaN answers
    or tags become null, which is how every statistic skips them."""
    source = {c: tie if c == "event_id" else c for c in LOG_COLUMNS}
    if missing := [s for s in source.values() if s not in df.columns]:
        raise ValueError(f"the log has no column {', '.join(missing)}")
    out = []
    for c, kind in LOG_COLUMNS.items():
        col = F.col(source[c])
        if df.schema[source[c]].dataType.typeName() in ("double", "float"):
            col = F.when(~F.isnan(col), col)
        out.append(col.cast(kind).alias(c))
    return df.select(*out)


def file_order(df: DataFrame, name: str = "event_id") -> DataFrame:
    """Number rows read from files in (path, place in the file) order.

    The order key is the file's path, the start of the split a row came from
    and the row's place inside the split, so it does not depend on how Spark
    packs splits into tasks or on the split size.  The numbers are a
    distributed rank; the rows are written once to the shared folder."""
    keyed_rows = df.select(
        "*",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )
    ranked = global_rank(keyed_rows, ["_path", "_block", "_at"], name)
    return ranked.withColumn(name, F.col(name) - 1).drop("_path", "_block", "_at")


def read_interactions_csv(spark: SparkSession, path: str, tie: str | None = None) -> DataFrame:
    """Read an interaction CSV with a header.

    Timestamps are parsed as ``yyyy-MM-dd HH:mm:ss`` into ``timestamp_ntz``.
    ``tie`` names a column of the file that breaks equal timestamps; without
    one ``event_id`` is the row's number in file order."""
    schema = CSV_SCHEMA if tie is None else T.StructType([*CSV_SCHEMA.fields, T.StructField(tie, T.LongType())])
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .csv(path)
    )
    return checked_log(file_order(df) if tie is None else df, tie or "event_id")


def read_interactions_parquet(spark: SparkSession, path: str, tie: str = "event_id") -> DataFrame:
    """Read an interaction log stored as Parquet (S1), typed and checked."""
    return checked_log(spark.read.parquet(path), tie)


def write_interactions_csv(df: DataFrame, path: str) -> None:
    """Write a log in the reference's CSV layout."""
    (
        df.select(*[f.name for f in CSV_SCHEMA.fields])
        .write.mode("overwrite")
        .option("header", True)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .csv(path)
    )


def write_predictions(pred: DataFrame, path: str) -> None:
    """Write ``id,prediction`` with a header, rows in id order.

    The sort is a range-partitioned global sort; each part file holds a
    contiguous id range, so concatenating parts in name order gives the
    reference's single file."""
    pred.select("id", "prediction").orderBy("id").write.mode("overwrite").option("header", True).csv(path)
