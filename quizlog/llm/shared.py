"""Small Spark helpers of the package."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlog.session import ensure_checkpoint_dir


_SHIPPED: set[str] = set()


def ship(spark) -> None:
    """Send this library's code to the executors, once per application, so
    their Python workers can import it whatever their working folder is."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="quizlog-code-"), "quizlog.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)  # Spark serves the file to the executors


def _give_back() -> None:
    """Return freed memory to the system: Python workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def batches(df: DataFrame, fn, schema) -> DataFrame:
    """``df.mapInArrow`` by a function of this library (for ``transform``)."""
    ship(df.sparkSession)

    def run(batches_):
        yield from fn(batches_)
        _give_back()

    return df.mapInArrow(run, schema)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: written to the shared checkpoint folder, which
    survives the loss of executors.  For narrow tables."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark) -> str:
    """A fresh folder inside the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/quizlog-{uuid.uuid4().hex}"


def store(df: DataFrame) -> DataFrame:
    """Like ``cut`` for wider tables: compressed Parquet in the shared folder."""
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(doc_id: str, m: int):
    """crc32(doc_id as text) mod m; null ids count as the empty string."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % m
