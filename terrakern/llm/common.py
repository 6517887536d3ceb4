"""Helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from functools import cache
from inspect import signature

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: A word is a run of characters other than these six (space, \t \n \v \f \r).
WORD_SPACE = r"\x20\x09-\x0D"
WORD = f"[^{WORD_SPACE}]+"

#: Arrow batches between the JVM and Python hold at most this much.
BATCH_ROWS = 2000
BATCH_BYTES = 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where the session names none and runs in local mode (tests) a temporary one is used.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="terrakern-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and reread it: cuts the lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Keep Arrow batches small, so that long texts cannot fill a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


@cache
def _trim():
    """The C library's call that hands free heap pages back, where there is one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):
        return lambda _: 0


def release_memory() -> None:
    """Give freed memory back to the system: idle Python workers stay around between stages."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def releasing(f):
    """``f``, a function of a group or cogroup, with its memory given back afterwards."""

    def of_group(group: pa.Table) -> pa.Table:
        try:
            return f(group)
        finally:
            release_memory()

    def of_cogroup(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return f(left, right)
        finally:
            release_memory()

    return of_group if len(signature(f).parameters) == 1 else of_cogroup


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a DDL string: what Spark expects back, all of it nullable."""
    return to_arrow_schema(StructType.fromDDL(ddl))

