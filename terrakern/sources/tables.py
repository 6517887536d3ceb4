"""Parquet tables as DataFrames with the types that the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with ``ts`` as an instant (UTC)."""
    return read(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def stated(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet table read with its stated schema: missing columns are null, others are ignored; absent is empty."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)
