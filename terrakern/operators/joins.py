"""Joins that need a shape of their own: as-of, range by cell expansion, masked merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def as_of(left: DataFrame, right: DataFrame, by: list[str], ts: str, value: str) -> DataFrame:
    """Add to each left row the last right ``value`` at or before its ``ts``: one union, one window, no join.

    Within equal times right rows come first.  ``by`` keys far hotter than a task
    holds must be cut into time ranges by the caller.
    """
    columns = [c for c in left.columns]
    row = F.struct(*columns)
    l = left.select(*by, ts, F.lit(1).alias("__side"), row.alias("__row"), F.lit(None).cast(right.schema[value].dataType).alias("__v"))
    r = right.select(*by, ts, F.lit(0).alias("__side"), F.lit(None).cast(l.schema["__row"].dataType).alias("__row"), F.col(value).alias("__v"))
    w = Window.partitionBy(*by).orderBy(ts, "__side", F.col("__v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    found = l.union(r).withColumn(value, F.last("__v", ignorenulls=True).over(w)).filter(F.col("__side") == 1)
    return found.select(*[F.col(f"__row.{c}").alias(c) for c in columns], value)


def by_cells(boxes: DataFrame, points: DataFrame, low: Column, high: Column, at: Column, width: float, exact: Column) -> DataFrame:
    """Range join: boxes are expanded to the cells that they touch, then an equi-join and the exact test."""
    cells = boxes.withColumn("__cell", F.explode(F.sequence(F.floor(low / width), F.floor(high / width))))
    return cells.join(points.withColumn("__cell", F.floor(at / width)), "__cell").filter(exact).drop("__cell")


def masked_merge(old: DataFrame, new: DataFrame, key: list[str], columns: list[str], owned: str) -> DataFrame:
    """Old rows with owned rows of ``new`` in their place; owned rows without an old one are added."""
    n = new.filter(F.col(owned)).select(*key, F.struct(*columns).alias("__new"), F.lit(True).alias("__owned"))
    joined = old.select(*key, F.struct(*columns).alias("__old")).join(n, key, "full")
    return joined.select(*key, *[F.when(F.col("__owned"), F.col(f"__new.{c}")).otherwise(F.col(f"__old.{c}")).alias(c) for c in columns])
