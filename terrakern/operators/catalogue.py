"""Catalogue items: best copies, ladders of spares, fusion order, first valid source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def ranked_copies(items: DataFrame, image: list[str], order: list[Column], name: str = "copy_rank") -> DataFrame:
    """Rank the copies of each image; ``order`` must end in a unique column."""
    return items.withColumn(name, F.row_number().over(Window.partitionBy(*image).orderBy(*order)))


def best_copies(items: DataFrame, image: list[str], order: list[Column]) -> DataFrame:
    """The best copy of each image."""
    return ranked_copies(items, image, order, "__rank").filter(F.col("__rank") == 1).drop("__rank")


def ladders(items: DataFrame, image: list[str], order: list[Column], id_col: str) -> DataFrame:
    """Per image: the id that is used, and the spares in the order in which they would replace it."""
    ranked = ranked_copies(items, image, order, "__rank")
    listed = F.array_sort(F.collect_list(F.struct(F.col("__rank").alias("r"), F.col(id_col).alias("id"))))
    out = ranked.groupBy(*image).agg(listed.alias("__all"))
    return out.select(*image, F.col("__all")[0]["id"].alias("used"), F.transform(F.slice("__all", 2, 1 << 30), lambda x: x["id"]).alias("spares"))


def step_down(items: DataFrame, image: list[str], order: list[Column], id_col: str, failed: Column) -> DataFrame:
    """Per image: the first copy in rank order that hasn't failed; images without one are absent."""
    return best_copies(items.filter(~failed), image, order).select(*image, F.col(id_col).alias("used"))


def fusion_positions(items: DataFrame, day: list[str], order: list[Column]) -> DataFrame:
    """0-based place of each item in its day's fusion order."""
    return ranked_copies(items, day, order, "position").withColumn("position", F.col("position") - 1)


def first_valid(samples: DataFrame, pixel: list[str], value: str, position: str, valid: Column) -> DataFrame:
    """Per pixel: value and position of the first source in fusion order that has data."""
    found = F.min_by(F.struct(F.col(value).alias("v"), F.col(position).alias("p")), F.when(valid, F.col(position)))
    return samples.groupBy(*pixel).agg(found.alias("f")).select(*pixel, F.col("f.v").alias(value), F.col("f.p").alias(position))


def unseen_days(items: DataFrame, stored: DataFrame, key: list[str]) -> DataFrame:
    """Items of days that aren't stored yet."""
    return items.join(stored.select(*key).distinct(), key, "left_anti")


def both_halves(west: DataFrame, east: DataFrame, id_col: str) -> DataFrame:
    """Items of both halves of a box across the antimeridian, one of each id."""
    return west.unionByName(east, allowMissingColumns=True).dropDuplicates([id_col])
