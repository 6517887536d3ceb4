"""Catalogue search over JSON-line items: pushed filters, exact time windows, and a budget that refuses.

Items lie on any file system of Spark's; a live service would land its pages there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SCHEMA = "id string, acquired_at timestamp, bbox array<double>, properties map<string,string>, assets map<string,string>"
#: A window may hold at most a page of items, and a search may need at most so many windows.
PAGE, MOST_WINDOWS = 500, 4096


class SearchBudgetError(ValueError):
    """The search cannot be cut into few enough windows of a page each."""


def overlapping(bbox: Column, west: float, south: float, east: float, north: float) -> Column:
    """Whether [west, south, east, north] of an item meets the box; an item with west > east crosses the antimeridian."""
    unwrapped = F.when(bbox[2] < bbox[0], bbox[2] + 360).otherwise(bbox[2])
    meets = lambda turn: (bbox[0] - turn <= east) & (unwrapped - turn >= west)
    return (meets(0) | meets(360)) & (bbox[1] <= north) & (bbox[3] >= south)


def search(spark: SparkSession, path: str, start: str, end: str, bbox: tuple[float, float, float, float] | None = None, properties: dict[str, str] | None = None, assets: list[str] | None = None) -> DataFrame:
    """Items acquired in [start, end) that meet the box and have the properties, with only the wanted assets."""
    items = spark.read.schema(SCHEMA).json(path).filter((F.col("acquired_at") >= F.lit(start).cast("timestamp")) & (F.col("acquired_at") < F.lit(end).cast("timestamp")))
    for key, value in (properties or {}).items():
        items = items.filter(F.col("properties")[key] == value)
    if bbox:
        items = items.filter(overlapping(F.col("bbox"), *bbox))
    if assets is not None:
        items = items.withColumn("assets", F.map_filter("assets", lambda k, _: k.isin(*assets)))
    return items


def windowed(items: DataFrame, page: int = PAGE, most: int = MOST_WINDOWS) -> DataFrame:
    """Add ``window``: consecutive days whose items fit a page, without gap or overlap.

    Days are dealt by the items before them, in half pages, so no window exceeds a page unless one day has more than
    half of one; a window over a page, or more than ``most`` windows, is refused.  Only counts per day are gathered.
    """
    days = items.groupBy(F.to_date("acquired_at").alias("day")).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    dealt = days.withColumn("window", F.floor(before * 2 / page))
    sizes = dealt.groupBy("window").agg(F.sum("n").alias("n")).agg(F.max("n").alias("largest"), F.count("*").alias("windows")).first()
    if (sizes["largest"] or 0) > page or sizes["windows"] > most:
        raise SearchBudgetError(f"{sizes['windows']} windows of up to {sizes['largest']} items; allowed are {most} of {page}")
    return items.withColumn("day", F.to_date("acquired_at")).join(dealt.select("day", "window"), "day").drop("day")
