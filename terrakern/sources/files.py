"""File scans and sinks: run files, provenance, land cells, censuses, skip records, shapes, staged tiles, plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class WriteOnceError(ValueError):
    """The place is already written."""


def _place(spark: SparkSession, path: str):
    """The file system of a path (any that Spark knows) and the path in it."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def claimed(spark: SparkSession, path: str) -> bool:
    """Create an empty file exclusively: true for the one caller who made it."""
    fs, where = _place(spark, path)
    try:
        fs.create(where, False).close()
    except Exception as e:
        if "AlreadyExists" in str(e) or "already exists" in str(e):
            return False
        raise
    return True


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is absent."""
    fs, where = _place(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


def verified_delete(spark: SparkSession, path: str) -> None:
    """Delete a folder with all in it, and make sure that nothing is left; an absent one is fine."""
    fs, where = _place(spark, path)
    if fs.exists(where):
        fs.delete(where, True)
    if fs.exists(where):
        raise OSError(f"{path} is still there")


# -- sinks -----------------------------------------------------------------------------------
def write_run_file(rows: DataFrame, root: str, run_id: str) -> None:
    """One run's rows as zstd Parquet by zone and year, written once."""
    rows.repartition("zone", "year").write.mode("errorifexists").option("compression", "zstd").partitionBy("zone", "year").parquet(f"{root}/run={run_id}")


def save_plan(plan: DataFrame, path: str) -> None:
    """A plan as JSON, written once: a second writer is refused."""
    if not claimed(plan.sparkSession, f"{path}/_claimed"):
        raise WriteOnceError(path)
    plan.coalesce(1).write.mode("append").json(path)


def stage_tile(rows: DataFrame, root: str, tile: str, outcome: Column) -> None:
    """Stage tiles by what became of them: ``data``, ``coverage`` (counts only) or ``skip`` (a marker)."""
    rows.withColumn("outcome", outcome).write.mode("overwrite").option("compression", "zstd").partitionBy("outcome").parquet(root)


def assemble(spark: SparkSession, root: str, schema: str, held: DataFrame, tile: str, on_skip: str) -> DataFrame:
    """Staged tiles over what the store holds: data replaces, skipped tiles are cleared or kept, others stay."""
    staged = spark.read.schema(schema + ", outcome string").parquet(root)
    data = staged.filter("outcome = 'data'").drop("outcome")
    gone = staged.filter("outcome = 'data'" if on_skip == "keep" else "outcome IN ('data', 'skip')").select(tile).distinct()
    return held.join(gone, tile, "left_anti").select(*data.columns).unionByName(data)


def extended(store: DataFrame, tiles: DataFrame, time: str, at: Column, fill: dict[str, Column]) -> DataFrame:
    """The store with one more time step: fill rows for every tile."""
    return store.unionByName(tiles.withColumns({time: at, **fill}), allowMissingColumns=True)


# -- scans --------------------------------------------------------------------------------------
def registry_scan(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All run files of a registry, lazily, with the hive keys run, zone and year; filters on them prune files."""
    return spark.read.schema(schema + ", run string, zone int, year int").option("basePath", root).parquet(f"{root}/run=*")


def provenance_scan(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All Parquet files under a folder, whatever its layout, without keys from it; ``file`` is where a row is from."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(root).withColumn("file", F.col("_metadata.file_path"))


def land_cells(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``grid_<lon>_<lat>.tiff`` as lon, lat and the line's SHA-256; others are left out."""
    form = r"^grid_(-?\d+(?:\.\d+)?)_(-?\d+(?:\.\d+)?)\.tiff$"
    lines = spark.read.text(path).filter(F.col("value").rlike(form))
    return lines.select(F.regexp_extract("value", form, 1).cast("double").alias("lon"), F.regexp_extract("value", form, 2).cast("double").alias("lat"), F.sha2("value", 256).alias("digest"))


def granule_census(spark: SparkSession, path: str) -> DataFrame:
    """Granule titles and links of a CSV with a header."""
    return spark.read.schema("title string, link string").option("header", True).csv(path)


def skip_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON records; an unreadable one is kept, in ``unreadable``, so that it can be counted."""
    return spark.read.schema(schema + ", unreadable string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "unreadable").json(path)


def chunk_grid(keys: DataFrame, key: str) -> DataFrame:
    """Rows and columns of the chunks that object keys ``.../c/<row>/<col>`` name."""
    part = lambda k: F.regexp_extract(key, r"(?:^|/)c/(\d+)/(\d+)$", k).try_cast("int")
    return keys.select(part(1).alias("row_"), part(2).alias("col_")).filter("row_ IS NOT NULL").distinct()


def shape_boxes(spark: SparkSession, path: str) -> DataFrame:
    """Name and box of each polygon of a GeoJSON file (one feature a line)."""
    shape = "properties struct<name: string>, geometry struct<type: string, coordinates: array<array<array<double>>>>"
    points = spark.read.schema(shape).json(path).select("properties.name", F.flatten("geometry.coordinates").alias("p"))
    of = lambda k: F.transform("p", lambda xy: xy[k])
    return points.select("name", F.array_min(of(0)).alias("west"), F.array_min(of(1)).alias("south"), F.array_max(of(0)).alias("east"), F.array_max(of(1)).alias("north"))


def external_table(spark: SparkSession, name: str, path: str, schema: str) -> DataFrame:
    """Declare a table over Parquet files that lie elsewhere, and read it."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet LOCATION '{path}'")
    return spark.table(name)
