"""File scans, sinks and the pixel store: written to the shared folder, read back, and held against SQL."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrakern.functions import text as T
from terrakern.operators import registry
from terrakern.sources import catalogue, files
from terrakern.sources.shared import shared_folder
from terrakern.sources.store import CommitConflictError, PixelStore
from terrakern.sources.tables import events, read

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


_RUN_ROWS = "SELECT o_orderkey AS tile, o_totalprice AS px, o_custkey % 10 AS zone, year(o_orderdate) AS year, o_orderstatus AS run FROM orders"


def _run_files(spark: SparkSession, d: str) -> str:
    root = shared_folder(spark, "runs")
    rows = read(spark, d, "orders").select(F.col("o_orderkey").alias("tile"), F.col("o_totalprice").alias("px"), (F.col("o_custkey") % 10).cast("int").alias("zone"), F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("run"))
    for run in "FOP":
        files.write_run_file(rows.filter(F.col("run") == run).drop("run"), root, run)
    return root


@query(f"SELECT run, zone, year, count(*) AS tiles, max(tile) AS newest FROM ({_RUN_ROWS}) WHERE zone IN (3, 4) GROUP BY 1, 2, 3")
def registry_run_files(spark, d):
    found = files.registry_scan(spark, _run_files(spark, d), "tile long, px double").filter(F.col("zone").isin(3, 4))
    return found.groupBy("run", "zone", "year").agg(F.count("*").alias("tiles"), F.max("tile").alias("newest"))


@query(f"SELECT run, count(*) AS n, round(sum(px), 2) AS px FROM ({_RUN_ROWS}) GROUP BY 1")
def provenance_scan(spark, d):
    found = files.provenance_scan(spark, _run_files(spark, d), "tile long, px double")
    return found.groupBy(F.regexp_extract("file", r"/run=([^/]+)/", 1).alias("run")).agg(F.count("*").alias("n"), F.round(F.sum("px"), 2).alias("px"))


@query(f"SELECT run, zone, year, count(*) AS n, true AS sized FROM ({_RUN_ROWS}) GROUP BY 1, 2, 3")
def file_metadata(spark, d):
    """Rows and sizes of files by their path alone."""
    found = spark.read.option("basePath", root := _run_files(spark, d)).parquet(f"{root}/run=*").select("run", "zone", "year", "_metadata.file_size")
    return found.groupBy("run", F.col("zone").cast("long").alias("zone"), "year").agg(F.count("*").alias("n"), (F.min("file_size") > 0).alias("sized"))


@query("SELECT c_custkey % 360 - 180 + 0.5 AS lon, c_custkey % 160 - 80 - 0.25 AS lat, count(*) AS n FROM customer WHERE c_custkey % 7 > 0 GROUP BY 1, 2")
def land_cells(spark, d):
    path, k = shared_folder(spark, "land"), F.col("c_custkey")
    line = F.concat(F.lit("grid_"), (k % 360 - 180 + 0.5).cast("string"), F.lit("_"), (k % 160 - 80 - 0.25).cast("string"), F.lit(".tiff"))
    read(spark, d, "customer").select(F.when(k % 7 > 0, line).otherwise(F.lit("README")).alias("value")).write.text(path)
    return files.land_cells(spark, path).groupBy("lon", "lat").agg(F.count("digest").alias("n"))


_TITLES = "SELECT user_id, ts::DATE AS day, CASE WHEN user_id % 6 = 0 THEN NULL ELSE 'T' || lpad((user_id % 150)::VARCHAR, 3, '0') || '-000123-IW1' END AS burst FROM events WHERE event_type = 'signup'"


@query(f"SELECT burst, count(*) AS granules, count(DISTINCT day) AS acquisitions FROM ({_TITLES}) WHERE burst IS NOT NULL GROUP BY 1")
def granule_census(spark, d):
    path = shared_folder(spark, "census")
    e = events(spark, d).filter("event_type = 'signup'")
    burst = F.when(F.col("user_id") % 6 != 0, F.concat(F.lit("T"), F.lpad((F.col("user_id") % 150).cast("string"), 3, "0"), F.lit("-000123-IW1"))).otherwise(F.lit("none"))
    e.select(F.concat(F.lit('a "title", '), burst.alias("b"), F.lit("_"), burst, F.lit("_"), F.date_format("ts", "yyyyMMdd")).alias("title"), F.concat(F.lit("https://h/"), F.col("event_id").cast("string")).alias("link")).write.option("header", True).option("escape", '"').csv(path)
    found = spark.read.schema("title string, link string").option("header", True).option("escape", '"').csv(path)
    found = found.select(T.burst(F.col("title")).alias("burst"), F.regexp_extract("title", r"(\d{8})$", 1).alias("day")).filter("burst IS NOT NULL")
    return found.groupBy("burst").agg(F.count("*").alias("granules"), F.count_distinct("day").alias("acquisitions"))


@query("SELECT CASE WHEN event_id % 9 = 0 THEN 'unreadable' ELSE event_type END AS reason, count(*) AS n FROM events GROUP BY 1")
def skip_records(spark, d):
    path = shared_folder(spark, "skips")
    good = F.to_json(F.struct(F.col("event_type").alias("reason"), F.col("user_id").alias("tile")))
    events(spark, d).select(F.when(F.col("event_id") % 9 == 0, F.lit('{"reason": "thin", "tile"')).otherwise(good).alias("value")).write.text(path)
    found = files.skip_records(spark, path, "reason string, tile long")
    return found.groupBy(F.when(F.col("unreadable").isNotNull(), "unreadable").otherwise(F.col("reason")).alias("reason")).agg(F.count("*").alias("n"))


@query("SELECT (o_orderkey % 30)::INTEGER AS row_, (o_custkey % 20)::INTEGER AS col_ FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2")
def live_chunk_grid(spark, d):
    leaf = F.when(F.col("o_orderstatus") == "F", F.lit("/c/")).otherwise(F.lit("/meta/"))
    keys = read(spark, d, "orders").select(F.concat(F.lit("zone/obs"), leaf, (F.col("o_orderkey") % 30).cast("string"), F.lit("/"), (F.col("o_custkey") % 20).cast("string")).alias("key"))
    return files.chunk_grid(keys, "key")


@query("SELECT 's' || s_suppkey AS name, s_suppkey % 170 + 0.0 AS west, s_suppkey % 80 - 2.0 AS south, s_suppkey % 170 + 3.5 AS east, s_suppkey % 80 + 1.0 AS north FROM supplier")
def shape_boxes(spark, d):
    path, x, y = shared_folder(spark, "shapes"), F.col("s_suppkey") % 170 + 0.0, F.col("s_suppkey") % 80 + 0.0
    ring = F.array(F.array(x, y), F.array(x + 3.5, y + 1), F.array(x + 2, y - 2), F.array(x, y))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("name")).alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))
    read(spark, d, "supplier").select(F.to_json(feature).alias("value")).write.text(path)
    return files.shape_boxes(spark, path)


@query("SELECT n_regionkey, count(*) AS n FROM nation GROUP BY 1")
def external_table(spark, d):
    name = f"terrakern_{uuid.uuid4().hex}"
    found = files.external_table(spark, name, f"{d}/nation.parquet", "n_nationkey int, n_name string, n_regionkey int")
    rows = found.groupBy("n_regionkey").agg(F.count("*").alias("n")).collect()  # one row per region
    spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame(rows, "n_regionkey int, n long")


@query("SELECT 'F' AS run, count(*) AS cells, 1::BIGINT AS refused FROM orders WHERE o_orderstatus = 'F'")
def plan_write_once(spark, d):
    path, refused = shared_folder(spark, "plan"), 0
    plan = read(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("cell"), F.col("o_orderstatus").alias("run"))
    for _ in range(2):
        try:
            files.save_plan(plan, path)
        except files.WriteOnceError:
            refused += 1
    return spark.read.schema("cell long, run string").json(path).groupBy("run").agg(F.count("*").alias("cells")).withColumn("refused", F.lit(refused).cast("long"))


_STAGED = "SELECT o_orderkey AS tile, o_totalprice AS px, CASE o_orderstatus WHEN 'F' THEN 'data' WHEN 'O' THEN 'coverage' ELSE 'skip' END AS outcome FROM orders WHERE o_orderkey % 2 = 0"


def _assembled(spark: SparkSession, d: str, on_skip: str) -> DataFrame:
    root, o = shared_folder(spark, "staged"), read(spark, d, "orders")
    outcome = F.when(F.col("status") == "F", "data").when(F.col("status") == "O", "coverage").otherwise("skip")
    files.stage_tile(o.filter("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("tile"), F.col("o_totalprice").alias("px"), F.col("o_orderstatus").alias("status")), root, "tile", outcome)
    held = o.filter("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("tile"), F.lit(0.0).alias("px"))
    return files.assemble(spark, root, "tile long, px double", held, "tile", on_skip)


@query(f"WITH s AS ({_STAGED}) SELECT tile, px FROM s WHERE outcome = 'data' UNION ALL SELECT o_orderkey, 0.0 FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey NOT IN (SELECT tile FROM s WHERE outcome IN ('data', 'skip'))")
def assemble_clear(spark, d):
    return _assembled(spark, d, "clear")


@query(f"WITH s AS ({_STAGED}) SELECT tile, px FROM s WHERE outcome = 'data' UNION ALL SELECT o_orderkey, 0.0 FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey NOT IN (SELECT tile FROM s WHERE outcome = 'data')")
def assemble_keep(spark, d):
    return _assembled(spark, d, "keep")


@query("SELECT c_custkey AS tile, y AS year, CASE WHEN y < 2025 THEN floor(c_acctbal)::BIGINT END AS px FROM customer, (SELECT unnest([2024, 2025]) AS y)")
def extend_time_axis(spark, d):
    tiles = read(spark, d, "customer").select(F.col("c_custkey").alias("tile"), F.floor("c_acctbal").alias("px"))
    return files.extended(tiles.withColumn("year", F.lit(2024)), tiles.select("tile"), "year", F.lit(2025), {"px": F.lit(None).cast("long")}).select("tile", "year", "px")


@query("SELECT user_id AS tile, count(*) AS holes FROM events WHERE value > 200 GROUP BY 1")
def hole_masks(spark, d):
    path = shared_folder(spark, "holes")
    scales = events(spark, d).select(F.col("user_id").alias("tile"), "event_id", F.when(F.col("value") > 200, float("nan")).otherwise(F.col("value")).alias("scale"))
    scales.filter(F.isnan("scale")).select("tile", "event_id").write.mode("ignore").parquet(path)
    return spark.read.schema("tile long, event_id long").parquet(path).groupBy("tile").agg(F.count("*").alias("holes"))


# -- the versioned store ---------------------------------------------------------------------------
_PIXELS = "tile string, px long, value double, zone string, year int"


def _store(spark: SparkSession, d: str) -> tuple[PixelStore, str]:
    """A store with three commits: a fill, an appended day, a masked merge; the second is tagged."""
    store = PixelStore(spark, shared_folder(spark, "store"), _PIXELS).create()
    px = read(spark, d, "orders").select(F.concat(F.lit("t"), (F.col("o_custkey") % 30).cast("string")).alias("tile"), F.col("o_orderkey").alias("px"), F.col("o_totalprice").alias("value"), (F.col("o_custkey") % 2).cast("string").alias("zone"), F.lit(2024).alias("year"))
    store.commit(px.filter("px % 2 = 0"), "fill", "run-1")
    second = store.append_day(px.filter("px % 2 = 1").withColumn("year", F.lit(2025)), datetime.date(2024, 5, 1), "run-2")
    store.tag("before-holes", second)
    owned = px.filter("px % 2 = 0 AND value > 300000").withColumns({"value": F.lit(-1.0), "own": F.col("px") % 3 == 0})
    store.merge_owned(owned, ["px"], "own", "run-3")
    return store, second


_ROWS = "SELECT o_orderkey AS px, o_totalprice AS value, CASE WHEN o_orderkey % 2 = 0 THEN 2024 ELSE 2025 END AS year FROM orders"


@query(f"SELECT year, count(*) AS n, round(sum(CASE WHEN px % 2 = 0 AND value > 300000 AND px % 3 = 0 THEN -1 ELSE value END), 2) AS total FROM ({_ROWS}) GROUP BY 1")
def store_read_current(spark, d):
    return _store(spark, d)[0].read().groupBy("year").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query(f"SELECT year, count(*) AS n, round(sum(value), 2) AS total FROM ({_ROWS}) GROUP BY 1")
def store_read_snapshot(spark, d):
    store, _ = _store(spark, d)
    return store.read("before-holes").groupBy("year").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("""SELECT tile, runs FROM (SELECT 't' || o_custkey % 30 AS tile, CASE WHEN bool_or(o_orderkey % 2 = 0 AND o_totalprice > 300000) THEN 'run-1,run-3' ELSE 'run-1' END AS runs FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1)""")
def store_commit_tiles(spark, d):
    """Lineage of the store's tiles of one year, from its commit log."""
    log = _store(spark, d)[0].commits().filter("year = 2024").select(F.explode("tiles").alias("tile"), "seq", "run_id", "mode")
    return registry.source_runs(log, ["tile"], ["seq"], "run_id", "mode").select("tile", F.array_join("source_runs", ",").alias("runs"))


@query("SELECT 3::BIGINT AS commits, 1::BIGINT AS conflicts, 1::BIGINT AS refused_days, 0::BIGINT AS expired FROM region LIMIT 1")
def store_conflicts(spark, d):
    """A writer that started from an older version is refused, and so is a stored day."""
    store, _ = _store(spark, d)
    rows, conflicts, refused = store.read().filter("zone = '1'"), 0, 0
    try:
        store.commit(rows, "fill", "late", expected=1)
    except CommitConflictError:
        conflicts += 1
    try:
        store.append_day(rows, datetime.date(2024, 5, 1), "again")
    except ValueError:
        refused += 1
    log = store.commits().agg(F.count_distinct("seq").alias("commits"))
    return log.select("commits", F.lit(conflicts).cast("long").alias("conflicts"), F.lit(refused).cast("long").alias("refused_days"), F.lit(store.collect_garbage()).cast("long").alias("expired"))


# -- catalogue ----------------------------------------------------------------------------------------
_ITEMS = "SELECT event_id, ts, user_id % 360 - 180 AS w, user_id % 120 - 60 AS s FROM events WHERE event_type = 'view'"


@query(f"SELECT ts::DATE AS day, count(*) AS items, min(event_id) AS first FROM ({_ITEMS}) WHERE ts >= '2024-01-03' AND ts < '2024-01-20' AND w <= 40 AND w + 2 >= -170 AND s <= 30 AND s + 2 >= -50 GROUP BY 1")
def catalogue_search(spark, d):
    path, u = shared_folder(spark, "items"), F.col("user_id")
    w, s = (u % 360 - 180).cast("double"), (u % 120 - 60).cast("double")
    item = F.struct(F.col("event_id").cast("string").alias("id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("acquired_at"), F.array(w, s, w + 2, s + 2).alias("bbox"), F.create_map(F.lit("type"), F.col("event_type")).alias("properties"), F.create_map(F.lit("red"), F.lit("r"), F.lit("nir"), F.lit("n")).alias("assets"))
    events(spark, d).select(F.to_json(item).alias("value")).write.text(path)
    found = catalogue.search(spark, path, "2024-01-03", "2024-01-20", (-170, -50, 40, 30), {"type": "view"}, ["red"])
    dealt = catalogue.windowed(found, page=1 << 40).filter(F.size("assets") == 1)
    return dealt.groupBy(F.to_date("acquired_at").alias("day")).agg(F.count("*").alias("items"), F.min(F.col("id").cast("long")).alias("first"))
