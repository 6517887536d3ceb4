"""Registry, provenance, planning and gate operators in full, bound to the tables.

Orders stand for catalogue items and run files, customers for tiles, events for pixels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrakern.operators import records as R
from terrakern.operators.catalogue import fusion_positions
from terrakern.sources.tables import events, read

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _joined(c: Column, sep: str = ",") -> Column:
    return F.array_join(F.transform(c, lambda x: x.cast("string")), sep)


# -- copies -----------------------------------------------------------------------------------
_ITEMS = """(SELECT o_orderkey AS id, o_custkey % 40 AS tile, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS day, CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE o_custkey % 3 END AS image,
    o_orderstatus <> 'P' AS complete, o_orderpriority LIKE '1%' AS harmonised, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE (o_orderkey % 5 + 1) * 100 END AS baseline,
    o_totalprice > 200000 AS local, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 9 END AS sequence FROM orders)"""
_RANKED = f"""(SELECT *, row_number() OVER (PARTITION BY tile, day, img ORDER BY complete DESC, refuses, (baseline IS NULL AND NOT harmonised), coalesce(baseline, 0) DESC, owes,
    (baseline IS NOT NULL AND NOT local), (sequence IS NULL), coalesce(sequence, 0) DESC, id) AS r FROM (SELECT *, coalesce(image::VARCHAR, 'id:' || id) AS img,
    baseline IS NULL AND NOT harmonised AS refuses, coalesce(baseline >= 400, false) AND NOT harmonised AS owes FROM {_ITEMS}))"""


def _items(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    items = read(spark, d, "orders").select(
        k.alias("id"), (F.col("o_custkey") % 40).alias("tile"), F.to_date(F.date_trunc("quarter", "o_orderdate")).alias("day"), F.when(F.col("o_custkey") % 11 != 0, F.col("o_custkey") % 3).alias("image"),
        (F.col("o_orderstatus") != "P").alias("complete"), F.col("o_orderpriority").like("1%").alias("harmonised"), F.when(k % 7 != 0, (k % 5 + 1) * 100).alias("baseline"),
        (F.col("o_totalprice") > 200000).alias("local"), F.when(k % 4 != 0, k % 9).alias("sequence"),
    )
    return items.withColumns({"refuses": F.col("baseline").isNull() & ~F.col("harmonised"), "owes": F.coalesce(F.col("baseline") >= 400, F.lit(False)) & ~F.col("harmonised")})


def _preference() -> list:
    return R.copy_preference(*[F.col(c) for c in ("complete", "refuses", "baseline", "harmonised", "owes", "local", "sequence", "id")])


@query(f"SELECT tile, day, string_agg(id::VARCHAR, ',' ORDER BY p) FILTER (r = 1) AS used, coalesce(string_agg(id::VARCHAR, ',' ORDER BY p) FILTER (r > 1 AND NOT refuses), '') AS spares FROM (SELECT *, row_number() OVER (PARTITION BY tile, day ORDER BY r, complete DESC, refuses, (baseline IS NULL AND NOT harmonised), coalesce(baseline, 0) DESC, owes, (baseline IS NOT NULL AND NOT local), (sequence IS NULL), coalesce(sequence, 0) DESC, id) AS p FROM {_RANKED}) GROUP BY 1, 2")
def preferred_copies(spark, d):
    found = R.preferred_copies(_items(spark, d), ["tile", "day"], "image", _preference(), F.col("refuses"), "id")
    return found.select("tile", "day", _joined(F.col("used")).alias("used"), _joined(F.col("spares")).alias("spares"))


_RADAR = "SELECT event_id, user_id % 20 AS tile, ts::DATE AS day, CASE WHEN user_id % 9 = 0 THEN NULL ELSE 'T' || lpad((user_id % 7)::VARCHAR, 3, '0') END AS burst, ts FROM events WHERE event_type IN ('signup','error')"


@query(f"WITH e AS ({_RADAR}), n AS (SELECT burst, count(DISTINCT ts::DATE) AS acquired FROM e WHERE burst IS NOT NULL GROUP BY 1) SELECT event_id, row_number() OVER (PARTITION BY tile, day ORDER BY day, (e.burst IS NULL), coalesce(acquired, 0) DESC, coalesce(e.burst, ''), ts, event_id) - 1 AS position FROM e LEFT JOIN n ON e.burst = n.burst")
def fusion_order_radar_full(spark, d):
    e = events(spark, d).filter(F.col("event_type").isin("signup", "error"))
    burst = F.when(F.col("user_id") % 9 != 0, F.concat(F.lit("T"), F.lpad((F.col("user_id") % 7).cast("string"), 3, "0")))
    e = e.select("event_id", (F.col("user_id") % 20).alias("tile"), F.to_date("ts").alias("day"), burst.alias("burst"), "ts")
    n = e.filter("burst IS NOT NULL").groupBy("burst").agg(F.count_distinct("day").alias("acquired"))
    order = R.radar_order(F.col("day"), F.col("burst"), F.col("acquired"), F.col("ts"), F.col("event_id"))
    return fusion_positions(e.join(n, "burst", "left"), ["tile", "day"], order).select("event_id", "position")


# -- master rows ----------------------------------------------------------------------------------
_RUNS = "SELECT o_custkey AS tile, o_orderkey AS run_id, o_orderdate AS assembled_at, CASE WHEN o_totalprice > 50000 THEN floor(o_totalprice)::BIGINT END AS chunk_px, o_orderstatus AS status FROM orders"
_FILLS = f"SELECT *, coalesce(CASE WHEN run_id % 5 = 0 THEN assembled_at - INTERVAL 30 DAY END, assembled_at) AS filled_at, CASE WHEN chunk_px IS NOT NULL THEN 'fill' END AS measured_by FROM ({_RUNS}) WHERE run_id % 3 <> 0"


def _runs(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").select(
        F.col("o_custkey").alias("tile"), F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("assembled_at"),
        F.when(F.col("o_totalprice") > 50000, F.floor("o_totalprice")).alias("chunk_px"), F.col("o_orderstatus").alias("status"),
    )


def _fills(spark: SparkSession, d: str) -> DataFrame:
    rows = _runs(spark, d).filter("run_id % 3 <> 0").withColumn("filled_at", F.expr("CASE WHEN run_id % 5 = 0 THEN assembled_at - INTERVAL 30 DAY END"))
    return R.as_master_rows(rows, "fill", F.col("chunk_px").isNotNull())


@query(f"SELECT tile, run_id, filled_at, measured_by FROM ({_FILLS})")
def as_master_rows_full(spark, d):
    return _fills(spark, d).select("tile", "run_id", "filled_at", "measured_by")


_HELD = f"SELECT h.*, f.filled_at, CASE WHEN h.chunk_px IS NOT NULL THEN 'rebuild' END AS measured_by FROM (SELECT * FROM ({_RUNS}) WHERE run_id % 3 = 0) h JOIN (SELECT tile, max(filled_at) AS filled_at FROM ({_FILLS}) GROUP BY 1) f USING (tile) WHERE h.run_id % 2 = 0"
_RANK = "CASE WHEN measured_by = 'fill' AND chunk_px IS NOT NULL THEN 0 WHEN chunk_px IS NOT NULL AND status = 'F' THEN 1 WHEN chunk_px IS NOT NULL THEN 2 ELSE 3 END"


@query(f"""WITH c AS (SELECT o_custkey AS tile, o_orderkey AS run, o_orderstatus <> 'F' AS whole, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS i FROM orders),
    s AS (SELECT tile, coalesce(max(i) FILTER (whole), 0) AS since FROM c GROUP BY 1), l AS (SELECT tile, string_agg(run::VARCHAR, ',' ORDER BY i) AS source_runs FROM c JOIN s USING (tile) WHERE i >= since GROUP BY 1),
    m AS (SELECT tile, run_id, measured_by, row_number() OVER (PARTITION BY tile ORDER BY filled_at DESC, {_RANK}, assembled_at DESC, run_id DESC) AS r
      FROM (SELECT tile, run_id, assembled_at, filled_at, chunk_px, status, measured_by FROM ({_FILLS}) UNION ALL SELECT tile, run_id, assembled_at, filled_at, chunk_px, status, measured_by FROM ({_HELD})))
    SELECT tile, run_id, measured_by, source_runs FROM m LEFT JOIN l USING (tile) WHERE r = 1""")
def merge_cell_full(spark, d):
    fills, o = _fills(spark, d), read(spark, d, "orders")
    newest = fills.groupBy("tile").agg(F.max("filled_at").alias("filled_at"))
    held = R.as_master_rows(_runs(spark, d).filter("run_id % 3 = 0 AND run_id % 2 = 0").join(newest, "tile"), "rebuild", F.col("chunk_px").isNotNull())
    log = o.select(F.col("o_custkey").alias("tile"), F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("run_id"), F.when(F.col("o_orderstatus") == "F", "holes").otherwise("fill").alias("mode"))
    merged = R.merge_cell(fills, held, log, F.col("status") == "F")
    return merged.select("tile", "run_id", "measured_by", _joined(F.col("source_runs")).alias("source_runs"))


@query("""SELECT cell, '[' || string_agg('["' || run || '","' || seen || '"]', ',' ORDER BY seen, run) || ']' AS stamp FROM (SELECT o_custkey % 20 AS cell, o_orderpriority AS run, CAST(max(o_orderdate)::DATE AS VARCHAR) AS seen FROM orders GROUP BY 1, 2) GROUP BY 1""")
def lineage_stamp_json(spark, d):
    o = read(spark, d, "orders").select((F.col("o_custkey") % 20).alias("cell"), F.col("o_orderpriority").alias("run"), F.to_date("o_orderdate").alias("at"))
    return R.lineage_stamp(o, ["cell"], "run", "at")


@query("""SELECT year, split_part(string_agg(run, ',' ORDER BY seen DESC, run DESC), ',', 1) AS current, coalesce(string_agg(run, ',' ORDER BY seen, run) FILTER (k > 1), '') AS previous FROM (SELECT *, row_number() OVER (PARTITION BY year ORDER BY seen DESC, run DESC) AS k FROM (SELECT year(o_orderdate) AS year, o_orderpriority AS run, max(o_orderkey) AS seen FROM orders GROUP BY 1, 2)) GROUP BY 1""")
def run_provenance(spark, d):
    o = read(spark, d, "orders").select(F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("run"), F.col("o_orderkey").alias("at"))
    return R.run_history(o, ["year"], "run", "at").select("year", "current", _joined(F.col("previous")).alias("previous"))


@query("""SELECT p.tile, p.position, arg_max(r.run_id, r.run_id) FILTER (r.mode <> 'holes' OR r.run_id % 8 = p.position OR (r.run_id + 3) % 8 = p.position) AS run_id FROM
    (SELECT DISTINCT user_id AS tile, event_id % 8 AS position FROM events) p JOIN (SELECT o_custkey AS tile, o_orderkey AS run_id, CASE WHEN o_orderstatus = 'F' THEN 'fill' ELSE 'holes' END AS mode FROM orders) r USING (tile) GROUP BY 1, 2""")
def claiming_run_of_pixel(spark, d):
    k = F.col("o_orderkey")
    runs = read(spark, d, "orders").select(F.col("o_custkey").alias("tile"), k.alias("run_id"), k.alias("at"), F.when(F.col("o_orderstatus") == "F", "fill").otherwise("holes").alias("mode"), F.array(k % 8, (k + 3) % 8).alias("mask"))
    pixels = events(spark, d).select(F.col("user_id").alias("tile"), (F.col("event_id") % 8).alias("position")).distinct()
    return R.claiming_runs(runs, pixels, "at", "mode", "mask")


# -- re-derived rows -----------------------------------------------------------------------------
_PER_TILE = "SELECT o_custkey AS tile, count(*) AS n, count(*) FILTER (o_orderstatus <> 'F') AS px_any, max(o_orderkey % 13) AS obs_max, count(*) FILTER (o_totalprice > 100000) AS radar FROM orders GROUP BY 1"


def _per_tile(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").groupBy(F.col("o_custkey").alias("tile")).agg(
        F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") != "F").alias("px_any"), F.max(F.col("o_orderkey") % 13).alias("obs_max"), F.count_if(F.col("o_totalprice") > 100000).alias("radar")
    )


@query(f"""SELECT tile, verdict, CASE WHEN verdict = 'mismatch' THEN concat_ws(',', CASE WHEN tile % 5 = 0 THEN 'obs_max' END, CASE WHEN tile % 3 <> 0 AND tile % 4 = 1 THEN 'radar' END) ELSE '' END AS differences
    FROM (SELECT *, CASE WHEN tile % 10 = 9 THEN 'unmeasured' WHEN tile % 6 = 1 THEN 'cropped' WHEN tile % 5 = 0 OR (tile % 3 <> 0 AND tile % 4 = 1) THEN 'mismatch' ELSE 'match' END AS verdict FROM ({_PER_TILE}))""")
def compare_row_full(spark, d):
    t, tile = _per_tile(spark, d), F.col("tile")
    recorded = t.select("tile", F.when(tile % 10 != 9, F.col("n")).alias("chunk_px"), (F.col("n") - F.when(tile % 6 == 1, 1).otherwise(0)).alias("eligible_px"), "px_any", "obs_max", "radar")
    rebuilt = t.select("tile", "px_any", (F.col("obs_max") + F.when(tile % 5 == 0, 1).otherwise(0)).alias("obs_max"), F.when(tile % 3 != 0, F.col("radar") + F.when(tile % 4 == 1, 1).otherwise(0)).alias("radar"))
    return R.compare_rows(rebuilt, recorded, "tile", ["px_any", "obs_max", "radar"], ["radar"]).select("tile", "verdict", _joined(F.col("differences")).alias("differences"))


@query(f"SELECT tile, n AS code_version, 'rebuild-7' AS run_id, DATE '2024-02-01' AS assembled_at, DATE '2023-01-01' + (tile % 28)::INTEGER AS filled_at, px_any, obs_max FROM ({_PER_TILE})")
def rebuilt_rows(spark, d):
    t = _per_tile(spark, d)
    day = F.date_add(F.lit("2023-01-01").cast("date"), (F.col("tile") % 28).cast("int"))
    source = t.select("tile", F.col("n").alias("code_version"), F.when(F.col("tile") % 2 == 0, day).alias("filled_at"), day.alias("assembled_at"))
    return R.rebuilt_rows(source, t, "tile", ["code_version"], ["px_any", "obs_max"], "rebuild-7", F.lit("2024-02-01").cast("date"))


# -- provenance planes ------------------------------------------------------------------------------
_PLANE = "SELECT user_id // 10 AS tile, ts::DATE AS day, CASE WHEN event_type = 'error' THEN -1 ELSE 1 END * (event_id % 7) AS k FROM events"


def _plane(spark: SparkSession, d: str) -> DataFrame:
    sign = F.when(F.col("event_type") == "error", -1).otherwise(1)
    return events(spark, d).select(F.floor(F.col("user_id") / 10).alias("tile"), F.to_date("ts").alias("day"), (sign * (F.col("event_id") % 7)).alias("k"))


@query(f"SELECT tile, day, string_agg(DISTINCT (abs(k) - 1)::VARCHAR, ',' ORDER BY (abs(k) - 1)::VARCHAR) AS sources, count(*) FILTER (k > 0) AS valid_px FROM ({_PLANE}) WHERE k <> 0 GROUP BY 1, 2")
def source_positions(spark, d):
    return R.source_positions(_plane(spark, d), ["tile", "day"], "k").select("tile", "day", _joined(F.col("sources")).alias("sources"), "valid_px")


@query(f"SELECT tile, day, CASE WHEN tile % 3 = 0 THEN 'sources' ELSE 'valid_px' END AS failure FROM ({_PLANE}) WHERE k <> 0 AND (tile % 3 = 0 OR tile % 4 = 0) GROUP BY 1, 2")
def publish_failures(spark, d):
    true = R.source_positions(_plane(spark, d), ["tile", "day"], "k")
    wrong = F.when(F.col("tile") % 3 == 0, F.concat("sources", F.array(F.lit(99).cast("long")))).otherwise(F.col("sources"))
    recorded = true.select("tile", "day", wrong.alias("sources"), (F.col("valid_px") + F.when(F.col("tile") % 4 == 0, 1).otherwise(0)).alias("valid_px"))
    return R.publish_failures(_plane(spark, d), recorded, ["tile", "day"], "k")


# -- plans and gates ---------------------------------------------------------------------------------
@query("SELECT o_custkey % 20 AS cell, CASE WHEN bool_or(o_totalprice > 445000) THEN NULL ELSE array_to_string(list_sort(list(DISTINCT lpad(o_custkey::VARCHAR, 6, '0'))), ',') END AS tiles FROM orders GROUP BY 1")
def plan_from_tiles_listed(spark, d):
    tile = F.when(F.col("o_totalprice") <= 445000, F.lpad(F.col("o_custkey").cast("string"), 6, "0"))
    rows = read(spark, d, "orders").select((F.col("o_custkey") % 20).alias("cell"), tile.alias("tile"))
    return R.plan_from_tiles(rows, ["cell"], "tile").select("cell", F.array_join("tiles", ",").alias("tiles"))


@query("SELECT c_custkey AS cell FROM customer JOIN (SELECT o_custkey, min(o_orderkey % 15) AS m FROM orders GROUP BY 1) ON c_custkey = o_custkey WHERE 9 > m")
def tightened_cells(spark, d):
    applied = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("cell")).agg(F.min(F.col("o_orderkey") % 15).alias("rule"))
    return R.tightened(read(spark, d, "customer").select(F.col("c_custkey").alias("cell"), F.lit(9).cast("long").alias("rule")), applied, ["cell"], "rule")


@query("SELECT user_id, day, reason FROM (SELECT user_id, day, reason, row_number() OVER (PARTITION BY user_id, day ORDER BY seen DESC) AS r FROM (SELECT user_id, ts::DATE AS day, event_type AS reason, event_id AS seen FROM events WHERE event_type IN ('error', 'signup'))) WHERE r = 1")
def skipped_days(spark, d):
    e = events(spark, d).select("user_id", F.to_date("ts").alias("day"), F.col("event_type").alias("reason"), F.col("event_id").alias("at"))
    return R.upserted(e.filter("reason = 'error'"), e.filter("reason = 'signup'"), ["user_id", "day"], "at").select("user_id", "day", "reason")


@query("SELECT user_id, first_day, last_day FROM (SELECT user_id, min(ts::DATE) AS first_day, max(ts::DATE) AS last_day, row_number() OVER (PARTITION BY user_id ORDER BY max(event_id) DESC) AS r FROM events GROUP BY user_id, event_type) WHERE r = 1")
def assessed_windows(spark, d):
    seen = events(spark, d).groupBy("user_id", "event_type").agg(F.min(F.to_date("ts")).alias("first_day"), F.max(F.to_date("ts")).alias("last_day"), F.max("event_id").alias("at"))
    return R.upserted(seen.filter("event_type < 'm'"), seen.filter("event_type >= 'm'"), ["user_id"], "at").select("user_id", "first_day", "last_day")


@query("SELECT user_id, count(*) FILTER (bad) AS given_up, count(*) FILTER (bad) > 10 AS refused FROM (SELECT user_id, ts::DATE, bool_or(event_type = 'error') AS bad FROM events GROUP BY 1, 2) GROUP BY 1")
def loss_budget(spark, d):
    days = events(spark, d).groupBy("user_id", F.to_date("ts").alias("day")).agg(F.bool_or(F.col("event_type") == "error").alias("bad"))
    return R.loss_verdict(days, ["user_id"], F.col("bad"))


@query("SELECT user_id, CASE WHEN bool_or(value > 400) THEN 'present' WHEN bool_or(event_type = 'error') THEN 'unknown' ELSE 'absent' END AS verdict FROM events GROUP BY 1")
def existence_probe(spark, d):
    failed = F.col("event_type") == "error"
    return R.probe_verdict(events(spark, d), ["user_id"], F.when(F.col("value") > 400, 1), failed)


@query("SELECT event_type, bool_or(e.d NOT IN (SELECT ts::DATE FROM events WHERE user_id % 2 = 0)) AS has_new FROM (SELECT event_type, ts::DATE AS d FROM events) e GROUP BY 1")
def has_new_dates(spark, d):
    e = events(spark, d).withColumn("day", F.to_date("ts"))
    stored = e.filter("user_id % 2 = 0").select("day", F.lit(True).alias("held")).distinct()
    return e.join(stored, "day", "left").groupBy("event_type").agg(F.bool_or(F.col("held").isNull()).alias("has_new"))


@query("SELECT o_custkey % 20 AS cell, count(*) AS commits, count(*) FILTER (o_orderkey % 17 = 0 OR o_custkey % 16 IN (3, 5) OR o_orderkey % 16 IN (3, 5)) AS conflicts FROM orders GROUP BY 1")
def catch_up_conflicts(spark, d):
    tiles = F.when(F.col("o_orderkey") % 17 != 0, F.array(F.col("o_custkey") % 16, F.col("o_orderkey") % 16))
    log = read(spark, d, "orders").select((F.col("o_custkey") % 20).alias("cell"), tiles.alias("tiles"))
    return log.groupBy("cell").agg(F.count("*").alias("commits"), F.count_if(R.conflicting(log, "tiles", [3, 5])).alias("conflicts"))


# -- geometry, samples and summaries ------------------------------------------------------------------
@query("SELECT c_custkey, zone FROM (SELECT c_custkey, unnest([z, z % 60 + 1]) AS zone, lon FROM (SELECT c_custkey, c_custkey % 360 - 180 + 0.5 AS lon, least(floor((c_custkey % 360 + 0.5) / 6) + 1, 60)::BIGINT AS z FROM customer)) WHERE zone = least(floor((lon + 180) / 6) + 1, 60)")
def zone_overlap(spark, d):
    lon = F.col("c_custkey") % 360 - 180 + 0.5
    z = F.least(F.floor((lon + 180) / 6) + 1, F.lit(60))
    rows = read(spark, d, "customer").select("c_custkey", lon.alias("lon"), F.explode(F.array(z, z % 60 + 1)).alias("zone"))
    return R.in_own_zone(rows, F.col("lon"), F.col("zone")).select("c_custkey", "zone")


@query("SELECT c_mktsegment, count(*) AS tiles, count(*) FILTER (c_acctbal > 0) AS embedded, sum(CASE WHEN c_acctbal <= 0 THEN c_custkey % 7 ELSE 0 END)::BIGINT AS refused, string_agg(DISTINCT lpad(c_nationkey::VARCHAR, 2, '0'), ',' ORDER BY lpad(c_nationkey::VARCHAR, 2, '0')) AS zones FROM customer WHERE c_custkey % 360 BETWEEN 20 AND 300 GROUP BY 1")
def aoi_summary(spark, d):
    inside = read(spark, d, "customer").filter((F.col("c_custkey") % 360).between(20, 300))
    zones = F.array_join(F.array_sort(F.collect_set(F.lpad(F.col("c_nationkey").cast("string"), 2, "0"))), ",")
    refused = F.sum(F.when(F.col("c_acctbal") <= 0, F.col("c_custkey") % 7).otherwise(0))
    return inside.groupBy("c_mktsegment").agg(F.count("*").alias("tiles"), F.count_if(F.col("c_acctbal") > 0).alias("embedded"), refused.alias("refused"), zones.alias("zones"))


@query("SELECT user_id, f AS first, s AS stop, CASE WHEN s - f <= 0.9 * 1000 THEN f ELSE 0 END AS read_from, CASE WHEN s - f <= 0.9 * 1000 THEN s ELSE 1000 END AS read_to FROM (SELECT user_id, min(event_id % 1000) AS f, max(event_id % 1000) + 1 AS s FROM events WHERE value > 90 GROUP BY 1)")
def valid_bbox_crop(spark, d):
    pixels = events(spark, d).withColumn("x", F.col("event_id") % 1000)
    return R.valid_box(pixels, ["user_id"], "x", F.col("value") > 90, 1000)


@query("SELECT min(i) AS first, max(i) + 1 AS stop FROM (SELECT s_acctbal AS c, row_number() OVER (ORDER BY s_acctbal, s_suppkey) - 1 AS i FROM supplier) WHERE c BETWEEN 1000 AND 5000")
def region_slice(spark, d):
    return R.region_slice(read(spark, d, "supplier"), "s_acctbal", 5000, 1000)


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) WHERE n <= 9 OR list_contains(list_transform(range(0, 9), lambda k: (k * (n - 1)) // 8), i)")
def strided_sample(spark, d):
    return R.strided(events(spark, d).select("user_id", "event_id"), ["user_id"], ["event_id"], 9)


@query("SELECT event_type, sum(CASE WHEN event_id % 3 > 0 THEN event_id % 50 END)::BIGINT AS px, sum(CASE WHEN event_type < 'c' THEN NULL ELSE event_id % 9 END)::BIGINT AS retries FROM events GROUP BY 1")
def worker_stats_sum(spark, d):
    k = F.col("event_id")
    return events(spark, d).groupBy("event_type").agg(F.sum(F.when(k % 3 > 0, k % 50)).alias("px"), F.sum(F.when(F.col("event_type") >= "c", k % 9)).alias("retries"))


@query("SELECT event_type, round(sum(n * m) / sum(n), 6) AS ram_mean, max(m) AS ram_peak, sum(n)::BIGINT AS samples FROM (SELECT event_type, user_id, count(*) AS n, max(value) AS m FROM events GROUP BY 1, 2) GROUP BY 1")
def ram_weighted(spark, d):
    w = events(spark, d).groupBy("event_type", "user_id").agg(F.count("*").alias("n"), F.max("value").alias("m"))
    return w.groupBy("event_type").agg(F.round(F.sum(F.col("n") * F.col("m")) / F.sum("n"), 6).alias("ram_mean"), F.max("m").alias("ram_peak"), F.sum("n").alias("samples"))


@query("""SELECT n_regionkey, count(*) AS cells, count(*) FILTER (n > 0 AND f > 0) AS published, count(*) FILTER (n > 0 AND f = 0) AS empty, count(*) FILTER (n IS NULL) AS missing FROM (SELECT n_regionkey, n_nationkey, y FROM nation, (SELECT DISTINCT year(o_orderdate) AS y FROM orders)) r
    LEFT JOIN (SELECT c_nationkey, year(o_orderdate) AS y, count(*) AS n, count(*) FILTER (o_totalprice > 440000) AS f FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) p ON c_nationkey = n_nationkey AND p.y = r.y GROUP BY 1""")
def delivery_reconciled(spark, d):
    """The roster (every nation and year, 25 times a few rows) against what was delivered."""
    o = read(spark, d, "orders").join(read(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).withColumn("y", F.year("o_orderdate"))
    made = o.groupBy(F.col("c_nationkey").alias("n_nationkey"), "y").agg(F.count("*").alias("n"), F.count_if(F.col("o_totalprice") > 440000).alias("f"))
    years = o.agg(F.collect_set("y").alias("ys"))
    roster = read(spark, d, "nation").crossJoin(F.broadcast(years)).select("n_regionkey", "n_nationkey", F.explode("ys").alias("y"))
    joined = roster.join(made, ["n_nationkey", "y"], "left")
    return joined.groupBy("n_regionkey").agg(F.count("*").alias("cells"), F.count_if((F.col("n") > 0) & (F.col("f") > 0)).alias("published"), F.count_if((F.col("n") > 0) & (F.col("f") == 0)).alias("empty"), F.count_if(F.col("n").isNull()).alias("missing"))


@query("SELECT label, count(*) AS px, count(*) FILTER (d = 0) AS bit_equal, round(max(d), 9) AS worst FROM (SELECT label, list_max(list_transform(embedding, lambda x: abs(x::DOUBLE - round_even(x::DOUBLE * 1024, 0) / 1024))) AS d FROM embeddings) GROUP BY 1")
def store_bit_equality(spark, d):
    """A store against a coarser copy of itself, matched by id: equal pixels and the worst difference."""
    a = read(spark, d, "embeddings").select("vec_id", "label", "embedding")
    b = a.select("vec_id", F.transform("embedding", lambda x: F.rint(x.cast("double") * 1024) / 1024).alias("copy"))
    worst = F.array_max(F.zip_with("embedding", "copy", lambda x, y: F.abs(x.cast("double") - y)))
    return a.join(b, "vec_id", "full").withColumn("d", worst).groupBy("label").agg(F.count("*").alias("px"), F.count_if(F.col("d") == 0).alias("bit_equal"), F.round(F.max("d"), 9).alias("worst"))


@query("SELECT DISTINCT o_custkey AS k, 'held' AS side FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events) UNION ALL SELECT DISTINCT user_id, 'wanted' FROM events WHERE user_id NOT IN (SELECT o_custkey FROM orders)")
def coordinate_departures(spark, d):
    held, wanted = read(spark, d, "orders").select(F.col("o_custkey").alias("k")), events(spark, d).select(F.col("user_id").alias("k"))
    return held.distinct().join(wanted.distinct(), "k", "left_anti").withColumn("side", F.lit("held")).union(wanted.distinct().join(held.distinct(), "k", "left_anti").withColumn("side", F.lit("wanted")))


@query("SELECT date_trunc('month', ts)::DATE AS month, count(*) AS items, count(DISTINCT user_id) AS tiles, min(event_id) AS first_item FROM events GROUP BY 1")
def month_streamed_scan(spark, d):
    """Items month by month: each month is a pushed-down range of its own, so a reader holds one at a time."""
    e = events(spark, d)
    span = e.agg(F.date_trunc("month", F.min("ts")).alias("a"), F.max("ts").alias("b"))
    months = span.select(F.explode(F.expr("sequence(a, b, INTERVAL 1 MONTH)")).alias("start")).select("start", F.expr("start + INTERVAL 1 MONTH").alias("stop"))
    keyed = e.join(F.broadcast(months), (F.date_trunc("month", "ts") == F.col("start")) & (F.col("ts") < F.col("stop")))
    return keyed.groupBy(F.to_date("start").alias("month")).agg(F.count("*").alias("items"), F.count_distinct("user_id").alias("tiles"), F.min("event_id").alias("first_item"))
