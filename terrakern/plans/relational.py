"""Aggregations, joins, windows, registry, embedding, telemetry and set operators bound to the tables.

Pixels are event users, observations are events (radar: signup ascending, error
descending; the other types optical), tiles are tens of users, run files are orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrakern.functions import geo as G
from terrakern.functions import pixel as P
from terrakern.operators import catalogue, joins, pixels, registry, telemetry
from terrakern.sources.tables import events, read

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _optical() -> Column:
    return F.col("event_type").isin("view", "click", "purchase")


def _radar() -> Column:
    return F.col("event_type").isin("signup", "error")


_O, _R = "event_type IN ('view','click','purchase')", "event_type IN ('signup','error')"


def _obs(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    return e.withColumn("day", F.to_date("ts")).withColumn("tile", F.floor(F.col("user_id") / 10))


def _counts(spark, d):
    return _obs(spark, d).groupBy("user_id", "tile").agg(F.count_if(_optical() & (F.col("value") > 60)).alias("optical"), F.count_if(_radar() & (F.col("value") > 80)).alias("radar"))


_COUNTS = f"(SELECT user_id, user_id//10 AS tile, count(*) FILTER ({_O} AND value > 60) AS optical, count(*) FILTER ({_R} AND value > 80) AS radar FROM events GROUP BY 1, 2)"


# -- filters and aggregations -------------------------------------------------------
@query(f"SELECT user_id, count(*) FILTER ({_O}) AS n_obs FROM events GROUP BY 1")
def obs_count(spark, d):
    return pixels.observation_counts(_obs(spark, d), ["user_id"], _optical())


@query(f"SELECT user_id, bit_or(CASE WHEN {_O} THEN 1::BIGINT << (month(ts)-1)::INTEGER ELSE 0 END)::BIGINT AS months FROM events GROUP BY 1")
def month_coverage(spark, d):
    return pixels.month_mask(_obs(spark, d), ["user_id"], "ts", _optical())


@query("SELECT event_id FROM events e WHERE EXISTS (SELECT 1 FROM events v WHERE v.event_type = 'purchase' AND v.user_id//10 = e.user_id//10 AND v.ts::DATE = e.ts::DATE)")
def prune_empty_steps(spark, d):
    return pixels.without_empty_steps(_obs(spark, d), ["tile", "day"], F.col("event_type") == "purchase").select("event_id")


@query(f"SELECT user_id, CASE WHEN optical = 0 THEN 'no_optical' WHEN optical < 9 THEN 'thin' WHEN radar = 0 THEN 'no_radar' END AS refusal FROM {_COUNTS}")
def eligibility(spark, d):
    return _counts(spark, d).select("user_id", pixels.refusal(F.col("optical"), F.col("radar"), 9).alias("refusal"))


@query(f"SELECT tile, refusal, count(*) AS n FROM (SELECT tile, CASE WHEN optical = 0 THEN 'no_optical' WHEN optical < 9 THEN 'thin' WHEN radar = 0 THEN 'no_radar' ELSE 'eligible' END AS refusal FROM {_COUNTS}) GROUP BY 1, 2")
def refusal_reasons(spark, d):
    reason = F.coalesce(pixels.refusal(F.col("optical"), F.col("radar"), 9), F.lit("eligible"))
    return _counts(spark, d).groupBy("tile", reason.alias("refusal")).agg(F.count("*").alias("n"))


@query(
    f"""SELECT tile, count(*) AS chunk_px, count(*) FILTER (optical > 0) AS px_with_any_optical, count(*) FILTER (optical = 0) AS refused_no_optical_px,
    count(*) FILTER (optical > 0 AND optical < 9) AS refused_thin_px, max(optical) AS obs_max, coalesce(round(quantile_cont(optical, 0.5) FILTER (optical > 0), 1), 0.0)::DOUBLE AS median_obs_where_any,
    round(quantile_cont(optical, 0.5) FILTER (optical > 0 AND optical < 9), 1)::DOUBLE AS median_obs_where_thin, count(*) FILTER (radar > 0) AS px_with_any_radar FROM {_COUNTS} GROUP BY 1"""
)
def coverage_record(spark, d):
    return pixels.coverage_record(_counts(spark, d), ["tile"], "optical", "radar", 9)


@query(f"SELECT tile, day, valid_px, live_px FROM (SELECT user_id//10 AS tile, ts::DATE AS day, count(*) FILTER ({_O} AND value > 50) AS valid_px, count(*) FILTER (value > 50) AS live_px FROM events GROUP BY 1, 2) WHERE live_px > 0 AND 100*valid_px >= 60*live_px")
def coverage_gate(spark, d):
    return pixels.admitted(_obs(spark, d), ["tile", "day"], _optical(), F.col("value") > 50, 60)


@query("SELECT c_custkey//40 AS row_, c_custkey%40//4 AS col_, bool_or(c_acctbal > 5000) AS live FROM customer GROUP BY 1, 2")
def coarsen_grid(spark, d):
    k = F.col("c_custkey")
    cells = read(spark, d, "customer").select((F.floor(k / 40) * 4).alias("row_"), (k % 40).alias("col_"), (F.col("c_acctbal") > 5000).alias("on"))
    return pixels.coarsened(cells, "row_", "col_", F.col("on"), 4)


@query("SELECT round(quantile_cont(value, 0.5), 4) AS p50, round(quantile_cont(value, 0.95), 4) AS p95, round(quantile_cont(value, 0.99), 4) AS p99 FROM events")
def latency_percentiles(spark, d):
    p = telemetry.exact_percentiles(events(spark, d), [], "value", {"p50": 0.5, "p95": 0.95, "p99": 0.99})
    return p.select(*[F.round(n, 4).alias(n) for n in ("p50", "p95", "p99")])


@query("SELECT event_type, round(sum(value)/count(*), 6) AS pooled, count(*) AS n FROM events GROUP BY 1")
def pooled_depth(spark, d):
    per_day = _obs(spark, d).groupBy("event_type", "day").agg(F.sum("value").alias("s"), F.count("*").alias("n"))
    return per_day.groupBy("event_type").agg(F.round(F.sum("s") / F.sum("n"), 6).alias("pooled"), F.sum("n").alias("n"))


@query("SELECT n_regionkey, round(sum(CASE WHEN s_acctbal > 0 THEN w ELSE 0 END)/sum(w), 9) AS fraction FROM (SELECT n_regionkey, s_acctbal, cos(radians(n_nationkey*6-70)) AS w FROM supplier JOIN nation ON s_nationkey = n_nationkey) GROUP BY 1")
def area_weighted_fraction(spark, d):
    w = F.cos(F.radians(F.col("n_nationkey") * 6 - 70))
    joined = read(spark, d, "supplier").join(read(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).withColumn("w", w)
    return joined.groupBy("n_regionkey").agg(F.round(F.sum(F.when(F.col("s_acctbal") > 0, F.col("w")).otherwise(0)) / F.sum("w"), 9).alias("fraction"))


@query("SELECT tile, round(sum(1 - c/100), 6) AS usable FROM (SELECT user_id//10 AS tile, ts::DATE AS day, avg(coalesce(CASE WHEN event_type = 'error' THEN NULL ELSE least(value, 100) END, 100)) AS c FROM events GROUP BY 1, 2) GROUP BY 1")
def usable_observations(spark, d):
    cloud = F.coalesce(F.when(F.col("event_type") != "error", F.least("value", F.lit(100))), F.lit(100))
    per_day = _obs(spark, d).groupBy("tile", "day").agg(F.avg(cloud).alias("c"))
    return per_day.groupBy("tile").agg(F.round(F.sum(1 - F.col("c") / 100), 6).alias("usable"))


@query("SELECT bin, arg_min(c_custkey, struct_pack(d := d, k := c_custkey)) AS nearest, count(*) AS n FROM (SELECT c_custkey, c_custkey % 360 // 15 AS bin, abs(c_custkey % 15 - 7) AS d FROM customer) GROUP BY 1")
def bin_representative(spark, d):
    k = F.col("c_custkey")
    rows = read(spark, d, "customer").select(k, F.floor(k % 360 / 15).alias("bin"), F.abs(k % 15 - 7).alias("d"))
    return rows.groupBy("bin").agg(F.min_by("c_custkey", F.struct("d", "c_custkey")).alias("nearest"), F.count("*").alias("n"))


@query("SELECT l_suppkey, count(DISTINCT l_shipdate) AS acquisitions FROM lineitem GROUP BY 1")
def burst_census(spark, d):
    return read(spark, d, "lineitem").groupBy("l_suppkey").agg(F.countDistinct("l_shipdate").alias("acquisitions"))


@query("SELECT day, sum(v)::BIGINT AS volume FROM (SELECT user_id, date_trunc('hour', ts) AS h, ts::DATE AS day, max(event_id % 1000) AS v FROM events GROUP BY 1, 2, 3) GROUP BY 1")
def object_volume(spark, d):
    hourly = _obs(spark, d).groupBy("user_id", F.date_trunc("hour", "ts").alias("h"), "day").agg(F.max(F.col("event_id") % 1000).alias("v"))
    return hourly.groupBy("day").agg(F.sum("v").alias("volume"))


@query("SELECT m, round(least(gb, 100)*0.09 + greatest(least(gb, 500)-100, 0)*0.07 + greatest(gb-500, 0)*0.05, 6) AS cost FROM (SELECT strftime(o_orderdate, '%Y-%m') AS m, count(*)::DOUBLE AS gb FROM orders GROUP BY 1)")
def tiered_cost(spark, d):
    gb = F.col("gb")
    monthly = read(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("m")).agg(F.count("*").cast("double").alias("gb"))
    tier = lambda low, high, price: F.greatest((F.least(gb, F.lit(high)) if high else gb) - low, F.lit(0.0)) * price
    return monthly.select("m", F.round(tier(0, 100, 0.09) + tier(100, 500, 0.07) + tier(500, None, 0.05), 6).alias("cost"))


@query("SELECT n_nationkey, sum(w) AS weight FROM (SELECT n_nationkey, CASE WHEN lat >= 60 THEN 208.0 WHEN lat >= 40 THEN 176.0 WHEN lat >= 20 THEN 168.0 WHEN lat >= 0 THEN 120.0 WHEN lat >= -20 THEN 104.0 WHEN lat >= -40 THEN 128.0 ELSE 104.0 END::DOUBLE AS w FROM (SELECT n_nationkey, c_custkey % 140 - 70 AS lat FROM customer JOIN nation ON c_nationkey = n_nationkey)) GROUP BY 1")
def zone_work_weight(spark, d):
    joined = read(spark, d, "customer").join(read(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_nationkey").agg(F.sum(G.latitude_weight(F.col("c_custkey") % 140 - 70)).alias("weight"))


@query("SELECT year(o_orderdate)::INTEGER AS year, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS published, round(100.0*count(*) FILTER (o_orderstatus = 'F')/count(*), 4)::DOUBLE AS pct FROM orders GROUP BY 1")
def year_rollup(spark, d):
    done = F.count_if(F.col("o_orderstatus") == "F")
    return read(spark, d, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"), done.alias("published"), F.round(100 * done / F.count("*"), 4).alias("pct"))


_DELIVERY = "SELECT o_orderstatus AS status, year(o_orderdate)::INTEGER AS year, count(*) AS n FROM orders GROUP BY "


@query(_DELIVERY + "GROUPING SETS ((o_orderstatus, year(o_orderdate)), (o_orderstatus), ())")
def delivery_grouping_sets(spark, d):
    rows = read(spark, d, "orders").select(F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("year"))
    return rows.groupingSets([["status", "year"], ["status"], []], "status", "year").agg(F.count("*").alias("n"))


@query(_DELIVERY + "CUBE (o_orderstatus, year(o_orderdate))")
def delivery_cube(spark, d):
    return read(spark, d, "orders").cube(F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))


@query(_DELIVERY + "ROLLUP (o_orderstatus, year(o_orderdate))")
def delivery_rollup(spark, d):
    return read(spark, d, "orders").rollup(F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))


@query()
def approx_tiles(spark, d):
    return read(spark, d, "lineitem").groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey", 0.02).alias("parts"))


@query("SELECT cell, count(*) AS rows, count(*) FILTER (m) AS measured, CASE WHEN count(*) = count(*) FILTER (m) THEN 'wholly' WHEN count(*) FILTER (m) = 0 THEN 'none' ELSE 'partly' END AS state FROM (SELECT o_custkey//50 AS cell, o_totalprice > 100000 AS m FROM orders) GROUP BY 1")
def completeness_census(spark, d):
    rows = read(spark, d, "orders").select(F.floor(F.col("o_custkey") / 50).alias("cell"), (F.col("o_totalprice") > 100000).alias("m"))
    per = rows.groupBy("cell").agg(F.count("*").alias("rows"), F.count_if("m").alias("measured"))
    return per.withColumn("state", F.when(F.col("rows") == F.col("measured"), "wholly").when(F.col("measured") == 0, "none").otherwise("partly"))


@query(f"SELECT sum(no_optical)::BIGINT AS no_optical, sum(thin)::BIGINT AS thin, sum(no_radar)::BIGINT AS no_radar, count(*) FILTER (no_optical >= thin AND no_optical >= no_radar AND no_optical > 0) AS mostly_no_optical, count(*) FILTER ((no_optical>0)::INT + (thin>0)::INT + (no_radar>0)::INT > 1) AS mixed FROM (SELECT tile, count(*) FILTER (optical = 0) AS no_optical, count(*) FILTER (optical BETWEEN 1 AND 8) AS thin, count(*) FILTER (optical >= 9 AND radar = 0) AS no_radar FROM {_COUNTS} GROUP BY 1)")
def optical_skip_summary(spark, d):
    o, r = F.col("optical"), F.col("radar")
    t = _counts(spark, d).groupBy("tile").agg(F.count_if(o == 0).alias("no_optical"), F.count_if(o.between(1, 8)).alias("thin"), F.count_if((o >= 9) & (r == 0)).alias("no_radar"))
    kinds = [F.col(k) for k in ("no_optical", "thin", "no_radar")]
    several = sum(((k > 0).cast("int") for k in kinds), F.lit(0)) > 1
    first = (kinds[0] >= kinds[1]) & (kinds[0] >= kinds[2]) & (kinds[0] > 0)
    return t.agg(*[F.sum(k).alias(n) for k, n in zip(kinds, ("no_optical", "thin", "no_radar"), strict=True)], F.count_if(first).alias("mostly_no_optical"), F.count_if(several).alias("mixed"))


@query(f"SELECT tile % 5 AS zone, CASE WHEN count(*) FILTER (radar = 0) > 0 THEN NULL ELSE round(100.0*count(*) FILTER (radar < 4)/count(*), 6) END::DOUBLE AS thin_radar_pct FROM {_COUNTS} GROUP BY 1")
def radar_summary(spark, d):
    silent = F.count_if(F.col("radar") == 0) > 0
    return _counts(spark, d).groupBy((F.col("tile") % 5).alias("zone")).agg(F.when(~silent, F.round(100 * F.count_if(F.col("radar") < 4) / F.count("*"), 6)).alias("thin_radar_pct"))


# -- joins -------------------------------------------------------------------------
@query("SELECT l_orderkey, l_linenumber, o_custkey, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_discount > 0.05 GROUP BY 1, 2, 3")
def granules_shard_dates(spark, d):
    shards = read(spark, d, "orders").select("o_orderkey", "o_custkey")
    return read(spark, d, "lineitem").filter("l_discount > 0.05").join(shards, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("l_orderkey", "l_linenumber", "o_custkey").agg(F.count("*").alias("n"))


@query("SELECT coalesce(w.k, h.k) AS tile, CASE WHEN h.k IS NULL THEN 'missing' WHEN w.k IS NULL THEN 'extra' ELSE 'differs' END AS kind FROM (SELECT o_custkey AS k, max(o_orderkey) AS v FROM orders WHERE o_custkey % 3 > 0 GROUP BY 1) w FULL JOIN (SELECT o_custkey AS k, CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE max(o_orderkey) END AS v FROM orders WHERE o_custkey % 4 > 0 GROUP BY 1) h ON w.k = h.k WHERE w.k IS NULL OR h.k IS NULL OR w.v IS DISTINCT FROM h.v")
def audit_full_outer(spark, d):
    o = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("tile")).agg(F.max("o_orderkey").alias("v"))
    held = o.filter("tile % 4 > 0").withColumn("v", F.when(F.col("tile") % 5 != 0, F.col("v")))
    return registry.audit(o.filter("tile % 3 > 0"), held, ["tile"], ["v"])


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def still_published_semi(spark, d):
    done = read(spark, d, "orders").filter("o_orderstatus = 'F'")
    return read(spark, d, "customer").join(done, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("SELECT user_id, m AS month FROM (SELECT DISTINCT user_id FROM events) u, (SELECT unnest(range(1, 13))::INTEGER AS m) WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = u.user_id AND month(e.ts) = m)")
def missing_months_anti(spark, d):
    e = events(spark, d).select("user_id", F.month("ts").alias("month")).distinct()
    spine = e.select("user_id").distinct().select("user_id", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
    return spine.join(e, ["user_id", "month"], "left_anti")


@query("SELECT s_suppkey, coalesce(n, 0) AS acquisitions FROM supplier LEFT JOIN (SELECT l_suppkey, count(DISTINCT l_shipdate) AS n FROM lineitem WHERE l_discount > 0.08 AND l_suppkey % 3 = 0 GROUP BY 1) ON s_suppkey = l_suppkey")
def burst_enrich_left(spark, d):
    n = read(spark, d, "lineitem").filter("l_discount > 0.08 and l_suppkey % 3 = 0").groupBy("l_suppkey").agg(F.countDistinct("l_shipdate").alias("n"))
    return read(spark, d, "supplier").join(n, F.col("s_suppkey") == F.col("l_suppkey"), "left").select("s_suppkey", F.coalesce("n", F.lit(0)).alias("acquisitions"))


@query("SELECT e.event_id, (SELECT max(p.event_id) FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'signup' AND p.ts = (SELECT max(q.ts) FROM events q WHERE q.user_id = e.user_id AND q.event_type = 'signup' AND q.ts <= e.ts)) AS phase FROM events e WHERE e.event_type = 'purchase'")
def phase_asof(spark, d):
    e = events(spark, d)
    phases = e.filter("event_type = 'signup'").select("user_id", "ts", F.col("event_id").alias("phase"))
    return joins.as_of(e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts"), phases, ["user_id"], "ts", "phase").select("event_id", "phase")


@query("SELECT s_suppkey, p_partkey FROM supplier JOIN part ON p_retailprice BETWEEN s_acctbal - 3 AND s_acctbal + 3")
def footprint_range_join(spark, d):
    boxes = read(spark, d, "supplier").select("s_suppkey", (F.col("s_acctbal") - 3).alias("low"), (F.col("s_acctbal") + 3).alias("high"))
    points = read(spark, d, "part").select("p_partkey", "p_retailprice")
    p = F.col("p_retailprice")
    return joins.by_cells(boxes, points, F.col("low"), F.col("high"), p, 10.0, (p >= F.col("low")) & (p <= F.col("high"))).select("s_suppkey", "p_partkey")


@query("SELECT DISTINCT r AS row_, c AS col_ FROM (SELECT s_suppkey % 20 AS r0, s_nationkey AS c0, s_suppkey % 3 AS h, s_suppkey % 4 AS w FROM supplier), LATERAL (SELECT unnest(range(r0, r0 + h + 1)) AS r), LATERAL (SELECT unnest(range(c0, c0 + w + 1)) AS c)")
def bitmap_expand(spark, d):
    k, n = F.col("s_suppkey"), F.col("s_nationkey").cast("long")
    rows = read(spark, d, "supplier").select(F.explode(F.sequence(k % 20, k % 20 + k % 3)).alias("row_"), k, n.alias("n"))
    return rows.select("row_", F.explode(F.sequence(F.col("n"), F.col("n") + k % 4)).alias("col_")).distinct()


@query("SELECT coalesce(o.k, n.k) AS tile, CASE WHEN n.k IS NOT NULL THEN n.v ELSE o.v END AS v FROM (SELECT c_custkey AS k, c_acctbal AS v FROM customer WHERE c_custkey % 7 > 0) o FULL JOIN (SELECT c_custkey AS k, -c_acctbal AS v FROM customer WHERE c_custkey % 3 = 0) n ON o.k = n.k")
def masked_merge(spark, d):
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("tile"), F.col("c_acctbal").alias("v"))
    new = c.withColumn("v", -F.col("v")).withColumn("owned", F.col("tile") % 3 == 0)
    return joins.masked_merge(c.filter("tile % 7 > 0"), new, ["tile"], ["v"], "owned")


@query("SELECT c_custkey AS tile, 'unpublished' AS side FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT DISTINCT o_custkey, 'unknown' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 9 > 0)")
def live_vs_master(spark, d):
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("tile"))
    o = read(spark, d, "orders").select(F.col("o_custkey").alias("tile")).distinct()
    return c.join(o, "tile", "left_anti").withColumn("side", F.lit("unpublished")).union(o.join(c.filter("tile % 9 > 0"), "tile", "left_anti").withColumn("side", F.lit("unknown")))


# -- windows and ranks ---------------------------------------------------------------
@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderpriority, o_orderkey DESC) AS r FROM orders) WHERE r = 1")
def newest_run_wins(spark, d):
    return registry.newest_run_wins(read(spark, d, "orders"), ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderpriority"), F.col("o_orderkey").desc()]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT user_id, day, event_type, event_id FROM (SELECT *, ts::DATE AS day, row_number() OVER (PARTITION BY user_id, ts::DATE, event_type ORDER BY value DESC, event_id) AS r FROM events) WHERE r = 1")
def dedup_best_copy(spark, d):
    return catalogue.best_copies(_obs(spark, d), ["user_id", "day", "event_type"], [F.col("value").desc(), F.col("event_id")]).select("user_id", "day", "event_type", "event_id")


@query("SELECT user_id, event_type, array_to_string(l[1:1], ',') AS used, array_to_string(l[2:], ',') AS spares FROM (SELECT user_id, event_type, list(event_id ORDER BY value DESC, event_id) AS l FROM events GROUP BY 1, 2)")
def dedup_ladder(spark, d):
    out = catalogue.ladders(events(spark, d), ["user_id", "event_type"], [F.col("value").desc(), F.col("event_id")], "event_id")
    return out.select("user_id", "event_type", F.col("used").cast("string").alias("used"), F.array_join(F.col("spares").cast("array<string>"), ",").alias("spares"))


@query("SELECT user_id, event_type, event_id AS used FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) AS r FROM events WHERE event_id % 4 > 0) WHERE r = 1")
def step_down(spark, d):
    return catalogue.step_down(events(spark, d), ["user_id", "event_type"], [F.col("value").desc(), F.col("event_id")], "event_id", F.col("event_id") % 4 == 0)


@query("SELECT event_id, CAST(row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY CASE WHEN event_type = 'error' THEN NULL ELSE value END NULLS LAST, event_id) - 1 AS INTEGER) AS position FROM events")
def fusion_order_optical(spark, d):
    cloud = F.when(F.col("event_type") != "error", F.col("value"))
    return catalogue.fusion_positions(_obs(spark, d), ["user_id", "day"], [cloud.asc_nulls_last(), F.col("event_id")]).select("event_id", "position")


@query("SELECT user_id, day, value, position FROM (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY position) AS r FROM (SELECT user_id, ts::DATE AS day, event_type, value, CAST(row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY event_id) - 1 AS INTEGER) AS position FROM events) WHERE event_type <> 'error') WHERE r = 1")
def first_valid_fuse(spark, d):
    placed = catalogue.fusion_positions(_obs(spark, d), ["user_id", "day"], [F.col("event_id")])
    return catalogue.first_valid(placed, ["user_id", "day"], "value", "position", F.col("event_type") != "error").filter("position is not null")


@query("SELECT user_id, event_type, island::BIGINT AS island, count(*) AS n, min(event_id) AS first_id FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM (SELECT *, CASE WHEN event_type = lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) THEN 0 ELSE 1 END AS new FROM events)) GROUP BY 1, 2, 3")
def gaps_islands(spark, d):
    marked = telemetry.islands(events(spark, d), "event_type", ["user_id"], ["ts", "event_id"])
    return marked.groupBy("user_id", "event_type", F.col("island").alias("island")).agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query("SELECT event_id, count(*) OVER w >= 3 AND min(value) OVER w >= 60 AS sustained, coalesce(sum(up) OVER w, 0) = 3 AS rising, coalesce(abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)) >= 100, false) AS churn FROM (SELECT *, CASE WHEN value > lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) THEN 1 ELSE 0 END AS up FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)")
def alerts_batch(spark, d):
    by, order = ["user_id"], ["ts", "event_id"]
    w = Window.partitionBy(*by).orderBy(*order)
    rows = telemetry.rising(events(spark, d), "value", 3, by, order, "rising")
    churn = F.coalesce(F.abs(F.col("value") - F.lag("value").over(w)) >= 100, F.lit(False))
    return rows.select("event_id", telemetry.sustained(F.col("value"), 60, 3, by, order).alias("sustained"), "rising", churn.alias("churn"))


@query("SELECT event_id, round((value - lag(value) OVER w)/nullif(epoch(ts) - epoch(lag(ts) OVER w), 0), 9) AS rate FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def rates(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    sec = lambda c: F.unix_micros(c) / 1e6
    dt = F.nullif(sec(F.col("ts")) - sec(F.lag("ts").over(w)), F.lit(0.0))
    return events(spark, d).select("event_id", F.round((F.col("value") - F.lag("value").over(w)) / dt, 9).alias("rate"))


@query()
def snapshot_thinning(spark, d):
    return telemetry.thinned(events(spark, d), ["user_id"], "event_id", "value", "event_type", 30.0)


@query("SELECT user_id//10 AS tile, min(user_id) AS first, max(user_id) AS last FROM events WHERE event_type = 'purchase' GROUP BY 1")
def row_bands(spark, d):
    return _obs(spark, d).filter("event_type = 'purchase'").groupBy("tile").agg(F.min("user_id").alias("first"), F.max("user_id").alias("last"))


# -- registry and lineage --------------------------------------------------------------
@query("SELECT o_custkey, o_orderkey, CASE WHEN o_orderpriority LIKE '1%' AND o_totalprice > 50000 THEN 0 WHEN o_totalprice > 50000 AND o_orderstatus = 'F' THEN 1 WHEN o_totalprice > 50000 THEN 2 ELSE 3 END AS rank FROM orders")
def as_master_rows(spark, d):
    measured = F.col("o_totalprice") > 50000
    by = F.when(F.col("o_orderpriority").like("1%"), "fill").otherwise("rebuild")
    return read(spark, d, "orders").select("o_custkey", "o_orderkey", registry.rank_of(by, measured, F.col("o_orderstatus") == "F").alias("rank"))


@query("SELECT kind, count(*) AS n FROM (SELECT 'duplicate_key' AS kind FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1 UNION ALL SELECT 'malformed_label' FROM lineitem WHERE l_returnflag NOT IN ('A','N')) GROUP BY 1")
def invariant_failures(spark, d):
    return registry.invariants(read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], F.col("l_returnflag").isin("A", "N"))


@query(
    """WITH RECURSIVE c AS (SELECT o_custkey, o_orderkey, o_orderpriority[1] IN ('1','2','3') AS holes, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS i FROM orders),
    f AS (SELECT o_custkey, i, CAST(o_orderkey % 7 AS VARCHAR) AS runs, o_orderkey % 7 AS last FROM c WHERE i = 1
    UNION ALL SELECT c.o_custkey, c.i, CASE WHEN NOT holes THEN CAST(o_orderkey % 7 AS VARCHAR) WHEN last = o_orderkey % 7 THEN runs ELSE runs || ',' || CAST(o_orderkey % 7 AS VARCHAR) END, o_orderkey % 7 FROM f JOIN c ON c.o_custkey = f.o_custkey AND c.i = f.i + 1)
    SELECT o_custkey, arg_max(runs, i) AS source_runs FROM f GROUP BY 1"""
)
def source_runs(spark, d):
    mode = F.when(F.substring("o_orderpriority", 1, 1).isin("1", "2", "3"), "holes").otherwise("fill")
    commits = read(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", (F.col("o_orderkey") % 7).alias("run"), mode.alias("mode"))
    out = registry.source_runs(commits, ["o_custkey"], ["o_orderdate", "o_orderkey"], "run", "mode")
    return out.select("o_custkey", F.array_join(F.col("source_runs").cast("array<string>"), ",").alias("source_runs"))


@query("SELECT year(o_orderdate)::INTEGER AS year, array_to_string(list_sort(list(DISTINCT o_custkey)), ',') AS tiles FROM orders WHERE o_orderstatus = 'P' GROUP BY 1")
def plan_from_registry(spark, d):
    rows = read(spark, d, "orders").withColumn("year", F.year("o_orderdate"))
    return registry.plan(rows, ["year"], "o_custkey", F.col("o_orderstatus") == "P").select("year", F.array_join(F.col("tiles").cast("array<string>"), ",").alias("tiles"))


@query("SELECT n_nationkey, y AS year FROM nation, (SELECT unnest(range(1995, 2002))::INTEGER AS y) WHERE NOT EXISTS (SELECT 1 FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = n_nationkey AND year(o_orderdate) = y AND o_totalprice > 440000)")
def campaign_work_list(spark, d):
    years = read(spark, d, "nation").select("n_nationkey", F.explode(F.sequence(F.lit(1995), F.lit(2001))).alias("year"))
    done = read(spark, d, "orders").filter("o_totalprice > 440000").join(read(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").alias("n_nationkey"), F.year("o_orderdate").alias("year"))
    return years.join(done.distinct(), ["n_nationkey", "year"], "left_anti")


@query(f"SELECT tile, CAST(row_number() OVER (ORDER BY m DESC, tile) AS INTEGER) AS rank FROM (SELECT tile, quantile_cont(optical, 0.5) AS m FROM {_COUNTS} WHERE optical > 0 AND optical < 12 GROUP BY 1)")
def infill_ranking(spark, d):
    thin = _counts(spark, d).filter("optical > 0 and optical < 12").groupBy("tile").agg(F.percentile("optical", F.lit(0.5)).alias("m"))
    return thin.select("tile", F.row_number().over(Window.orderBy(F.col("m").desc(), "tile")).alias("rank"))


@query("SELECT o_orderkey, CASE WHEN l.n IS NULL THEN 'unmeasured' WHEN l.n = o_orderkey % 5 THEN 'match' ELSE 'mismatch' END AS verdict FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) l ON o_orderkey = l_orderkey")
def compare_row(spark, d):
    n = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    verdict = F.when(F.col("n").isNull(), "unmeasured").when(F.col("n") == F.col("o_orderkey") % 5, "match").otherwise("mismatch")
    return read(spark, d, "orders").join(n, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", verdict.alias("verdict"))


# -- embeddings --------------------------------------------------------------------------
@query("SELECT vec_id, round(greatest(list_max(list_transform(embedding, lambda x: abs(x::DOUBLE)))/127, 1e-8), 12) AS scale, list_sum(list_transform(embedding, lambda x: round_even(x::DOUBLE/greatest(list_max(list_transform(embedding, lambda y: abs(y::DOUBLE)))/127, 1e-8), 0)))::BIGINT AS total FROM embeddings")
def quantize(spark, d):
    q, scale = P.quantised(F.col("embedding"))
    total = F.aggregate(q, F.lit(0).cast("long"), lambda s, x: s + x)
    return read(spark, d, "embeddings").select("vec_id", F.round(scale, 12).alias("scale"), total.alias("total"))


@query("SELECT vec_id, list_max(list_transform(list_zip(embedding, list_transform(embedding, lambda x: s*round_even(x::DOUBLE/s, 0))), lambda p: abs(p[1]::DOUBLE - p[2]))) <= s*0.5000001 AS within FROM (SELECT *, greatest(list_max(list_transform(embedding, lambda x: abs(x::DOUBLE)))/127, 1e-8) AS s FROM embeddings)")
def dequantize(spark, d):
    q, scale = P.quantised(F.col("embedding"))
    held = read(spark, d, "embeddings").select("vec_id", "embedding", q.alias("q"), scale.alias("s"))
    off = F.array_max(F.zip_with("embedding", P.dequantised(F.col("q"), F.col("s")), lambda a, b: F.abs(a.cast("double") - b)))
    return held.select("vec_id", (off <= F.col("s") * 0.5000001).alias("within"))


@query("SELECT vec_id, len(embedding[1:16])::INTEGER AS n, round(list_sum(list_transform(embedding[1:16], lambda x: x::DOUBLE)), 6) AS total FROM embeddings")
def prefix_slice(spark, d):
    p = F.slice("embedding", 1, 16)
    return read(spark, d, "embeddings").select("vec_id", F.size(p).alias("n"), F.round(F.aggregate(p, F.lit(0.0), lambda s, x: s + x.cast("double")), 6).alias("total"))


@query("SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def cosine_pairs(spark, d):
    a = read(spark, d, "embeddings").select("vec_id", "embedding")
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return a.join(b, "vec_id").select("vec_id", F.round(P.cosine(F.col("embedding"), F.col("other")), 6).alias("cosine"))


@query("SELECT label, count(*) FILTER (d <= 0.1) AS within_01, count(*) FILTER (d <= 0.3) AS within_03, count(*) AS n FROM (SELECT label, abs(unnest(embedding)::DOUBLE) AS d FROM embeddings) GROUP BY 1")
def absdiff_cdf(spark, d):
    x = read(spark, d, "embeddings").select("label", F.explode("embedding").alias("x")).withColumn("d", F.abs(F.col("x").cast("double")))
    return x.groupBy("label").agg(F.count_if(F.col("d") <= 0.1).alias("within_01"), F.count_if(F.col("d") <= 0.3).alias("within_03"), F.count("*").alias("n"))


# -- sets, sorts, limits --------------------------------------------------------------------
@query("SELECT c_custkey AS k, c_name AS name, NULL::DOUBLE AS price FROM customer UNION ALL SELECT p_partkey, NULL, p_retailprice FROM part")
def union_aligned(spark, d):
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    return c.unionByName(read(spark, d, "part").select(F.col("p_partkey").alias("k"), F.col("p_retailprice").alias("price")), allowMissingColumns=True)


@query("SELECT event_id FROM events WHERE user_id < 90 UNION SELECT event_id FROM events WHERE user_id > 60")
def dedup_halves(spark, d):
    e = events(spark, d).select("event_id", "user_id")
    return catalogue.both_halves(e.filter("user_id < 90"), e.filter("user_id > 60"), "event_id").select("event_id")


@query("SELECT l_suppkey AS k FROM lineitem WHERE l_discount > 0.09 INTERSECT SELECT s_suppkey FROM supplier WHERE s_acctbal > 0")
def windows_intersect(spark, d):
    return read(spark, d, "lineitem").filter("l_discount > 0.09").select(F.col("l_suppkey").alias("k")).intersect(read(spark, d, "supplier").filter("s_acctbal > 0").select("s_suppkey"))


@query("SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 200")
def topk_spikes(spark, d):
    return events(spark, d).select("event_id", "value").orderBy(F.col("value").desc(), "event_id").limit(200)


@query("SELECT user_id, n, CAST(row_number() OVER (ORDER BY n DESC, user_id) AS INTEGER) AS place FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1)")
def densest_first(spark, d):
    n = events(spark, d).groupBy("user_id").agg(F.count("*").alias("n"))
    return n.select("user_id", "n", F.row_number().over(Window.orderBy(F.col("n").desc(), "user_id")).alias("place"))


@query()
def sample_live(spark, d):
    return events(spark, d).filter(_optical()).sample(0.1, seed=7).select("event_id")


# -- telemetry -----------------------------------------------------------------------------
@query("SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS bin, event_type, count(*) AS n, round(max(value), 6) AS top FROM events GROUP BY 1, 2")
def log_bins_5m(spark, d):
    out = telemetry.bins(events(spark, d), "ts", "5 minutes", ["event_type"], [F.count("*").alias("n"), F.round(F.max("value"), 6).alias("top")])
    return out.withColumn("bin", F.col("bin").cast("timestamp_ntz"))


@query("SELECT user_id, min(ts) FILTER (event_type = 'signup') AS first_signup, max(ts) FILTER (event_type = 'error') AS last_error, bool_or(event_type = 'purchase') AS bought FROM events GROUP BY 1")
def lifecycle_flags(spark, d):
    when = lambda t: F.when(F.col("event_type") == t, F.col("ts").cast("timestamp_ntz"))
    return events(spark, d).groupBy("user_id").agg(F.min(when("signup")).alias("first_signup"), F.max(when("error")).alias("last_error"), F.bool_or(F.col("event_type") == "purchase").alias("bought"))


@query("SELECT user_id//10 AS stream, round(max(value), 4) AS peak, round(avg(value), 4) AS mean, round(quantile_cont(value, 0.99), 4) AS p99, count(*) AS samples FROM events GROUP BY 1")
def ram_rollup(spark, d):
    e = _obs(spark, d).select(F.col("tile").alias("stream"), "value")
    sums = e.groupBy("stream").agg(F.round(F.max("value"), 4).alias("peak"), F.round(F.avg("value"), 4).alias("mean"), F.count("*").alias("samples"))
    p99 = telemetry.exact_percentiles(e, ["stream"], "value", {"p99": 0.99}).select("stream", F.round("p99", 4).alias("p99"))
    return sums.join(p99, "stream")


@query("SELECT CASE WHEN value < 20 THEN 'ok' WHEN value < 60 THEN 'slow' ELSE 'failed' END AS status, sum(event_id % 4)::BIGINT AS retries, count(*) AS n FROM events GROUP BY 1")
def retries_by_status(spark, d):
    status = F.when(F.col("value") < 20, "ok").when(F.col("value") < 60, "slow").otherwise("failed")
    return events(spark, d).groupBy(status.alias("status")).agg(F.sum(F.col("event_id") % 4).alias("retries"), F.count("*").alias("n"))
