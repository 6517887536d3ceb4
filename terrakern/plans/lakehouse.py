"""Further filters, joins, sequences, lineage and log operators bound to the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrakern.functions import calendar as C
from terrakern.functions import geo as G
from terrakern.functions import pixel as P
from terrakern.functions import text as T
from terrakern.functions import utm
from terrakern.operators import catalogue, registry, telemetry
from terrakern.sources.tables import events, read

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


# -- sequences and maps --------------------------------------------------------------
@query("SELECT p_partkey, CAST(k AS INTEGER) AS strip, CAST(k*16 AS INTEGER) AS first, CAST(least((k+1)*16, p_size) AS INTEGER) AS stop FROM part, LATERAL (SELECT unnest(range(0, (p_size + 15)//16)) AS k)")
def strip_plan(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("p_size")
    strips = read(spark, d, "part").select("p_partkey", n, F.posexplode(F.sequence(F.lit(0), F.floor((n + 15) / 16).cast("int") - 1)).alias("strip", "k"))
    return strips.select("p_partkey", "strip", (F.col("k") * 16).alias("first"), F.least((F.col("k") + 1) * 16, n).alias("stop"))


@query("SELECT o_custkey, CAST(min(o_orderdate)::DATE - 1 AS DATE) AS ask_from, CAST(max(o_orderdate)::DATE + 1 AS DATE) AS ask_to, max(o_orderdate)::DATE - min(o_orderdate)::DATE + 1 AS days FROM orders GROUP BY 1")
def padded_ranges(spark, d):
    a, b = F.to_date(F.min("o_orderdate")), F.to_date(F.max("o_orderdate"))
    return read(spark, d, "orders").groupBy("o_custkey").agg(F.date_sub(a, 1).alias("ask_from"), F.date_add(b, 1).alias("ask_to"), (F.datediff(b, a) + 1).cast("long").alias("days"))


@query("SELECT CAST(d AS DATE) AS day, count(event_id) AS n FROM (SELECT unnest(generate_series(DATE '2023-12-30', DATE '2024-02-02', INTERVAL 1 DAY)) AS d) LEFT JOIN events ON ts::DATE = CAST(d AS DATE) GROUP BY 1")
def daily_axis(spark, d):
    axis = spark.range(1).select(F.explode(F.sequence(F.lit("2023-12-30").cast("date"), F.lit("2024-02-02").cast("date"))).alias("day"))
    return axis.join(events(spark, d).withColumn("day", F.to_date("ts")), "day", "left").groupBy("day").agg(F.count("event_id").alias("n"))


@query("SELECT user_id, array_to_string(list_concat(coalesce(list(event_id ORDER BY event_id) FILTER (event_type = 'signup'), []), coalesce(list(event_id ORDER BY event_id) FILTER (event_type = 'error'), [])), ',') AS merged FROM events GROUP BY 1")
def merged_radar_sequence(spark, d):
    part = lambda t: F.array_sort(F.collect_list(F.when(F.col("event_type") == t, F.col("event_id"))))
    merged = F.concat(part("signup"), part("error"))
    return events(spark, d).groupBy("user_id").agg(F.array_join(merged.cast("array<string>"), ",").alias("merged"))


@query("SELECT n_regionkey, array_to_string(list(n_name || '=' || n_nationkey ORDER BY n_name), ';') AS assets FROM nation GROUP BY 1")
def assets_sorted_map(spark, d):
    m = T.sorted_map(F.map_from_entries(F.collect_list(F.struct("n_name", F.col("n_nationkey").cast("string")))))
    text = F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return read(spark, d, "nation").groupBy("n_regionkey").agg(text.alias("assets"))


@query("SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INTEGER) AS place FROM orders")
def granule_json_explode(spark, d):
    listed = read(spark, d, "orders").groupBy("o_custkey").agg(F.to_json(F.array_sort(F.collect_list("o_orderkey"))).alias("j"))
    return listed.select("o_custkey", F.posexplode(F.from_json("j", "array<bigint>")).alias("place", "o_orderkey"))


@query("SELECT n_regionkey, n_nationkey FROM nation")
def plan_json_roundtrip(spark, d):
    plan = read(spark, d, "nation").groupBy("n_regionkey").agg(F.to_json(F.struct(F.array_sort(F.collect_list("n_nationkey")).alias("tiles"))).alias("plan"))
    return plan.select("n_regionkey", F.explode(F.from_json("plan", "tiles array<int>")["tiles"]).alias("n_nationkey"))


@query("SELECT c_custkey, round(" + utm.ROW_LATITUDE_SQL.format(n="CASE WHEN c_custkey % 2 = 0 THEN c_custkey * 1000.0 ELSE c_custkey * 1000.0 - 10000000.0 END") + ", 9) AS latitude FROM customer")
def row_latitude(spark, d):
    n = F.col("c_custkey") * 1000.0
    return read(spark, d, "customer").select("c_custkey", F.round(utm.row_latitude(n, F.col("c_custkey") % 2 != 0), 9).alias("latitude"))


# -- filters -------------------------------------------------------------------------
@query("SELECT event_id, event_id % 12 IN (4,5,6,7,10,11) AS scl_valid, (event_id % 2 <> 0 OR event_id % 3 <> 0) AS radar_valid FROM events")
def scl_and_radar_valid(spark, d):
    k = F.col("event_id")
    return events(spark, d).select(k, (k % 12).isin(*P.VALID_CLASSES).alias("scl_valid"), ((k % 2 != 0) | (k % 3 != 0)).alias("radar_valid"))


@query("SELECT event_id, CASE WHEN n.n_regionkey < 3 THEN value ELSE 0 END AS value FROM events JOIN nation n ON user_id % 25 = n_nationkey")
def roi_mask(spark, d):
    mask = read(spark, d, "nation").select((F.col("n_nationkey").cast("long")).alias("cell"), (F.col("n_regionkey") < 3).alias("live"))
    return events(spark, d).withColumn("cell", F.col("user_id") % 25).join(mask, "cell").select("event_id", F.when(F.col("live"), F.col("value")).otherwise(0).alias("value"))


@query("SELECT event_id FROM events WHERE ts::DATE NOT IN (SELECT ts::DATE FROM events WHERE event_type = 'error' AND day(ts) % 3 = 0)")
def existing_date_anti(spark, d):
    e = events(spark, d).withColumn("day", F.to_date("ts"))
    return catalogue.unseen_days(e, e.filter("event_type = 'error' AND day(ts) % 3 = 0"), ["day"]).select("event_id")


@query("SELECT event_id FROM events WHERE CAST(ts + to_hours(CAST(trunc(((user_id % 25)*15-180)/15.0) AS INTEGER)) AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-15'")
def owned_filter(spark, d):
    day = C.solar_day(F.col("ts"), (F.col("user_id") % 25) * 15 - 180)
    asked = events(spark, d).filter(F.to_date("ts").between("2024-01-09", "2024-01-16"))
    return asked.filter(day.between("2024-01-10", "2024-01-15")).select("event_id")


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '1%') AND c_acctbal > 0")
def narrow_tiles(spark, d):
    chosen = read(spark, d, "orders").filter(F.col("o_orderpriority").like("1%")).select(F.col("o_custkey").alias("c_custkey"))
    return read(spark, d, "customer").filter("c_acctbal > 0").join(chosen, "c_custkey", "left_semi").select("c_custkey")


# -- aggregates -----------------------------------------------------------------------
@query("SELECT tile, count(*) FILTER (n = 0) AS no_optical, count(*) FILTER (n BETWEEN 1 AND 5) AS thin, count(*) FILTER (n <= 5) AS refused FROM (SELECT user_id//10 AS tile, user_id, count(*) FILTER (event_type = 'purchase') AS n FROM events GROUP BY 1, 2) GROUP BY 1")
def rederive_measurements(spark, d):
    per = events(spark, d).groupBy(F.floor(F.col("user_id") / 10).alias("tile"), "user_id").agg(F.count_if(F.col("event_type") == "purchase").alias("n"))
    return per.groupBy("tile").agg(F.count_if(F.col("n") == 0).alias("no_optical"), F.count_if(F.col("n").between(1, 5)).alias("thin"), F.count_if(F.col("n") <= 5).alias("refused"))


@query("SELECT count(*) FILTER (l_quantity * 1000 > l_extendedprice) AS violating, count(*) FILTER (l_discount > 0) AS measured FROM lineitem")
def basis_violations(spark, d):
    return read(spark, d, "lineitem").agg(F.count_if(F.col("l_quantity") * 1000 > F.col("l_extendedprice")).alias("violating"), F.count_if(F.col("l_discount") > 0).alias("measured"))


@query("SELECT h, max(n) AS most FROM (SELECT date_trunc('hour', ts) AS h, time_bucket(INTERVAL 5 MINUTE, ts) AS b, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1")
def hourly_max_crosscheck(spark, d):
    per = events(spark, d).groupBy(F.date_trunc("hour", "ts").alias("h"), F.window("ts", "5 minutes")).agg(F.count("*").alias("n"))
    return per.groupBy(F.col("h").cast("timestamp_ntz").alias("h")).agg(F.max("n").alias("most"))


@query("SELECT user_id, count(*) AS n, min(o_custkey) IS NOT NULL AS known FROM events LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P') ON user_id = o_custkey GROUP BY 1")
def pixel_lineage(spark, d):
    runs = read(spark, d, "orders").filter("o_orderstatus = 'P'").select("o_custkey").distinct()
    return events(spark, d).join(runs, F.col("user_id") == F.col("o_custkey"), "left").groupBy("user_id").agg(F.count("*").alias("n"), F.min("o_custkey").isNotNull().alias("known"))


# -- joins -----------------------------------------------------------------------------
@query("SELECT s_suppkey, CASE WHEN lat >= 60 THEN 208.0 WHEN lat >= 40 THEN 176.0 WHEN lat >= 20 THEN 168.0 WHEN lat >= 0 THEN 120.0 WHEN lat >= -20 THEN 104.0 WHEN lat >= -40 THEN 128.0 ELSE 104.0 END::DOUBLE AS weight FROM (SELECT s_suppkey, s_suppkey % 150 - 75 AS lat FROM supplier)")
def step_join_weights(spark, d):
    # the steps stand at multiples of 20 degrees: one row a band, so an equality join finds each point's step
    weight = lambda band: next(w for lower, w in G.LATITUDE_STEPS if lower <= 20 * band)
    bands = spark.createDataFrame([(b, float(weight(b))) for b in range(-4, 5)], "band long, weight double")
    points = read(spark, d, "supplier").select("s_suppkey", F.floor((F.col("s_suppkey") % 150 - 75) / 20).alias("band"))
    return points.join(F.broadcast(bands), "band").select("s_suppkey", "weight")


@query("SELECT a.c_custkey FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 1 WHERE abs(b.c_acctbal - a.c_acctbal) > 100")
def grid_conformance(spark, d):
    a = read(spark, d, "customer").select("c_custkey", "c_acctbal")
    b = a.select((F.col("c_custkey") - 1).alias("c_custkey"), F.col("c_acctbal").alias("other"))
    return a.join(b, "c_custkey").filter(F.abs(F.col("other") - F.col("c_acctbal")) > 100).select("c_custkey")


@query("SELECT DISTINCT l_orderkey FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)")
def implicated_items(spark, d):
    held = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws("-", "l_linenumber", "l_suppkey"), "l_suppkey"))).alias("assets"))
    failed = read(spark, d, "supplier").filter("s_acctbal < 0").select(F.col("s_suppkey").alias("href"))
    return held.select("l_orderkey", F.explode(F.map_values("assets")).alias("href")).join(failed, "href", "left_semi").select("l_orderkey").distinct()


@query("SELECT o_custkey, o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) UNION ALL SELECT NULL, l_orderkey FROM (SELECT DISTINCT l_orderkey FROM lineitem) WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def store_disagreements(spark, d):
    o, items = read(spark, d, "orders").select("o_custkey", "o_orderkey"), read(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    lost = items.join(o, "o_orderkey", "left_anti").select(F.lit(None).cast("long").alias("o_custkey"), "o_orderkey")
    return o.join(items, "o_orderkey", "left_anti").select("o_custkey", "o_orderkey").union(lost)


# -- windows --------------------------------------------------------------------------
@query("SELECT l_orderkey, l_suppkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, l_suppkey) - 1 AS INTEGER) AS position FROM (SELECT l_orderkey, l_suppkey, max(n) AS n FROM lineitem JOIN (SELECT l_suppkey AS k, count(DISTINCT l_shipdate) AS n FROM lineitem GROUP BY 1) ON l_suppkey = k GROUP BY 1, 2)")
def fusion_order_radar(spark, d):
    items = read(spark, d, "lineitem")
    n = items.groupBy("l_suppkey").agg(F.countDistinct("l_shipdate").alias("n"))
    each = items.select("l_orderkey", "l_suppkey").distinct().join(n, "l_suppkey")
    return catalogue.fusion_positions(each, ["l_orderkey"], [F.col("n").desc(), F.col("l_suppkey")]).select("l_orderkey", "l_suppkey", "position")


@query("SELECT day, user_id, event_type FROM (SELECT ts::DATE AS day, user_id, event_type, row_number() OVER (PARTITION BY ts::DATE, user_id ORDER BY ts, event_id) AS r FROM events) WHERE r = 1")
def first_baseline(spark, d):
    e = events(spark, d).withColumn("day", F.to_date("ts"))
    return catalogue.best_copies(e, ["day", "user_id"], [F.col("ts"), F.col("event_id")]).select("day", "user_id", "event_type")


@query("SELECT day, n, n - lag(n) OVER (ORDER BY day) AS change FROM (SELECT ts::DATE AS day, count(DISTINCT user_id) AS n FROM events GROUP BY 1)")
def worker_churn(spark, d):
    n = events(spark, d).groupBy(F.to_date("ts").alias("day")).agg(F.countDistinct("user_id").alias("n"))
    return n.select("day", "n", (F.col("n") - F.lag("n").over(Window.orderBy("day"))).alias("change"))


@query("SELECT user_id, bucket, CAST((row_number() OVER (PARTITION BY bucket ORDER BY user_id) - 1)//16 AS BIGINT) AS batch FROM (SELECT user_id, CAST(least(256, ceil(greatest(count(*),1)/8.0)*8) AS INTEGER) AS bucket FROM events GROUP BY 1)")
def bucket_batches(spark, d):
    n = events(spark, d).groupBy("user_id").agg(P.ladder_bucket(F.count("*")).alias("bucket"))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("user_id")) - 1
    return n.select("user_id", "bucket", F.floor(place / 16).alias("batch"))


@query("SELECT event_type, user_id, value FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS r FROM events) WHERE r <= 5")
def preview_first_five(spark, d):
    return catalogue.ranked_copies(events(spark, d), ["event_type"], [F.col("value").desc(), F.col("event_id")], "r").filter("r <= 5").select("event_type", "user_id", "value")


# -- registry -------------------------------------------------------------------------
@query("SELECT c_custkey, coalesce(n, 0) AS runs, n IS NOT NULL AS embedded, 9 AS optical_min_obs FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON c_custkey = o_custkey")
def registry_rows(spark, d):
    n = read(spark, d, "orders").filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.count("*").alias("n"))
    joined = read(spark, d, "customer").join(n, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("c_custkey", F.coalesce("n", F.lit(0)).alias("runs"), F.col("n").isNotNull().alias("embedded"), F.lit(9).alias("optical_min_obs"))


@query("SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, CASE WHEN o_orderpriority LIKE '1%' AND o_totalprice > 50000 THEN 0 WHEN o_totalprice > 50000 AND o_orderstatus = 'F' THEN 1 WHEN o_totalprice > 50000 THEN 2 ELSE 3 END, o_orderkey DESC) AS r FROM orders WHERE o_orderpriority LIKE '1%' OR EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)) WHERE r = 1")
def merge_cell(spark, d):
    o = read(spark, d, "orders")
    fills, rebuilt = o.filter(F.col("o_orderpriority").like("1%")), o.filter(~F.col("o_orderpriority").like("1%"))
    held = rebuilt.join(read(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")
    measured, by = F.col("o_totalprice") > 50000, F.when(F.col("o_orderpriority").like("1%"), "fill").otherwise("rebuild")
    rank = registry.rank_of(by, measured, F.col("o_orderstatus") == "F")
    return registry.newest_run_wins(fills.unionByName(held), ["o_custkey"], [F.col("o_orderdate").desc(), rank, F.col("o_orderkey").desc()]).select("o_custkey", "o_orderkey")


@query("SELECT o_custkey, max(o_orderdate) AS latest, arg_max(o_orderkey, struct_pack(a := o_orderdate, b := o_orderkey)) AS run FROM orders GROUP BY 1")
def lineage_stamp(spark, d):
    return read(spark, d, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("latest"), F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("run"))


@query("SELECT o_custkey % 20 AS cell, CASE WHEN bool_or(o_totalprice > 445000) THEN NULL ELSE count(DISTINCT o_custkey) END AS tiles FROM orders GROUP BY 1")
def plan_from_tiles(spark, d):
    return read(spark, d, "orders").groupBy((F.col("o_custkey") % 20).alias("cell")).agg(F.when(~F.bool_or(F.col("o_totalprice") > 445000), F.countDistinct("o_custkey")).alias("tiles"))


@query("SELECT o_custkey, least(9, min(o_orderkey % 15)) AS floor_, min(o_orderkey % 15) < 9 AS loosened FROM orders GROUP BY 1")
def min_obs_floor(spark, d):
    least = F.min(F.col("o_orderkey") % 15)
    return read(spark, d, "orders").groupBy("o_custkey").agg(F.least(F.lit(9).cast("long"), least).alias("floor_"), (least < 9).alias("loosened"))


@query("SELECT c_custkey, CASE WHEN n IS NULL THEN 'pending' WHEN n = f THEN 'done' ELSE 'not_complete' END AS state FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus <> 'P') AS f FROM orders GROUP BY 1) ON c_custkey = o_custkey")
def update_state(spark, d):
    n = read(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") != "P").alias("f"))
    state = F.when(F.col("n").isNull(), "pending").when(F.col("n") == F.col("f"), "done").otherwise("not_complete")
    return read(spark, d, "customer").join(n, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", state.alias("state"))


@query("SELECT n_nationkey FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000)")
def missing_zones(spark, d):
    done = read(spark, d, "supplier").filter("s_acctbal > 9000").select(F.col("s_nationkey").alias("n_nationkey"))
    return read(spark, d, "nation").join(done, "n_nationkey", "left_anti").select("n_nationkey")


@query("SELECT label, count(*) AS n, round(avg(c), 6) AS mean_cosine, round(min(c), 6) AS least_cosine FROM (SELECT a.label, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS c FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1) GROUP BY 1")
def compare_outputs(spark, d):
    a = read(spark, d, "embeddings").select("vec_id", "embedding", "label")
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    c = a.join(b, "vec_id").withColumn("c", P.cosine(F.col("embedding"), F.col("other")))
    return c.groupBy("label").agg(F.count("*").alias("n"), F.round(F.avg("c"), 6).alias("mean_cosine"), F.round(F.min("c"), 6).alias("least_cosine"))


@query("SELECT user_id, CAST(floor(before * 4.0 / total) AS BIGINT) AS part FROM (SELECT user_id, n, coalesce(sum(n) OVER (ORDER BY user_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(n) OVER () AS total FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1))")
def partition_bands_weighted(spark, d):
    n = events(spark, d).groupBy("user_id").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("user_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return n.select("user_id", F.floor(before * 4.0 / F.sum("n").over(Window.partitionBy())).alias("part"))


@query("SELECT user_id, event_type, island, round(epoch(max(ts)) - epoch(min(ts)), 3) AS seconds FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS island FROM (SELECT *, CASE WHEN event_type = lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) THEN 0 ELSE 1 END AS new FROM events)) GROUP BY 1, 2, 3")
def stage_timings(spark, d):
    runs = telemetry.islands(events(spark, d), "event_type", ["user_id"], ["ts", "event_id"])
    took = (F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / 1e6
    return runs.groupBy("user_id", "event_type", "island").agg(F.round(took, 3).alias("seconds"))


@query("SELECT 'o_comment' AS name, 'missing' AS departure UNION ALL SELECT 'o_orderpriority', 'undeclared' UNION ALL SELECT 'o_totalprice', 'type double'")
def schema_departures(spark, d):
    declared = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "float", "o_orderdate": "timestamp_ntz", "o_comment": "string"}
    found = dict(read(spark, d, "orders").dtypes)
    out = [(n, "missing") for n in declared if n not in found] + [(n, "undeclared") for n in found if n not in declared]
    out += [(n, f"type {found[n]}") for n, t in declared.items() if n in found and found[n] != t]
    return spark.createDataFrame(out, "name string, departure string")
