"""Items, zones, strips, batches and log lines bound to the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrakern.functions import geo as G
from terrakern.functions import items as I
from terrakern.functions import pixel as P
from terrakern.functions import text as T
from terrakern.sources.tables import events, read

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'MGRS-' || n || 'UUP' WHEN o_orderkey % 6 = 4 THEN 'MGRS-' || n || 'TWM' WHEN o_orderkey % 5 <> 0 THEN 'MGRS-' || n || 'XYZ' END AS tile,
    CASE WHEN o_orderkey % 7 = 1 THEN 3 WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 10 END::INTEGER AS sequence,
    CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 THEN 'GS2A_20240101T100000_' || n || '|20250619T1536' || lpad((n - 1)::VARCHAR, 2, '0') END AS image FROM (SELECT o_orderkey, o_orderkey % 60 + 1 AS n FROM orders)""")
def item_identity(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    n = (k % 60 + 1).cast("string")
    code = F.when(k % 3 == 0, F.concat(F.lit("MGRS-"), n, F.lit("UUP"))).otherwise("")
    square = F.when(k % 2 == 0, F.concat(F.lit(" "), n, F.lit("TWM"))).otherwise(F.concat(F.lit("T"), n, F.lit("TWM")))
    name = F.when(k % 5 == 0, "X_T33TWM_1").otherwise(F.concat(F.lit("S2A_"), n, F.lit("XYZ_20240101_"), (k % 10).cast("string"), F.lit("_L2A")))
    declared = F.when(k % 7 == 0, "1.9").when(k % 7 == 1, " 3 ")
    take = F.concat(F.lit("GS2A_20240101T100000_"), n, F.when(k % 11 == 0, "_N5").otherwise("_N05.10"))
    strip = F.when(k % 13 != 0, F.concat(F.lit("S2B_OPER_MSI_L2A_DS_2BPS_20250619T191325_S20250619T1536"), F.lpad((k % 60).cast("string"), 2, "0"), F.lit("_N05.11")))
    return read(spark, d, "orders").select(k, I.item_tile(code, F.when(k % 3 == 1, square), name).alias("tile"), I.item_sequence(declared, name).alias("sequence"), I.image_identity(take, strip).alias("image"))


@query("""SELECT l_orderkey, CASE WHEN bool_or(b IS NULL) THEN 'unknown' WHEN bool_and(b IN (0, 2)) THEN 'harmonised' WHEN bool_and(b = 1) THEN 'raw' WHEN bool_or(b IN (0, 2)) AND bool_or(b = 1) THEN 'mixed' ELSE 'unknown' END AS producer
    FROM (SELECT l_orderkey, CASE WHEN l_partkey % 17 = 0 THEN NULL WHEN l_partkey % 5 = 0 THEN 3 ELSE l_suppkey % 3 END AS b FROM lineitem) GROUP BY 1""")
def item_producer(spark, d):
    s, k = F.col("l_suppkey") % 3, F.col("l_partkey")
    known = F.when(s == 0, "s3://sentinel-cogs/a").when(s == 1, "https://sentinel-s2-l2a.s3.eu-central-1.amazonaws.com/a").otherwise("https://s3.us-west-2.amazonaws.com/e84-earth-search-sentinel-data/a")
    href = F.when(k % 17 == 0, F.lit(None)).when(k % 5 == 0, "s3://elsewhere/a").otherwise(known)
    return read(spark, d, "lineitem").groupBy("l_orderkey").agg(I.producer(T.bucket(href)).alias("producer"))


@query("""SELECT c_custkey, zone, CASE WHEN f = 0 THEN NULL WHEN f = 1 THEN zone[:5] ELSE zone END AS grp, CASE WHEN f = 1 AND zone IS NOT NULL THEN 's' END AS half, CASE WHEN zone IS NULL THEN '' WHEN f = 0 THEN zone || 'n,' || zone || 's' ELSE zone END AS fills
    FROM (SELECT c_custkey, c_custkey % 5 AS f, CASE WHEN c_custkey % 70 NOT BETWEEN 1 AND 60 OR c_custkey % 5 = 4 THEN NULL ELSE CASE c_custkey % 5 WHEN 0 THEN 'utm' || n WHEN 1 THEN 'utm' || n || 's' WHEN 2 THEN n || 'N' ELSE n || 'S' END END AS zone
    FROM (SELECT c_custkey, lpad((c_custkey % 70)::VARCHAR, 2, '0') AS n FROM customer))""")
def fill_zones(spark, d):
    k = F.col("c_custkey")
    n = (k % 70).cast("string")
    raw = F.when(k % 5 == 0, F.concat(F.lit("utm"), n)).when(k % 5 == 1, F.concat(F.lit(" UTM"), n, F.lit("s "))).when(k % 5 == 2, F.concat(n, F.lit("N"))).when(k % 5 == 3, F.concat(F.lpad(n, 2, "0"), F.lit("s"))).otherwise(F.concat(F.lit("zone"), n))
    zone = F.col("zone")
    group, half = I.group_and_half(zone)
    return read(spark, d, "customer").select(k, I.fill_zone(raw).alias("zone")).select(k, zone, group.alias("grp"), half.alias("half"), F.array_join(I.fill_zones(zone), ",").alias("fills"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN (date_trunc('month', o_orderdate) - INTERVAL 11 MONTH)::DATE END AS first_month, CASE WHEN o_orderkey % 9 <> 0 THEN date_trunc('month', o_orderdate)::DATE END AS last_month FROM orders")
def month_window(spark, d):
    text = F.when(F.col("o_orderkey") % 9 == 0, "Juneish 2025").otherwise(F.date_format("o_orderdate", " MMMM yyyy"))
    first, last = I.year_to(text)
    return read(spark, d, "orders").select("o_orderkey", first.alias("first_month"), last.alias("last_month"))


@query("SELECT event_id, floor(epoch(ts))::BIGINT - CASE event_id % 3 WHEN 1 THEN 7200 WHEN 2 THEN -19800 ELSE 0 END AS instant FROM events")
def aware_instants(spark, d):
    zone = F.when(F.col("event_id") % 3 == 0, "Z").when(F.col("event_id") % 3 == 1, "+02:00").otherwise("-05:30")
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), zone)
    return events(spark, d).select("event_id", F.unix_seconds(I.aware_instant(text)).alias("instant"))


@query("""SELECT p_partkey, (4 * (8 * p_size::BIGINT * s * 4096 + 4 * p_size * s * s * 64 + 4 * p_size * s * 64 * 256 + 8 * p_size * 8 * 4096 + 4 * p_size * 64 * 64 + 4 * p_size * 8 * 64 * 256))::BIGINT AS flops,
    CASE WHEN r < 256 THEN 256 ELSE least(2048, r) END::BIGINT AS strip FROM (SELECT p_partkey, p_size, (least(256, ceil(p_size / 8.0) * 8))::BIGINT AS s, (greatest(3758096384 - p_size::BIGINT * 10 * 2048 * 2048, 0) // (p_size * 10 * 1500 * 20)) AS r FROM part)""")
def flops_and_strips(spark, d):
    n = F.col("p_size").cast("long")
    flops = I.transformer_flops(n, [P.ladder_bucket(n).cast("long"), F.lit(8).cast("long")], 64, 256, 4)
    return read(spark, d, "part").select("p_partkey", flops.alias("flops"), I.strip_height(n * 10, F.lit(1500).cast("long"), F.lit(2048).cast("long"), F.lit(2048).cast("long")).alias("strip"))


@query("SELECT event_id, ['our-credential', 'provider-refused', 'refusal-unattributed', 'client-error', 'unreadable', 'absent', 'undecidable', 'provider-refused', 'undecidable'][event_id % 9 + 1] AS verdict FROM events")
def read_failures(spark, d):
    said = ("ExpiredToken after SlowDown", "RasterioIOError: HTTP response code: 503", "SlowDown", "HTTP response code: 418 in ZIPDecode", "ZIPDecode failed", "CPLE_ HTTP response code: 404", "NoSuchKey", "CPLE_ response_code=429", "odd")
    text = F.get(F.array(*map(F.lit, said)), (F.col("event_id") % 9).cast("int"))
    return events(spark, d).select("event_id", T.read_failure(text).alias("verdict"))


@query("SELECT o_orderkey, (o_orderkey % 50) * 2048 AS y0, (o_orderkey % 50 + 1) * 2048 AS y1, (o_custkey % 50) * 2048 AS x0, (o_custkey % 50 + 1) * 2048 AS x1, year(o_orderdate)::BIGINT - 2017 AS step FROM orders")
def tile_slices(spark, d):
    label = T.tile_label(F.col("o_orderkey") % 50, F.col("o_custkey") % 50)
    row, col = T.parsed_tile(label)
    slices = I.tile_slices(row.cast("long"), col.cast("long"), F.year("o_orderdate").cast("long"))
    return read(spark, d, "orders").select("o_orderkey", *[c.alias(n) for n, c in slices.items()])


@query("""SELECT n_regionkey, substr(sha256('{' || string_agg('"' || n_name || '": ' || n_nationkey, ', ' ORDER BY n_name) || '}'), 1, 16) AS hash FROM nation GROUP BY 1""")
def manifest_hash(spark, d):
    entries = F.map_from_entries(F.collect_list(F.struct("n_name", "n_nationkey")))
    return read(spark, d, "nation").groupBy("n_regionkey").agg(I.manifest_hash(entries).alias("hash"))


@query("""SELECT c_custkey, CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END + zone AS epsg, nullif(ceil(c_custkey * 7.0 / 10), 0)::BIGINT AS width, CASE WHEN c_custkey % 3 > 0 THEN ceil((c_custkey % 3) * 11.0 / 10)::BIGINT END AS height
    FROM (SELECT c_custkey, c_custkey % 100 - 50 AS lat, (floor((c_custkey % 360) / 6) + 1)::INTEGER AS zone FROM customer)""")
def target_grid(spark, d):
    k = F.col("c_custkey")
    lon, lat = (k % 360 - 180).cast("double"), (k % 100 - 50).cast("double")
    grid = lambda n: I.grid_size(F.lit(500000.0), F.lit(500000.0) + n, 10.0)
    return read(spark, d, "customer").select(k, I.target_epsg(G.zone_number(lon, lat), lat).alias("epsg"), grid(k * 7.0).alias("width"), grid((k % 3) * 11.0).alias("height"))


_MIDDLES = "list_transform(range(0, 16 - n), lambda i: i * (n // (16 - n)) + least(i, n % (16 - n)) + (n // (16 - n) + CASE WHEN i < n % (16 - n) THEN 1 ELSE 0 END) // 2)"
_PICKED = f"""CASE WHEN 16 <= n THEN list_transform(range(0, 16), lambda i: CASE WHEN i = 15 THEN n - 1 ELSE floor(i * ((n - 1)::DOUBLE / 15))::BIGINT END)
    WHEN 16 - n <= n THEN list_concat(range(0, n), {_MIDDLES}) ELSE list_concat(range(0, n), list_transform(range(0, 16 - n), lambda i: i % n)) END"""


@query(f"""SELECT user_id, slot::INTEGER AS slot, CASE WHEN n = 0 THEN 0.0 ELSE round((v[p[slot + 1] + 1] - 50.0) / (20.5 + 1e-9), 6) END AS z, CASE WHEN n = 0 THEN 0 ELSE y[p[slot + 1] + 1] END::INTEGER AS doy
    FROM (SELECT *, unnest(range(0, 16)) AS slot FROM (SELECT *, CASE WHEN n > 0 THEN {_PICKED} END AS p FROM (SELECT user_id, count(*) FILTER (value > 80) AS n, list(value ORDER BY ts, event_id) FILTER (value > 80) AS v,
    list(dayofyear(ts) ORDER BY ts, event_id) FILTER (value > 80) AS y FROM events GROUP BY 1)))""")
def resampled_batch(spark, d):
    step = F.struct("ts", "event_id", F.col("value").alias("value"), F.dayofyear("ts").alias("doy"))
    steps = events(spark, d).groupBy("user_id").agg(F.array_sort(F.collect_list(F.when(F.col("value") > 80, step))).alias("s"))
    batch = steps.select("user_id", F.posexplode(I.resampled_batch(F.col("s"), 16, 50.0, 20.5)).alias("slot", "x"))
    return batch.select("user_id", "slot", F.round("x.z", 6).alias("z"), "x.doy")


@query("SELECT day, n, change FROM (SELECT day, n, n - lag(n) OVER (ORDER BY day) AS change FROM (SELECT ts::DATE AS day, count(DISTINCT user_id) // 8 AS n FROM events GROUP BY 1)) WHERE change <> 0")
def worker_changes(spark, d):
    """Days on which the count changes; one row a day is ranked, however large the log."""
    n = events(spark, d).groupBy(F.to_date("ts").alias("day")).agg(F.floor(F.count_distinct("user_id") / 8).alias("n"))
    return n.withColumn("change", F.col("n") - F.lag("n").over(Window.orderBy("day"))).filter("change <> 0")


@query("SELECT label, px, CASE WHEN s > 0 THEN round(px / s, 4) END AS rate FROM (SELECT user_id AS label, event_id % 1000 AS px, (event_id % 4)::DOUBLE AS s, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events WHERE event_id % 10 > 1) WHERE r = 1")
def chunk_summaries(spark, d):
    """The last summary of each chunk: JSON after a marker; lines without it or with broken JSON are skipped."""
    k = F.col("event_id")
    good = F.concat(F.lit('12:00 worker CHUNK_SUMMARY {"label": '), F.col("user_id").cast("string"), F.lit(', "px": '), (k % 1000).cast("string"), F.lit(', "s": '), (k % 4).cast("string"), F.lit("}"))
    line = F.when(k % 10 == 0, '12:00 CHUNK_SUMMARY {"label": oops').when(k % 10 == 1, "12:00 all quiet").otherwise(good)
    said = F.when(line.contains("CHUNK_SUMMARY "), F.from_json(F.substring_index(line, "CHUNK_SUMMARY ", -1), "label long, px long, s double"))
    parsed = events(spark, d).select("ts", k, said.alias("j")).filter("j.label IS NOT NULL")
    last = parsed.groupBy(F.col("j.label").alias("label")).agg(F.max_by("j", F.struct("ts", "event_id")).alias("j"))
    return last.select("label", "j.px", F.round(F.try_divide("j.px", "j.s"), 4).alias("rate"))


@query("SELECT optical, radar, n, row_number() OVER (ORDER BY optical * radar DESC, optical DESC) - 1 AS place FROM (SELECT least(256, ceil(greatest(o, 1) / 8.0) * 8)::INTEGER AS optical, least(256, ceil(greatest(r, 1) / 8.0) * 8)::INTEGER AS radar, count(*) AS n FROM (SELECT user_id, count(*) FILTER (value > 20) AS o, count(*) FILTER (value <= 20) AS r FROM events GROUP BY 1) GROUP BY 1, 2)")
def buckets_largest_first(spark, d):
    """Buckets by size; at most 32 * 32 rows are ranked."""
    per = events(spark, d).groupBy("user_id").agg(F.count_if(F.col("value") > 20).alias("o"), F.count_if(F.col("value") <= 20).alias("r"))
    n = per.groupBy(P.ladder_bucket(F.col("o")).alias("optical"), P.ladder_bucket(F.col("r")).alias("radar")).agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.orderBy((F.col("optical") * F.col("radar")).desc(), F.col("optical").desc())) - 1
    return n.withColumn("place", place.cast("long"))


@query("SELECT o_orderkey, first_value(o_orderpriority) OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderdate, o_orderkey) AS baseline FROM orders")
def baseline_of_year(spark, d):
    """The baseline of the first item of each tile and year, looked up for every item."""
    o = read(spark, d, "orders").withColumn("y", F.year("o_orderdate"))
    first = o.groupBy("o_custkey", "y").agg(F.min_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("baseline"))
    return o.join(first, ["o_custkey", "y"]).select("o_orderkey", "baseline")


@query("SELECT label, count(*) FILTER (vec_id % 10 <> 0 AND vec_id % 7 <> 0) AS both, count(*) FILTER (vec_id % 10 <> 0 AND vec_id % 7 = 0) AS only_a, count(*) FILTER (vec_id % 10 = 0 AND vec_id % 7 <> 0) AS only_b, count(*) FILTER (vec_id % 10 <> 0 AND vec_id % 7 <> 0 AND vec_id % 3 <> 0) AS equal FROM embeddings WHERE vec_id % 10 <> 0 OR vec_id % 7 <> 0 GROUP BY 1")
def staged_pairs(spark, d):
    """Two staged outputs, full outer on label and pixel: what both hold, what one lacks, what is bit-equal."""
    e = read(spark, d, "embeddings").select("label", "vec_id", "embedding")
    a = e.filter("vec_id % 10 <> 0").withColumnRenamed("embedding", "a")
    b = e.filter("vec_id % 7 <> 0").select("label", "vec_id", F.when(F.col("vec_id") % 3 == 0, F.transform("embedding", lambda x: x + 1)).otherwise(F.col("embedding")).alias("b"))
    x, y = F.col("a").isNotNull(), F.col("b").isNotNull()
    counted = {"both": x & y, "only_a": x & ~y, "only_b": ~x & y, "equal": F.col("a") == F.col("b")}
    return a.join(b, ["label", "vec_id"], "full").groupBy("label").agg(*[F.count_if(c).alias(n) for n, c in counted.items()])
