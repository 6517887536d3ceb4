"""Scalar functions bound to the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrakern.functions import calendar as C
from terrakern.functions import geo as G
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


@query("""SELECT event_id, CASE WHEN value > 0 THEN CAST(greatest(0, least(32767, floor((20*log10(value)+50)*200))) AS INTEGER) ELSE 0 END AS db FROM events""")
def db_scale(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).select("event_id", P.scaled_db(F.col("value")).alias("db"))


@query("""SELECT p_partkey, p_size*100 AS dn, CASE WHEN p_size*100 > 0 THEN greatest(p_size*100-1000, 1) ELSE p_size*100 END AS corrected FROM part""")
def boa_correct(spark, d):
    dn = F.col("p_size") * 100
    return read(spark, d, "part").select("p_partkey", dn.alias("dn"), P.offset_corrected(dn).alias("corrected"))


@query("""SELECT p_partkey, CASE WHEN p_type LIKE 'STANDARD%' THEN 'EXEMPT' WHEN p_size*12 < 400 THEN 'EXEMPT' WHEN p_type LIKE 'SMALL%' THEN 'UNDECIDABLE' ELSE 'OWED' END AS decision FROM part""")
def boa_decision(spark, d):
    producer = F.when(F.col("p_type").like("STANDARD%"), "harmonised").when(F.col("p_type").like("SMALL%"), F.lit(None)).otherwise("raw")
    return read(spark, d, "part").select("p_partkey", P.offset_decision(producer, F.col("p_size") * 12).alias("decision"))


@query("""SELECT p_partkey, round((p_retailprice - 1400.0)/(120.5 + 1e-9), 6) AS z FROM part""")
def zscore_bands(spark, d):
    return read(spark, d, "part").select("p_partkey", F.round(P.z_score(F.col("p_retailprice"), 1400.0, 120.5), 6).alias("z"))


@query("""SELECT user_id, n, CAST(least(256, ceil(greatest(n,1)/8.0)*8) AS INTEGER) AS bucket FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)""")
def ladder_bucket(spark, d):
    n = events(spark, d).groupBy("user_id").agg(F.count("*").alias("n"))
    return n.select("user_id", "n", P.ladder_bucket(F.col("n")).alias("bucket"))


@query("""SELECT p_partkey, CAST(ceil(p_retailprice/2048.0) AS INTEGER) AS tiles, CAST(least(256, ceil(greatest(p_size,1)/8.0)*8) AS INTEGER) + CAST(least(256, ceil(greatest(p_size % 7,1)/8.0)*8) AS INTEGER) AS tokens FROM part""")
def flops_tokens(spark, d):
    return read(spark, d, "part").select("p_partkey", G.tiles_across(F.col("p_retailprice")).alias("tiles"), P.tokens(F.col("p_size"), F.col("p_size") % 7).alias("tokens"))


@query("""SELECT n_nationkey, CAST(trunc((n_nationkey*15-180)/15.0) AS INTEGER) AS offset_h, CAST(trunc((n_nationkey*14.7-180)/15.0) AS INTEGER) AS offset_frac FROM nation""")
def solar_offset(spark, d):
    k = F.col("n_nationkey")
    return read(spark, d, "nation").select("n_nationkey", C.solar_offset_hours(k * 15 - 180).alias("offset_h"), C.solar_offset_hours(k * 14.7 - 180).alias("offset_frac"))


@query("""SELECT event_id, CAST(ts + to_hours(CAST(trunc(((user_id % 25)*15-180)/15.0) AS INTEGER)) AS DATE) AS solar_day FROM events""")
def solar_day(spark, d):
    return events(spark, d).select("event_id", C.solar_day(F.col("ts"), (F.col("user_id") % 25) * 15 - 180).alias("solar_day"))


@query("""SELECT DISTINCT CAST(ts AS DATE) AS day, epoch(CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 12 HOUR)::BIGINT AS noon_s FROM events""")
def noon_stamp(spark, d):
    days = events(spark, d).select(F.to_date("ts").alias("day")).distinct()
    return days.select("day", F.unix_seconds(C.noon(F.col("day"))).alias("noon_s"))


@query("""SELECT n_nationkey, CASE WHEN m > 180 THEN m - 360 ELSE m END AS middle FROM (SELECT n_nationkey, CASE WHEN w > e THEN w + (e + 360 - w)/2.0 ELSE (w + e)/2.0 END AS m FROM (SELECT n_nationkey, CAST(n_nationkey*15-180 AS DOUBLE) AS w, CAST(CASE WHEN n_nationkey*15-180+20 > 180 THEN n_nationkey*15-180+20-360 ELSE n_nationkey*15-180+20 END AS DOUBLE) AS e FROM nation))""")
def bbox_mid_longitude(spark, d):
    w = (F.col("n_nationkey") * 15 - 180).cast("double")
    e = F.when(w + 20 > 180, w + 20 - 360).otherwise(w + 20)
    return read(spark, d, "nation").select("n_nationkey", C.middle_longitude(w, e).alias("middle"))


@query("""SELECT o_orderkey, o_orderdate::DATE >= DATE '1996-03-01' AND o_orderdate::DATE < DATE '1997-03-01' AS inside, dayofyear(o_orderdate)::INTEGER AS doy, month(o_orderdate)::INTEGER AS month FROM orders""")
def time_window_members(spark, d):
    day = F.to_date("o_orderdate")
    return read(spark, d, "orders").select("o_orderkey", C.in_window(day, F.lit("1996-03-15").cast("date")).alias("inside"), F.dayofyear(day).alias("doy"), F.month(day).alias("month"))


@query("""SELECT CAST(m AS DATE) AS first, CAST(least(m + INTERVAL 1 MONTH - INTERVAL 1 DAY, DATE '1996-04-20') AS DATE) AS last FROM (SELECT unnest(generate_series(DATE '1995-12-01', DATE '1996-04-01', INTERVAL 1 MONTH)) AS m)""")
def month_ranges(spark, d):
    months = spark.range(1).select(F.explode(F.sequence(F.lit("1995-12-01").cast("date"), F.lit("1996-04-20").cast("date"), F.expr("interval 1 month"))).alias("first"))
    return months.select("first", F.least(F.last_day("first"), F.lit("1996-04-20").cast("date")).alias("last"))


@query("""SELECT c_custkey, CAST(s + k*30 AS DATE) AS first, CAST(least(s + k*30 + 29, e) AS DATE) AS last FROM (SELECT o_custkey AS c_custkey, min(o_orderdate::DATE) AS s, max(o_orderdate::DATE) AS e FROM orders GROUP BY 1) t, LATERAL (SELECT unnest(range(0, CAST((e - s)//30 + 1 AS BIGINT)))::INTEGER AS k)""")
def fixed_day_ranges(spark, d):
    span = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.to_date(F.min("o_orderdate")).alias("s"), F.to_date(F.max("o_orderdate")).alias("e"))
    return span.select("c_custkey", F.explode(C.fixed_ranges(F.col("s"), F.col("e"), 30)).alias("r")).select("c_custkey", "r.first", "r.last")


@query("""SELECT o_custkey, CAST(greatest(DATE '1998-01-01', max(o_orderdate::DATE) + 1) AS DATE) AS resume FROM orders GROUP BY 1""")
def resume_start(spark, d):
    newest = read(spark, d, "orders").groupBy("o_custkey").agg(F.to_date(F.max("o_orderdate")).alias("n"))
    return newest.select("o_custkey", C.resume_start(F.lit("1998-01-01").cast("date"), F.col("n")).alias("resume"))


@query("""SELECT p_partkey, 'chunk_' || p_size || '_' || p_partkey AS label, p_size AS tile_row, CAST(p_partkey AS INTEGER) AS tile_col, p_size*2048 AS y0 FROM part""")
def tile_label_parse(spark, d):
    label = T.tile_label(F.col("p_size"), F.col("p_partkey"))
    row, col = T.parsed_tile(label)
    return read(spark, d, "part").select("p_partkey", label.alias("label"), row.alias("tile_row"), col.alias("tile_col"), (row * 2048).alias("y0"))


@query("""SELECT n_nationkey, CASE WHEN n_nationkey BETWEEN 1 AND 60 THEN lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || CASE WHEN n_regionkey < 2 THEN 'S' ELSE 'N' END END AS zone FROM nation""")
def zone_canonical(spark, d):
    raw = F.concat(F.lit(" "), F.col("n_nationkey").cast("string"), F.when(F.col("n_regionkey") < 2, "s").otherwise("n"))
    return read(spark, d, "nation").select("n_nationkey", T.canonical_zone(raw).alias("zone"))


@query("""SELECT p_partkey, CASE WHEN p_size < 10 THEN NULL ELSE (p_size % 6)*100 + (p_size % 10)*10 END AS baseline FROM part""")
def baseline_parse(spark, d):
    s = F.col("p_size")
    raw = F.when(s < 10, F.concat(F.lit("N0"), (s % 6).cast("string"))).otherwise(F.concat(F.lit("0"), (s % 6).cast("string"), F.lit("."), (s % 10).cast("string")))
    return read(spark, d, "part").select("p_partkey", T.baseline_number(raw).alias("baseline"))


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'T' || lpad(CAST(s_nationkey AS VARCHAR),3,'0') || '-' || lpad(CAST(s_suppkey AS VARCHAR),6,'0') || '-IW1' END AS burst FROM supplier""")
def burst_parse(spark, d):
    name = F.concat(F.lit("T"), F.lpad(F.col("s_nationkey").cast("string"), 3, "0"), F.lit("-"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0"), F.lit("-IW1"))
    title = F.concat(F.lit("OPERA_L2_RTC-S1_"), F.when(F.col("s_suppkey") % 4 == 0, F.lit("NONE")).otherwise(name), F.lit("_20240101T000000Z_"))
    return read(spark, d, "supplier").select("s_suppkey", T.burst(title).alias("burst"))


@query("""SELECT page_id, nullif(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)', 1)), '') AS host FROM pages""")
def host_of_url(spark, d):
    return read(spark, d, "pages").select("page_id", T.host(F.col("url")).alias("host"))


@query("""SELECT s_suppkey, 'bucket' || s_nationkey AS bucket FROM supplier""")
def bucket_of_url(spark, d):
    k, b = F.col("s_suppkey"), F.concat(F.lit("bucket"), F.col("s_nationkey").cast("string"))
    href = F.when(k % 3 == 0, F.concat(F.lit("s3://"), b, F.lit("/k"))).when(k % 3 == 1, F.concat(F.lit("https://"), b, F.lit(".s3.us-west-2.amazonaws.com/k"))).otherwise(F.concat(F.lit("https://s3.us-west-2.amazonaws.com/"), b, F.lit("/k")))
    return read(spark, d, "supplier").select("s_suppkey", T.bucket(href).alias("bucket"))


@query("""SELECT event_id, CASE event_type WHEN 'error' THEN 'transient' WHEN 'view' THEN 'absent' WHEN 'signup' THEN 'refused' ELSE 'other' END AS class FROM events""")
def error_class(spark, d):
    message = F.when(F.col("event_type") == "error", "Read timed out").when(F.col("event_type") == "view", "No such key").when(F.col("event_type") == "signup", "HTTP 403").otherwise("odd value")
    return events(spark, d).select("event_id", T.error_class(message).alias("class"))


@query("""SELECT o_custkey, sha256(array_to_string(list_sort(list_distinct(list(CAST(o_orderkey AS VARCHAR)))), ',')) AS digest FROM orders GROUP BY 1""")
def shard_set_sha(spark, d):
    return read(spark, d, "orders").groupBy("o_custkey").agg(T.set_digest(F.collect_list(F.col("o_orderkey").cast("string"))).alias("digest"))


@query("""SELECT event_id, 7 + event_id % 31 AS workers, CAST(round(value, 1) AS DOUBLE) AS cpu, CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id % 100 AS DOUBLE) END AS mem, event_id % 13 - 3 AS backlog FROM events""")
def health_line_parse(spark, d):
    e = events(spark, d)
    mem = F.when(F.col("event_id") % 5 == 0, "nan").otherwise((F.col("event_id") % 100).cast("string"))
    line = F.concat(F.lit("workers="), (7 + F.col("event_id") % 31).cast("string"), F.lit(" cpu="), F.round("value", 1).cast("decimal(18,1)").cast("string"), F.lit("% mem="), mem, F.lit("% backlog="), (F.col("event_id") % 13 - 3).cast("string"))
    part = lambda k: F.regexp_extract(line, T.HEALTH, k)
    return e.select("event_id", part(1).cast("long").alias("workers"), part(2).try_cast("double").alias("cpu"), F.nullif(part(3), F.lit("nan")).try_cast("double").alias("mem"), part(4).cast("long").alias("backlog"))


def _pairs(spark):
    n = spark.range(0, 41).select(F.col("id").cast("int").alias("n"))
    t = spark.createDataFrame([(8,), (16,), (24,), (32,)], "t int")
    return n.join(F.broadcast(t))


_SPLIT = """list_transform(range(0, {g}), lambda i: CAST(i*({n}//{g}) + least(i, {n}%{g}) + (({n}//{g}) + CASE WHEN i < {n}%{g} THEN 1 ELSE 0 END)//2 AS INTEGER))"""


@query(
    f"""SELECT n, t, CASE WHEN n = 0 THEN '' WHEN t < n THEN array_to_string({_SPLIT.format(g="t", n="n")}, ',')
    WHEN t = n THEN array_to_string(range(0, n), ',')
    ELSE array_to_string(list_concat(range(0, n), list_transform(range(1, t-n+1), lambda j: CAST(least(round_even(j*((n-1)::DOUBLE/(t-n+1)), 0), n-1) AS BIGINT))), ',') END AS picked
    FROM (SELECT unnest(range(0,41))::INTEGER AS n), (SELECT unnest([8,16,24,32])::INTEGER AS t)"""
)
def resample_v11(spark, d):
    return _pairs(spark).select("n", "t", F.array_join(P.resampled_indices(F.col("n"), F.col("t")).cast("array<string>"), ",").alias("picked"))


@query(
    f"""SELECT n, t, CASE WHEN n = 0 THEN '' WHEN t <= n THEN array_to_string(list_transform(range(0, t), lambda i: CASE WHEN i = t-1 THEN n-1 ELSE CAST(floor(i*((n-1)::DOUBLE/(t-1))) AS INTEGER) END), ',')
    WHEN t-n <= n THEN array_to_string(list_concat(range(0, n)::INTEGER[], {_SPLIT.format(g="(t-n)", n="n")}), ',')
    ELSE array_to_string(list_concat(range(0, n), list_transform(range(0, t-n), lambda i: i % n)), ',') END AS picked
    FROM (SELECT unnest(range(0,41))::INTEGER AS n), (SELECT unnest([8,16,24,32])::INTEGER AS t)"""
)
def resample_v2(spark, d):
    return _pairs(spark).select("n", "t", F.array_join(P.resampled_indices_even(F.col("n"), F.col("t")).cast("array<string>"), ",").alias("picked"))


@query("""SELECT event_id, CAST(floor(value) AS BIGINT) AS v, CAST(event_id % 9 AS BIGINT) AS pos, CAST(floor(value) AS BIGINT) | ((event_id % 9 + 1) << 16) AS pack FROM events WHERE value < 60000""")
def pack_position(spark, d):
    e = events(spark, d).filter("value < 60000")
    pack = P.packed(F.floor("value"), F.col("event_id") % 9)
    value, position = P.unpacked(pack)
    return e.select("event_id", value.alias("v"), position.alias("pos"), pack.alias("pack"))


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def event_json(spark, d):
    return events(spark, d).select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("""SELECT n_nationkey, unnest(CASE WHEN w > e THEN [w, -180.0] ELSE [w] END) AS west, unnest(CASE WHEN w > e THEN [180.0, e] ELSE [e] END) AS east FROM (SELECT n_nationkey, CAST(n_nationkey*15-180 AS DOUBLE) AS w, CAST(CASE WHEN n_nationkey*15-160 > 180 THEN n_nationkey*15-520 ELSE n_nationkey*15-160 END AS DOUBLE) AS e FROM nation)""")
def antimeridian_split(spark, d):
    w = (F.col("n_nationkey") * 15 - 180).cast("double")
    e = F.when(w + 20 > 180, w - 340).otherwise(w + 20)
    return read(spark, d, "nation").select("n_nationkey", F.explode(G.split_box(w, e)).alias("b")).select("n_nationkey", "b.west", "b.east")


_BOX = """(SELECT c_custkey, CAST(c_custkey % 360 - 180 AS DOUBLE) AS w, CAST(CASE WHEN c_custkey % 360 - 155 > 180 THEN c_custkey % 360 - 515 ELSE c_custkey % 360 - 155 END AS DOUBLE) AS e, CAST(c_custkey % 160 - 80 AS DOUBLE) AS s, CAST(c_custkey % 160 - 75 AS DOUBLE) AS n FROM customer)"""


def _boxes(spark, d):
    k = F.col("c_custkey")
    w = (k % 360 - 180).cast("double")
    return read(spark, d, "customer").select(k, w.alias("w"), F.when(w + 25 > 180, w - 335).otherwise(w + 25).alias("e"), (k % 160 - 80).cast("double").alias("s"), (k % 160 - 75).cast("double").alias("n"))


@query(f"""SELECT c_custkey FROM (SELECT *, CASE WHEN e < w THEN e + 360 ELSE e END AS te FROM {_BOX}) WHERE ((w <= 179.5 AND te >= 150) OR (w - 360 <= 179.5 AND te - 360 >= 150)) AND s <= 40 AND n >= -20""")
def aoi_overlap_unwrap(spark, d):
    return _boxes(spark, d).filter(G.overlaps_wrapped(F.col("w"), F.col("s"), F.col("e"), F.col("n"), (150.0, -20.0, 179.5, 40.0))).select("c_custkey")


@query(f"""SELECT c_custkey FROM {_BOX} WHERE w <= 20 AND e >= -10 AND s <= 60 AND n >= 35""")
def aoi_overlap_plain(spark, d):
    return _boxes(spark, d).filter(G.overlaps(F.col("w"), F.col("s"), F.col("e"), F.col("n"), (-10.0, 35.0, 20.0, 60.0))).select("c_custkey")


@query(f"""SELECT c_custkey FROM {_BOX} WHERE CASE WHEN w <= e THEN 175.0 BETWEEN w AND e ELSE 175.0 >= w OR 175.0 <= e END""")
def point_in_box_wrapped(spark, d):
    return _boxes(spark, d).filter(G.inside_wrapped(F.lit(175.0), F.col("w"), F.col("e"))).select("c_custkey")


@query(
    f"""SELECT c_custkey, CASE WHEN s >= 56 AND s < 64 AND w >= 3 AND w < 12 THEN 32 WHEN s >= 72 AND s <= 84 AND w >= 0 AND w < 42 THEN CASE WHEN w < 9 THEN 31 WHEN w < 21 THEN 33 WHEN w < 33 THEN 35 ELSE 37 END
    ELSE CAST(least(60, floor((w+180)/6)+1) AS INTEGER) END AS zone FROM {_BOX}"""
)
def utm_zone_exceptions(spark, d):
    return _boxes(spark, d).select("c_custkey", G.zone_number(F.col("w"), F.col("s")).alias("zone"))


@query(f"""SELECT c_custkey, CASE WHEN s >= 60 THEN 208.0 WHEN s >= 40 THEN 176.0 WHEN s >= 20 THEN 168.0 WHEN s >= 0 THEN 120.0 WHEN s >= -20 THEN 104.0 WHEN s >= -40 THEN 128.0 ELSE 104.0 END::DOUBLE AS weight FROM {_BOX}""")
def lat_band_weight(spark, d):
    return _boxes(spark, d).select("c_custkey", G.latitude_weight(F.col("s")).alias("weight"))


@query("""SELECT p_partkey, (500000.0 + (p_size + 0.5)*10)::DOUBLE AS x FROM part""")
def pixel_center_coords(spark, d):
    return read(spark, d, "part").select("p_partkey", G.pixel_centre(F.lit(500000.0), F.col("p_size")).alias("x"))
