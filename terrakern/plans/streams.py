"""Streaming and algorithmic operators bound to the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrakern.functions import geo as G
from terrakern.functions import pixel as P
from terrakern.functions import utm
from terrakern.operators import batching
from terrakern.sources.shared import shared_folder
from terrakern.sources.tables import events, read
from terrakern.streaming import streams

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _folder(spark: SparkSession) -> str:
    return shared_folder(spark, "stream")


def _stream(spark: SparkSession, d: str) -> DataFrame:
    """The events as a stream of files; the glob keeps the reader to the one table."""
    schema = read(spark, d, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d).withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT DISTINCT event_id, ts, user_id FROM events")
def stream_dedup_tail(spark, d):
    rows = _stream(spark, d).select("event_id", "ts", "user_id")
    return streams.drained(streams.deduplicated_tail(rows.union(rows), "event_id", "ts"), _folder(spark), "tail")


@query("SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS bin, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_bins(spark, d):
    return streams.latest_bins(_stream(spark, d), "ts", "5 minutes", "10 minutes", ["event_type"], _folder(spark))


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, min(value) OVER w AS low, count(*) OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS 2 PRECEDING)) WHERE n = 3 AND low >= 60")
def stream_alerts(spark, d):
    rows = _stream(spark, d).select("user_id", "event_id", "value")
    return streams.drained(streams.sustained_alerts(rows, "user_id", "value", "event_id", 60.0, 3), _folder(spark), "alerts")


@query("SELECT event_id, ts::DATE AS day FROM events WHERE ts IS NOT NULL")
def stream_append_guard(spark, d):
    folder = _folder(spark)
    rows = _stream(spark, d).withColumn("day", F.to_date("ts"))
    streams.guarded_append(rows, "day", f"{folder}/stored", f"{folder}/rejected", f"{folder}/state", ["event_id"]).awaitTermination()
    return spark.read.parquet(f"{folder}/stored").select("event_id", "day")


@query()
def merge_bands_dp(spark, d):
    bands = events(spark, d).groupBy((F.col("user_id") % 5).alias("zone"), F.floor(F.col("user_id") / 10).alias("band")).agg(F.min(F.col("event_id") % 40).alias("west"), F.max(F.col("event_id") % 40).alias("east"))
    placed = bands.withColumns({"top": F.col("band") * 2, "bottom": F.col("band") * 2 + F.col("band") % 2})
    return batching.band_plan(placed, ["zone"], "band").select("zone", "band", "window")


@query()
def group_by_budget(spark, d):
    n = events(spark, d).groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count_if(F.col("value") > 60).cast("double").alias("weight"))
    return batching.batched(n, ["user_id"], ["day"], "weight", 6.0, 4)


@query()
def lpt_partition(spark, d):
    work = read(spark, d, "customer").groupBy("c_nationkey").agg(F.sum("c_acctbal").alias("weight"))
    return batching.per_group(work.withColumn("all", F.lit(1)), ["all"], ["c_nationkey"], "weight", "cluster", lambda w: batching.lightest_first(w, 6)).drop("all")


@query("SELECT vec_id, round(scale, 12) AS scale, list_sum(list_transform(v, lambda x: round_even(x / scale, 0)))::BIGINT AS total FROM (SELECT vec_id, v, greatest(list_max(list_transform(v, lambda x: abs(x))) / 127, 1e-8) AS scale FROM (SELECT vec_id, list_transform(embedding, lambda x, i: x::DOUBLE * (1 + (i - 1) % 3)) AS v FROM embeddings))")
def encode_stub(spark, d):
    """A stand-in model: a fixed linear map of each vector, quantised."""
    flipped = F.transform("embedding", lambda x, i: x.cast("double") * (1 + i % 3))
    q, scale = P.quantised(flipped)
    return read(spark, d, "embeddings").select("vec_id", F.round(scale, 12).alias("scale"), F.aggregate(q, F.lit(0).cast("long"), lambda s, x: s + x).alias("total"))


@query()
def utm_tile_bbox(spark, d):
    lon, lat = F.col("c_custkey") % 360 - 180 + 0.5, F.col("c_custkey") % 160 - 80
    zone = G.zone_number(lon, lat)
    points = read(spark, d, "customer").select("c_custkey", utm.projected(lon, lat, zone).alias("p"), zone.alias("zone"))
    return points.select("c_custkey", "zone", F.floor(F.col("p.easting") / 20480).alias("tile_col"), F.floor(F.col("p.northing") / 20480).alias("tile_row"))
