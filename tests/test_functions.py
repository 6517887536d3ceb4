import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrakern.functions import calendar, geo, pixel, text


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def naive(n, t):
    if n <= 0:
        return []
    if t == n:
        return list(range(n))
    if t < n:
        return [int(g[len(g) // 2]) for g in np.array_split(np.arange(n), t)]
    extra = t - n
    step = (n - 1) / (extra + 1)
    return list(range(n)) + [min(int(np.rint(j * step)), n - 1) for j in range(1, extra + 1)]


def naive_even(n, t):
    if n <= 0:
        return []
    if t <= n:
        return np.linspace(0, n - 1, t).astype(int).tolist()
    rest = t - n
    more = [int(g[len(g) // 2]) for g in np.array_split(np.arange(n), rest)] if rest <= n else [i % n for i in range(rest)]
    return list(range(n)) + more


def test_resampling_for_every_count(spark):
    pairs = spark.range(0, 257).selectExpr("cast(id as int) n").crossJoin(spark.createDataFrame([(k,) for k in (8, 16, 64, 136, 256)], "t int"))
    for r in pairs.select("n", "t", pixel.resampled_indices(F.col("n"), F.col("t")).alias("a"), pixel.resampled_indices_even(F.col("n"), F.col("t")).alias("b")).collect():
        assert r.a == naive(r.n, r.t) and r.b == naive_even(r.n, r.t), (r.n, r.t)


def test_pixel_arithmetic(spark):
    r = one(
        spark,
        none=pixel.scaled_db(F.lit(0.0)), top=pixel.scaled_db(F.lit(1e9)), one=pixel.scaled_db(F.lit(1.0)), low=pixel.offset_corrected(F.lit(900)), nodata=pixel.offset_corrected(F.lit(0)),
        zero=pixel.ladder_bucket(F.lit(0)), nine=pixel.ladder_bucket(F.lit(9)), many=pixel.ladder_bucket(F.lit(999)),
    )
    assert tuple(r) == (0, 32767, 10000, 1, 0, 8, 16, 256)
    q, scale = pixel.quantised(F.col("v"))
    rows = spark.createDataFrame([([1.0, -0.5, 0.0],), ([0.0, 0.0, 0.0],)], "v array<double>").select(q.alias("q"), scale.alias("s")).collect()
    assert rows[0].q == [127, -64, 0] and rows[1].q == [0, 0, 0] and rows[1].s == 1e-8
    value, position = pixel.unpacked(pixel.packed(F.lit(77), F.lit(3)))
    assert tuple(one(spark, v=value, p=position)) == (77, 3)


@pytest.mark.parametrize(("lon", "hours"), [(0, 0), (14.9, 0), (15, 1), (-14.9, 0), (-15, -1), (180, 12), (-180, -12)])
def test_solar_offset(spark, lon, hours):
    assert one(spark, h=calendar.solar_offset_hours(F.lit(float(lon)))).h == hours


def test_calendar(spark):
    day = F.lit(datetime.date(2024, 1, 1))
    ranges = one(spark, r=calendar.fixed_ranges(day, F.date_add(day, 64), 30)).r
    assert [(x.first, x.last) for x in ranges][-1] == (datetime.date(2024, 3, 1), datetime.date(2024, 3, 5))
    assert one(spark, m=calendar.middle_longitude(F.lit(170.0), F.lit(-160.0))).m == -175.0
    stamps = one(spark, a=calendar.aware_instant(F.lit("2024-01-01T00:00:00Z")), b=calendar.aware_instant(F.lit("2024-01-01T00:00:00")), c=calendar.aware_instant(F.lit("xxZ")))
    assert stamps.a is not None and stamps.b is None and stamps.c is None


def test_text(spark):
    r = one(
        spark,
        a=text.baseline_number(F.lit("05.1")), b=F.array(*[text.baseline_number(F.lit(x)) for x in (" 5.1 ", "4", "05.10", "N05", "5.123")]), c=text.canonical_zone(F.lit(" 7n ")), d=text.canonical_zone(F.lit("61N")),
        e=text.bucket(F.lit("https://b.s3.us-west-2.amazonaws.com/k")), f=text.error_class(F.lit("Slow Down")), g=text.parsed_tile(F.lit("chunk_01_02"))[1],
    )
    assert tuple(r) == (510, [510, 400, 510, None, None], "07N", None, "b", "transient", 2)


def test_geo(spark):
    r = one(
        spark,
        a=geo.zone_number(F.lit(5.0), F.lit(60.0)), b=geo.zone_number(F.lit(10.0), F.lit(75.0)), c=geo.zone_number(F.lit(180.0), F.lit(0.0)),
        d=geo.latitude_weight(F.lit(-20.0)), e=geo.latitude_weight(F.lit(-20.1)), f=geo.inside_wrapped(F.lit(179.0), F.lit(170.0), F.lit(-170.0)),
        g=geo.overlaps_wrapped(F.lit(175.0), F.lit(0.0), F.lit(-175.0), F.lit(1.0), (-179.0, 0.0, -178.0, 1.0)),
    )
    assert tuple(r) == (32, 33, 60, 104.0, 128.0, True, True)


def test_utm():
    from terrakern.functions import utm

    east, north = utm.forward(9.0, 0.0, 32)
    assert (round(float(east), 3), round(float(north), 3)) == (500000.0, 0.0)
    lon, lat = np.meshgrid(np.linspace(6, 12, 7), np.linspace(-79, 83, 19))
    east, north = utm.forward(lon, lat, 32)
    back = utm.inverse(east, north, 32, lat < 0)
    assert np.abs(back[0] - lon).max() < 1e-8 and np.abs(back[1] - lat).max() < 1e-8
    # one degree of the central meridian from the equator, scaled by 0.9996
    assert abs(float(utm.forward(9.0, 1.0, 32)[1]) - 110574.3886 * 0.9996) < 0.5
    box = utm.tile_box(60, 833000.0, 0.0, 20480.0)
    assert box[0] > box[2]
