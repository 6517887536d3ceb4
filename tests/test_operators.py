import collections
import datetime
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrakern.functions import items
from terrakern.operators import batching, catalogue, joins, pixels, records, registry, telemetry
from terrakern.sources import catalogue as catalogue_source
from terrakern.sources.store import CommitConflictError, DuplicateDateError, NonMonotonicDateError, PixelStore
from terrakern.streaming import streams


def test_ladder_and_step_down(spark):
    rows = spark.createDataFrame([("t", 1, 5), ("t", 2, 9), ("t", 3, 7), ("u", 4, 1)], "image string, id int, q int")
    order = [F.col("q").desc(), F.col("id")]
    assert {(r.image, r.used, tuple(r.spares)) for r in catalogue.ladders(rows, ["image"], order, "id").collect()} == {("t", 2, (3, 1)), ("u", 4, ())}
    assert {tuple(r) for r in catalogue.step_down(rows, ["image"], order, "id", F.col("id").isin(2, 4)).collect()} == {("t", 3)}


def test_first_valid(spark):
    rows = spark.createDataFrame([(1, 0, 0), (1, 1, 7), (1, 2, 9), (2, 0, 0)], "px int, position int, v int")
    got = {tuple(r) for r in catalogue.first_valid(rows, ["px"], "v", "position", F.col("v") != 0).collect()}
    assert got == {(1, 7, 1), (2, None, None)}


def test_refusal_and_coverage(spark):
    rows = spark.createDataFrame([("t", 0, 1), ("t", 3, 1), ("t", 20, 0), ("t", 20, 5)], "tile string, o int, r int")
    reason = rows.select(pixels.refusal(F.col("o"), F.col("r"), 9).alias("x")).collect()
    assert sorted(str(r.x) for r in reason) == ["None", "no_optical", "no_radar", "thin"]
    c = pixels.coverage_record(rows, ["tile"], "o", "r", 9).first()
    assert (c.chunk_px, c.px_with_any_optical, c.refused_thin_px, c.median_obs_where_any, c.median_obs_where_thin) == (4, 3, 1, 20.0, 3.0)


def test_source_runs_and_audit(spark):
    log = spark.createDataFrame([("t", 1, "a", "fill"), ("t", 2, "b", "holes"), ("t", 3, "b", "holes"), ("u", 1, "a", "holes"), ("u", 2, "c", "fill")], "tile string, at int, run string, mode string")
    assert {r.tile: r.source_runs for r in registry.source_runs(log, ["tile"], ["at"], "run", "mode").collect()} == {"t": ["a", "b"], "u": ["c"]}
    want = spark.createDataFrame([(1, None), (2, 5), (3, 1)], "k int, v int")
    held = spark.createDataFrame([(1, None), (2, 6), (4, 1)], "k int, v int")
    assert {tuple(r) for r in registry.audit(want, held, ["k"], ["v"]).collect()} == {(2, "differs"), (3, "missing"), (4, "extra")}


def test_thinning_follows_the_last_kept(spark):
    rows = spark.createDataFrame([("k", i, float(v), "p") for i, v in enumerate([0, 2, 4, 5, 6, 7, 9])], "k string, at int, v double, phase string")
    assert sorted(r.at for r in telemetry.thinned(rows, ["k"], "at", "v", "phase", 3.0).collect()) == [0, 2, 5]


def test_as_of_and_cells(spark):
    left = spark.createDataFrame([(1, 5), (1, 10), (2, 1)], "k int, ts int")
    right = spark.createDataFrame([(1, 5, "a"), (1, 7, "b")], "k int, ts int, v string")
    assert {tuple(r) for r in joins.as_of(left, right, ["k"], "ts", "v").collect()} == {(1, 5, "a"), (1, 10, "b"), (2, 1, None)}
    boxes = spark.createDataFrame([(1, 0.0, 25.0)], "b int, lo double, hi double")
    points = spark.createDataFrame([(7, 24.0), (8, 26.0), (9, 0.0)], "p int, x double")
    x = F.col("x")
    got = joins.by_cells(boxes, points, F.col("lo"), F.col("hi"), x, 10.0, (x >= F.col("lo")) & (x <= F.col("hi")))
    assert {(r.b, r.p) for r in got.collect()} == {(1, 7), (1, 9)}


def test_band_windows_are_of_least_cost():
    rnd = np.random.default_rng(1)
    for _ in range(60):
        n = int(rnd.integers(1, 8))
        west, top = rnd.integers(0, 30, n), np.cumsum(rnd.integers(1, 6, n))
        boxes = np.stack((west, west + rnd.integers(0, 20, n), top, top + rnd.integers(0, 2, n)), axis=1)
        cost, cap = float(rnd.choice([5, 20, 200])), float(rnd.choice([30, 120, 10**6]))

        def total(groups):
            out = 0.0
            for first, last in groups:
                part = boxes[first : last + 1]
                area = (part[:, 1].max() - part[:, 0].min() + 1) * (part[:, 3].max() - part[:, 2].min() + 1)
                if last > first and area > cap:
                    return np.inf
                out += cost + area
            return out

        found = batching.band_windows(boxes, cost, cap)
        runs = [(int(np.flatnonzero(found == w)[0]), int(np.flatnonzero(found == w)[-1])) for w in range(found[-1] + 1)]
        assert total(runs) == min(total(g) for g in _groupings(n)) and list(found) == sorted(found)
    assert len(batching.band_windows([])) == 0


def test_budget_batches(spark):
    def plain(weights, budget, slots):
        batches, used, taken = [[]], 0.0, 0
        for w in weights:
            if w and batches[-1] and (taken + 1 > slots or used + w > budget):
                batches.append([])
                used, taken = 0.0, 0
            batches[-1].append(w)
            used, taken = used + w, taken + bool(w)
        return [k for k, b in enumerate(batches) for _ in b]

    rnd = np.random.default_rng(2)
    groups = {g: rnd.choice([0, 1, 2, 3, 9], int(rnd.integers(1, 12))).astype(float).tolist() for g in range(40)}
    rows = spark.createDataFrame([(g, i, w) for g, ws in groups.items() for i, w in enumerate(ws)], "g int, i int, w double")
    got = {g: [] for g in groups}
    for r in batching.batched(rows, ["g"], ["i"], "w", 6.0, 3).orderBy("g", "i").collect():
        got[r.g].append(r.batch)
    assert got == {g: plain(ws, 6.0, 3) for g, ws in groups.items()}
    assert sum(batching.lightest_first([1, 5, 3, 3], 2)) in (2, 3)


def _groupings(n):
    if not n:
        return [[]]
    return [[*g, (k, n - 1)] for k in range(n) for g in _groupings(k)]


def test_store(spark, tmp_path):
    schema = "zone string, year int, tile string, px int, v int"
    store = PixelStore(spark, str(tmp_path / "s"), schema).create()
    rows = lambda data: spark.createDataFrame(data, schema)
    first = store.append_day(rows([("30N", 2024, "a", 1, 10), ("30N", 2024, "a", 2, 20), ("30N", 2024, "b", 1, 5)]), datetime.date(2024, 1, 1), "r1")
    store.tag("v1", first)
    with pytest.raises(NonMonotonicDateError):
        store.append_day(rows([("30N", 2024, "c", 1, 1)]), datetime.date(2024, 1, 1), "r2")
    new = spark.createDataFrame([("30N", 2024, "a", 1, 11, False), ("30N", 2024, "a", 2, 22, True), ("30N", 2024, "a", 3, 33, True)], schema + ", owned boolean")
    store.merge_owned(new, ["px"], "owned", "r3")
    now = {(r.tile, r.px, r.v) for r in store.read().collect()}
    assert now == {("a", 1, 10), ("a", 2, 22), ("a", 3, 33), ("b", 1, 5)}
    assert {(r.tile, r.px, r.v) for r in store.read("v1").collect()} == {("a", 1, 10), ("a", 2, 20), ("b", 1, 5)}
    assert store.expired().count() == 0
    with pytest.raises(ValueError):
        store.tag("v1", first)


def test_two_writers_from_one_version(spark, tmp_path):
    schema = "zone string, year int, tile string, px int"
    store = PixelStore(spark, str(tmp_path / "s"), schema).create()
    rows = spark.createDataFrame([("30N", 2024, "a", 1)], schema)
    store.append_day(rows, datetime.date(2024, 1, 1), "r1")
    version = store.version()
    store.commit(rows.withColumn("tile", F.lit("b")), "fill", "r2", expected=version)
    with pytest.raises(CommitConflictError):
        store.commit(rows.withColumn("tile", F.lit("c")), "fill", "r3", expected=version)
    with pytest.raises(DuplicateDateError):
        store.append_day(rows, datetime.date(2024, 1, 1), "r4")
    assert {r.tile for r in store.read().collect()} == {"a", "b"}


def test_catalogue_search(spark, tmp_path):
    start = datetime.datetime(2024, 1, 1)
    with open(tmp_path / "items.jsonl", "w") as f:
        for k in range(100):
            box = [179.0, 0, -179.0, 1] if k % 2 else [0, 0, 1, 1]
            f.write(json.dumps({"id": f"i{k}", "acquired_at": (start + datetime.timedelta(hours=7 * k)).isoformat(), "bbox": box, "assets": {"red": "s3://b/r", "nir": "x"}}) + "\n")
    found = catalogue_source.search(spark, str(tmp_path), "2024-01-01", "2024-01-15", assets=["red"])
    dealt = catalogue_source.windowed(found, page=10).collect()
    assert {r.id for r in dealt} == {f"i{k}" for k in range(48)} and all(set(r.assets) == {"red"} for r in dealt)
    sizes = collections.Counter(r.window for r in dealt)
    assert max(sizes.values()) <= 10 and len(sizes) > 3
    assert {r.id for r in catalogue_source.search(spark, str(tmp_path), "2024-01-01", "2024-01-15", bbox=(-180, 0, -179.5, 1)).collect()} == {f"i{k}" for k in range(1, 48, 2)}
    for page, most in ((2, 99), (10, 2)):
        with pytest.raises(catalogue_source.SearchBudgetError):
            catalogue_source.windowed(found, page, most)


def test_guarded_append_loses_nothing(spark, tmp_path):
    day = datetime.date
    folder = tmp_path / "in"
    schema = "id int, day date"
    spark.createDataFrame([(1, day(2024, 1, 2))], schema).coalesce(1).write.parquet(str(folder / "a"))
    run = lambda: streams.guarded_append(spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(folder)), "day", str(tmp_path / "t"), str(tmp_path / "r"), str(tmp_path / "c"), ["id"]).awaitTermination()
    run()
    spark.createDataFrame([(2, day(2024, 1, 1)), (3, day(2024, 1, 3)), (3, day(2024, 1, 3)), (4, None)], schema).coalesce(1).write.parquet(str(folder / "b"))
    run()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [1, 3]
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "r")).collect()) == [2, 4]


def test_records(spark):
    rows = spark.createDataFrame([(1, None, None), (2, "x", 5)], "run_id int, filled_at string, chunk_px int").withColumn("assembled_at", F.lit("now"))
    assert {tuple(r) for r in records.as_master_rows(rows, "fill", F.col("chunk_px").isNotNull()).select("run_id", "filled_at", "measured_by").collect()} == {(1, "now", None), (2, "x", "fill")}
    with pytest.raises(Exception, match="must carry filled_at"):
        records.as_master_rows(rows, "rebuild", F.col("chunk_px").isNotNull()).collect()
    plane = spark.createDataFrame([("a", 3), ("a", -1), ("a", 0), ("b", 0)], "t string, k int")
    assert [tuple(r) for r in records.source_positions(plane, ["t"], "k").collect()] == [("a", [0, 2], 1)]
    with pytest.raises(Exception, match="beyond 16 bits"):
        records.source_positions(plane.withColumn("k", F.lit(40000)), ["t"], "k").collect()
    blocks = spark.createDataFrame([("a", 1, True), ("b", 0, False), ("c", None, True), ("c", 0, False)], "z string, hits int, failed boolean")
    assert {tuple(r) for r in records.probe_verdict(blocks, ["z"], F.col("hits"), F.col("failed")).collect()} == {("a", "present"), ("b", "absent"), ("c", "unknown")}


def test_exact_percentiles(spark):
    rnd = random.Random(4)
    rows = [(k, rnd.choice([rnd.gauss(0, 9), float(rnd.randint(0, 5))])) for k in (1, 1, 1, 2) for _ in range(900)] + [(3, 7.5), (4, None), (1, None)]
    df = spark.createDataFrame(rows, "k int, v double")
    wanted = {"least": 0.0, "low": 0.013, "middle": 0.5, "high": 0.99, "most": 1.0}
    for accuracy in (40, 100, 10000):
        got = {r.k: r for r in telemetry.exact_percentiles(df, ["k"], "v", wanted, accuracy).collect()}
        for k in (1, 2, 3):
            for name, p in wanted.items():
                assert abs(got[k][name] - np.quantile([v for g, v in rows if g == k and v is not None], p)) < 1e-9
        assert got[4].middle is None
        whole = telemetry.exact_percentiles(df, [], "v", wanted, accuracy).first()
        assert abs(whole.high - np.quantile([v for _, v in rows if v is not None], 0.99)) < 1e-9
    assert telemetry.exact_percentiles(df.limit(0), ["k"], "v", wanted).count() == 0


def test_naive_instant_is_refused(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00Z",), (None,)], "t string")
    assert [r[0] for r in df.select(F.unix_seconds(items.aware_instant(F.col("t")))).collect()] == [1704067200, None]
    with pytest.raises(Exception, match="no zone"):
        spark.createDataFrame([("2024-01-01T00:00:00",)], "t string").select(items.aware_instant(F.col("t"))).collect()
