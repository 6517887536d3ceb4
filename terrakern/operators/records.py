"""Rows of the registry and of provenance: preference among copies, master rows, merging, lineage, comparison, plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrakern.operators.registry import FILL, newest_run_wins, rank_of, source_runs

#: Fixed value: the largest fusion position that a signed 16-bit plane can hold.
MOST_POSITION = 32767


# -- copies of one image ---------------------------------------------------------------
def copy_preference(complete: Column, refuses: Column, baseline: Column, harmonised: Column, owes: Column, local: Column, sequence: Column, item_id: Column) -> list[Column]:
    """The nine terms of preference, best first: whole read set, not refusing, readable baseline (or none needed),
    newest baseline, nothing owed, nearby (only between readable baselines), sequence known, newest sequence, id."""
    readable = baseline.isNotNull()
    cost = lambda c: F.when(c, 1).otherwise(0)
    return [
        cost(~complete),
        cost(refuses),
        cost(~readable & ~harmonised),
        -F.coalesce(baseline, F.lit(0)),
        cost(owes),
        cost(readable & ~local),
        cost(sequence.isNull()),
        -F.coalesce(sequence, F.lit(0)),
        item_id,
    ]


def preferred_copies(items: DataFrame, tile_day: list[str], image: str, order: list[Column], refuses: Column, item_id: str) -> DataFrame:
    """Per tile and day: ``used``, the best copy of each image, and ``spares`` in the order in which they would step in.

    A copy without an image stands alone; copies that would refuse their day are never spares.
    """
    alone = F.coalesce(F.col(image).cast("string"), F.concat(F.lit("id:"), F.col(item_id).cast("string")))
    ranked = items.withColumn("__image", alone).withColumn("__rank", F.row_number().over(Window.partitionBy(*tile_day, "__image").orderBy(*order)))
    ranked = ranked.withColumn("__place", F.row_number().over(Window.partitionBy(*tile_day).orderBy("__rank", *order)))
    listed = lambda kept: F.transform(F.array_sort(F.collect_list(F.when(kept, F.struct("__place", F.col(item_id).alias("id"))))), lambda x: x["id"])
    first = F.col("__rank") == 1
    return ranked.groupBy(*tile_day).agg(listed(first).alias("used"), listed(~first & ~refuses).alias("spares"))


def radar_order(day: Column, burst: Column, acquisitions: Column, at: Column, item_id: Column) -> list[Column]:
    """Fusion order of radar items: day, named bursts first, most acquired first, burst, time, id."""
    return [day, F.when(burst.isNull(), 1).otherwise(0), -F.coalesce(acquisitions, F.lit(0)), F.coalesce(burst, F.lit("")), at, item_id]


# -- master rows ---------------------------------------------------------------------------
def as_master_rows(rows: DataFrame, origin: str, measured: Column) -> DataFrame:
    """``filled_at`` (a fill's own ``assembled_at`` where it has none) and ``measured_by``, null where nothing is measured.

    A re-derived row without ``filled_at`` is an error: by its own stamp it would pass for a newer run.
    """
    if origin == FILL:
        filled = F.coalesce("filled_at", "assembled_at")
    else:
        filled = F.when(F.col("filled_at").isNull(), F.raise_error(F.lit("a re-derived row must carry filled_at"))).otherwise(F.col("filled_at"))
    return rows.withColumns({"filled_at": filled, "measured_by": F.when(measured, F.lit(origin))})


def merge_cell(fills: DataFrame, held: DataFrame, commits: DataFrame, radar: Column) -> DataFrame:
    """One row per tile: fills and held re-derivations of fills that still exist, the newest fill first, then by rank.

    ``fills`` and ``held`` are master rows (tile, run_id, assembled_at, filled_at, measured_by, chunk_px, ...).  Held
    rows measured by a fill are left out, as the fill itself is there.  ``source_runs`` comes from the commit log
    (tile, at, run_id, mode), null for a tile that no commit names.
    """
    derived = held.filter(F.coalesce(F.col("measured_by") != FILL, F.lit(True))).join(fills.select("tile", "filled_at").distinct(), ["tile", "filled_at"], "left_semi")
    rank = rank_of(F.coalesce("measured_by", F.lit("")), F.col("chunk_px").isNotNull(), radar)
    order = [F.col("filled_at").desc(), rank, F.col("assembled_at").desc(), F.col("run_id").desc()]
    winners = newest_run_wins(fills.unionByName(derived), ["tile"], order)
    return winners.join(source_runs(commits, ["tile"], ["at", "run_id"], "run_id", "mode"), "tile", "left")


def lineage_stamp(commits: DataFrame, cell: list[str], run: str, at: str) -> DataFrame:
    """Per cell the JSON list of [run, time of its latest commit], oldest first."""
    latest = commits.groupBy(*cell, run).agg(F.max(at).alias("__at"))
    entries = F.array_sort(F.collect_list(F.struct(F.col("__at").cast("string").alias("at"), F.col(run).cast("string").alias("run"))))
    return latest.groupBy(*cell).agg(F.to_json(F.transform(entries, lambda x: F.array(x["run"], x["at"]))).alias("stamp"))


def run_history(records: DataFrame, year: list[str], run: str, at: str) -> DataFrame:
    """Per year the current run and those before it (each once, by its last record), oldest first."""
    last = records.groupBy(*year, run).agg(F.max(at).alias("__at"))
    runs = F.transform(F.array_sort(F.collect_list(F.struct("__at", F.col(run).alias("run")))), lambda x: x["run"])
    return last.groupBy(*year).agg(runs.alias("__runs")).select(*year, F.element_at("__runs", -1).alias("current"), F.slice("__runs", F.lit(1), F.size("__runs") - 1).alias("previous"))


def claiming_runs(runs: DataFrame, pixels: DataFrame, order: str, mode: str, mask: str) -> DataFrame:
    """Per pixel the newest run that claims it: a whole fill, or a run of holes whose mask holds the pixel.

    ``runs``: tile, run_id, ``order``, ``mode``, ``mask`` (positions); ``pixels``: tile, position.
    """
    claims = (F.col(mode) != "holes") | F.array_contains(mask, F.col("position"))
    return pixels.join(runs, "tile").groupBy("tile", "position").agg(F.max_by("run_id", F.when(claims, F.col(order))).alias("run_id"))


# -- re-derived rows ----------------------------------------------------------------------
def compare_rows(rebuilt: DataFrame, recorded: DataFrame, key: str, compared: list[str], optional: list[str]) -> DataFrame:
    """``verdict`` and ``differences`` (names) of re-derived rows against recorded ones.

    unmeasured: no recorded ``chunk_px``; cropped: recorded over less than the whole tile; else match or mismatch of
    the compared columns, nulls equal.  ``optional`` columns count only where they were re-derived.
    """
    got = rebuilt.select(key, *[F.col(c).alias(f"got_{c}") for c in compared])
    differs = []
    for c in compared:
        unlike = ~F.col(f"got_{c}").eqNullSafe(F.col(c))
        differs.append(F.when(unlike & (F.col(f"got_{c}").isNotNull() if c in optional else F.lit(True)), F.lit(c)))
    found = F.array_compact(F.array(*differs))
    cropped = F.col("eligible_px").isNotNull() & (F.col("eligible_px") != F.col("chunk_px"))
    verdict = F.when(F.col("chunk_px").isNull(), "unmeasured").when(cropped, "cropped").when(F.size(found) == 0, "match").otherwise("mismatch")
    out = recorded.join(got, key, "left").withColumn("verdict", verdict)
    return out.select(key, "verdict", F.when(F.col("verdict") == "mismatch", found).otherwise(F.array().cast("array<string>")).alias("differences"))


def rebuilt_rows(source: DataFrame, measured: DataFrame, key: str, carried: list[str], rebuilt: list[str], run_id: str, assembled_at: Column) -> DataFrame:
    """Rows of a re-derivation: carried identity, the pass's own run and stamp, the fill's stamp in ``filled_at``, new measurements."""
    held = source.select(key, *carried, F.coalesce("filled_at", "assembled_at").alias("filled_at"))
    return held.join(measured.select(key, *rebuilt), key, "left").withColumns({"run_id": F.lit(run_id), "assembled_at": assembled_at})


# -- provenance ------------------------------------------------------------------------------
def source_positions(plane: DataFrame, by: list[str], signed: str) -> DataFrame:
    """``sources``, the distinct fusion positions (|k| - 1, ascending) of a plane, and ``valid_px``, its pixels with k > 0.

    0 is no data; a plane with none is left out; a position that 16 bits cannot hold is an error.
    """
    k = F.col(signed)
    size = F.when(F.abs(k) > MOST_POSITION, F.raise_error(F.lit("a fusion position is beyond 16 bits"))).otherwise(F.abs(k))
    out = plane.filter(k != 0).groupBy(*by)
    return out.agg(F.array_sort(F.collect_set(size - 1)).alias("sources"), F.count_if(k > 0).alias("valid_px"))


def publish_failures(plane: DataFrame, recorded: DataFrame, by: list[str], signed: str) -> DataFrame:
    """Keys whose recorded ``sources`` or ``valid_px`` are not those of the plane, or that only one side has."""
    true = source_positions(plane, by, signed).withColumnsRenamed({"sources": "true_sources", "valid_px": "true_valid"})
    joined = recorded.join(true, by, "full")
    why = F.when(F.col("true_sources").isNull(), "no plane").when(F.col("sources").isNull(), "no record")
    why = why.when(F.col("sources") != F.col("true_sources"), "sources").when(F.col("valid_px") != F.col("true_valid"), "valid_px")
    return joined.select(*by, why.alias("failure")).filter(F.col("failure").isNotNull())


# -- plans and gates -----------------------------------------------------------------------------
def plan_from_tiles(tiles: DataFrame, cell: list[str], tile: str) -> DataFrame:
    """Cells with their sorted tiles; null means all, as soon as one row of the cell names none."""
    return tiles.groupBy(*cell).agg(F.when(~F.bool_or(F.col(tile).isNull()), F.array_sort(F.collect_set(tile))).alias("tiles"))


def tightened(rules: DataFrame, applied: DataFrame, cell: list[str], rule: str) -> DataFrame:
    """Cells whose new rule asks for more than the one already applied: these are refused."""
    return rules.join(applied.withColumnRenamed(rule, "__applied"), cell).filter(F.col(rule) > F.col("__applied")).select(*cell)


def upserted(held: DataFrame, new: DataFrame, key: list[str], at: str) -> DataFrame:
    """Both tables with the newest row of each key."""
    return newest_run_wins(held.unionByName(new), key, [F.col(at).desc()])


def loss_verdict(days: DataFrame, by: list[str], given_up: Column, most: int = 10) -> DataFrame:
    """Days given up per leg, and whether that is more than may be lost."""
    return days.groupBy(*by).agg(F.count_if(given_up).alias("given_up")).withColumn("refused", F.col("given_up") > most)


def probe_verdict(blocks: DataFrame, by: list[str], hits: Column, failed: Column) -> DataFrame:
    """present if any block has something; unknown if none has but one could not be read; else absent."""
    verdict = F.when(F.bool_or(F.coalesce(hits > 0, F.lit(False))), "present").when(F.bool_or(failed), "unknown").otherwise("absent")
    return blocks.groupBy(*by).agg(verdict.alias("verdict"))


def conflicting(commits: DataFrame, tiles: str, mine: list) -> Column:
    """Whether a commit touches any of my shards; a commit that names none touches all."""
    return F.col(tiles).isNull() | F.arrays_overlap(F.col(tiles), F.array(*[F.lit(m) for m in mine]))


# -- geometry and samples -----------------------------------------------------------------------
def in_own_zone(rows: DataFrame, lon: Column, zone: Column) -> DataFrame:
    """Rows of overlapping zones whose six-degree band holds the point."""
    return rows.filter(F.least(F.floor((lon + 180) / 6) + 1, F.lit(60)) == zone)


def valid_box(pixels: DataFrame, by: list[str], column: str, valid: Column, width: int, saving: float = 0.1) -> DataFrame:
    """First and last valid column of each tile, and the columns to read: the box if it saves a tenth, else all."""
    box = pixels.filter(valid).groupBy(*by).agg(F.min(column).alias("first"), (F.max(column) + 1).alias("stop"))
    crop = (F.col("stop") - F.col("first")) <= (1 - saving) * width
    return box.select(*by, "first", "stop", F.when(crop, F.col("first")).otherwise(F.lit(0)).alias("read_from"), F.when(crop, F.col("stop")).otherwise(F.lit(width)).alias("read_to"))


def region_slice(axis: DataFrame, coordinate: str, low, high) -> DataFrame:
    """Index slice of the coordinates between two values, in either order, both ends included."""
    low, high = min(low, high), max(low, high)
    places = axis.select(F.col(coordinate).alias("c"), (F.row_number().over(Window.orderBy(coordinate)) - 1).alias("i"))
    return places.filter(F.col("c").between(low, high)).agg(F.min("i").alias("first"), (F.max("i") + 1).alias("stop"))


def strided(rows: DataFrame, by: list[str], order: list[str], count: int) -> DataFrame:
    """About ``count`` evenly spaced rows of each group, its first and last among them."""
    place = Window.partitionBy(*by)
    held = rows.withColumn("__i", F.row_number().over(place.orderBy(*order)) - 1).withColumn("__n", F.count("*").over(place))
    # the k-th of count places is floor(k * (n - 1) / (count - 1)); a row is one if a k lands on it
    k = F.ceil(F.col("__i") * (count - 1) / F.greatest(F.col("__n") - 1, F.lit(1)))
    lands = (F.col("__n") <= count) | (F.floor(k * (F.col("__n") - 1) / (count - 1)) == F.col("__i"))
    return held.filter(lands).drop("__i", "__n")
