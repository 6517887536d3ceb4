"""Catalogue items, fill zones, month windows, strips and batches."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrakern.functions import pixel

#: Forms of identifiers.
MGRS_SQUARE = r"^[0-9]{1,2}[A-Z]{3}$"
ID_TILE = r"^[A-Z0-9]+_([0-9]{1,2}[A-Z]{3})_"
ID_SEQUENCE = r"_([0-9]+)_[A-Z0-9]+$"
DATATAKE = r"^(G[A-Z0-9]{2,}_[0-9]{8}T[0-9]{6}_[0-9]+)_N[0-9]{1,2}\.[0-9]{1,2}$"
DATASTRIP = r"^S2[A-Z]_OPER_MSI_L2A_DS_[A-Z0-9_]{4}_[0-9]{8}T[0-9]{6}_S([0-9]{8}T[0-9]{6})_N[0-9]{1,2}\.[0-9]{1,2}$"
#: Buckets by producer.
HARMONISED_BUCKETS = ("sentinel-cogs", "e84-earth-search-sentinel-data")
RAW_BUCKETS = ("sentinel-s2-l2a",)
#: Bytes that a strip may hold, bytes of an observed pixel, least height of a strip.
STRIP_BYTES, OBSERVED_BYTES, LEAST_STRIP = 3758096384, 20, 256
#: Side of a tile in pixels, first year of the time axis.
TILE, FIRST_YEAR = 2048, 2017


def _found(text: Column, form: str) -> Column:
    return F.nullif(F.regexp_extract(text, form, 1), F.lit(""))


def item_tile(grid_code: Column, square: Column, item_id: Column) -> Column:
    """Tile from the grid code, a bare grid square or the identifier, in this order; null if none names it."""
    bare = F.when(F.trim(square).rlike(MGRS_SQUARE), F.trim(square))
    return F.coalesce(F.nullif(grid_code, F.lit("")), F.concat(F.lit("MGRS-"), F.coalesce(bare, _found(item_id, ID_TILE))))


def item_sequence(declared: Column, item_id: Column) -> Column:
    """A declared sequence of digits alone, or else that of the identifier."""
    stated = F.when(F.trim(declared).rlike("^[0-9]+$"), F.trim(declared))
    return F.coalesce(stated, _found(item_id, ID_SEQUENCE)).try_cast("int")


def image_identity(datatake: Column, datastrip: Column) -> Column:
    """Pass and start of the datastrip; null unless both are of their form."""
    return F.concat(_found(F.trim(datatake), DATATAKE), F.lit("|"), _found(F.trim(datastrip), DATASTRIP))


def producer(bucket: Column) -> Column:
    """Aggregate over the buckets of an item's bands: harmonised, raw, mixed, or unknown (also if one is not known)."""
    ours, raw = F.coalesce(bucket.isin(*HARMONISED_BUCKETS), F.lit(False)), F.coalesce(bucket.isin(*RAW_BUCKETS), F.lit(False))
    return (
        F.when(F.bool_or(bucket.isNull()), "unknown")
        .when(F.bool_and(ours), "harmonised")
        .when(F.bool_and(raw), "raw")
        .when(F.bool_or(ours) & F.bool_or(raw), "mixed")
        .otherwise("unknown")
    )


def fill_zone(text: Column) -> Column:
    """Canonical '07S', 'utm07' or 'utm07s' of a zone in any case, with spaces and without a leading zero; null for others."""
    form = r"^(?:(UTM)([0-9]{1,2})([NS]?)|([0-9]{1,2})([NS]))$"
    t = F.upper(F.trim(text))
    part = lambda k: F.regexp_extract(t, form, k)
    number = F.concat(part(2), part(4)).try_cast("int")
    two = F.lpad(number.cast("string"), 2, "0")
    name = F.when(part(1) != "", F.concat(F.lit("utm"), two, F.lower(part(3)))).otherwise(F.concat(two, part(5)))
    return F.when(t.rlike(form) & number.between(1, 60), name)


def group_and_half(zone: Column) -> tuple[Column, Column]:
    """Group and column half that a canonical fill zone writes; nulls for a whole column, which is no cell."""
    half = _found(zone, "^utm[0-9]{2}([ns])$")
    whole = zone.rlike("^utm[0-9]{2}$")
    return F.when(~whole, F.when(half.isNotNull(), F.left(zone, F.lit(5))).otherwise(zone)), half


def fill_zones(zone: Column) -> Column:
    """The fill zones that write a canonical zone: the two halves of a whole column, else itself."""
    return F.when(zone.rlike("^utm[0-9]{2}$"), F.array(F.concat(zone, F.lit("n")), F.concat(zone, F.lit("s")))).otherwise(F.array(zone))


def year_to(month: Column) -> tuple[Column, Column]:
    """First and last month (their first days) of the twelve that end at 'June 2025'; nulls for other texts."""
    last = F.to_date(F.try_to_timestamp(F.concat(F.lit("1 "), F.trim(month)), F.lit("d MMMM yyyy")))
    return F.add_months(last, -11), last


def aware_instant(text: Column) -> Column:
    """An ISO instant; a text without a zone is refused with an error, null stays null."""
    zoned = text.rlike(r"(Z|[+-]\d{2}:\d{2})$")
    return F.when(zoned, F.to_timestamp(text)).when(text.isNotNull(), F.raise_error(F.concat(F.lit("no zone: "), text)).cast("timestamp"))


def transformer_flops(batch: Column, lengths: list[Column], width: int, inner: int, layers: int) -> Column:
    """Multiply-adds, counted twice, of the projections, scores and inner layers of each backbone at its own length."""
    each = [8 * batch * n * width**2 + 4 * batch * n * n * width + 4 * batch * n * width * inner for n in lengths]
    return sum(each[1:], each[0]) * layers


def strip_height(kept: Column, width: Column, height: Column, mask_width: Column | None = None) -> Column:
    """Most rows of a strip whose bands and full mask fit STRIP_BYTES, at least LEAST_STRIP."""
    steps = F.greatest(kept, F.lit(1)).cast("long")
    left = F.greatest(F.lit(STRIP_BYTES) - steps * height * (width if mask_width is None else mask_width), F.lit(0))
    rows = F.floor(left / (steps * width * OBSERVED_BYTES))
    return F.when(rows < LEAST_STRIP, F.lit(LEAST_STRIP).cast("long")).otherwise(F.least(height.cast("long"), rows))


def tile_slices(row: Column, col: Column, year: Column) -> dict[str, Column]:
    """Pixel slices of a tile and the place of its year on the time axis."""
    return {"y0": row * TILE, "y1": (row + 1) * TILE, "x0": col * TILE, "x1": (col + 1) * TILE, "step": year - FIRST_YEAR}


def manifest_hash(entries: Column) -> Column:
    """First 16 hex digits of the SHA-256 of a map (string to number) as JSON, keys sorted, ', ' and ': ' between."""
    pairs = F.transform(F.array_sort(F.map_entries(entries)), lambda e: F.concat(F.lit('"'), e["key"], F.lit('": '), e["value"].cast("string")))
    return F.left(F.sha2(F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}")), 256), F.lit(16))


def target_epsg(zone: Column, latitude: Column) -> Column:
    return F.when(latitude >= 0, zone + 32600).otherwise(zone + 32700)


def grid_size(least: Column, most: Column, resolution: float) -> Column:
    """Pixels between two bounds; null if there are none."""
    n = F.ceil((most - least) / F.lit(resolution))
    return F.when(n > 0, n)


def resampled_batch(steps: Column, target: int, mean: float, std: float) -> Column:
    """``target`` standardised steps of a pixel from its valid (value, doy) steps; zeros if it has none."""
    n = F.size(steps)
    picked = pixel.resampled_indices_even(n, F.lit(target))
    z = F.transform(picked, lambda i: F.struct(pixel.z_score(F.get(steps, i)["value"], mean, std).alias("z"), F.get(steps, i)["doy"].alias("doy")))
    none = F.array_repeat(F.struct(F.lit(0.0).alias("z"), F.lit(0).alias("doy")), target)
    return F.when(n > 0, z).otherwise(none)
