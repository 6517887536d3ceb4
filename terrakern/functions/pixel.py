"""Pixel arithmetic: scaling, corrections, ladder buckets, resampling and bit packing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Scene classes that hold a usable observation.
VALID_CLASSES = (4, 5, 6, 7, 10, 11)
#: Decibel scaling, correction offset and observation ladder.
DB_SHIFT, DB_FACTOR, DB_MAX = 50, 200, 32767
OFFSET, OFFSET_BASELINE = 1000, 400
LADDER_STEP, LADDER_TOP = 8, 256
SCALE_FLOOR = 1e-8


def scaled_db(amplitude: Column) -> Column:
    """(20 log10(a) + 50) * 200, floored and clipped to [0, 32767]; 0 (no data) for a <= 0 or null."""
    value = F.floor((20 * F.log10(amplitude) + DB_SHIFT) * DB_FACTOR)
    return F.when(amplitude > 0, F.greatest(F.lit(0), F.least(F.lit(DB_MAX), value))).otherwise(0).cast("int")


def offset_corrected(dn: Column) -> Column:
    """dn - 1000 with a floor of 1; no data (0) stays."""
    return F.when(dn > 0, F.greatest(dn - OFFSET, F.lit(1))).otherwise(dn)


def offset_decision(producer: Column, baseline: Column) -> Column:
    """OWED, EXEMPT or UNDECIDABLE from the producer (harmonised, raw, null) and baseline (null if unreadable)."""
    return (
        F.when(producer == "harmonised", "EXEMPT")
        .when(baseline < OFFSET_BASELINE, "EXEMPT")
        .when(producer.isNull() | baseline.isNull(), "UNDECIDABLE")
        .otherwise("OWED")
    )


def z_score(x: Column, mean, std) -> Column:
    return (x - mean) / (F.lit(std) + 1e-9)


def ladder_bucket(count: Column) -> Column:
    """Smallest multiple of 8 that holds the count, from 8 to 256."""
    return F.least(F.lit(LADDER_TOP), F.ceil(F.greatest(count, F.lit(1)) / LADDER_STEP) * LADDER_STEP).cast("int")


def _split_median(n: Column, groups: Column) -> Column:
    """Middle index of each of ``groups`` near-equal parts of 0..n-1."""
    q, r = F.floor(n / groups), n % groups
    return F.transform(F.sequence(F.lit(0), groups - 1), lambda i: (i * q + F.least(i, r) + F.floor((q + (i < r).cast("int")) / 2)).cast("int"))


def _upto(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def resampled_indices(n: Column, t: Column) -> Column:
    """Which of n observations fill t places, first form: split medians, or all and then an even spread."""
    n, t = n.cast("int"), t.cast("int")
    extra = t - n
    step = (n - 1) / (extra + 1)
    spread = F.transform(F.sequence(F.lit(1), F.greatest(extra, F.lit(1))), lambda j: F.least(F.rint(j * step), n - 1).cast("int"))
    return F.when(n <= 0, F.array().cast("array<int>")).when(t == n, _upto(n)).when(t < n, _split_median(n, t)).otherwise(F.concat(_upto(n), spread))


def resampled_indices_even(n: Column, t: Column) -> Column:
    """Second form: an even spread that ends at the last, or all and then medians or a cycle."""
    n, t = n.cast("int"), t.cast("int")
    step = (n - 1) / F.greatest(t - 1, F.lit(1))
    down = F.transform(F.sequence(F.lit(0), t - 1), lambda i: F.when((i == t - 1) & (t > 1), n - 1).otherwise(F.floor(i * step)).cast("int"))
    rest = F.greatest(t - n, F.lit(1))
    cycle = F.transform(F.sequence(F.lit(0), rest - 1), lambda i: (i % F.greatest(n, F.lit(1))).cast("int"))
    up = F.concat(_upto(n), F.when(rest <= n, _split_median(n, rest)).otherwise(cycle))
    return F.when(n <= 0, F.array().cast("array<int>")).when(t <= n, down).otherwise(up)


def packed(value: Column, position: Column, bits: int = 16) -> Column:
    """value | (position + 1) << bits; 0 where the value is missing."""
    return F.when(value.isNull(), F.lit(0).cast("long")).otherwise(value.cast("long").bitwiseOR(F.shiftleft((position + 1).cast("long"), bits)))


def unpacked(pack: Column, bits: int = 16) -> tuple[Column, Column]:
    """(value, position) of a pack; nulls where nothing was packed."""
    position = F.shiftrightunsigned(pack, bits)
    value = pack.bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
    return F.when(position > 0, value), F.when(position > 0, position - 1)


def quantised(vector: Column) -> tuple[Column, Column]:
    """(int8 array, scale): scale = max(max|x| / 127, 1e-8), values rounded half to even and clipped."""
    scale = F.greatest(F.array_max(F.transform(vector, lambda x: F.abs(x.cast("double")))) / 127, F.lit(SCALE_FLOOR))
    return F.transform(vector, lambda x: F.greatest(F.lit(-127), F.least(F.lit(127), F.rint(x.cast("double") / scale))).cast("tinyint")), scale


def dequantised(vector: Column, scale: Column) -> Column:
    """Array of value * scale; a NaN scale (absent pixel) gives NaNs."""
    return F.transform(vector, lambda x: x.cast("double") * scale)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null if either vector is all zero."""
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def tokens(optical: Column, radar: Column) -> Column:
    """Tokens of a pixel: its optical and radar ladder sizes."""
    return ladder_bucket(optical) + ladder_bucket(radar)
