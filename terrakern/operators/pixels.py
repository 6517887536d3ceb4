"""Observations per pixel: counts, month coverage, eligibility, coverage records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def observation_counts(obs: DataFrame, pixel: list[str], valid: Column, name: str = "n_obs") -> DataFrame:
    return obs.groupBy(*pixel).agg(F.count_if(valid).alias(name))


def month_mask(obs: DataFrame, pixel: list[str], day: str, valid: Column) -> DataFrame:
    """Bit k - 1 is set if month k has a valid observation."""
    bit = F.when(valid, F.expr(f"shiftleft(1L, month({day}) - 1)")).otherwise(0)
    return obs.groupBy(*pixel).agg(F.bit_or(bit.cast("long")).alias("months"))


def without_empty_steps(obs: DataFrame, step: list[str], valid: Column) -> DataFrame:
    """Rows of steps (tile, date) that are valid somewhere."""
    live = obs.filter(valid).select(*step).distinct()
    return obs.join(live, step, "left_semi")


def refusal(optical: Column, radar: Column, least: int, radar_free: bool = False) -> Column:
    """Why a pixel is refused: no_optical, thin, no_radar; null if it is eligible."""
    out = F.when(optical == 0, "no_optical").when(optical < least, "thin")
    return out if radar_free else out.when(radar == 0, "no_radar")


def coverage_record(counts: DataFrame, tile: list[str], optical: str, radar: str, least: int) -> DataFrame:
    """Measurements of a tile from its pixels' counts; medians to one decimal, of thin pixels null without any."""
    some, thin = F.col(optical) > 0, (F.col(optical) > 0) & (F.col(optical) < least)
    return counts.groupBy(*tile).agg(
        F.count("*").alias("chunk_px"),
        F.count_if(some).alias("px_with_any_optical"),
        F.count_if(~some).alias("refused_no_optical_px"),
        F.count_if(thin).alias("refused_thin_px"),
        F.max(optical).alias("obs_max"),
        F.coalesce(F.round(F.percentile(F.when(some, F.col(optical)), F.lit(0.5)), 1), F.lit(0.0)).alias("median_obs_where_any"),
        F.round(F.percentile(F.when(thin, F.col(optical)), F.lit(0.5)), 1).alias("median_obs_where_thin"),
        F.count_if(F.col(radar) > 0).alias("px_with_any_radar"),
    )


def admitted(obs: DataFrame, step: list[str], valid: Column, live: Column, percent: float) -> DataFrame:
    """Steps with at least ``percent`` of their live pixels valid; none without a live pixel."""
    per = obs.groupBy(*step).agg(F.count_if(valid & live).alias("valid_px"), F.count_if(live).alias("live_px"))
    return per.filter((F.col("live_px") > 0) & (100 * F.col("valid_px") >= percent * F.col("live_px")))


def coarsened(mask: DataFrame, row: str, col: str, live: Column, factor: int) -> DataFrame:
    """Any live cell in each factor x factor block."""
    return mask.groupBy(F.floor(F.col(row) / factor).alias(row), F.floor(F.col(col) / factor).alias(col)).agg(F.bool_or(live).alias("live"))
