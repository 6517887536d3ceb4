"""The registry: one current row per tile and year, audits, completeness, plans, lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrakern.operators.catalogue import best_copies

MEASURED, FILL = "chunk_px", "fill"


def rank_of(measured_by: Column, measured: Column, radar: Column) -> Column:
    """0 a measured fill, 1 measured with radar, 2 measured, 3 unmeasured."""
    return F.when((measured_by == FILL) & measured, 0).when(measured & radar, 1).when(measured, 2).otherwise(3)


def newest_run_wins(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row per key: newest fill, then rank, then newest assembly, then run id."""
    return best_copies(rows, key, order)


def invariants(rows: DataFrame, key: list[str], label: Column) -> DataFrame:
    """One row per kind of failure and how often: duplicate keys, malformed labels, null keys."""
    duplicate = rows.groupBy(*key).count().filter("count > 1").select(F.lit("duplicate_key").alias("kind"))
    malformed = rows.filter(~label).select(F.lit("malformed_label").alias("kind"))
    missing = F.lit(False)
    for k in key:
        missing = missing | F.col(k).isNull()
    return duplicate.union(malformed).union(rows.filter(missing).select(F.lit("null_key").alias("kind"))).groupBy("kind").agg(F.count("*").alias("n"))


def audit(want: DataFrame, held: DataFrame, key: list[str], compared: list[str]) -> DataFrame:
    """Keys that are missing, extra or differ in a compared column (null-safe), with the kind."""
    w = want.select(*[F.col(k).alias(f"w_{k}") for k in key], *[F.col(c).alias(f"w_{c}") for c in compared], F.lit(True).alias("in_want"))
    h = held.select(*[F.col(k).alias(f"h_{k}") for k in key], *[F.col(c).alias(f"h_{c}") for c in compared], F.lit(True).alias("in_held"))
    on = F.lit(True)
    for k in key:
        on = on & (F.col(f"w_{k}") == F.col(f"h_{k}"))
    same = F.lit(True)
    for c in compared:
        same = same & F.col(f"w_{c}").eqNullSafe(F.col(f"h_{c}"))
    kind = F.when(F.col("in_held").isNull(), "missing").when(F.col("in_want").isNull(), "extra").when(~same, "differs")
    return w.join(h, on, "full").select(*[F.coalesce(f"w_{k}", f"h_{k}").alias(k) for k in key], kind.alias("kind")).filter(F.col("kind").isNotNull())


def source_runs(commits: DataFrame, key: list[str], at: list[str], run: str, mode: str) -> DataFrame:
    """Ordered fold per key: a ``holes`` commit appends its run (no immediate repeat), any other starts the list anew."""
    ordered = F.array_sort(F.collect_list(F.struct(*at, F.col(run).alias("__run"), F.col(mode).alias("__mode"))))
    kind = commits.schema[run].dataType.simpleString()
    start = F.array().cast(f"array<{kind}>")

    def step(held: Column, c: Column) -> Column:
        again = (F.size(held) > 0) & (F.get(held, F.size(held) - 1) == c["__run"])
        return F.when(c["__mode"] != "holes", F.array(c["__run"])).when(again, held).otherwise(F.concat(held, F.array(c["__run"])))

    return commits.groupBy(*key).agg(F.aggregate(ordered, start, step).alias("source_runs"))


def plan(rows: DataFrame, cell: list[str], tile: str, wanted: Column) -> DataFrame:
    """Cells with the sorted tiles to be redone."""
    return rows.filter(wanted).groupBy(*cell).agg(F.array_sort(F.collect_set(tile)).alias("tiles"))
