"""Log and fleet analytics: bins, runs, alerts, rates, thinning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def bins(rows: DataFrame, ts: str, width: str, by: list[str], aggregates: list[Column]) -> DataFrame:
    """Tumbling bins aligned to the epoch."""
    binned = rows.withColumn("bin", F.window(F.col(ts), width)["start"])
    return binned.groupBy("bin", *by).agg(*aggregates)


def sustained(value: Column, at_least: float, last: int, by: list[str], order: list[str]) -> Column:
    """Whether the last ``last`` values all reach the threshold (never before there are so many)."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(-(last - 1), 0)
    return (F.count(F.lit(1)).over(w) >= last) & (F.min(value).over(w) >= at_least)


def rising(rows: DataFrame, value: str, steps: int, by: list[str], order: list[str], name: str) -> DataFrame:
    """Add whether the last ``steps`` steps were all strictly upward."""
    w = Window.partitionBy(*by).orderBy(*order)
    up = rows.withColumn("__up", F.coalesce((F.col(value) > F.lag(value).over(w)).cast("int"), F.lit(0)))
    return up.withColumn(name, F.sum("__up").over(w.rowsBetween(-(steps - 1), 0)) == steps).drop("__up")


def islands(rows: DataFrame, value: str, by: list[str], order: list[str]) -> DataFrame:
    """Runs of equal values: first and last place and length of each."""
    w = Window.partitionBy(*by).orderBy(*order)
    marked = rows.withColumn("__new", F.coalesce((F.col(value) != F.lag(value).over(w)).cast("int"), F.lit(1)))
    return marked.withColumn("island", F.sum("__new").over(w)).drop("__new")


def thinned(rows: DataFrame, by: list[str], order: str, value: str, phase: str, least: float) -> DataFrame:
    """Keep a sample if it differs from the last kept one by ``least`` or in phase: a fold, not a lag."""
    items = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v"), F.col(phase).alias("p"))))
    item = f"struct<o:{rows.schema[order].dataType.simpleString()},v:{rows.schema[value].dataType.simpleString()},p:{rows.schema[phase].dataType.simpleString()}>"

    def step(kept: Column, x: Column) -> Column:
        last = F.get(kept, F.size(kept) - 1)
        keep = (F.size(kept) == 0) | (F.abs(x["v"] - last["v"]) >= least) | (x["p"] != last["p"])
        return F.when(keep, F.concat(kept, F.array(x))).otherwise(kept)

    folded = rows.groupBy(*by).agg(F.aggregate(items, F.array().cast(f"array<{item}>"), step).alias("__kept"))
    return folded.select(*by, F.explode("__kept").alias("x")).select(*by, F.col("x.o").alias(order), F.col("x.v").alias(value), F.col("x.p").alias(phase))


def exact_percentiles(df: DataFrame, keys: list[str], value: str, wanted: dict[str, float], accuracy: int = 10000) -> DataFrame:
    """Interpolated percentiles of each group, exact without holding a group's values in one task.

    A sketch, off by at most 1 / ``accuracy`` of the ranks, brackets each percentile at four times that (groups
    of at most ``accuracy`` values are a bracket as a whole); only the
    distinct values inside the brackets are counted and ranked, with the number of
    values below added.  Null values take no part; a group of nulls has null results.
    """
    names, near = list(wanted), 4 / accuracy
    ends = [min(max(p + s * near, 0.0), 1.0) for p in wanted.values() for s in (-1, 1)]
    sketch = F.percentile_approx(value, F.array(*map(F.lit, ends)), F.lit(accuracy))
    bounds = df.groupBy(*keys).agg(F.count(value).alias("__n"), sketch.alias("__q"), F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    small = F.col("__n") <= accuracy
    lo = lambda i: F.when(small | F.lit(ends[2 * i] == 0), F.col("__lo")).otherwise(F.col("__q")[2 * i])
    hi = lambda i: F.when(small | F.lit(ends[2 * i + 1] == 1), F.col("__hi")).otherwise(F.col("__q")[2 * i + 1])
    brackets = bounds.select(*keys, "__n", *[c.alias(f"__{s}{i}") for i in range(len(names)) for s, c in (("lo", lo(i)), ("hi", hi(i)))])
    joined = df.select(*keys, value).join(brackets, keys) if keys else df.select(value).crossJoin(F.broadcast(brackets))  # one row
    v = F.col(value)
    kept = joined.withColumn("__v", F.when(sum([v.between(F.col(f"__lo{i}"), F.col(f"__hi{i}")).cast("int") for i in range(len(names))], F.lit(0)) > 0, v))
    # values outside the brackets are counted in one row for each gap that they fall in
    gap = sum([(v > F.col(f"__hi{i}")).cast("int") for i in range(len(names))], F.lit(0))
    counted = kept.filter(v.isNotNull()).groupBy(*keys, gap.alias("__gap"), "__v").agg(F.count("*").alias("__c"), F.min(value).alias("__at"), F.first("__n").alias("__n"))
    before = F.sum("__c").over(Window.partitionBy(*keys).orderBy("__at"))
    ranked = counted.withColumn("__to", before)
    found = []
    for name, p in wanted.items():
        place = (F.col("__n") - 1) * p
        at = lambda r: F.min(F.when(F.col("__to") > r, F.col("__at")))
        low, high, part = at(F.floor(place)), at(F.ceil(place)), F.max(place - F.floor(place))
        found.append((low + (high - low) * part).alias(name))
    out = ranked.groupBy(*keys).agg(*found)
    return df.select(*keys).distinct().join(out, keys, "left") if keys else out
