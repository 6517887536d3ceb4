"""Ordered and greedy decisions per group."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def band_windows(boxes: np.ndarray, cost: float = 200.0, cap: float = 120.0) -> np.ndarray:
    """Window number of each band (rows west, east, top, bottom; all ends included), in order.

    A window is a run of neighbouring bands and is read as their bounding box, the rows between them too.  Of all cuts
    the one of least ``cost`` per window plus area is taken; several bands together may not exceed ``cap``.  Equal
    costs go to the shorter last window.
    """
    boxes = np.asarray(boxes, np.int64).reshape(-1, 4)
    upto, begin = np.zeros(len(boxes) + 1), np.zeros(len(boxes), np.int64)
    for last in range(len(boxes)):
        # bounding boxes of the bands first..last for every first, shortest run first
        back = boxes[last::-1]
        wide = np.maximum.accumulate(back[:, 1]) - np.minimum.accumulate(back[:, 0]) + 1
        high = np.maximum.accumulate(back[:, 3]) - np.minimum.accumulate(back[:, 2]) + 1
        area = (wide * high).astype(float)
        total = upto[last::-1] + cost + area
        total[1:][area[1:] > cap] = np.inf
        size = int(np.argmin(total))
        upto[last + 1], begin[last] = total[size], last - size
    starts, at = [], len(boxes)
    while at:
        at = int(begin[at - 1])
        starts.append(at)
    return np.searchsorted(np.array(starts[::-1], np.int64), np.arange(len(boxes)), "right") - 1


def band_plan(bands: DataFrame, by: list[str], order: str) -> DataFrame:
    """Add ``window`` to bands (west, east, top, bottom) of each group; a group's bands are few."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        return pdf.assign(window=band_windows(pdf[["west", "east", "top", "bottom"]].to_numpy()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in bands.schema) + ", window int"
    return bands.groupBy(*by).applyInPandas(run, schema)


def budget_batches(items: Column, weight: str, budget: float, slots: int) -> Column:
    """Batch number of each of an array of structs in order, as one fold.

    A weighty item opens a new batch when the open one has no slot left or would pass the budget; weightless items
    ride along without a slot.
    """
    start = F.struct(F.lit(0).alias("batch"), F.lit(0.0).alias("used"), F.lit(0).alias("taken"), F.array().cast("array<int>").alias("out"))

    def step(state: Column, item: Column) -> Column:
        w = item[weight].cast("double")
        weighty = w != 0
        full = weighty & (F.size(state["out"]) > 0) & ((state["taken"] >= slots) | (state["used"] + w > budget))
        batch = state["batch"] + full.cast("int")
        return F.struct(
            batch.alias("batch"),
            (F.when(full, 0.0).otherwise(state["used"]) + w).alias("used"),
            (F.when(full, 0).otherwise(state["taken"]) + weighty.cast("int")).alias("taken"),
            F.concat(state["out"], F.array(batch)).alias("out"),
        )

    return F.aggregate(items, start, step, lambda state: state["out"])


def batched(rows: DataFrame, by: list[str], order: list[str], weight: str, budget: float, slots: int) -> DataFrame:
    """Add ``batch`` to the rows (by, order, weight) of each group."""
    listed = rows.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(*order, weight))).alias("__items"))
    numbered = F.arrays_zip(F.col("__items").alias("item"), budget_batches(F.col("__items"), weight, budget, slots).alias("batch"))
    return listed.select(*by, F.explode(numbered).alias("x")).select(*by, "x.item.*", "x.batch")


def lightest_first(weights: list[float], clusters: int) -> list[int]:
    """Cluster of each item: heaviest first, to the first lightest cluster."""
    heap = [(0.0, k) for k in range(clusters)]
    out = [0] * len(weights)
    for i in sorted(range(len(weights)), key=lambda k: -weights[k]):
        load, k = heapq.heappop(heap)
        out[i] = k
        heapq.heappush(heap, (load + weights[i], k))
    return out


def per_group(rows: DataFrame, by: list[str], order: list[str], weight: str, name: str, decide) -> DataFrame:
    """Add ``decide(weights in order)`` as the integer column ``name``, group by group."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        return pdf.assign(**{name: decide(pdf[weight].tolist())})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", `{name}` int"
    return rows.groupBy(*by).applyInPandas(run, schema)
