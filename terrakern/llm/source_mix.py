"""Mixing sources to target weights by Sainte-Lague apportionment.

Targets follow from the sources' sizes and weights.  The words of the mix are cut
into blocks of about BLOCK_WORDS (a shard of fewer words is one block); blocks go
to sources by highest quotients of their targets in blocks of their own size, and
a source's blocks to its shards in the same way, so that every shard has an
integer quota.  Within a shard, documents stand in a seeded order and their words are cut
into equal blocks; all blocks are taken as often as the quota allows, and a seeded
choice of them once more.

Whole documents are chosen to the same quota: every document of a shard as often
as the quota holds the shard, and some once more until its words are used up.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from terrakern.llm.common import WORD, releasing, stage

#: Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
#: A source is repeated at most so often.
MOST_REPEATS = 3
BLOCK_WORDS = 16
#: A shard aims at this many words, or more if there would be over MOST_SHARDS.
SHARD_WORDS = 1 << 18
MOST_SHARDS = 100_000
#: Sources (one aggregated row each) that the driver may hold; more raise an error.
MOST_SOURCES = 100_000


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, cap: int = MOST_REPEATS) -> list[float]:
    """Share sum(sizes) by weight; what is above ``cap`` times a source's size is reshared by weight."""
    left, open_ = float(sum(sizes)), list(range(len(sizes)))
    weight = [weights[k % len(weights)] for k in range(len(sizes))]
    out = [0.0] * len(sizes)
    while open_:
        rate = left / sum(weight[k] for k in open_)
        full = [k for k in open_ if weight[k] * rate >= cap * sizes[k]]
        if not full:
            for k in open_:
                out[k] = weight[k] * rate
            break
        for k in full:
            out[k] = float(cap * sizes[k])
            left -= out[k]
        open_ = [k for k in open_ if k not in set(full)]
    return out


def apportion(weights: np.ndarray, seats: int, caps: np.ndarray) -> np.ndarray:
    """Seats by highest quotients weight / (seats so far + 1/2), none above its cap.

    The divisor is found by bisection; the last few seats go one by one, ties to the
    earlier place.
    """
    weights, caps = np.asarray(weights, float), np.asarray(caps, np.int64)
    caps = np.where(weights > 0, caps, 0)
    seats = min(int(seats), int(caps.sum()))
    if seats <= 0:
        return np.zeros(len(weights), np.int64)
    given = lambda rate: np.minimum(np.floor(weights * rate + 0.5).astype(np.int64), caps)
    low, high = 0.0, (caps.max() + 1) / weights[weights > 0].min()
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if given(mid).sum() <= seats else (low, mid)
    out = given(low * (1 - 1e-12))
    heap = [(-weights[k] / (out[k] + 0.5), k) for k in np.flatnonzero(out < caps).tolist()]
    heapq.heapify(heap)
    for _ in range(seats - int(out.sum())):
        _, k = heap[0]
        out[k] += 1
        if out[k] < caps[k]:
            heapq.heapreplace(heap, (-weights[k] / (out[k] + 0.5), k))
        else:
            heapq.heappop(heap)
    return out


class Shard(NamedTuple):
    source: str | None
    shard: int
    blocks: int
    repeats: int
    more: int
    step: int
    offset: int


def _seeded(seed: int, source: str | None, shard: int) -> int:
    return int.from_bytes(hashlib.sha256(f"{seed}|{source!r}|{shard}".encode()).digest()[:8], "big")


def plan_shards(shards: list[tuple[str | None, int, int]], goal: dict[str | None, float], seed: int) -> list[Shard]:
    """Quota, and the choice of blocks that get one more, for each (source, shard, words)."""
    sources = list(goal)
    by_source: dict[str | None, list[tuple[int, int]]] = {s: [] for s in sources}
    for source, shard, words in sorted(shards, key=lambda x: x[1]):
        if words:
            by_source[source].append((shard, words))
    cut = {s: np.array([max(1, round(w / BLOCK_WORDS)) for _, w in by_source[s]], np.int64) for s in sources}
    wanted = np.array([goal[s] * cut[s].sum() / max(1, sum(w for _, w in by_source[s])) for s in sources])  # blocks of the source's own size
    seats = apportion(wanted, round(wanted.sum()), np.array([MOST_REPEATS * cut[s].sum() for s in sources]))
    out = []
    for source, given in zip(sources, seats.tolist(), strict=True):
        quotas = apportion(cut[source], given, MOST_REPEATS * cut[source]) if by_source[source] else []
        for (shard, _), blocks, quota in zip(by_source[source], cut[source].tolist(), list(map(int, quotas)), strict=True):
            draw = _seeded(seed, source, shard)
            step = draw % blocks or 1
            while math.gcd(step, blocks) != 1:
                step += 1
            out.append(Shard(source, shard, blocks, quota // blocks, quota % blocks, step, (draw >> 32) % blocks))
    return out


def _taken(docs: DataFrame, carry: list[str], id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """``row`` (the carried columns), size, source_size, target, taken, and the source, shard and order that the row stands in."""
    spark = docs.sparkSession
    rows = stage(
        docs.select(
            F.struct(*[F.col(c) for c in carry]).alias("row"),
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ),
        "mix",
    )
    found = rows.groupBy("source").agg(F.sum("size").alias("size")).limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    sizes = {r["source"]: r["size"] for r in sorted(found, key=lambda r: (r["source"] is None, r["source"] or ""))}
    goal = dict(zip(sizes, targets(list(sizes.values())), strict=True))
    aim = max(SHARD_WORDS, -(-sum(sizes.values()) // MOST_SHARDS))
    count = {s: max(1, -(-n // aim)) for s, n in sizes.items()}
    per_source = [(s, sizes[s], goal[s], count[s]) for s in sizes]
    source_type = docs.schema[source_col].dataType
    fields = [T.StructField("s", source_type), T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType()), T.StructField("shards", T.LongType())]
    known = F.broadcast(spark.createDataFrame(per_source, T.StructType(fields)))
    order = F.xxhash64(F.lit(seed), F.col("id").cast("string"), F.col("size"))
    dealt = rows.join(known, rows["source"].eqNullSafe(known["s"])).drop("s").withColumn("order", order).withColumn("shard", F.pmod(F.xxhash64("order"), "shards"))
    by_shard = [(r["source"], r["shard"], r["size"]) for r in dealt.groupBy("source", "shard").agg(F.sum("size").alias("size")).collect()]
    plan = plan_shards(by_shard, goal, seed)
    fields = [T.StructField("s", source_type), *[T.StructField(n, T.LongType()) for n in ("h", "blocks", "repeats", "more", "step", "offset")]]
    quotas = F.broadcast(spark.createDataFrame([tuple(p) for p in plan], T.StructType(fields)))
    within = Window.partitionBy("source", "shard")
    placed = dealt.withColumn("shard_size", F.sum("size").over(within)).withColumn("end", F.sum("size").over(within.orderBy("order", "id", "size").rowsBetween(Window.unboundedPreceding, 0)))
    joined = placed.join(quotas, placed["source"].eqNullSafe(quotas["s"]) & (placed["shard"] == quotas["h"]), "left")
    extra = F.expr(
        """aggregate(
            sequence(((end - size + 1) * blocks - 1) div shard_size, (end * blocks - 1) div shard_size),
            0L,
            (sum, j) -> sum + if(
                pmod(step * j + offset, blocks) < more,
                least(end, ((j + 1) * shard_size) div blocks) - greatest(end - size, (j * shard_size) div blocks),
                0L))"""
    )
    taken = F.when((F.col("size") > 0) & F.col("blocks").isNotNull(), F.col("repeats") * F.col("size") + extra).otherwise(F.lit(0)).cast("long")
    return joined.select("row", "size", "source_size", "target", taken.alias("taken"), "source", "shard", "order")


def mix(docs: DataFrame, carry: list[str], id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7) -> DataFrame:
    """The ``carry`` columns of every row with size, source_size (long), target (double), taken (long).

    ``size`` counts words (0 for a null or empty text), ``taken`` the words that the
    mix takes from the row, repeats counted, at most 3 times its size.  Null sources
    are one source, the last; null ids and repeated rows count like others; an empty
    table gives an empty result; carried columns travel in a struct, so names cannot
    clash.  Only one row per source and per shard comes to the driver: more than
    MOST_SOURCES sources raise ValueError, shards grow with the input instead of
    exceeding MOST_SHARDS beyond one per source.
    """
    rows = _taken(docs, carry, id_col, text_col, source_col, seed)
    clash = {"size", "source_size", "target", "taken"}
    return rows.select(*[F.col("row")[c].alias(c) for c in carry if c not in clash], "size", "source_size", "target", "taken")


def whole_times(sizes: np.ndarray, orders: np.ndarray, words: int) -> np.ndarray:
    """How often each document of a shard is kept whole, so that the words kept come to ``words``.

    All are kept ``words // sum(sizes)`` times and some once more.  These are dealt
    from the longest document down, so that the short ones make up what the long ones
    leave: a document that fits goes in when the words owed so far exceed a seeded
    part of its size, or when the rest could not fill the quota without it.  One that
    doesn't fit goes in only if the rest cannot fill the quota, by a seeded draw with
    which the words expected are the quota.
    """
    whole = int(sizes.sum())
    out = np.zeros(len(sizes), np.int64)
    if not whole:
        return out
    repeats, need = divmod(int(words), whole)
    out[sizes > 0] = repeats
    share, owed, rest = need / whole, 0.0, whole
    for k in np.lexsort((orders, -sizes)).tolist():
        size = int(sizes[k])
        if need <= 0 or not size:
            break
        rest -= size
        owed += share * size
        draw = (_seeded(int(orders[k]), None, 0) >> 11) / (1 << 53)
        if size <= need:
            more = rest < need or owed > draw * size
        else:
            more = rest < need and draw * (size - rest) < need - rest
        if more:
            out[k] += 1
            need -= size
            owed -= size
    return out


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7) -> DataFrame:
    """The rows of ``docs``, each as often as ``whole_times`` says for the words that the mix takes from its shard.

    The words of a shard's whole documents differ from its quota by less than a
    document that is shorter than those chosen before it, usually its shortest.  Rows
    without words are left out.
    """
    doc = F.struct(*[F.col(c) for c in docs.columns]).alias("__doc")
    taken = _taken(docs.select(doc, F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(source_col).alias("source")), ["__doc"], "id", "text", "source", seed)
    keyed = stage(taken.filter("size > 0").select("row", "size", "taken", "source", "shard", "order").withColumn("key", F.monotonically_increasing_id()), "mix-taken")

    def choose(shard: pa.Table) -> pa.Table:
        times = whole_times(shard["size"].to_numpy(), shard["order"].to_numpy(), int(shard["taken"].to_numpy().sum()))
        kept = np.flatnonzero(times)
        return pa.table({"key": shard["key"].take(pa.array(kept)), "times": pa.array(times[kept], pa.int32())})

    shards = keyed.select("key", "size", "taken", "source", "shard", "order").groupBy("source", "shard")
    times = stage(shards.applyInArrow(releasing(choose), "key long, times int"), "mix-times")
    repeated = keyed.join(times, "key").select("row", F.explode(F.sequence(F.lit(1), "times")).alias("time"))
    return repeated.select(*[F.col("row")["__doc"][c].alias(c) for c in docs.columns])
