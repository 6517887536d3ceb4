"""Approximate nearest neighbours by inner product: a permutation index.

Each vector is represented by the order of its PREFIX nearest pivots and posted,
with the pivot's rank, in those pivots' inverted files.  A query walks the files of
its own nearest pivots, which gives every candidate's footrule distance; the
nearest are reranked by exact inner product, a number that grows more slowly than
the table.

Vectors are lifted by one coordinate to a common length (x / M, sqrt(1 - |x/M|^2)),
so that nearness of directions is nearness by inner product.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Pivots are drawn from a bounded sample (the DRAWN vectors of least id hash); how many of them order a vector.
DRAWN, PIVOTS, PREFIX = 2048, 256, 64
#: Of n vectors, RERANKED * n ** POWER are reranked for a query, dealt over the shards by their sizes.
RERANKED, POWER = 1.67, 0.75
#: Rows of a shard grow with the table so that there are about MOST_SHARDS, within these bounds.
SHARD_ROWS, MOST_SHARD_ROWS, MOST_SHARDS = 4096, 1 << 17, 64
QUERY_BLOCK = 1024


class Index(NamedTuple):
    """A shard: distinct vectors with their smallest ids, ranks, and the pivots' inverted files."""

    vectors: np.ndarray
    ids: list[np.ndarray]
    posted: list[np.ndarray]
    ranks: list[np.ndarray]


def lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    scaled = vectors / longest
    rest = np.sqrt(np.maximum(1 - (scaled * scaled).sum(axis=1), 0))
    return np.concatenate((scaled, rest[:, None]), axis=1)


def orders(lifted_vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` nearest pivots of each vector, nearest first, ties to the earlier pivot."""
    near = lifted_vectors @ pivots.T
    return np.argsort(-near, axis=1, kind="stable")[:, :prefix]


def spread(sample: np.ndarray, count: int) -> np.ndarray:
    """``count`` of the sample's vectors, each as far as can be from those before: near copies give one pivot."""
    chosen, nearest_yet = [0], sample @ sample[0]
    while len(chosen) < min(count, len(sample)):
        chosen.append(int(np.argmin(nearest_yet)))
        nearest_yet = np.maximum(nearest_yet, sample @ sample[chosen[-1]])
    return sample[chosen]


def build(ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, longest: float, keep: int, prefix: int = PREFIX) -> Index:
    """Index a shard; equal vectors are one entry with their ``keep`` smallest ids."""
    distinct, back = np.unique(vectors, axis=0, return_inverse=True)
    back = back.ravel()
    order = np.lexsort((ids, back))
    groups = np.split(ids[order], np.searchsorted(back[order], np.arange(1, len(distinct))))
    nearest = orders(lifted(distinct, longest), pivots, prefix)
    at = nearest.ravel()
    row, rank = np.repeat(np.arange(len(distinct)), nearest.shape[1]), np.tile(np.arange(nearest.shape[1]), len(distinct))
    by_pivot = np.argsort(at, kind="stable")
    cuts = np.searchsorted(at[by_pivot], np.arange(1, len(pivots)))
    return Index(distinct, [np.unique(g)[:keep] for g in groups], np.split(row[by_pivot], cuts), np.split(rank[by_pivot].astype(np.int32), cuts))


def footrule(index: Index, order: np.ndarray, prefix: int) -> np.ndarray:
    """Footrule distance from a pivot order to every entry; a pivot that is not posted has rank ``prefix``."""
    gain = np.zeros(len(index.vectors), np.int32)
    for rank, pivot in enumerate(order.tolist()):
        posted, ranks = index.posted[pivot], index.ranks[pivot]
        # of both missing ranks' cost, what this posting saves
        gain[posted] += (prefix - rank) + (prefix - ranks) - np.abs(ranks - rank)
    return prefix * (prefix + 1) - gain


def search(index: Index, queries: np.ndarray, query_ids: np.ndarray, pivots: np.ndarray, longest: float, k: int, share: float, prefix: int = PREFIX) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its ``k`` best found: (query id, ids, scores), nearest first, ties to the smaller id.

    The ``share`` of entries that is nearest by footrule is reranked, at least ``k`` + 1.
    """
    count = len(index.vectors)
    budget = min(count, max(k + 1, int(np.ceil(share * count))))
    # a query is compared by direction alone, so its own length doesn't matter
    unit = queries / np.sqrt((queries * queries).sum(axis=1))[:, None]
    near = orders(np.concatenate((unit, np.zeros((len(unit), 1))), axis=1), pivots, prefix)
    for q, own, order in zip(queries, query_ids.tolist(), near, strict=True):
        found = np.argpartition(footrule(index, order, prefix), budget - 1)[:budget]
        rough = index.vectors[found] @ q
        if len(found) > k + 1:
            edge = np.partition(rough, -(k + 1))[-(k + 1)]
            found = found[rough >= edge - 1e-9 * max(1.0, abs(edge))]
        exact = (index.vectors[found] * q).sum(axis=1)
        ids = [index.ids[e] for e in found.tolist()]
        flat = np.concatenate(ids)
        scores = np.repeat(exact, [len(i) for i in ids])
        other = flat != own
        flat, scores = flat[other], scores[other]
        best = np.lexsort((flat, -scores))[:k]
        yield own, flat[best], scores[best]


def usable(vector: Column) -> Column:
    """Not null, not zero, no null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Return ``query_id, rank, id_col, score``: the ``k`` best of each row whose id is divisible by ``every``.

    Candidates are all rows but those with the query's id; equal scores go to the
    smaller id.  Vectors shorter than the longest count as if zeros followed.  Rows with
    a null id or a vector that is null, zero or has a null or non-finite component take no part; rows with
    one id and one vector count once.  An empty table gives an empty result; other
    columns are not read.  Every row is indexed: each block of queries meets each
    shard once, and only ``k`` results of a query and shard are shuffled again.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.transform(vector_col, lambda x: x.cast("double")).alias("v")).filter(F.col("id").isNotNull() & usable(F.col("v")))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    most = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("size"), F.max(length).alias("longest"), F.count_if(F.col("id") % every == 0).alias("queries")).first()
    out = "query_id long, id long, score double"
    if not most["queries"]:
        return spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score double")
    count, longest = most["n"], most["longest"]
    rows = rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), F.lit(most["size"]) - F.size("v"))))
    share = min(1.0, RERANKED * count ** (POWER - 1))
    drawn = rows.orderBy(F.xxhash64(F.lit(3), F.col("id")), "id", "v").limit(DRAWN).select("v").collect()
    pivots = spread(lifted(np.unique(np.array([r["v"] for r in drawn], float), axis=0), longest), PIVOTS)
    prefix = min(PREFIX, len(pivots))
    shard_rows = min(MOST_SHARD_ROWS, max(SHARD_ROWS, -(-count // MOST_SHARDS)))
    shards, blocks = -(-count // shard_rows), -(-most["queries"] // QUERY_BLOCK)
    sent = spark.sparkContext.broadcast((pivots, longest))

    def run(entries: pa.Table, queries: pa.Table) -> pa.Table:
        names = {"query_id": pa.int64(), "id": pa.int64(), "score": pa.float64()}
        pivots, longest = sent.value
        if not entries.num_rows or not queries.num_rows:
            return pa.schema(list(names.items())).empty_table()
        index = build(entries.column("id").to_numpy(), _matrix(entries), pivots, longest, k + 1, prefix)
        found = list(search(index, _matrix(queries), queries.column("id").to_numpy(), pivots, longest, k, share, prefix))
        columns = [np.repeat([q for q, _, _ in found], [len(i) for _, i, _ in found]), np.concatenate([i for _, i, _ in found]), np.concatenate([s for _, _, s in found])]
        return pa.table({n: pa.array(c, t) for (n, t), c in zip(names.items(), columns, strict=True)})

    shard, block = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(shards)).cast("int"), F.pmod(F.xxhash64("id", F.lit(6)), F.lit(blocks)).cast("int")
    entries = rows.select(shard.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(int(blocks) - 1))).alias("block"), "id", "v")
    queries = rows.filter(F.col("id") % every == 0).select(F.explode(F.sequence(F.lit(0), F.lit(int(shards) - 1))).alias("shard"), block.alias("block"), "id", "v")
    found = entries.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block")).applyInArrow(run, out)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table.column("v").combine_chunks().flatten().to_numpy()
    return flat.reshape(table.num_rows, -1)
