"""Near-duplicate classes: improved consistent weighted sampling over TF-IDF shingles.

1. Document frequencies are counted exactly for every shingle in more than a RARE-th
   of all documents; there are at most RARE times the mean number of shingles of a
   document of them.  A count-min sketch of fixed size, which never counts too low,
   first tells which shingles can be so frequent, and only those are shuffled.
2. Each text gets BANDS x ROWS consistent weighted samples.  Equal word sequences
   become one node; nodes with an equal band are candidates.
3. In every band bucket each node is compared with the bucket's smallest by weighted
   Jaccard similarity; links make classes.
4. Buckets that still hold several classes are settled exactly: every node outside
   the bucket's largest class is compared with all nodes of other classes, in chunks.

The weight of a shingle is tf * log(1 + min(N / df, RARE)) ** DAMPING.  The damping
keeps what a large group of near copies shares, which is frequent, from being
outweighed by the rare shingles in which its members differ.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrakern.llm.common import arrow_schema, bounded_batches, release_memory, releasing, stage

WORDS, SIMILARITY = 5, 0.8
#: A pair of similarity 0.8 shares a band with probability 1 - (1 - 0.8 ** ROWS) ** BANDS = 0.99996.
BANDS, ROWS = 14, 3
RARE, DAMPING = 1024, 0.25
COUNTERS, SLICES = 1 << 20, 16
#: Vectors that meet in one task at most, beside what they are compared with.
CHUNK = 2000
#: Narrow rows of a bucket that meet in one task.
SPLIT = 256
GROUP_CHARS = 1 << 18
#: Shingle weights that are sampled at once.
SAMPLED = 1 << 17

_MUL = np.uint64(0x9E3779B97F4A7C15)
_K = [np.uint64(k) for k in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _K[0]
    h = (h ^ (h >> np.uint64(27))) * _K[1]
    return h ^ (h >> np.uint64(31))


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the text, shingle hash and count, sorted by both; a text of 1 to 4 words is one shingle."""
    coded = [t.encode() for t in texts]
    data = np.frombuffer(b"\n".join(coded), np.uint8)
    sizes = np.fromiter(map(len, coded), np.int64, len(coded)) + 1
    change = np.flatnonzero(np.diff(np.concatenate(([False], ~_SPACE[data], [False])).astype(np.int8)))
    starts, stops = change[::2], change[1::2]
    n = np.diff(np.searchsorted(starts, np.concatenate(([0], np.cumsum(sizes)))))
    owner = np.repeat(np.arange(len(texts)), n)
    # hash of each word: sum of byte * mul^place, moved back to place 0
    powers = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(len(data), _MUL))))
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1])))
    back = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(len(data), np.uint64(pow(int(_MUL), -1, 1 << 64))))))
    word = _mixed((prefix[stops] - prefix[starts]) * back[starts] + (stops - starts).astype(np.uint64))
    first = np.concatenate(([0], np.cumsum(n)))[:-1]
    h = np.zeros(len(word), np.uint64)
    left = (first + n)[owner] - np.arange(len(word))  # words from here to the end of the text
    for k in range(WORDS):
        at = np.flatnonzero(left > k)
        h[at] = (h[at] + word[at + k] + np.uint64(k + 1)) * _MUL
    whole = (left >= WORDS) | ((n[owner] < WORDS) & (left == n[owner]))
    owner, h = owner[whole], _mixed(h[whole])
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1]))) if len(h) else np.zeros(0, np.int64)
    return owner[new], h[new], np.diff(np.append(new, len(h)))


def sequence_keys(texts: list[str]) -> np.ndarray:
    """Two hashes of each text's word sequence."""
    import hashlib

    digests = [hashlib.blake2b(b" ".join(t.encode().split()), digest_size=16).digest() for t in texts]
    return np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)


def counter_places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A shingle's counter in either row."""
    return (h % np.uint64(COUNTERS)).astype(np.int64), ((h >> np.uint64(32)) * _K[2] >> np.uint64(44)).astype(np.int64) % COUNTERS


def frequent(docs: DataFrame, text_col: str, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and document frequencies of the shingles in more than count / RARE documents.

    The sketch's counters over that (a bitmap of fixed size) come to the driver and go
    to all tasks; then the shingles whose counters are all over it are counted
    exactly.  At most RARE times the mean number of shingles per document are left.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, used = np.zeros((2, COUNTERS), np.int64), False
        for batch in batches:
            for texts in grouped(batch.column(0).to_pylist()):
                _, h, _ = shingles(texts)
                used = used or bool(len(h))
                for row, places in enumerate(counter_places(h)):
                    sketch[row] += np.bincount(places, minlength=COUNTERS)
        if used:
            parts = sketch.reshape(2 * SLICES, -1)
            small = parts.max() < 1 << 16
            blobs = [p.astype(np.uint16 if small else np.int64).tobytes() for p in parts]
            yield pa.RecordBatch.from_arrays([pa.array(range(2 * SLICES), pa.int32()), pa.array(blobs, pa.binary())], ["part", "counts"])
        del sketch
        release_memory()

    wide = 2 * COUNTERS // (2 * SLICES)

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(wide, np.int64)
        for batch in batches:
            for blob in batch.column("counts").to_pylist():
                total += np.frombuffer(blob, np.uint16 if len(blob) == 2 * wide else np.int64)
        over = np.packbits(total * RARE > count).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([over], pa.binary())], ["part", "over"])

    texts = docs.select(F.col(text_col).alias("text"))
    sent = texts.mapInArrow(add, "part int, counts binary")
    over = np.zeros((2 * SLICES, wide), bool)
    for r in sent.groupBy("part").applyInArrow(merge, "part int, over binary").collect():
        over[r["part"]] = np.unpackbits(np.frombuffer(r["over"], np.uint8), count=wide)
    maps = docs.sparkSession.sparkContext.broadcast(np.packbits(over.reshape(2, COUNTERS), axis=1))

    def count_exactly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [np.unpackbits(m, count=COUNTERS).astype(bool) for m in maps.value]
        for batch in batches:
            for texts in grouped(batch.column(0).to_pylist()):
                _, h, _ = shingles(texts)
                first, second = counter_places(h)
                found, n = np.unique(h[bits[0][first] & bits[1][second]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n, pa.int64())], ["hash", "n"])
        release_memory()

    counted = texts.mapInArrow(count_exactly, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")).filter(F.col("n") * RARE > count).toArrow()
    hashes, n = counted.column("hash").to_numpy().view(np.uint64), counted.column("n").to_numpy()
    order = np.argsort(hashes)
    return hashes[order], n[order]


def grouped(texts: list[str | None]) -> Iterator[list[str]]:
    held, size = [], 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1])
        if size >= GROUP_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


class Weigher:
    """TF-IDF weights from the frequencies of frequent shingles."""

    def __init__(self, frequencies: tuple[np.ndarray, np.ndarray], count: int):
        self.hashes, self.n = frequencies
        self.count = count

    def weights(self, h: np.ndarray, tf: np.ndarray) -> np.ndarray:
        share = np.full(len(h), float(RARE))
        if len(self.hashes):
            near = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            hit = np.flatnonzero(self.hashes[near] == h)
            share[hit] = np.minimum(self.count / self.n[near[hit]], RARE)
        return (tf * np.log1p(share) ** DAMPING).astype(np.float32)


def _uniform(bits: np.ndarray) -> np.ndarray:
    return (bits & np.uint64(0xFFFFF)).astype(np.float32) * np.float32(2**-20) + np.float32(2**-21)


def samples(owner: np.ndarray, h: np.ndarray, weights: np.ndarray, texts: int) -> np.ndarray:
    """BANDS * ROWS consistent weighted samples of each text, as hashes of (shingle, t); 0 without shingles."""
    draws = BANDS * ROWS
    out = np.zeros((texts, draws), np.uint64)
    for a, b in _even_cuts(owner):
        own, part, log_s = owner[a:b], h[a:b], np.log(weights[a:b])
        firsts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        lengths = np.diff(np.append(firsts, len(own)))
        for j in range(draws):
            one = _mixed(part + np.uint64((2 * j + 1) * int(_K[3]) % (1 << 64)))
            two = one * _K[2]
            two ^= two >> np.uint64(29)
            r = -np.log(_uniform(one) * _uniform(one >> np.uint64(20)))
            c = -np.log(_uniform(two) * _uniform(two >> np.uint64(20)))
            beta = _uniform(two >> np.uint64(42))
            t = np.floor(log_s / r + beta)
            log_a = np.log(c) - r * (t - beta + np.float32(1))
            least = np.minimum.reduceat(log_a, firsts)
            hit = np.flatnonzero(log_a == np.repeat(least, lengths))
            hit = hit[np.append(True, own[hit[1:]] != own[hit[:-1]])]
            out[own[hit], j] = _mixed(part[hit] ^ (t[hit].astype(np.int64).astype(np.uint64) * _MUL))
    return out


def _even_cuts(owner: np.ndarray) -> Iterator[tuple[int, int]]:
    """Slices of whole texts, about SAMPLED shingles each."""
    at = 0
    while at < len(owner):
        end = min(at + SAMPLED, len(owner))
        if end < len(owner):
            end = int(np.searchsorted(owner, owner[end - 1], "right"))
        yield at, end
        at = end


def band_keys(sampled: np.ndarray) -> np.ndarray:
    """One signed 64-bit key per band; 0 for a text without shingles."""
    keys = np.zeros((len(sampled), BANDS), np.uint64)
    for k in range(ROWS):
        keys = _mixed(keys + sampled.reshape(-1, BANDS, ROWS)[:, :, k] * _MUL)
    keys = _mixed(keys + np.arange(1, BANDS + 1, dtype=np.uint64) * _K[0])
    keys[~sampled.any(axis=1)] = 0
    return keys.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], many_h: np.ndarray, many_w: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of one vector with each of many (ragged)."""
    h, w = a
    at = np.minimum(np.searchsorted(h, many_h), max(len(h) - 1, 0))
    common = np.where(h[at] == many_h, np.minimum(w[at], many_w), 0.0) if len(h) else np.zeros(len(many_h))
    edges = np.concatenate(([0], np.cumsum(sizes)))
    total = np.concatenate(([0.0], np.cumsum(common, dtype=np.float64)))
    weight = np.concatenate(([0.0], np.cumsum(many_w, dtype=np.float64)))
    inter = total[edges[1:]] - total[edges[:-1]]
    union = float(w.sum(dtype=np.float64)) + weight[edges[1:]] - weight[edges[:-1]] - inter
    return np.where(union > 0, inter / np.maximum(union, 1e-30), 1.0)


def _packed(h: np.ndarray, w: np.ndarray) -> bytes:
    """A vector: a flag, then 40-bit hashes, then weights (one if all are equal)."""
    flat = len(w) > 0 and bool((w == w[0]).all())
    five = np.ascontiguousarray((h >> np.uint64(24)).view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()
    return (b"\1" if flat else b"\0") + (w[:1] if flat else w).astype("<f4").tobytes() + five


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    if len(blob) <= 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.float32)
    if blob[0]:
        n = (len(blob) - 5) // 5
        w, at = np.full(n, np.frombuffer(blob, "<f4", 1, 1)[0]), 5
    else:
        n = (len(blob) - 1) // 9
        w, at = np.frombuffer(blob, "<f4", n, 1), 1 + 4 * n
    h = np.zeros((n, 8), np.uint8)
    h[:, :5] = np.frombuffer(blob, np.uint8, 5 * n, at).reshape(-1, 5)
    return h.view(np.uint64).ravel(), w


def _ragged(blobs: list[bytes]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray, np.ndarray]:
    vectors = [_unpacked(b) for b in blobs]
    sizes = np.array([len(h) for h, _ in vectors], np.int64)
    return vectors, np.concatenate([np.zeros(0, np.uint64), *[h for h, _ in vectors]]), np.concatenate([np.zeros(0, np.float32), *[w for _, w in vectors]]), sizes


def _links(a: list[int], b: list[int]) -> pa.Table:
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _verify_star(leaders: pa.Table, members: pa.Table) -> pa.Table:
    if not leaders.num_rows or not members.num_rows:
        return _links([], [])
    leader = leaders.column("leader")[0].as_py()
    _, h, w, sizes = _ragged(members.column("vector").to_pylist())
    near = similarity(_unpacked(leaders.column("of_leader")[0].as_py()), h, w, sizes) >= SIMILARITY
    found = [m for m, ok in zip(members.column("member").to_pylist(), near.tolist(), strict=True) if ok]
    return _links([leader] * len(found), found)


def _verify_rest(probes: pa.Table, bases: pa.Table) -> pa.Table:
    """Links between a probe and the bases of other classes; one per probe and class is enough."""
    if not probes.num_rows or not bases.num_rows:
        return _links([], [])
    _, h, w, sizes = _ragged(bases.column("vector").to_pylist())
    ids, classes = bases.column("node").to_numpy(), bases.column("class").to_numpy()
    a, b = [], []
    for node, own, blob in zip(probes.column("node").to_pylist(), probes.column("class").to_pylist(), probes.column("vector").to_pylist(), strict=True):
        near = np.flatnonzero((similarity(_unpacked(blob), h, w, sizes) >= SIMILARITY) & (classes != own))
        _, first = np.unique(classes[near], return_index=True)
        a += [node] * len(first)
        b += ids[near[first]].tolist()
    return _links(a, b)


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable over the links (a, b): node, class, for every node of a link.

    Rounds of neighbour minimum and pointer jumping over staged tables; none comes
    to the driver but the number of changes.
    """
    both = stage(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stage(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("class")), "classes")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("class").alias("near")).withColumnRenamed("a", "node")
        lower = labels.join(near, "node").select("node", F.col("class").alias("old"), F.least("class", "near").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("class").alias("beyond"))
        # what a node's class has learnt from any of its nodes reaches all of them
        pulled = lower.groupBy(F.col("old").alias("to2")).agg(F.min("to").alias("least"))
        moved = lower.join(jump, "to", "left").join(pulled, F.col("old") == F.col("to2"), "left")
        moved = stage(moved.select("node", "old", F.least("to", "beyond", "least").alias("class")), "classes")
        labels = moved.select("node", "class")
        if moved.filter(F.col("old") != F.col("class")).isEmpty():
            return labels


def classes(docs: DataFrame, carry: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ``carry`` columns of every row with class_id: the smallest id of its near-duplicate class.

    Two different word sequences are linked if the weighted Jaccard similarity of
    their TF-IDF weighted 5-word shingles is at least 0.8; classes are connected
    components, and rows of equal words share a class.  A null text has no words;
    all texts without words are one class.  Rows with one id are one document; rows
    with a null id are classed by their words and get a negative class_id unless a
    row with an id is in the class.  An empty table gives an empty result; carried
    columns travel in a struct, so names cannot clash.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    count = docs.count()
    sent = spark.sparkContext.broadcast((frequent(docs, text_col, count), count))
    rows = docs.select(F.struct(*[F.col(c) for c in carry]).alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigher = Weigher(*sent.value)
        for batch in batches:
            keys, bands = [], []
            for texts in grouped(batch.column(2).to_pylist()):
                owner, h, tf = shingles(texts)
                bands.append(band_keys(samples(owner, h, weigher.weights(h, tf), len(texts))))
                keys.append(sequence_keys(texts))
            keys, bands = np.concatenate(keys) if keys else np.zeros((0, 2), np.int64), np.concatenate(bands) if bands else np.zeros((0, BANDS), np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(bands) + 1, dtype=np.int32) * BANDS), pa.array(bands.ravel()))
            columns = [batch.column(0), batch.column(1), pa.array(keys[:, 0]), pa.array(keys[:, 1]), lists]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            release_memory()

    row_type = rows.schema["row"].dataType.simpleString()
    ddl = f"row {row_type}, id long, k1 long, k2 long, bands array<long>"
    schema = arrow_schema(ddl)
    sketched = stage(rows.mapInArrow(sketch, ddl), "near-sketch")
    nodes = sketched.groupBy("k1", "k2").agg(F.min("id").alias("id"), F.first("bands").alias("bands"))
    nodes = stage(nodes.select("k1", "k2", F.coalesce("id", _without_id(F.col("k1"))).alias("node"), "bands"), "near-nodes")
    posted = nodes.select("node", F.explode("bands").alias("key")).filter(F.col("key") != 0)
    shared = posted.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("n"), F.expr("bit_xor(xxhash64(node))").alias("members")).filter(F.col("n") > 1)
    shared = stage(shared.groupBy("leader", "n", "members").agg(F.min("key").alias("key")), "near-buckets")  # one of buckets with the same nodes
    members = stage(posted.join(shared.select("key", "leader", "n"), "key").select("key", "leader", "node", F.ceil(F.col("n") / SPLIT).alias("parts")), "near-members")
    vectors = stage(_vectors(rows, members.select("node").distinct(), sent), "near-vectors")

    pairs = members.filter(F.col("leader") != F.col("node")).select("leader", F.col("node").alias("member")).distinct()
    chunks = pairs.groupBy("leader").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    chunk = lambda node: F.pmod(F.xxhash64(node), F.col("chunks"))
    right = pairs.join(chunks, "leader").select("leader", chunk(F.col("member")).alias("chunk"), "member")
    right = right.join(vectors.select(F.col("node").alias("member"), "vector"), "member").select(F.col("leader").alias("of"), F.col("chunk").alias("part"), "member", "vector")
    left = chunks.select("leader", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
    left = left.join(vectors.select(F.col("node").alias("leader"), F.col("vector").alias("of_leader")), "leader").select("leader", "chunk", "of_leader")
    star = stage(left.groupBy("leader", "chunk").cogroup(right.groupBy("of", "part")).applyInArrow(releasing(_verify_star), "a long, b long"), "near-links")
    found = components(star)

    # a bucket is cut into parts, so that its rows never meet in one task
    classed = members.join(found, "node", "left").select("key", "parts", F.pmod(F.xxhash64("node"), "parts").alias("piece"), "node", F.coalesce("class", "node").alias("class"))
    per_class = classed.groupBy("key", "parts", "class").agg(F.count("*").alias("n"))
    open_ = per_class.groupBy("key", "parts").agg(F.sum("n").alias("size"), F.count("*").alias("classes"), F.max(F.struct("n", "class")).alias("largest")).filter(F.col("classes") > 1)
    open_ = open_.select("key", F.ceil(F.col("size") / CHUNK).alias("chunks"), F.col("largest.class").alias("major"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("piece"))
    rest = classed.join(open_, ["key", "piece"]).join(vectors, "node")
    bases = rest.select(F.col("key").alias("of"), chunk(F.col("node")).alias("part"), F.col("node").alias("node"), F.col("class").alias("class"), F.col("vector").alias("vector"))
    probes = rest.filter(F.col("class") != F.col("major")).select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), "node", "class", "vector")
    late = stage(probes.groupBy("key", "chunk").cogroup(bases.groupBy("of", "part")).applyInArrow(releasing(_verify_rest), "a long, b long"), "near-links")
    if not late.isEmpty():
        found = components(star.union(late))
    by_key = nodes.join(found, "node", "left").select("k1", "k2", F.coalesce("class", "node").alias("class_id"))
    out = sketched.select("row", "k1", "k2").join(by_key, ["k1", "k2"])
    return out.select(*[F.col("row")[c].alias(c) for c in carry if c != "class_id"], "class_id")


def _without_id(k1: Column) -> Column:
    """The node of rows that have only null ids, from their words: negative."""
    return F.when(k1 < 0, k1).otherwise(-k1 - 1)


def _vectors(rows: DataFrame, wanted: DataFrame, sent) -> DataFrame:
    """node, vector: packed TF-IDF vectors of the wanted nodes, one of each.

    The texts meet the wanted nodes in a sort-merge join at every size.
    """
    named = rows.filter(F.col("id").isNotNull()).select(F.col("id").alias("node"), "text").join(wanted.hint("merge"), "node", "left_semi")
    nameless = _pack(rows.filter(F.col("id").isNull()).select(F.col("id").alias("node"), "text"), sent).join(wanted, "node", "left_semi")
    return _pack(named, sent).union(nameless).groupBy("node").agg(F.max("vector").alias("vector"))


def _pack(texts: DataFrame, sent) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigher = Weigher(*sent.value)
        for batch in batches:
            blobs, nodes = [], batch.column(0).to_pylist()
            for group in grouped(batch.column(1).to_pylist()):
                if nodes[len(blobs)] is None:  # a table of rows without ids
                    k1 = sequence_keys(group)[:, 0]
                    nodes[len(blobs) : len(blobs) + len(group)] = np.where(k1 < 0, k1, -k1 - 1).tolist()
                owner, h, tf = shingles(group)
                w, edges = weigher.weights(h, tf), np.searchsorted(owner, np.arange(len(group) + 1))
                blobs += [_packed(h[a:b], w[a:b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(blobs, pa.binary())], ["node", "vector"])
            release_memory()

    return texts.mapInArrow(pack, "node long, vector binary")


def first_of_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each class: that with the smallest id (of repeated rows, one)."""
    packed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("__doc"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    classed = classes(packed, ["__doc", "id"], "id", "text")
    kept = classed.filter(F.col("id").eqNullSafe(F.col("class_id")) | F.col("id").isNull() & (F.col("class_id") < 0))
    kept = kept.groupBy("class_id").agg(F.min("__doc").alias("__doc"))
    return kept.select(*[F.col("__doc")[c].alias(c) for c in docs.columns])
