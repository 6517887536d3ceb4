"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text, each counted once: n-grams of one to NGRAM words, and pairs of
words with up to SKIP words between.  All are 64-bit hashes; FTRL's per-coordinate
rates and L1 threshold leave few of them a weight, and those weights are broadcast.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrakern.llm.common import bounded_batches

#: Labelled rows that a model is fitted on at most (those of least hash), and bytes of their texts.
MOST_LABELLED, MOST_LABELLED_BYTES = 6_000, 64 << 20
#: Texts are scored in groups of this many characters.
GROUP_CHARS = 4 << 20
NGRAM, SKIP = 2, 1
#: Words count by so many letters from their start, so that inflected forms are one word.
STEM = 4
#: A feature in fewer texts of the sample gets no coordinate.
LEAST_TEXTS = 3
THRESHOLD = 0.3
_MUL = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_KIND = np.uint64(0xA0761D6478BD642F)


class Ftrl(NamedTuple):
    """Rate, smoothing, L1, L2 and passes over the sample.

    These and NGRAM, SKIP and STEM are chosen on rows one may learn from alone: fitted
    on remainders 0 and 3, compared on remainder 1.
    """

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.05
    passes: int = 4


class Weights(NamedTuple):
    """A fitted model: bias, sorted feature hashes, their weights."""

    bias: float
    keys: np.ndarray
    values: np.ndarray


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _KIND
    return h ^ (h >> np.uint64(29))


def _kind(n: int) -> np.uint64:
    """An odd multiplier for each kind of feature."""
    return np.uint64((0xE7037ED1A0B428DB * (2 * n + 1)) % (1 << 64) | 1)


@cache
def _wordy() -> np.ndarray:
    """Whether each code point is a letter, a mark or a number."""
    return np.array([unicodedata.category(chr(c))[0] in "LMN" for c in range(sys.maxunicode + 1)])


def features(texts: list[str], ngram: int = NGRAM, skip: int = SKIP, stem: int = STEM) -> tuple[np.ndarray, np.ndarray]:
    """Place of the text and hash, for every feature occurrence of the texts.

    Words are runs of letters, marks and numbers, in lower case.
    """
    joined = "\n".join(lowered := [t.lower() for t in texts])
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, lowered), np.int64, len(texts)) + 1
    change = np.flatnonzero(np.diff(np.concatenate(([False], _wordy()[code], [False])).astype(np.int8)))
    starts, stops = change[::2], change[1::2]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    stops = np.minimum(stops, starts + stem)
    owner = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, np.concatenate(([0], np.cumsum(sizes))))))
    # hash of each word: sum of code * mul^place, moved back to place 0
    powers = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(len(code), _MUL))))
    back = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(int(starts[-1]), _BACK))))
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum((code.astype(np.uint64) + np.uint64(1)) * powers[:-1])))
    word = _mixed((prefix[stops] - prefix[starts]) * back[starts] + (stops - starts).astype(np.uint64))
    found, gram = [(owner, word)], word
    for n in range(2, ngram + 1):
        whole = owner[n - 1 :] == owner[: len(owner) - n + 1]
        gram = _mixed(gram[: len(owner) - n + 1] * _kind(n) + word[n - 1 :])
        found.append((owner[: len(gram)][whole], gram[whole]))
    for gap in range(2, skip + 2):
        same = owner[gap:] == owner[:-gap]
        found.append((owner[:-gap][same], _mixed(word[:-gap][same] * _kind(100 + gap) + word[gap:][same])))
    return np.concatenate([o for o, _ in found]), np.concatenate([x for _, x in found])


def fit(texts: list[str], labels: np.ndarray, settings: Ftrl = Ftrl(), ngram: int = NGRAM, skip: int = SKIP) -> Weights:
    """One coordinate per feature hash of the sample, updated text by text."""
    owner, hashes = features(texts, ngram, skip)
    keys, place = np.unique(hashes, return_inverse=True)
    pairs = np.unique(owner * max(len(keys), 1) + place)
    owner, place = pairs // max(len(keys), 1), pairs % max(len(keys), 1)
    often = np.bincount(place, minlength=len(keys)) >= LEAST_TEXTS
    owner, place = owner[often[place]], (np.cumsum(often) - 1)[place[often[place]]]
    keys = keys[often]
    rows = np.split(place, np.searchsorted(owner, np.arange(1, len(texts)))) if texts else []
    z, n = np.zeros(len(keys) + 1), np.zeros(len(keys) + 1)
    share = min(max(float(labels.mean()) if len(labels) else 0.0, 1e-3), 1 - 1e-3)
    base = float(np.log(share / (1 - share)))

    def weight(at: np.ndarray) -> np.ndarray:
        lambda1 = np.where(at == len(keys), 0.0, settings.l1)
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - lambda1, 0)
        return -shrunk / ((settings.beta + np.sqrt(n[at])) / settings.alpha + settings.l2)

    for _ in range(settings.passes):
        for row, label in zip(rows, labels.tolist(), strict=True):
            at = np.append(row, len(keys))
            w = weight(at)
            g = 1 / (1 + np.exp(-np.clip(base + w.sum(), -35, 35))) - label
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / settings.alpha
            z[at] += g - sigma * w
            n[at] += g * g
    w = weight(np.arange(len(keys) + 1))
    used = np.flatnonzero(w[:-1])
    return Weights(base + float(w[-1]), keys[used], w[used])


class Scorer:
    """Scores texts by a model; a bitmap tells most features without a weight."""

    BITS = 20

    def __init__(self, model: Weights):
        self.model = model
        self.maybe = np.zeros(1 << self.BITS, bool)
        self.maybe[(model.keys >> np.uint64(64 - self.BITS)).astype(np.int64)] = True

    def score(self, texts: list[str | None]) -> np.ndarray:
        out, held, size = [], [], 0
        for text in texts:
            held.append(text or "")
            size += len(held[-1])
            if size >= GROUP_CHARS:
                out.append(self._score(held))
                held, size = [], 0
        if held:
            out.append(self._score(held))
        return np.concatenate(out) if out else np.zeros(0)

    def _score(self, texts: list[str]) -> np.ndarray:
        owner, hashes = features(texts)
        near = np.flatnonzero(self.maybe[(hashes >> np.uint64(64 - self.BITS)).astype(np.int64)])
        sums = np.full(len(texts), self.model.bias)
        if len(near):
            owner, hashes = owner[near], hashes[near]
            at = np.minimum(np.searchsorted(self.model.keys, hashes), len(self.model.keys) - 1)
            hit = self.model.keys[at] == hashes
            pairs = np.unique(owner[hit] * len(self.model.keys) + at[hit])  # each feature once
            sums += np.bincount(pairs // len(self.model.keys), self.model.values[pairs % len(self.model.keys)], len(texts))
        return 1 / (1 + np.exp(-np.clip(sums, -35, 35)))


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = MOST_LABELLED, most_bytes: int = MOST_LABELLED_BYTES) -> Weights:
    """Fit on labelled rows that are not held out: all, or the ``most`` of least id hash whose texts have ``most_bytes`` together.

    The sample's ids (at most ``most``) are broadcast, one task fits, and only the
    weights that L1 left come to the driver.  Null labels and ids are left out; of
    several texts of one id the shortest counts, and an id labelled twice counts
    twice; no labelled row gives a model without weights.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    order = F.xxhash64(F.lit(11), F.col(id_col).cast("string"))
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    sample = known.select(F.col(id_col).alias("__id"), F.col(label_col).cast("double").alias("label"), order.alias("order")).orderBy("order", "label").limit(most)
    text = F.coalesce(F.col(text_col), F.lit(""))
    named = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.octet_length(text).alias("bytes"), F.xxhash64(text).alias("hash"))
    found = named.select("id", "bytes", "hash").join(F.broadcast(sample), F.col("id") == F.col("__id"))
    found = found.groupBy("order", "label", "id").agg(F.min(F.struct("bytes", "hash")).alias("text_key"))  # at most ``most`` rows
    upto = F.sum(F.col("text_key.bytes").cast("long")).over(Window.orderBy("order", "label", "id").rowsBetween(Window.unboundedPreceding, 0))
    wanted = found.withColumn("upto", upto).filter(F.col("upto") <= most_bytes).select("order", "label", F.col("id").alias("__id"), "text_key")
    joined = named.join(F.broadcast(wanted), (F.col("id") == F.col("__id")) & (F.col("bytes") == F.col("text_key.bytes")) & (F.col("hash") == F.col("text_key.hash")))
    joined = joined.groupBy("order", "label", "id").agg(F.min("text").alias("text"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["order", "label", "text"])
        model = fit(rows["text"].tolist(), rows["label"].to_numpy())
        return pd.DataFrame({"key": np.append(model.keys.view(np.int64), 0), "value": np.append(model.values, model.bias), "bias": np.append(np.zeros(len(model.keys), bool), True)})

    found = joined.select("order", "label", "text", F.lit(0).alias("all")).groupBy("all").applyInPandas(run, "key long, value double, bias boolean").toPandas()
    bias = found["bias"].to_numpy(bool)
    keys, values = found["key"].to_numpy(np.int64)[~bias].view(np.uint64), found["value"].to_numpy(float)[~bias]
    at = np.argsort(keys)
    return Weights(float(found["value"].to_numpy(float)[bias].sum()), keys[at], values[at])


def score(docs: DataFrame, model: Weights, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Return ``id_col, held_out, score, predicted`` for every row.

    Only the text counts for the score; null and empty texts get the model's bias.
    Null ids are not held out; repeated rows get one score each; an empty table gives
    an empty result; other columns are not read.  No shuffle.
    """
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Weights(*sent.value))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer.score(batch.column(1).to_pylist()), pa.float64())], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    scored = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, score double")
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
