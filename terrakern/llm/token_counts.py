"""Token counts by rank-synchronous array merging.

The pre-tokens of a batch that the worker has not met yet are held as one ragged
numpy array of symbols.  In each round every sequence applies its own
lowest-ranked pair at all its places at once; a sequence without a mergeable pair
is finished, and its surviving symbols are counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrakern.llm.byte_bpe import LONG, REMEMBERED, REMEMBERED_BYTES, ByteBPE, loaded, vocabulary_text
from terrakern.llm.common import bounded_batches

#: Words merged together in one ragged array hold about this many bytes.
RAGGED_BYTES = 1 << 20


class Counter:
    """Counts tokens of texts; remembers the counts of words it has merged."""

    def __init__(self, bpe: ByteBPE):
        self.bpe, self.known, self.held = bpe, {}, 0

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Number of tokens of each of the (distinct) words."""
        if len(self.known) > REMEMBERED or self.held > REMEMBERED_BYTES:
            self.known.clear()
            self.held = 0
        once: dict[bytes, int] = {}  # long words are not remembered
        batch, size = [], 0
        for word in words:
            if word in self.known:
                continue
            if word in self.bpe.special_bytes:
                self.known[word] = 1
                continue
            batch.append(word)
            size += len(word)
            if size >= RAGGED_BYTES:
                self._merge(batch, once)
                batch, size = [], 0
        if batch:
            self._merge(batch, once)
        return np.fromiter((self.known[w] if w in self.known else once[w] for w in words), np.int64, len(words))

    def _merge(self, words: list[bytes], once: dict[bytes, int]) -> None:
        for word, n in zip(words, self.bpe.merge_together(words)[1].tolist(), strict=True):
            if len(word) > LONG:
                once[word] = n
            else:
                self.known[word] = n
                self.held += len(word)

    def count(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        for owner, words in self.bpe.groups(texts):
            each = self.counts(words.dictionary.to_pylist())[words.indices.to_numpy()]
            out += np.bincount(owner, each, len(texts)).astype(np.int64)
        return out


_counters: dict[int, Counter] = {}


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """Return ``id_col, n_bytes, n_tokens, over_limit`` for every row.

    ``vocabulary`` is the path of a byte-level BPE ``tokenizers`` JSON file; its
    content, of fixed size, is broadcast.  Null and empty texts have 0 bytes and 0
    tokens; words of any length take time about in proportion to it; null ids and repeated rows pass through; an empty table gives an empty
    result; other columns are not read.  No shuffle.
    """
    bounded_batches(docs.sparkSession)
    content = docs.sparkSession.sparkContext.broadcast(vocabulary_text(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(content.value)
        counter = _counters.setdefault(id(bpe), Counter(bpe))
        for batch in batches:
            n = counter.count(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), F.col(text_col).alias("text"))
    counted = narrow.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
