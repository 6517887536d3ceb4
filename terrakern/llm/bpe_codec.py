"""BPE encoding and decoding by speculation and verification.

Greedy longest match proposes tokens for every word that the worker has not met.
A proposal is the true encoding exactly if each token encodes to itself and each
adjacent pair (a, b) is compatible: merging the bytes of a and b together gives
[a, b] again.  Compatibility is tested for all adjacent pairs at once against a
sorted table of known pairs; only words with an incompatible pair are merged
exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrakern.llm.byte_bpe import LONG, REMEMBERED, REMEMBERED_BYTES, ByteBPE, loaded, vocabulary_text
from terrakern.llm.common import arrow_schema, bounded_batches

#: Stands in for the second token where a token is tested alone.
ALONE = (1 << 31) - 1
#: Known pairs before a worker starts afresh, and new ones before they join the rest.
MOST_PAIRS, MOST_NEW = 1 << 21, 1 << 15


class Codec:
    """Encodes words and texts of one vocabulary, and decodes ids."""

    def __init__(self, bpe: ByteBPE):
        self.bpe = bpe
        self._forget()
        self.exact_merges = 0

    def _forget(self) -> None:
        self.words: dict[bytes, list[int]] = {w: [i] for w, i in self.bpe.special_bytes.items()}
        self.held = 0
        none = (np.zeros(0, np.int64), np.zeros(0, bool))
        #: Tables of pairs (sorted keys, verdicts): all but the newest, and the newest.
        self.old, self.new = none, none

    # -- speculate -----------------------------------------------------------
    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match from the left."""
        ids, lengths, at, out = self.bpe.ids, self.bpe.lengths, 0, []
        whole = ids.get(word)
        if whole is not None:
            return [whole]
        while at < len(word):
            for size in (*lengths.get(word[at : at + 3], ()), 2, 1):
                found = ids.get(word[at : at + size])
                if found is not None and at + size <= len(word):
                    break
            out.append(found)
            at += size
        return out

    # -- verify --------------------------------------------------------------
    def compatible(self, keys: np.ndarray) -> np.ndarray:
        """Whether each pair key (a << 32 | b) is compatible; new ones are worked out once."""
        distinct, back = np.unique(keys, return_inverse=True)
        fits, known = np.zeros(len(distinct), bool), np.zeros(len(distinct), bool)
        for table, verdicts in (self.old, self.new):
            at = np.searchsorted(table, distinct)
            inside = np.flatnonzero(at < len(table))
            inside = inside[table[at[inside]] == distinct[inside]]
            known[inside], fits[inside] = True, verdicts[at[inside]]
        if not known.all():
            fresh = distinct[~known]
            fits[~known] = self._fit(fresh)
            self.new = _joined(self.new, (fresh, fits[~known]))
            if len(self.new[0]) > MOST_NEW:
                self.old = _joined(self.old, self.new) if len(self.old[0]) < MOST_PAIRS else self.new
                self.new = (np.zeros(0, np.int64), np.zeros(0, bool))
        return fits[back]

    def _fit(self, keys: np.ndarray) -> np.ndarray:
        """Merges the bytes of both tokens of each key: do the same two come out?"""
        of, left, right = self.bpe.bytes_of, keys >> 32, keys & 0xFFFFFFFF
        alone = right == ALONE
        joined = [of[a] + (b"" if b == ALONE else of[b]) for a, b in zip(left.tolist(), right.tolist(), strict=True)]
        out, n = self.bpe.merge_together(joined)
        first = np.cumsum(n) - n
        last = first + np.where(alone, 0, n - 1)
        return (n == np.where(alone, 1, 2)) & (out[first] == left) & (alone | (out[last] == right))

    def learn(self, words: list[bytes]) -> dict[bytes, list[int]]:
        """Encode new words: propose, test all adjacent pairs, merge exactly what fails.

        Returns the long words; they are not remembered.
        """
        if not words:
            return {}
        proposals = [self.propose(w) for w in words]
        sizes = np.fromiter(map(len, proposals), np.int64, len(proposals))
        flat = np.fromiter((t for p in proposals for t in p), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        inner = owner[:-1] == owner[1:]
        alone = np.flatnonzero(sizes == 1)
        first = np.cumsum(sizes) - sizes
        keys = np.concatenate([((flat[:-1] << 32) | flat[1:])[inner], (flat[first[alone]] << 32) | ALONE])
        whose = np.concatenate([owner[:-1][inner], alone])
        failing = np.unique(whose[~self.compatible(keys)]).tolist()
        if failing:
            merged, n = self.bpe.merge_together([words[k] for k in failing])
            for k, ids in zip(failing, np.split(merged, np.cumsum(n)[:-1]), strict=True):
                proposals[k] = ids.tolist()
            self.exact_merges += len(failing)
        once = {}
        for word, ids in zip(words, proposals, strict=True):
            if len(word) > LONG:
                once[word] = ids
            else:
                self.words[word] = ids
                self.held += len(word)
        return once

    # -- texts ---------------------------------------------------------------
    def known(self, words: list[bytes]) -> list[list[int]]:
        """Ids of the (distinct) words."""
        if len(self.words) > REMEMBERED or self.held > REMEMBERED_BYTES:
            self._forget()
        once = self.learn([w for w in words if w not in self.words])
        return [self.words[w] if w in self.words else once[w] for w in words]

    def encode(self, text: str) -> list[int]:
        out = []
        for _, words in self.bpe.groups([text]):
            ids = self.known(words.dictionary.to_pylist())
            out += [t for k in words.indices.to_pylist() for t in ids[k]]
        return out

    def encode_many(self, texts: list[str | None]) -> pa.ListArray:
        """The ids of each text."""
        counts, flat = np.zeros(len(texts), np.int64), []
        for owner, words in self.bpe.groups(texts):
            ids = pa.array(self.known(words.dictionary.to_pylist()), pa.list_(pa.int32())).take(words.indices)
            flat.append(ids.flatten().to_numpy())
            counts += np.bincount(owner, ids.value_lengths().to_numpy(), len(texts)).astype(np.int64)
        offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *flat]), pa.int32()))

    def decode(self, ids: list[int]) -> str:
        """Text of the ids; special tokens are kept, broken UTF-8 becomes U+FFFD."""
        special = {i: s.encode() for s, i in self.bpe.special.items()}
        of = self.bpe.bytes_of
        return b"".join([special[i] if i in special else of[i] for i in ids]).decode("utf-8", errors="replace")


def _joined(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Both tables of pairs as one."""
    keys, verdicts = (np.concatenate((a[k], b[k])) for k in range(2))
    order = np.argsort(keys, kind="stable")
    return keys[order], verdicts[order]


_codecs: dict[int, Codec] = {}


def _codec(content: str) -> Codec:
    bpe = loaded(content)
    return _codecs.setdefault(id(bpe), Codec(bpe))


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return ``id_col, ids array<int>`` for every row, as the ``tokenizers`` library encodes it.

    ``vocabulary`` is the path of a byte-level BPE JSON file; its content, of fixed
    size, is broadcast.  Special strings in a text give their special token.  Null
    and empty texts give no ids; null ids and repeated rows pass through; an empty
    table gives an empty result; other columns are not read.  No shuffle.
    """
    bounded_batches(docs.sparkSession, 500)
    content = docs.sparkSession.sparkContext.broadcast(vocabulary_text(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(content.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), codec.encode_many(batch.column(1).to_pylist())], ["id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    coded = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, ids array<int>")
    return coded.select(F.col("id").alias(id_col), "ids")


def decode(coded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Return ``id_col, text`` for every row of ids; null ids give an empty text."""
    bounded_batches(coded.sparkSession, 500)
    content = coded.sparkSession.sparkContext.broadcast(vocabulary_text(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(content.value)
        for batch in batches:
            texts = [codec.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    kind = coded.schema[id_col].dataType.simpleString()
    out = coded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"id {kind}, text string")
    return out.select(F.col("id").alias(id_col), "text")


def round_trip_digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return ``id_col, n_tokens, ids_sha256, decoded_sha256``: encode, then decode, in one pass.

    The same codec as :func:`encode` and :func:`decode`; ids and decoded bytes are
    digested word by word, so no list of a whole text's ids is held.  Nulls, empty
    texts and empty tables as there.
    """
    bounded_batches(docs.sparkSession)
    content = docs.sparkSession.sparkContext.broadcast(vocabulary_text(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(content.value)
        for batch in batches:
            rows = digests(codec, batch.column(1).to_pylist())
            n, coded, decoded = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = narrow.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)


class _Digest:
    """Running digests of one text's ids and of its decoded bytes."""

    def __init__(self):
        self.n, self.coded, self.plain, self.tail = 0, hashlib.sha256(), hashlib.sha256(), b""

    def add(self, n: int, ids: memoryview, text: bytes) -> None:
        """``ids``: decimal ids, each behind a comma."""
        self.coded.update(ids if self.n else ids[1:])
        self.n += n
        self.tail = _decoded(self.plain, self.tail + text)

    def end(self) -> tuple[int, str, str]:
        self.plain.update(self.tail.decode("utf-8", errors="replace").encode())
        return self.n, self.coded.hexdigest(), self.plain.hexdigest()


def digests(codec: Codec, texts: list[str | None], ids_of: list[list[np.ndarray]] | None = None) -> list[tuple[int, str, str]]:
    """For each text: number of ids, digest of the ids, digest of the text decoded from them.

    Words new to the worker are learnt together, for several texts at a time.
    ``ids_of``, a list for each text, takes the ids themselves.
    """
    out = [_Digest() for _ in texts]
    of = codec.bpe.bytes_of | {i: w for w, i in codec.bpe.special_bytes.items()}
    for owner, words in codec.bpe.groups(texts):
        ids = codec.known(words.dictionary.to_pylist())
        which = words.indices
        coded = pa.array([("," + ",".join(map(str, w))).encode() for w in ids], pa.binary()).take(which)
        plain = pa.array([b"".join([of[t] for t in w]) for w in ids], pa.binary()).take(which)
        n = np.concatenate(([0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))[which.to_numpy()])))
        firsts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        (coded, at), (plain, to) = _laid_out(coded), _laid_out(plain)
        flat = pa.array(ids, pa.list_(pa.int32())).take(which).flatten().to_numpy() if ids_of is not None else None
        for a, b in zip(firsts.tolist(), [*firsts[1:].tolist(), len(owner)], strict=True):
            out[owner[a]].add(int(n[b] - n[a]), coded[at[a] : at[b]], bytes(plain[to[a] : to[b]]))
            if flat is not None:
                ids_of[owner[a]].append(flat[n[a] : n[b]])
    return [x.end() for x in out]


def _laid_out(array: pa.BinaryArray) -> tuple[memoryview, np.ndarray]:
    """An array's bytes and offsets."""
    _, offsets, data = array.buffers()
    return memoryview(data or b""), np.frombuffer(offsets, np.int32)[: len(array) + 1]


def _decoded(plain, data: bytes) -> bytes:
    """Decode ``data`` but for an unfinished character at its end, which is returned."""
    cut = len(data)
    for back in range(1, min(4, len(data)) + 1):
        b = data[-back]
        if b >= 0xC0:
            if (0xF0 <= b and back < 4) or (0xE0 <= b < 0xF0 and back < 3) or (b < 0xE0 and back < 2):
                cut = len(data) - back
            break
        if b < 0x80:
            break
    plain.update(data[:cut].decode("utf-8", errors="replace").encode())
    return data[cut:]


def encode_documents(docs: DataFrame, carry: list[str], vocabulary: str, text_col: str = "text") -> DataFrame:
    """The ``carry`` columns of every row with n_tokens, ids, ids_sha256 and decoded_sha256.

    Nulls, empty texts and empty tables as in :func:`encode`; carried columns travel
    in a struct, so their names cannot clash.
    """
    bounded_batches(docs.sparkSession, 500)
    content = docs.sparkSession.sparkContext.broadcast(vocabulary_text(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(content.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            parts: list[list[np.ndarray]] = [[] for _ in texts]
            n, coded, decoded = zip(*digests(codec, texts, parts), strict=True) if texts else ((), (), ())
            flat = np.concatenate([np.zeros(0, np.int32), *[p for text in parts for p in text]])
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32)), pa.array(flat, pa.int32()))
            columns = [batch.column(0), pa.array(n, pa.int64()), ids, pa.array(coded, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    rows = docs.select(F.struct(*[F.col(c) for c in carry]).alias("row"), F.col(text_col).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    ddl = f"row {kind}, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string"
    schema = arrow_schema(ddl)
    out = rows.mapInArrow(run, ddl)
    added = ["n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    return out.select(*[F.col("row")[c].alias(c) for c in carry if c not in added], *added)
