"""Suffix-array deduplication of byte strings that repeat across documents.

Every byte covered by a ``span``-byte string that also starts in a document with a
smaller id is removed.  The work is split so that no task sees more than a block of
documents or one bucket of suffixes:

1. Documents are dealt into blocks.  In each ``span``-byte window the ``GRAM``-byte
   string of least hash is the window's anchor; consecutive windows with one anchor
   make a run.  Equal windows have equal anchors, so the anchor names the suffix
   bucket in which all equal windows meet.  Blocks send their distinct anchor
   hashes; a bucket answers each with one bit: does the anchor occur elsewhere?
2. Blocks send the text of the runs whose anchor occurs twice, once per distinct
   text, with the smallest document id.  Each bucket sorts its suffixes by
   difference-cover blockwise construction (:func:`sorted_suffixes`), finds equal
   windows as neighbours, and answers with the smallest id of each window.  Runs
   go by their number in the block; hashes only bring equal texts together, whose
   bytes are then compared.
3. Blocks mark what the answers cover.

Texts travel as one exchange that all three steps reuse.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrakern.llm.common import arrow_schema, releasing

#: Bytes of an anchor.
GRAM = 20
#: Aims for the text of a block and of a bucket.
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 2 << 20
#: Window starts that are worked on at once.
UNIT = 1 << 19
#: Suffixes that one bucket sorts at a time.
SORT_AT_ONCE = 1 << 17
#: A difference cover of the residues modulo 31.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
NO_ID = np.iinfo(np.int64).max

_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_TABLE = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_MUL), n, 1 << 64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h = h * _MIX
    return h ^ (h >> np.uint64(32))


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from each place, by doubling."""
    whole, width, have, doubled = None, 1, 0, _TABLE[data]
    n = len(data)
    while True:
        if gram & width:
            if whole is None:
                whole, have = doubled, width
            else:
                m = n - have - width + 1
                whole = doubled[have : have + m] + whole[:m] * _power(width)
                have += width
        if have == gram:
            return _mixed(whole)
        m = n - 2 * width + 1
        doubled = doubled[:m] * _power(width) + doubled[width : width + m]
        width *= 2


class Runs:
    """Runs of windows of some concatenated texts: where they start, how many windows, anchor and text hashes."""

    def __init__(self, data: np.ndarray, text_of: np.ndarray, starts: np.ndarray, ends: np.ndarray, span: int, gram: int):
        self.start = self.windows = self.offset = np.zeros(0, np.int64)
        self.anchor = np.zeros(0, np.uint64)
        if len(data) < span:
            return
        hashes = gram_hashes(data, gram)
        # least hash, leftmost place: packed into one number
        packed = (hashes & np.uint64(0xFFFFFFFFFF000000)) | (np.arange(len(hashes), dtype=np.uint64) & np.uint64(0xFFFFFF))
        width, least, need = 1, packed, span - gram + 1
        while width * 2 <= need:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < need:
            least = np.minimum(least[: len(packed) - need + 1], least[need - width : need - width + len(packed) - need + 1])
        anchor = (least & np.uint64(0xFFFFFF)).astype(np.int64)
        inside = np.zeros(len(data) + 1, np.int8)
        long = ends - starts >= span
        np.add.at(inside, starts[long], 1)
        np.add.at(inside, ends[long] - span + 1, -1)
        valid = np.cumsum(inside[: len(anchor)]) > 0
        first = valid.copy()
        first[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
        own = starts[long]
        first[own] = True
        last = valid.copy()
        last[:-1] &= first[1:] | ~valid[1:]
        self.start = np.flatnonzero(first)
        self.windows = np.flatnonzero(last) - self.start + 1
        self.anchor = _mixed(hashes[anchor[self.start]] * _MIX)  # least hashes are small: mixed again, buckets are even
        self.offset = anchor[self.start] - self.start
        self._data, self._stop = data, self.start + self.windows + span - 1

    @cached_property
    def text(self) -> np.ndarray:
        """Hashes of the runs' texts, from prefix sums of table * mul^place."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        powers, back = _powers(len(self._data) + 1)
        prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_TABLE[self._data] * powers[: len(self._data)])))
        return _mixed((prefix[self._stop] - prefix[self.start]) * back[self.start] + self.windows.astype(np.uint64) * _MIX)


_known_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``count`` powers of the multiplier and of its inverse; kept for the next unit."""
    if not _known_powers or len(_known_powers[0][0]) < count:
        made = [np.full(count, np.uint64(m), np.uint64) for m in (int(_MUL), pow(int(_MUL), -1, 1 << 64))]
        for m in made:
            m[0] = 1
        _known_powers[:] = [tuple(np.multiply.accumulate(m) for m in made)]
    return _known_powers[0]


def units(texts: list[bytes], span: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Cut texts into pieces of window starts: (data, text of each piece, starts, ends, place in the text).

    Neighbouring pieces of a long text overlap by span - 1 bytes, so no window is
    lost and none counts twice.
    """
    held, size = [], 0
    for k, text in enumerate(texts):
        for at in range(0, max(len(text) - span + 1, 0), UNIT):
            piece = text[at : at + UNIT + span - 1]
            held.append((k, at, piece))
            size += len(piece)
            if size >= UNIT:
                yield _unit(held)
                held, size = [], 0
    if held:
        yield _unit(held)


def _unit(held: list[tuple[int, int, bytes]]):
    lengths = np.array([len(p) for _, _, p in held], np.int64)
    ends = np.cumsum(lengths)
    data = np.frombuffer(b"".join([p for _, _, p in held]), np.uint8)
    return data, np.array([k for k, _, _ in held]), ends - lengths, ends, np.array([at for _, at, _ in held])


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _six(hashes: np.ndarray) -> bytes:
    """The upper 48 bits of each hash."""
    return np.ascontiguousarray(hashes.view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()


def _from_six(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


# -- difference-cover suffix sorting ----------------------------------------------
def _words(rows: np.ndarray, at_row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each place, as a number that sorts as they do."""
    flat = np.lib.stride_tricks.as_strided(rows.ravel(), (rows.size - 7, 8), (1, 1))
    return np.ascontiguousarray(flat[at_row * rows.shape[1] + at]).view(">u8").ravel().astype(np.uint64)


def _word_keys(rows: np.ndarray, at_row: np.ndarray, at: np.ndarray) -> list[Callable[[np.ndarray], np.ndarray]]:
    """The first 32 bytes from each place, as four keys."""
    return [lambda e, k=k: _words(rows, at_row[e], at[e] + 8 * k) for k in range(4)]


def _dense(count: int, keys: list[Callable[[np.ndarray], np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Order of 0..count-1 by the keys (most significant first), and the dense rank of each in that order.

    Each key gives the values of chosen elements; a later key is asked of those only
    that the earlier ones leave tied.
    """
    first = keys[0](np.arange(count))
    order = np.argsort(first)
    new = np.ones(count, bool)
    new[1:] = first[order[1:]] != first[order[:-1]]
    for key in keys[1:]:
        tied = np.flatnonzero(~new | ~np.append(new[1:], True))
        if not len(tied):
            break
        group = np.cumsum(new[tied])
        values = key(order[tied])
        by = np.lexsort((values, group))
        order[tied], values = order[tied][by], values[by]
        new[tied[1:]] |= values[1:] != values[:-1]
    return order, np.cumsum(new) - 1


def cover_ranks(rows: np.ndarray, reach: int) -> np.ndarray:
    """Ranks of the suffixes at cover positions (place modulo PERIOD in COVER), zero-padded texts.

    The first 32 bytes of each sample are ranked, then pairs of ranks PERIOD apart
    are ranked until ``reach`` bytes are told apart.  Places not sampled have 0.
    """
    count, width = rows.shape
    padded = np.concatenate((rows, np.zeros((count, 32 + 8), np.uint8)), axis=1)
    places = np.array([q for q in range(width) if q % PERIOD in COVER])
    at_row, at = np.repeat(np.arange(count), len(places)), np.tile(places, count)
    order, dense = _dense(len(at), _word_keys(padded, at_row, at))
    ranks = np.zeros((count, width + max(reach, PERIOD)), np.int32)
    ranks[at_row[order], at[order]] = dense + 1
    depth, step = 32, PERIOD
    while depth < reach:
        first, second = ranks[at_row, at], ranks[at_row, at + step]
        order, dense = _dense(len(at), [lambda e, v=first: v[e], lambda e, v=second: v[e]])
        ranks[at_row[order], at[order]] = dense + 1
        depth, step = depth + step, 2 * step
    return ranks


def sorted_suffixes(rows: np.ndarray, at_row: np.ndarray, at: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Order of the suffixes (row, place): by their first PERIOD + 1 bytes, ties by the ranks of cover samples.

    Suffixes that tie look up the ranks at one shift that takes all of them to cover
    positions; a tie of so many residues that none does is settled pair by pair,
    each pair at its own shift, which a difference cover always has.
    """
    padded = np.concatenate((rows, np.zeros((len(rows), 40), np.uint8)), axis=1)
    order, group = _dense(len(at), _word_keys(padded, at_row, at))
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    residues = np.bitwise_or.reduceat(np.int64(1) << (at[order] % PERIOD), starts) if len(starts) else starts
    shift = np.full(len(starts), -1)
    cover = sum(1 << c for c in COVER)
    for by in range(PERIOD - 1, -1, -1):
        turned = ((residues << by) | (residues >> (PERIOD - by))) & ((1 << PERIOD) - 1)
        shift[(turned & ~cover) == 0] = by
    by = shift[group]
    rank = np.where(by >= 0, ranks[at_row[order], at[order] + np.maximum(by, 0)], 0)
    order = order[np.lexsort((rank, group))]
    sizes = np.diff(np.append(starts, len(order)))
    for g in np.flatnonzero((shift < 0) & (sizes > 1)).tolist():
        part = order[starts[g] : starts[g] + sizes[g]]

        def compare(a: int, b: int) -> int:
            s = next(s for s in range(PERIOD) if (at[a] + s) % PERIOD in COVER and (at[b] + s) % PERIOD in COVER)
            return int(ranks[at_row[a], at[a] + s]) - int(ranks[at_row[b], at[b] + s])

        order[starts[g] : starts[g] + sizes[g]] = sorted(part.tolist(), key=functools.cmp_to_key(compare))
    return order


def window_minima(rows: np.ndarray, lead: np.ndarray, windows: np.ndarray, ids: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id of each window of the texts, which start at column ``lead``: (offsets into the flat result, result).

    The suffixes are cut by their first two bytes into parts that are sorted one
    after the other, so memory is bounded by the largest part and the cover ranks.
    """
    offsets = np.concatenate(([0], np.cumsum(windows)))
    at_row = np.repeat(np.arange(len(rows)), windows)
    at = np.arange(offsets[-1]) - offsets[at_row] + lead[at_row]
    out = ids[at_row].copy()
    if not len(at):
        return offsets, out
    ranks = cover_ranks(rows, span)
    pair = rows[at_row, at].astype(np.int64) * 256 + rows[at_row, at + 1]
    part = (np.cumsum(np.bincount(pair, minlength=65536)) // SORT_AT_ONCE)[pair]
    padded = np.concatenate((rows, np.zeros((len(rows), 8), np.uint8)), axis=1)
    for p in np.unique(part).tolist():
        here = np.flatnonzero(part == p)
        here = here[sorted_suffixes(rows, at_row[here], at[here], ranks)]
        same = np.ones(max(len(here) - 1, 0), bool)
        for k in [*range(0, span - 7, 8), span - 8]:  # neighbours that agree on the whole span
            left = np.flatnonzero(same)
            a, b = here[left], here[left + 1]
            same[left] = _words(padded, at_row[a], at[a] + k) == _words(padded, at_row[b], at[b] + k)
        starts = np.flatnonzero(np.append(True, ~same))
        least = np.minimum.reduceat(out[here], starts)
        out[here] = np.repeat(least, np.diff(np.append(starts, len(here))))
    return offsets, out


# -- blocks and buckets -----------------------------------------------------------
def classes(hashes: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of equal texts of at least 8 bytes: the first text of each, and the class of each text.

    Texts with one hash are compared with the first of them; should any differ, all
    are told apart by their bytes.
    """
    _, first, back = np.unique(hashes, return_index=True, return_inverse=True)
    rest = np.flatnonzero(first[back] != np.arange(len(back)))
    if not len(rest):
        return first, back
    twin = first[back[rest]]
    same = size[rest] == size[twin]
    for k in range(0, int(size[rest].max()), 8):  # the last word of a text overlaps the one before
        at = np.minimum(k, size[rest] - 8)
        same &= _words(data[None], np.zeros(1, np.int64), start[rest] + at) == _words(data[None], np.zeros(1, np.int64), start[twin] + np.minimum(at, size[twin] - 8))
    if same.all():
        return first, back
    seen: dict[bytes, int] = {}
    back = np.array([seen.setdefault(data[a : a + n].tobytes(), len(seen)) for a, n in zip(start.tolist(), size.tolist(), strict=True)], np.int64)
    return np.unique(back, return_index=True)[1], back


def _block_texts(table: pa.Table) -> tuple[pa.Table, np.ndarray, list[bytes]]:
    """A block's rows in an order of their own (id, text), their ids and their texts."""
    table = table.sort_by([("id", "ascending"), ("bytes", "ascending")])
    ids = table.column("id").fill_null(NO_ID).to_numpy()
    return table, ids, [t or b"" for t in table.column("bytes").to_pylist()]


def _anchors(found: list[Runs]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *[r.anchor for r in found]])


def _send_anchors(table: pa.Table, span: int, buckets: int) -> pa.Table:
    block = table.column("block")[0]
    _, _, texts = _block_texts(table)
    found = np.unique(_anchors([Runs(*u[:4], span, GRAM) for u in units(texts, span)]))
    full, parts = _cut(_bucket(found, buckets))
    blobs = [_six(found[part]) for part in parts]
    return pa.table({"bucket": pa.array(full, pa.int64()), "block": pa.array([block.as_py()] * len(full), pa.int64()), "hashes": pa.array(blobs, pa.binary())})


def _answer_anchors(table: pa.Table) -> pa.Table:
    blobs = [_from_six(b) for b in table.column("hashes").to_pylist()]
    found, counts = np.unique(np.concatenate(blobs), return_counts=True)
    shared = found[counts > 1]
    bits = [np.packbits(np.isin(b, shared, assume_unique=True)).tobytes() for b in blobs]
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "bits": pa.array(bits, pa.binary())})


def _send_runs(table: pa.Table, answers: pa.Table, span: int, buckets: int) -> pa.Table:
    names = {"bucket": pa.int64(), "block": pa.int64(), "n": pa.int32(), "texts": pa.binary()}
    if not table.num_rows:
        return pa.schema(list(names.items())).empty_table()
    block = table.column("block")[0].as_py()
    _, ids, texts = _block_texts(table)
    cut = [(u, Runs(*u[:4], span, GRAM)) for u in units(texts, span)]
    found, counts = np.unique(_anchors([r for _, r in cut]), return_counts=True)
    parts = dict(zip(*_cut(_bucket(found, buckets)), strict=True))
    shared = counts > 1
    for b, bits in zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist(), strict=True):
        part = parts[b]
        shared[part] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=part.stop - part.start).astype(bool)
    shared = found[shared]
    out: dict[int, list[bytes]] = {}
    n_out: dict[int, int] = {}
    base = np.cumsum([0] + [len(r.start) for _, r in cut])
    for ((data, text_of, _, ends, _), runs), before in zip(cut, base.tolist(), strict=False) if len(shared) else []:
        near = np.minimum(np.searchsorted(shared, runs.anchor), len(shared) - 1)
        sent = np.flatnonzero(shared[near] == runs.anchor)
        if not len(sent):
            continue
        owner = ids[text_of[np.searchsorted(ends, runs.start[sent], "right")]]
        first = np.sort(classes(runs.text[sent], data, runs.start[sent], runs.windows[sent] + span - 1)[0])
        sent, owner = sent[first], owner[first]  # ids rise within a unit: the first run of a text has the smallest
        bucket = _bucket(runs.anchor[sent], buckets)
        order = np.argsort(bucket, kind="stable")
        sent, owner, bucket = sent[order], owner[order], bucket[order]
        for b, part in zip(*_cut(bucket), strict=True):
            s = sent[part]
            n = runs.windows[s]
            size = n + span - 1
            take = np.repeat(runs.start[s] - np.cumsum(size) + size, size) + np.arange(size.sum())
            blob = b"".join((np.int32(len(s)).tobytes(), runs.text[s].tobytes(), (s + before).astype(np.int32).tobytes(), owner[part].tobytes(), n.astype(np.uint8).tobytes(), runs.offset[s].astype(np.uint8).tobytes(), data[take].tobytes()))
            out.setdefault(b, []).append(blob)
            n_out[b] = n_out.get(b, 0) + len(s)
    keys = list(out)
    values = [keys, [block] * len(keys), [n_out[b] for b in keys], [b"".join(out[b]) for b in keys]]
    return pa.table({k: pa.array(v, t) for (k, t), v in zip(names.items(), values, strict=True)})


def _cut(values: np.ndarray) -> tuple[list[int], list[slice]]:
    """Distinct values of a sorted array and the slice of each."""
    if not len(values):
        return [], []
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    stops = np.append(starts[1:], len(values))
    return values[starts].tolist(), [slice(a, b) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]


def _parse_runs(blob: bytes, span: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Text hash, number in the block, id, windows and anchor's place of each run, and all runs' bytes."""
    at = 0
    while at < len(blob):
        n = int(np.frombuffer(blob, np.int32, 1, at)[0])
        at += 4
        fields = []
        for kind in (np.uint64, np.int32, np.int64, np.uint8, np.uint8):
            fields.append(np.frombuffer(blob, kind, n, at))
            at += fields[-1].nbytes
        text, number, ids, windows, offset = fields
        size = int(windows.sum(dtype=np.int64)) + n * (span - 1)
        yield text, number, ids, windows.astype(np.int64), offset.astype(np.int64), np.frombuffer(blob, np.uint8, size, at)
        at += size


def _answer_runs(table: pa.Table, span: int) -> pa.Table:
    blocks, parts = [], []
    for block, blob in zip(table.column("block").to_pylist(), table.column("texts").to_pylist(), strict=True):
        for part in _parse_runs(blob, span):
            parts.append(part)
            blocks.append(np.full(len(part[0]), block))
    text, number, ids, windows, offset = (np.concatenate([p[k] for p in parts]) for k in range(5))
    data = np.concatenate([p[5] for p in parts])
    block = np.concatenate(blocks)
    del parts, blocks
    stops = np.cumsum(windows + span - 1)
    begins = stops - windows - span + 1
    first, back = classes(text, data, begins, stops - begins)
    least = np.full(len(first), NO_ID)
    np.minimum.at(least, back, ids)
    w = windows[first]
    # anchors stand in one column, so equal windows start in equal columns
    lead = offset[first].max() - offset[first]
    rows = np.zeros((len(first), int((lead + w).max()) + span - 1), np.uint8)
    for k in range(int(w.max()) + span - 1):
        has = np.flatnonzero(w + span - 1 > k)
        rows[has, lead[has] + k] = data[begins[first[has]] + k]
    offsets, minima = window_minima(rows, lead, w, least, span)
    # runs of equal answers within each distinct text
    new = np.append(True, minima[1:] != minima[:-1])
    new[offsets[:-1]] = True
    run = np.flatnonzero(new)
    run_text = np.searchsorted(offsets, run, "right") - 1
    run_stop = np.append(run[1:], offsets[-1])
    per_text = np.searchsorted(run_text, np.arange(len(first) + 1))
    # every sender gets the runs that are smaller than what it knows itself
    n = per_text[back + 1] - per_text[back]
    entry = np.repeat(np.arange(len(back)), n)
    which = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + per_text[back[entry]]
    told = minima[run[which]] < ids[entry]
    entry, which = entry[told], which[told]
    order = np.argsort(block[entry], kind="stable")
    entry, which = entry[order], which[order]
    base = offsets[run_text[which]]
    reply = np.rec.fromarrays([number[entry], minima[run[which]], (run[which] - base).astype(np.uint16), (run_stop[which] - base).astype(np.uint16)], dtype=REPLY)
    keys, cuts = _cut(block[entry])
    return pa.table({"block": pa.array(keys, pa.int64()), "replies": pa.array([reply[c].tobytes() for c in cuts], pa.binary())})


REPLY = np.dtype([("run", "<i4"), ("least", "<i8"), ("first", "<u2"), ("stop", "<u2")])


def removed_masks(ids: np.ndarray, texts: list[bytes], replies: np.ndarray, span: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each text that loses bytes (more than once if it is long): its place and where removed runs start and end."""
    replies, before = replies[np.argsort(replies["run"], kind="stable")], 0
    for data, text_of, starts, ends, place in units(texts, span):
        runs = Runs(data, text_of, starts, ends, span, GRAM)
        piece = np.searchsorted(ends, runs.start, "right")
        owner = ids[text_of[piece]]
        change = np.zeros(len(data) + 1, np.int32)
        first, back = classes(runs.text, data, runs.start, runs.windows + span - 1)
        twin = first[back]
        whole = owner[twin] < owner  # the same run stands in an earlier document of this unit
        np.add.at(change, runs.start[whole], 1)
        np.add.at(change, (runs.start + runs.windows + span - 1)[whole], -1)
        lo, hi = (np.searchsorted(replies["run"], twin + before, side) for side in ("left", "right"))
        before += len(twin)
        n = hi - lo
        run = np.repeat(np.arange(len(n)), n)
        which = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + lo[run]
        hit = replies["least"][which] < owner[run]
        run, which = run[hit], which[hit]
        np.add.at(change, runs.start[run] + replies["first"][which], 1)
        np.add.at(change, runs.start[run] + replies["stop"][which] + span - 1, -1)
        covered = np.cumsum(change[:-1]) > 0
        for k, a, b, at in zip(text_of.tolist(), starts.tolist(), ends.tolist(), place.tolist(), strict=True):
            edges = np.flatnonzero(np.diff(np.concatenate(([False], covered[a:b], [False]))))
            if len(edges):
                yield k, edges.reshape(-1, 2) + at


def merged_spans(found: Iterator[tuple[int, np.ndarray]], count: int) -> list[np.ndarray]:
    """Maximal removed runs of each of ``count`` texts."""
    out: list[list[np.ndarray]] = [[] for _ in range(count)]
    for k, spans in found:
        out[k].append(spans)
    merged = []
    for spans in out:
        if len(spans) > 1:  # pieces of a long text overlap
            s = np.concatenate(spans)
            s = s[np.argsort(s[:, 0], kind="stable")]
            reach = np.maximum.accumulate(s[:, 1])
            new = np.append(True, s[1:, 0] > reach[:-1])
            stop = np.append(np.flatnonzero(new)[1:] - 1, len(s) - 1)
            spans = [np.stack((s[new, 0], reach[stop]), axis=1)]
        merged.append(spans[0] if spans else np.zeros((0, 2), np.int64))
    return merged


def kept_bytes(text: bytes, spans: np.ndarray) -> bytes:
    at, out = 0, []
    for a, b in spans.tolist():
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def dedup(docs: DataFrame, carry: list[str], id_col: str = "doc_id", text_col: str = "text", span: int = 50, with_text: bool = False) -> DataFrame:
    """The ``carry`` columns of every row with n_bytes, n_removed, n_spans, kept_sha256 (and kept binary).

    Removed is each byte covered by a ``span``-byte string that also starts in a row
    with a smaller id; strings are judged on the input.  Null texts are empty; a
    null id counts as larger than all others; rows with one id never remove from
    each other, repeated rows included; an empty table gives an empty result;
    carried columns travel in a struct, so names cannot clash.  ``id_col`` must be
    of an integer type, and ``span`` between 2 * GRAM and 200.
    """
    if not 2 * GRAM <= span <= 200:
        raise ValueError(f"span is {span}, not between {2 * GRAM} and 200")
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    blocks, buckets = max(1, -(-total // BLOCK_BYTES)), max(1, -(-total // BUCKET_BYTES))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = docs.select(
        F.pmod(F.xxhash64(F.col(id_col).cast("long"), F.octet_length(text_col)), F.lit(blocks)).alias("block"),
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("bytes"),
        F.struct(*[F.col(c) for c in carry]).alias("row"),
    ).repartition(parts, "block")
    texts = held.select("block", "id", "bytes", "row")
    by_block = texts.groupBy("block")

    def send_anchors(table: pa.Table) -> pa.Table:
        return _send_anchors(table, span, buckets)

    def send_runs(table: pa.Table, answers: pa.Table) -> pa.Table:
        return _send_runs(table, answers, span, buckets)

    def answer_anchors(table: pa.Table) -> pa.Table:
        return _answer_anchors(table)

    def answer_runs(table: pa.Table) -> pa.Table:
        return _answer_runs(table, span)

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        table, ids, texts = _block_texts(table)
        replies = np.frombuffer(b"".join(answers.column("replies").to_pylist()), REPLY)
        spans = merged_spans(removed_masks(ids, texts, replies, span), len(texts))
        kept = [kept_bytes(t, s) for t, s in zip(texts, spans, strict=True)]
        columns = {
            "row": table.column("row"),
            "n_bytes": pa.array(map(len, texts), pa.int64()),
            "n_removed": pa.array([int((s[:, 1] - s[:, 0]).sum()) for s in spans], pa.int64()),
            "n_spans": pa.array(map(len, spans), pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
        }
        return pa.table(columns | ({"kept": pa.array(kept, pa.binary())} if with_text else {})).cast(schema)

    row_type = texts.schema["row"].dataType
    out_type = f"row {row_type.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    schema = arrow_schema(out_type)
    sent = by_block.applyInArrow(releasing(send_anchors), "bucket long, block long, hashes binary")
    answered = sent.groupBy("bucket").applyInArrow(releasing(answer_anchors), "block long, bucket long, bits binary")
    runs = by_block.cogroup(answered.groupBy("block")).applyInArrow(releasing(send_runs), "bucket long, block long, n int, texts binary")
    replies = runs.groupBy("bucket").applyInArrow(releasing(answer_runs), "block long, replies binary")
    done = by_block.cogroup(replies.groupBy("block")).applyInArrow(releasing(finish), out_type)
    clash = {"n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"}
    more = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text
    return done.select(*[F.col("row")[c].alias(c) for c in carry if c not in clash], *more)


def trimmed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = 50) -> DataFrame:
    """The rows of ``docs`` with repeated strings cut out of their texts; rows that lose all their text go.

    Bytes that a cut leaves of a broken character are dropped with it.  Rows whose
    text was empty or null stay as they are.
    """

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [b.decode("utf-8", "ignore") for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(schema.field(0).type), pa.array(texts, pa.string())], schema=schema)

    others = [c for c in docs.columns if c != text_col]
    doc = F.struct(*[F.col(c) for c in others], F.when(F.col(text_col).isNull(), True).otherwise(False).alias("__was_null"))
    packed = docs.select(doc.alias("doc"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    cut = dedup(packed, ["doc"], "id", "text", span, with_text=True).filter((F.col("n_bytes") == 0) | (F.col("n_removed") < F.col("n_bytes")))
    kind = cut.schema["doc"].dataType.simpleString()
    schema = arrow_schema(f"doc {kind}, text string")
    out = cut.select("doc", "kept").mapInArrow(decoded, f"doc {kind}, text string")
    text = F.when(F.col("doc")["__was_null"], F.lit(None)).otherwise(F.col("text"))
    return out.select(*[text.alias(c) if c == text_col else F.col("doc")[c].alias(c) for c in docs.columns])
