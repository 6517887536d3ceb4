"""A byte-level BPE vocabulary as data: pre-tokenising, merge ranks, exact merging."""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from tokenizers.pre_tokenizers import ByteLevel

#: The characters with Unicode's White_Space property.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Texts longer than this many characters are handled piece by piece.
PIECE = 1 << 20
#: Words whose results a worker remembers, and bytes of them, before it starts afresh; longer words than LONG are never remembered.
REMEMBERED, REMEMBERED_BYTES = 400_000, 16 << 20
#: Words of more bytes are merged by the places of each rank instead of in rounds over all symbols.
LONG = 256
#: Characters of text that are split into words at a time.
GROUP = 4 << 20
NO_RANK = np.iinfo(np.int32).max


@cache
def _category(kind: str) -> np.ndarray:
    """Whether each code point is of the general category ``kind`` (L or N) for the tokenizer.

    Python's two Unicode tables differ in the newest characters; only those are
    asked of the tokenizer's own pre-tokenizer.
    """
    every = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    newest, older = np.zeros(sys.maxunicode + 2, bool), np.zeros(sys.maxunicode + 2, bool)
    newest[[ord(c) for c in regex.findall(rf"\p{{{kind}}}", "".join(map(chr, every)))]] = True
    older[[c for c in every if unicodedata.category(chr(c))[0] == kind]] = True
    split = ByteLevel(add_prefix_space=False).pre_tokenize_str
    mate = {"L": "a", "N": "1"}[kind]
    for c in np.flatnonzero(newest != older).tolist():
        newest[c] = len(split(mate + chr(c))) == 1
    return newest


OTHER, LETTER, NUMBER, SPACE = range(4)
#: What may follow an apostrophe in a contraction of the public pre-token pattern.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


@cache
def _classes() -> np.ndarray:
    """OTHER, LETTER, NUMBER or SPACE for each code point."""
    out = np.zeros(sys.maxunicode + 2, np.uint8)
    out[_category("L")], out[_category("N")], out[[ord(c) for c in WHITE]] = LETTER, NUMBER, SPACE
    return out


def pre_tokens(parts: list[tuple[bool, str]]) -> tuple[pa.BinaryArray, np.ndarray]:
    """Words of all parts, one after the other, and how many each part has.

    The public pattern is ``'(s|t|re|ve|m|ll|d)| ?L+| ?N+| ?O+|S+(?!\\S)|S+``.  As each
    class is matched greedily, words start where the class changes, but a space
    goes with what follows, the last of several white characters stands apart from
    those before, and a lone apostrophe may open a contraction.  A special part
    (True, text) is one word.
    """
    joined = "".join([text for _, text in parts])
    code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    lengths = np.fromiter((len(text) for _, text in parts), np.int64, len(parts))
    begins = np.cumsum(lengths) - lengths
    kind = _classes()[code]
    opens = np.zeros(len(code) + 1, bool)  # a part starts here, or the last one has ended
    opens[begins], opens[-1] = True, True
    starts = opens.copy()
    starts[1:-1] |= kind[1:] != kind[:-1]
    after_white = np.flatnonzero(~opens[1:-1] & (kind[:-1] == SPACE) & (kind[1:] != SPACE)) + 1
    starts[after_white - 1] = True
    starts[after_white[code[after_white - 1] == 32]] = False
    quotes = np.flatnonzero((code == 39) & starts[:-1])
    for tail in CONTRACTIONS:
        at = quotes
        for k, c in enumerate(tail, 1):
            at = at[(at + k < len(code))]
            at = at[(code[at + k] == ord(c)) & ~opens[at + k]]
        starts[at + 1], starts[at + 1 + len(tail)] = False, True
    for at in [k for k, (special, _) in enumerate(parts) if special]:
        starts[begins[at] + 1 : begins[at] + lengths[at]] = False
    places = np.flatnonzero(starts)
    data = joined.encode()
    if len(data) != len(code):
        width = 1 + (code >= 0x80).astype(np.int8) + (code >= 0x800) + (code >= 0x10000)
        ends = np.cumsum(width)
        offsets = np.where(places > 0, ends[places - 1], 0)
    else:
        offsets = places
    words = pa.Array.from_buffers(pa.binary(), max(len(places) - 1, 0), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])
    counted = np.concatenate(([0], np.cumsum(starts[:-1])))
    return words, counted[begins + lengths] - counted[begins]


_SAFE_CUT = re.compile(r"(?<=[a-z]) (?=[a-z])")


def pieces(text: str) -> Iterator[str]:
    """Cut a long text before spaces between two ASCII letters, where a pre-token always starts."""
    at = 0
    while len(text) - at > PIECE and (cut := _SAFE_CUT.search(text, at + PIECE)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class ByteBPE:
    """Vocabulary and merge ranks of a ``tokenizers`` JSON file (byte-level BPE)."""

    def __init__(self, content: str):
        spec = json.loads(content)
        to_byte = byte_alphabet()
        self.ids = {bytes(to_byte[c] for c in t): i for t, i in spec["model"]["vocab"].items()}
        self.bytes_of = {i: t for t, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_bytes = {s.encode(): i for s, i in self.special.items()}
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        # lengths of the tokens that start with three bytes, longest first
        starting: dict[bytes, set[int]] = {}
        for t in self.ids:
            if len(t) > 2:
                starting.setdefault(t[:3], set()).add(len(t))
        self.lengths = {start: sorted(found, reverse=True) for start, found in starting.items()}
        self.byte_id = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left = np.array([spec["model"]["vocab"][a] for a, _ in merges], np.int64)
        right = np.array([spec["model"]["vocab"][b] for _, b in merges], np.int64)
        made = np.array([spec["model"]["vocab"][a + b] for a, b in merges], np.int64)
        keys = (left << 32) | right
        order = np.argsort(keys)
        self.pair_keys, self.pair_rank, self.pair_made = keys[order], order.astype(np.int32), made[order]

    def segments(self, text: str) -> Iterator[tuple[bool, str]]:
        """The text's parts: (True, special string) or (False, ordinary piece)."""
        if self.special_split and any(s in text for s in self.special):
            split = self.special_split.split(text)
        else:
            split = [text]
        for k, part in enumerate(split):
            if k % 2:
                yield True, part
            elif part:
                for piece in pieces(part):
                    yield False, piece

    def groups(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, pa.DictionaryArray]]:
        """Words of the texts, some texts at a time: the text's place for each word, and the word."""
        parts, owners, size = [], [], 0

        def words() -> tuple[np.ndarray, pa.DictionaryArray]:
            found, n = pre_tokens(parts)
            return np.repeat(np.array(owners), n), found.dictionary_encode()

        for k, text in enumerate(texts):
            for part in self.segments(text or ""):
                parts.append(part)
                owners.append(k)
                size += len(part[1])
                if size >= GROUP:
                    yield words()
                    parts, owners, size = [], [], 0
        if parts:
            yield words()

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (NO_RANK if it never merges) and its place in the merge table."""
        keys = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_rank[at], NO_RANK), at

    def merge_together(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Merge many (non-empty) words at once; their symbols, one word after the other, and their numbers.

        The words are one ragged array.  In each round every word applies its own
        lowest-ranked pair at all its places; a word without one is finished.  Words
        of over LONG bytes apart: see :meth:`merge_long`.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        if (lengths > LONG).any():
            merged, counts = [np.zeros(0, np.int64)] * len(words), np.zeros(len(words), np.int64)
            for part, merge in ((np.flatnonzero(lengths <= LONG), self.merge_together), (np.flatnonzero(lengths > LONG), self.merge_long)):
                symbols, counts[part] = merge([words[k] for k in part.tolist()])
                for k, s in zip(part.tolist(), np.split(symbols, np.cumsum(counts[part])[:-1]) if len(part) else [], strict=True):
                    merged[k] = s
            return np.concatenate(merged), counts
        symbols = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        counts = np.zeros(len(words), np.int64)
        finished = []
        while len(symbols):
            rank, at = self.lookup(symbols[:-1], symbols[1:])
            rank = np.append(np.where(owner[:-1] == owner[1:], rank, NO_RANK), NO_RANK)
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            sizes = np.diff(np.append(starts, len(owner)))
            lowest = np.minimum.reduceat(rank, starts)
            done = lowest == NO_RANK
            counts[owner[starts[done]]] = sizes[done]
            keep = ~np.repeat(done, sizes)
            finished.append((owner[~keep], symbols[~keep]))
            # where a pair overlaps itself (aaa), every second place counts, from the left
            places = np.flatnonzero((rank == np.repeat(lowest, sizes)) & keep)
            if len(places):
                order = np.arange(len(places))
                run_start = np.maximum.accumulate(np.where(np.append(True, np.diff(places) > 1), order, 0))
                places = places[(order - run_start) % 2 == 0]
                symbols[places] = self.pair_made[at[places]]
                keep[places + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        owners = np.concatenate([o for o, _ in finished] or [owner])
        return np.concatenate([x for _, x in finished] or [symbols])[np.argsort(owners, kind="stable")], counts

    def merge_long(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`merge_together`, for long words: in about linear time, by linked symbols.

        The pairs' places are kept by rank.  The lowest rank is taken from all its
        places at once; only the pairs beside them are looked up again.
        """
        symbols = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        n = len(symbols)
        after, before = np.arange(1, n + 2), np.arange(-1, n)  # place n is a wall
        symbols = np.append(symbols, 0)
        wall = np.zeros(n + 1, bool)  # no pair starts here
        wall[ends - 1], wall[n] = True, True
        rank, made = np.full(n + 1, NO_RANK, np.int32), np.zeros(n + 1, np.int64)
        alive = np.ones(n + 1, bool)
        places: dict[int, list[np.ndarray]] = {}
        waiting: list[int] = []

        def look_up(at: np.ndarray) -> None:
            at = at[~wall[at]]
            found, pair = self.lookup(symbols[at], symbols[after[at]])
            rank[at] = found
            hit = found != NO_RANK
            at, found = at[hit], found[hit]
            made[at] = self.pair_made[pair[hit]]
            order = np.argsort(found, kind="stable")
            at, found = at[order], found[order]
            starts = np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(found) else found
            for r, part in zip(found[starts].tolist(), np.split(at, starts[1:]) if len(found) else [], strict=True):
                if r not in places:
                    places[r] = []
                    heapq.heappush(waiting, r)
                places[r].append(part)

        look_up(np.arange(n))
        while waiting:
            lowest = heapq.heappop(waiting)
            at = np.unique(np.concatenate(places.pop(lowest)))
            at = at[alive[at] & (rank[at] == lowest)]
            if not len(at):
                continue
            # where a pair overlaps itself (aaa), every second place counts, from the left
            order = np.arange(len(at))
            run_start = np.maximum.accumulate(np.where(np.append(True, after[at[:-1]] != at[1:]), order, 0))
            at = at[(order - run_start) % 2 == 0]
            gone = after[at]
            symbols[at], wall[at] = made[at], wall[gone]
            alive[gone], rank[gone], rank[at] = False, NO_RANK, NO_RANK
            after[at] = after[gone]
            before[after[at]] = at
            beside = before[at]
            look_up(np.unique(np.concatenate((at, beside[(beside >= 0)]))))
        kept = np.flatnonzero(alive[:n])
        return symbols[kept], np.diff(np.append(0, np.searchsorted(kept, ends)))


_loaded: dict[int, ByteBPE] = {}


def loaded(content: str) -> ByteBPE:
    """One parsed vocabulary per worker and file."""
    key = hash(content)
    if key not in _loaded:
        _loaded[key] = ByteBPE(content)
    return _loaded[key]


def vocabulary_text(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()
