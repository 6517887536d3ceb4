"""op1 against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest

from terrakern.llm import suffix_dedup


def brute(rows, span=50):
    key = lambda i: (i is None, i or 0)
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - span + 1):
            w = b[p : p + span]
            first[w] = min(first.get(w, key(i)), key(i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        covered = bytearray(len(b))
        for p in range(len(b) - span + 1):
            if first[b[p : p + span]] < key(i):
                covered[p : p + span] = b"\1" * span
        kept = bytes(c for c, m in zip(b, covered, strict=True) if not m)
        out.append((i, len(b), sum(covered), len([x for x in bytes(covered).split(b"\0") if x]), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rnd = random.Random(seed)
    parts = ["tion", "er", "he", "an", "re", "ou", "è", "ing", "ß", "st"]
    prose = lambda n: " ".join("".join(rnd.choice(parts) for _ in range(rnd.randint(1, 4))) for _ in range(n))
    shared = [prose(rnd.randint(5, 60)) for _ in range(12)]
    rows = []
    for _ in range(250):
        text = [prose(rnd.randint(0, 40))]
        for _ in range(rnd.randint(0, 3)):
            text += [rnd.choice(shared)[rnd.randint(0, 5) :], prose(rnd.randint(0, 10))]
        rows.append((rnd.randint(0, 200), rnd.choice([" ", "\n", ""]).join(text)))
    rows += [(1, None), (None, rows[0][1]), (None, rows[0][1]), (5, ""), (7, "a" * 300), (8, "a" * 1000), (9, "ab" * 200), (11, "ab" * 100 + "b" * 60), (3, rows[5][1]), (3, rows[5][1])]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, small):
    rows = corpus(5)
    if small:  # many blocks, buckets, units and sorting parts
        for name, value in (("BLOCK_BYTES", 3000), ("BUCKET_BYTES", 5000), ("UNIT", 700), ("SORT_AT_ONCE", 50)):
            monkeypatch.setattr(suffix_dedup, name, value)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted([tuple(r) for r in suffix_dedup.dedup(docs, ["doc_id"]).collect()], key=str) == brute(rows)


@pytest.mark.parametrize("hashes", [1, 7, None])
def test_colliding_hashes(monkeypatch, hashes):
    """Two blocks by hand, texts of runs in one hash, a few hashes or their own: the result is the same."""
    if hashes:
        monkeypatch.setattr(suffix_dedup.Runs, "text", property(lambda r: (r.anchor + r.windows.astype(np.uint64)) % np.uint64(hashes)))
    monkeypatch.setattr(suffix_dedup, "UNIT", 5000)
    rows = [(i, t) for i, t in corpus(6) if i is not None]
    blocks = [pa.table({"block": [b] * len(part), "id": [i for i, _ in part], "bytes": [(t or "").encode() for _, t in part]}) for b, part in enumerate((rows[::2], rows[1::2]))]
    by = lambda t, name: [t.filter(pa.compute.equal(t[name], k)) for k in sorted(set(t[name].to_pylist()))]
    sent = pa.concat_tables([suffix_dedup._send_anchors(b, 50, 3) for b in blocks])
    bits = by(pa.concat_tables([suffix_dedup._answer_anchors(t) for t in by(sent, "bucket")]), "block")
    runs = pa.concat_tables([suffix_dedup._send_runs(b, a, 50, 3) for b, a in zip(blocks, bits, strict=True)])
    replies = pa.concat_tables([suffix_dedup._answer_runs(t, 50) for t in by(runs, "bucket")])
    out = []
    for k, b in enumerate(blocks):
        _, ids, texts = suffix_dedup._block_texts(b)
        mine = np.frombuffer(b"".join(r for r, n in zip(replies["replies"].to_pylist(), replies["block"].to_pylist(), strict=True) if n == k), suffix_dedup.REPLY)
        spans = suffix_dedup.merged_spans(suffix_dedup.removed_masks(ids, texts, mine, 50), len(texts))
        kept = [suffix_dedup.kept_bytes(t, s) for t, s in zip(texts, spans, strict=True)]
        out += [(int(i), len(t), len(t) - len(x), len(s), hashlib.sha256(x).hexdigest()) for i, t, s, x in zip(ids, texts, spans, kept, strict=True)]
    assert sorted(out, key=str) == brute(rows)


def test_sorted_suffixes_and_minima():
    rnd = np.random.default_rng(3)
    lengths = rnd.integers(50, 77, 60)
    rows = np.zeros((60, 76), np.uint8)
    for k, n in enumerate(lengths):
        rows[k, :n] = rnd.integers(97, 99, n)
    rows[10:20, :60] = rows[0, :60]
    rows[20:30, 5:55] = rows[0, 0:50]
    rows[30:40, 9:59] = rows[0, 0:50]
    at_row, at = np.repeat(np.arange(60), 20), np.tile(np.arange(20), 60)
    ranks = suffix_dedup.cover_ranks(rows, 50)
    order = suffix_dedup.sorted_suffixes(rows, at_row, at, ranks)
    suffix = [bytes(rows[r, a:]) + b"\0" * 200 for r, a in zip(at_row, at, strict=True)]
    assert all(suffix[order[k]][:80] <= suffix[order[k + 1]][:80] for k in range(len(order) - 1))
    windows = lengths - 49
    offsets, least = suffix_dedup.window_minima(rows, np.zeros(60, np.int64), windows, np.arange(60)[::-1].copy(), 50)
    seen = {}
    for r in range(60):
        for w in range(windows[r]):
            seen.setdefault(bytes(rows[r, w : w + 50]), []).append(59 - r)
    for r in range(60):
        for w in range(windows[r]):
            assert least[offsets[r] + w] == min(seen[bytes(rows[r, w : w + 50])])


def test_empty_and_clashing(spark):
    docs = spark.createDataFrame([(1, "x" * 60, 5, 6), (2, "y" + "x" * 60, 7, 8)], "doc_id long, text string, n_bytes long, row long")
    out = suffix_dedup.dedup(docs, ["doc_id", "row", "n_bytes"])
    assert out.columns == ["doc_id", "row", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert {(r.doc_id, r.row, r.n_bytes, r.n_removed) for r in out.collect()} == {(1, 6, 60, 0), (2, 8, 61, 60)}
    assert suffix_dedup.dedup(docs.limit(0), ["doc_id"]).count() == 0
    kept = {r.doc_id: r.text for r in suffix_dedup.trimmed_documents(docs.union(docs.limit(1).selectExpr("3L", "text", "0L", "0L"))).collect()}
    assert kept == {1: "x" * 60, 2: "y"}
