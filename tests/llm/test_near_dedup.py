"""op4 against brute force."""

import collections
import math
import random

import numpy as np

from terrakern.llm import near_dedup


def brute(rows):
    n = len(rows)
    words = [tuple((t or "").split()) for _, t in rows]
    vectors, df = [], collections.Counter()
    for w in words:
        c = collections.Counter(w[i : i + 5] for i in range(len(w) - 4)) if len(w) >= 5 else collections.Counter([w] if w else [])
        vectors.append(c)
        df.update(c.keys())
    idf = {k: math.log1p(min(n / v, near_dedup.RARE)) ** near_dedup.DAMPING for k, v in df.items()}
    assert len({round(x, 6) for x in idf.values()}) > 10  # weights differ
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if words[i] != words[j]:
                common = sum(min(vectors[i][k], vectors[j][k]) * idf[k] for k in vectors[i].keys() & vectors[j].keys())
                union = sum(v * idf[k] for x in (i, j) for k, v in vectors[x].items()) - common
                if not common or common / union < 0.8:
                    continue
            parent[root(i)] = root(j)
    least = {}
    for i in range(n):
        least[root(i)] = min(least.get(root(i), rows[i][0]), rows[i][0])
    return {rows[i][0]: least[root(i)] for i in range(n)}


def corpus():
    rnd = random.Random(3)
    prose = lambda n: ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 6))) for _ in range(n)]
    base, line, rows = [prose(rnd.choice([3, 8, 30, 120, 300])) for _ in range(40)], prose(12), []
    for i in range(350):
        w = list(rnd.choice(base)) if rnd.random() < 0.7 else prose(rnd.choice([2, 10, 60]))
        for _ in range(rnd.choice([0, 0, 1, 2, 5])):
            w[rnd.randrange(len(w))] = prose(1)[0]
        rows.append((i * 3, rnd.choice([" ", "  "]).join(w + line * (rnd.random() < 0.4))))
    return rows + [(9000, None), (9001, ""), (-5, rows[0][1]), (9003, " \n")]


def test_equals_brute_force(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows)
    assert dict(near_dedup.classes(docs, ["doc_id"]).collect()) == want
    monkeypatch.setattr(near_dedup, "CHUNK", 5)
    assert dict(near_dedup.classes(docs, ["doc_id"]).collect()) == want


def test_frequencies_are_exact(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    df = collections.Counter(h for _, t in rows for h in near_dedup.shingles([t or ""])[1].tolist())
    for rare in (near_dedup.RARE, 20):
        monkeypatch.setattr(near_dedup, "RARE", rare)
        hashes, n = near_dedup.frequent(docs, "text", len(rows))
        assert dict(zip(hashes.tolist(), n.tolist())) == {h: v for h, v in df.items() if v * rare > len(rows)}


def test_samples_estimate_weighted_similarity():
    rnd = np.random.default_rng(1)
    keys = rnd.integers(1, 1 << 62, 400).astype(np.uint64)
    keys.sort()
    a, b = keys[:300], keys[60:]
    wa, wb = rnd.uniform(0.5, 3, 300).astype(np.float32), rnd.uniform(0.5, 3, 340).astype(np.float32)
    exact = near_dedup.similarity((a, wa), b, wb, np.array([340]))[0]
    same = []
    for shift in range(40):
        move = np.uint64(shift * 7919)
        s = near_dedup.samples(np.repeat([0, 1], [300, 340]), np.concatenate((a, b)) ^ move, np.concatenate((wa, wb)), 2)
        same.append((s[0] == s[1]).mean())
    assert abs(np.mean(same) - exact) < 0.04


def test_nulls_repeats_clashes_and_empty(spark):
    rows = [(None, "a b c d e f g", 1), (None, "a b c d e f g", 2), (4, "a b c d e f g", 3), (None, "q q q", 4), (8, "z z z z z z z", 5), (8, "z z z z z z z", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, class_id long")
    got = [tuple(r) for r in near_dedup.classes(docs, ["doc_id", "text"]).collect()]
    assert sorted(c for i, t, c in got if t.startswith("a")) == [4, 4, 4]
    assert [c < 0 for _, t, c in got if t.startswith("q")] == [True]
    kept = sorted([tuple(r) for r in near_dedup.first_of_class(docs).collect()], key=str)
    assert kept == sorted([(4, "a b c d e f g", 3), (8, "z z z z z z z", 5), (None, "q q q", 4)], key=str)
    assert near_dedup.first_of_class(docs.limit(0)).count() == 0
