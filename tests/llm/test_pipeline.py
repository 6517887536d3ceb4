"""The pipeline's stages: each works on what its predecessor kept, and its decisions take effect."""

import hashlib
import random
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from terrakern.llm.common import stage


def test_stages(spark):
    rnd = random.Random(2)
    prose = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(n))
    shared = prose(60)
    rows = [(i, prose(80), "en", f"s{i % 3}") for i in range(60)]
    rows += [(100, rows[3][1], "en", "s1"), (101, rows[4][1] + " tail", "en", "s1"), (102, prose(40) + " " + shared, "en", "s0"), (103, prose(40) + " " + shared, "en", "s2"), (104, "a b c", "en", "s0"), (105, None, None, None)]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {}
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, ""), name)
        kept[name] = docs.collect()
        if name != "encode":
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
    ids = {name: {r.doc_id for r in found} for name, found in kept.items()}
    assert ids["quality"] == set(range(60)) | {100, 101, 102, 103}
    assert ids["near_dedup"] == set(range(60)) | {102, 103}
    texts = {r.doc_id: r for r in kept["suffix_dedup"]}
    assert shared in texts[102].text and shared not in texts[103].text and texts[103].n_chars == len(texts[103].text)
    assert ids["mix"] <= ids["suffix_dedup"] and all(r.n_tokens == len(r.ids) > 0 for r in kept["encode"])


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(n))


def _plain(rows):
    """What the pipeline keeps of (doc_id, text) of one source, none of them an outlier: (doc_id, n_tokens, ids_sha256) counted."""

    def repeated(words):
        at = {}
        for i in range(len(words) - 4):
            at.setdefault(tuple(words[i : i + 5]), []).append(i)
        return len({i + k for places in at.values() if len(places) > 1 for i in places for k in range(5)})

    passed = {}
    for doc_id, text in rows:
        words = (text or "").split()
        if len(words) >= 10 and 100 * repeated(words) <= 20 * len(words):
            passed[doc_id] = text
    shingles = {d: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for d, w in ((d, t.split()) for d, t in passed.items())}
    root = {d: d for d in passed}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in passed:
        for b in passed:
            if a < b and len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    kept = {d: passed[d].encode() for d in sorted(passed) if find(d) == d}
    seen, found = set(), Counter()
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    for d, text in kept.items():
        gone = {i + k for i in range(len(text) - 49) if text[i : i + 50] in seen for k in range(50)}
        seen |= {text[i : i + 50] for i in range(len(text) - 49)}
        left = bytes(x for i, x in enumerate(text) if i not in gone).decode()
        if left:
            ids = tokenizer.encode(left, add_special_tokens=False).ids
            found[d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()] += 1
    return found


def test_run_equals_a_plain_version(spark, tmp_path):
    rnd = random.Random(5)
    passage, long_text = _prose(rnd, 55), _prose(rnd, 6000)
    texts = [_prose(rnd, rnd.randint(60, 120)) for _ in range(50)]
    rows = list(enumerate(texts))
    rows += [(60, texts[7]), (61, texts[8] + " tail"), (62, "head " + texts[8]), (63, "one two three"), (64, None), (65, ""), (66, " ".join(["a b c d e f"] * 9))]
    rows += [(70 + k, _prose(rnd, 40 + k) + " " + passage + " " + _prose(rnd, 30)) for k in range(4)] + [(80, long_text)]
    rows += [rows[3], rows[3]]  # repeated rows
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or ""), 5, "x") for d, t in rows], f"{SCHEMA}, kept int, class_id string")  # extra columns that clash
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in out) == _plain(rows)
    assert {60, 61, 62, 63, 64, 65, 66}.isdisjoint(r.doc_id for r in out) and {70, 71, 72, 73, 80} <= {r.doc_id for r in out}


def test_run_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_run_with_nulls_in_every_column(spark, tmp_path):
    rnd = random.Random(9)
    texts = [_prose(rnd, 70) for _ in range(12)]
    rows = [(i, t, "en" if i % 2 else None, "s" if i % 3 else None, None) for i, t in enumerate(texts)]
    rows += [(None, _prose(rnd, 70), None, None, None), (None, None, None, None, None), (50, texts[4], None, None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, ""), name)
        kept[name] = docs.collect()
    assert Counter(r.doc_id for r in kept["quality"]) == Counter([*range(12), None, 50])
    assert Counter(r.doc_id for r in kept["near_dedup"]) == Counter([*range(12), None])
    assert all(r.n_chars == len(r.text) > 0 for r in kept["suffix_dedup"])
    sources = {r.source for r in kept["mix"]}
    assert sources == {None, "s"} and kept["encode"]
