"""Corpus-wide operators and the pipeline against brute force on small tables with the odd cases."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltframe.llm import ngram_join, repeats, substring_dedup, suffix_dedup, topk
from voltframe.llm.decontaminate import words
from voltframe.llm.suffix import suffix_array

SCHEMA = "doc_id long, text string, __row string, lo string, n_words string"


@pytest.fixture(scope="module")
def cases():
    rng = np.random.default_rng(7)
    pool = [f"t{i}" for i in range(500)]

    def text(n):
        return " ".join(rng.choice(pool, n))

    a, b, c = text(120), text(80), text(60)
    near = a.split()
    near[60] = "other"
    out = [(0, a), (1, a), (2, " ".join(near)), (3, text(30) + " " + b[:260] + " " + text(20)), (4, b), (4, b), (None, b + " tail"), (5, None), (6, ""), (7, "x" * 700), (8, "é" * 300 + c), (9, c + " " + c), (10, "a b c"), (11, "a  b c"), (12, text(3000))]
    return [(i, t, "r", "l", "w") for i, t in out]


def expected_rows(cases):
    return sorted(((i, (t or "")) for i, t, *_ in cases), key=lambda x: (x[0] is not None, x[0] or 0))


@pytest.mark.parametrize("hot", [20_000, 0])
def test_suffix_dedup(spark, cases, hot, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "CHUNK", 2000)
    count = Counter()
    docs = [(i, t.encode()) for i, t in expected_rows(cases)]
    for _, t in docs:
        count.update(t[i : i + 200] for i in range(len(t) - 199))
    want = Counter()
    for i, t in docs:
        gone = bytearray(len(t))
        for p in range(len(t) - 199):
            if count[t[p : p + 200]] > 1:
                gone[p : p + 200] = b"\1" * 200
        kept = bytes(x for x, y in zip(t, gone, strict=True) if not y)
        want[i, len(t), len(t) - len(kept), sum(gone[p] and not (p and gone[p - 1]) for p in range(len(t))), hashlib.sha256(kept).hexdigest()] += 1
    got = suffix_dedup.dedup(spark.createDataFrame(cases, SCHEMA))
    assert Counter(map(tuple, got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())) == want
    assert suffix_dedup.dedup(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("hot", [20_000, 0])
def test_substring_dedup(spark, cases, hot, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", hot)
    seen, want = set(), Counter()
    for i, t in expected_rows(cases):
        w = t.encode().split()
        gone = [False] * len(w)
        for p in range(len(w) - 19):
            k = tuple(w[p : p + 20])
            if k in seen:
                gone[p : p + 20] = [True] * 20
            seen.add(k)
        kept = [x for x, y in zip(w, gone, strict=True) if not y]
        want[i, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()] += 1
    got = substring_dedup.dedup(spark.createDataFrame(cases, SCHEMA), with_text=True)
    assert Counter(map(tuple, got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect())) == want
    assert substring_dedup.dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_suffix_array():
    rng = np.random.default_rng(1)
    text = np.append(rng.integers(1, 3, 300), 0)
    assert suffix_array(text).tolist() == sorted(range(301), key=lambda i: text[i:].tolist())


@pytest.mark.parametrize("block", [ngram_join.BLOCK, 60])
def test_ngram_join(spark, cases, block):
    docs = expected_rows(cases)
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if (w := words(t.encode())) else None for _, t in docs]
    linked = [[j for j, y in enumerate(sets) if j != i and x and y and len(x & y) >= 0.8 * len(x | y) - 1e-9] for i, x in enumerate(sets)]
    label = list(range(len(docs)))
    for _ in docs:
        for i, js in enumerate(linked):
            label[i] = min([label[i], *(label[j] for j in js)])
    got = ngram_join.classes(spark.createDataFrame(cases, SCHEMA), block=block).collect()
    assert Counter((r["doc_id"], r["n_links"]) for r in got) == Counter((i, len(js)) for (i, _), js in zip(docs, linked, strict=True))
    sizes = Counter(Counter(r["class_id"] for r in got).values())
    assert sizes == Counter(Counter(label).values())
    assert ngram_join.classes(spark.createDataFrame([], SCHEMA)).count() == 0
    kept = ngram_join.one_of_each(spark.createDataFrame(cases, SCHEMA))
    assert kept.count() == len(set(label)) and kept.columns == ["doc_id", "text", "__row", "lo", "n_words"]


def test_forest_depth():
    assert ngram_join.depth_for(0.8, 0.9999) == 4
    assert 1 - (1 - 0.8 ** ngram_join.depth_for(0.8, 0.9999)) ** ngram_join.TREES >= 0.9999


def test_top_k(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, rng.normal(size=8).round(2).tolist()) for i in range(350)]
    vectors += [(350, vectors[3][1]), (400, None), (500, [1.0, float("nan")]), (600, [float("inf")]), (700, [1.0, None]), (None, [1.0]), (800, [0.5]), (351, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in vectors], "vec_id long, embedding array<double>, score int")
    fine = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, x in fine:
        if q % 100 == 0:
            best = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in fine if i != q)[:10]
            want += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    for shard in (topk.SHARD_ROWS, 90):
        got = topk.top_k(df, F.col("vec_id") % 100 == 0, shard_rows=shard, group_queries=2)
        assert sorted(map(tuple, got.collect())) == sorted(want)
    assert topk.top_k(df.where("false"), F.col("vec_id") % 100 == 0).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "", "en", "s", 0), (10**6 + 2, "5", None, "s", 1)], docs.schema)
    first = corpus_pipeline.keep_known_languages(spark, docs.unionByName(odd), d)
    kept = {r["doc_id"] for r in first.select("doc_id").collect()}
    assert not kept & {10**6, 10**6 + 1, 10**6 + 2} and len(kept) >= 0.97 * docs.count() and first.columns == docs.columns
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, d).collect()}
    assert 0 < len(out) <= len(kept)
    last = corpus_pipeline.mask_secrets(spark, docs, d)
    assert last.columns == docs.columns and last.where("n_chars <> length(text)").isEmpty() and last.where("text like '%AKIA%'").isEmpty()
