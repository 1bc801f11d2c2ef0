"""Each operator against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import base64
import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from voltframe.llm import bpe, decontaminate, language, secrets, token_count, toxicity
from voltframe.llm.fm_index import FMIndex

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = [None, "", "   ", "Hello  world!\n\n it's 123 aéß 中文 x", "The quick brown fox " * 300, "\x1c \x85  tab\tend ", "aaaaaaaaaaaaaaaa" * 8, "The quick brown fox " * 300]
CLASH = "doc_id long, text string, n_tokens string, __row string, score string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i if i != 2 else None, t, "x", "y", "z") for i, t in enumerate(TEXTS)], CLASH)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def test_bpe_is_tiktoken(docs, none):
    import tiktoken

    ranks = bpe.parse_ranks(bpe.load_ranks(RANKS))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = Counter((r["n_tokens"], r["ids_sha256"], r["decoded"]) for r in bpe.encode(docs, RANKS, public_tokenizers.PATTERN, with_ids=True, with_text=True).collect())
    want = Counter()
    for t in TEXTS:
        ids = own.encode_ordinary(t or "")
        want[len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), t or ""] += 1
    assert got == want and bpe.encode(none, RANKS, public_tokenizers.PATTERN).count() == 0


def test_token_counts_are_greedy(docs, none):
    vocabulary = set(base64.b64decode(x.split()[0]) for x in open(RANKS, "rb"))

    def pieces(word):
        n = 0
        while word:
            k = next(k for k in range(len(word), 0, -1) if word[:k] in vocabulary)
            word, n = word[k:], n + 1
        return n

    want = Counter((len(t.encode().split()), sum(pieces(b" " + w) for w in t.encode().split())) for t in (t or "" for t in TEXTS))
    assert Counter((r["n_words"], r["n_tokens"]) for r in token_count.token_counts(docs, RANKS).collect()) == want
    assert token_count.token_counts(none, RANKS).count() == 0


def test_automaton_on_a_tricky_vocabulary():
    vocabulary = [bytes([b]) for b in b"abcd"] + [b"ab", b"abcd", b"bcda", b"cdab", b"aba"]
    auto = token_count.Automaton(vocabulary)
    rng = np.random.default_rng(3)
    for _ in range(300):
        word = bytes(rng.choice(list(b"abcd"), rng.integers(0, 12)).tolist())
        rest, n = word, 0
        while rest:
            rest, n = rest[max(len(v) for v in vocabulary if rest.startswith(v)) :], n + 1
        assert auto.pieces(word) == n


ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(t):
    x = [(m.start(), 0, "assign:%d:%d" % m.span()) for m in ASSIGN.finditer(t) if len(m[1]) >= 8]
    x += [(m.start(), 1, "access:%d:%d" % m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    x += [(m.start(), 2, "hex:%d:%d" % m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return ",".join(y[2] for y in sorted(x))


def test_secrets(spark, none):
    key = "Zx81kQpLm4Tt9vWw2Ry7Bn"
    cases = [None, "", f"é k = {key}!", "token: api_key: abcdefgh12", "PASSWORD='longenough1' token=secret=abcdefghijk", "AKIA AKIAAKIAAKIA1234 " + "0123456789abcdef" * 3, "calculate_total_balance_for_customer mentallychlichkeitenin", f"token = \"{'ab12' * 10}\"" * 3]
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in secrets.scan(df).collect()}
    for i, t in enumerate(cases):
        assert got[i]["base_sha256"] == hashlib.sha256(base_spans(t or "").encode()).hexdigest(), t
    assert got[2]["spans"] == f"markov:6:{6 + len(key)}" and got[6]["spans"] == ""
    masked = {r["doc_id"]: r["text"] for r in secrets.redact(df).collect()}
    assert masked[2] == "é k = [SECRET]!" and masked[0] is None and masked[6] == cases[6] and "ab12" not in masked[7]
    assert secrets.scan(none).count() == 0


def test_decontamination(spark, docs, none):
    words = [f"w{i}" for i in range(400)]
    bench = [(1, " ".join(words[:20])), (10, " ".join(words[30:33])), (2, None), (3, "!!"), (None, "w399"), (1, " ".join(words[50:63]))]
    cases = [None, "", " ".join(words), "W5-w6,w7 " + " ".join(words[8:17]), "w0 w1 " + " ".join(words[2:14]) + " x " * 300, "w30 w31 w32", "w30 w31 w31 w32"]
    items = spark.createDataFrame(bench, "item_id long, text string")
    df = spark.createDataFrame([*enumerate(cases), (2, cases[2])], "doc_id long, text string")
    windows = {}
    for item, t in bench:
        w = decontaminate.words((t or "").encode())
        for i in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[i : i + 13]), set()).update([str(item)] if item is not None else [])  # words of unnamed items are hit, too
    for part_bytes in (1 << 20, 60):
        got = decontaminate.find(df, items, part_bytes=part_bytes).collect()
        assert len(got) == len(cases) + 1
        for r in got:
            w = decontaminate.words((cases[r["doc_id"]] or "").encode())
            hit, found = set(), set()
            for k, owners in windows.items():
                for i in range(len(w) - len(k) + 1):
                    if tuple(w[i : i + len(k)]) == k:
                        hit.update(range(i, i + len(k)))
                        found |= owners
            assert (r["n_words"], r["n_hit"], r["items"]) == (len(w), len(hit), sorted(found))
    assert decontaminate.find(none, items).count() == 0
    assert decontaminate.clean(docs, items.where("false")).count() == len(TEXTS)
    assert decontaminate.clean(docs, items).columns == docs.columns


def test_fm_index():
    rng = np.random.default_rng(5)
    text = np.append(rng.integers(0, 4, 500), 0)
    index = FMIndex(text, 4, rate=4)
    for _ in range(100):
        p = rng.integers(1, 4, rng.integers(1, 6))
        lo, hi = index.search(p[None, :], np.array([len(p)]))
        want = [i for i in range(len(text) - len(p) + 1) if (text[i : i + len(p)] == p).all()]
        assert sorted(index.locate(np.arange(lo[0], hi[0])).tolist()) == want


def test_toxicity(spark, none):
    rng = np.random.default_rng(1)
    vocabulary = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(10) for j in range(10)]

    def document(toxic):
        lines = [" ".join(rng.choice(vocabulary, 8)) for _ in range(6)]
        if toxic:
            lines[3] += " vile"
        return ". ".join(lines) + "."

    rows = [(document(i % 2), i % 2) for i in range(300)]
    weights, bias = toxicity.fit(rows)
    cases = [(i, document(i % 2)) for i in range(60)] + [(100, None), (101, ""), (102, "...")]
    df = toxicity.score(spark.createDataFrame(cases, "doc_id long, text string"), (weights, bias))
    for r in df.collect():
        if r["doc_id"] >= 100:
            assert r["score"] == 0
        else:
            text = cases[r["doc_id"]][1]
            assert (r["score"] >= 0.5) == bool(r["doc_id"] % 2)
            assert all("vile" in text[x["s"] : x["e"]] for x in r["offending"]) and len(r["offending"]) == r["doc_id"] % 2
    assert toxicity.fit([]) == ({}, toxicity.BIAS) and toxicity.score(none, ({}, -7.0)).count() == 0


def test_forward_backward_in_blocks():
    rng = np.random.default_rng(0)
    k, lengths = 3, np.array([0, 1, 5, 7, 8, 50, 3])
    s, tr = rng.normal(size=(lengths.sum(), k)) * 2, rng.normal(size=(k, k))
    got, at = language.posteriors(s, lengths, tr, block=7), 0
    for n in lengths:
        e, a = np.exp(s[at : at + n]), np.exp(tr)
        alpha, beta = [e[0]] if n else [], [np.ones(k)]
        for t in range(1, n):
            alpha.append(alpha[-1] @ a * e[t])
        for t in range(n - 1, 0, -1):
            beta.append(a @ (e[t] * beta[-1]))
        if n:
            p = np.array(alpha) * np.array(beta[::-1])
            assert np.allclose(got[at : at + n], p / p.sum(1, keepdims=True))
        at += n


def test_language(spark, none):
    rng = np.random.default_rng(2)
    stems = {"aa": ["lor", "mip", "dol"], "bb": ["zak", "wux", "qey"]}

    def text(lang, n=40):
        return " ".join("".join(rng.choice(stems[lang], rng.integers(1, 4))) for _ in range(n))

    model = language.fit([(text(x), x) for x in ("aa", "bb") for _ in range(60)])
    mixed = text("aa", 30) + " " + text("bb", 30)
    df = spark.createDataFrame([(0, text("aa")), (1, text("bb", 900)), (2, None), (3, ""), (4, "12 ?!"), (4, "12 ?!")], "doc_id long, text string")
    got = [(r["doc_id"], r["__lang_pred"], r["__score"]) for r in language.predict(df, model).collect()]
    assert [g[:2] for g in got] == [(0, "aa"), (1, "bb"), (2, "und"), (3, "und"), (4, "und"), (4, "und")] and got[1][2] > 0.9 and got[2][2] == 0
    p, lengths = language.Tagger(model).words([mixed])
    assert (p[:30].argmax(1) == 0).mean() > 0.9 and (p[30:].argmax(1) == 1).mean() > 0.9 and lengths[0] == 60
    empty = language.fit([])
    assert [r["__lang_pred"] for r in language.predict(df, empty).collect()] == ["und"] * 6 and language.predict(none, model).count() == 0
