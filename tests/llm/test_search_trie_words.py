"""Ranked search, the prefix trie and word BPE against brute force, odd cases included."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from voltframe.llm import prefix_trie, ranked_search, word_bpe

LONG = " ".join(["alpha"] * 900 + ["beta"] * 300)
DOCS = [
    (1, "Alpha beta, ALPHA; gamma-delta 42"), (2, "alpha"), (3, "alpha"), (4, None), (5, ""), (6, " ,;\n"), (7, "beta beta beta gamma ñandú Ñandú É"), (8, LONG), (9, "delta " * 40 + "alpha"),
    (10, "alpha beta gamma delta"), (10, "alpha beta"), (None, "alpha"), (11, "zeta eta"), (12, "x" * 5000 + " beta"), (13, "日本 語 alpha"), (14, "beta gamma")] + [(100 + i, " ".join(random.Random(i).choices("alpha beta gamma delta eps zeta eta theta".split(), k=3 + i % 17))) for i in range(120)]
ITEMS = [(1, "alpha alpha gamma"), (2, "BETA? delta."), (3, None), (4, "..."), (5, "nowhere to be found"), (1, "zeta"), (None, "eta theta 42"), (6, "ñandú é Ñandú"), (7, "alpha alpha gamma")]
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return WORD.findall((text or "").translate(UPPER))


def ranked(docs, items, k):
    held = [(i, terms(t)) for i, t in docs if terms(t)]
    n_docs, n_terms = len(held), sum(len(w) for _, w in held)
    df = Counter(t for _, w in held for t in set(w))
    out = []
    for item, text in items:
        scores = []
        for i, w in held:
            tf, m = Counter(w), 100 - 50 + (50 * len(w) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 20 * m)) for t in set(terms(text)) if t in tf)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize(("k", "shard_size", "part_items"), [(50, 2_000_000, 10_000), (3, 60, 2)])
def test_ranked_search(spark, k, shard_size, part_items):
    docs = spark.createDataFrame([(i, t, 1) for i, t in DOCS], "doc_id long, text string, score int").repartition(5)
    items = spark.createDataFrame([(i, t, "c") for i, t in ITEMS], "item_id long, text string, rank string")
    got = ranked_search.search(docs, items, k=k, shard_size=shard_size, part_items=part_items)
    assert Counter(map(tuple, got.select("item_id", "rank", "doc_id", "score").collect())) == ranked(DOCS, ITEMS, k)
    assert ranked_search.search(docs.where("false"), items).count() == 0 and ranked_search.search(docs, items.where("false")).count() == 0


def test_shard_prunes_and_stays_exact():
    rng = np.random.default_rng(0)
    n, queries = 3000, [[0, 1, 2, 3], [4, 5], [0, 9], [7]]
    lists = {t: np.flatnonzero(rng.random(n) < p) for t, p in enumerate([0.5, 0.4, 0.02, 0.01, 0.3, 0.01, 0.1, 0.2])}
    parts = {t: rng.integers(1, 20 if t in (0, 1, 4) else 900, len(x)) for t, x in lists.items()}
    term, doc, part = (np.concatenate(x) for x in zip(*((np.full(len(lists[t]), t), lists[t], parts[t]) for t in lists), strict=True))
    order = np.argsort(doc, kind="stable")
    shard = ranked_search.Shard(term[order], doc[order].astype(np.int32), part[order], list(range(n)), block=64)
    for q in queries:
        best = ranked_search.Best(10)
        shard.search(q, best)
        score = np.zeros(n, np.int64)
        for t in q:
            if t in lists:
                score[lists[t]] += parts[t]
        want = sorted((-s, i) for i, s in enumerate(score.tolist()) if s)[:10]
        assert [(s, i) for s, _, i in best.rows] == want
    assert 0 < shard.probed < 0.2 * sum(map(len, lists.values()))


def test_long_texts_are_counted_by_pieces():
    text = " ".join(f"w{i % 7} tail" for i in range(5000)).encode()
    for piece in (1, 13, 1 << 20):
        assert ranked_search.counted(text, {b"w3": 0, b"tail": 1}, piece) == (10_000, Counter({1: 5000, 0: 714}))


def trie_by_hand(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            leaf = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            turns[c].append((t is not None, t or 0, leaf, role, text))
    turns = {c: [x[3:] for x in sorted(v)] for c, v in turns.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(turns.get(c - c % 5, [])[:h] + own[h:])
    nodes = defaultdict(list)
    for c, x in sorted(built.items()):
        for d in range(len(x) + 1):
            nodes[x[:d]].append(c)
    out = []
    for x, members in nodes.items():
        below = [y for y in nodes if y[: len(x)] == x]
        leaves = [y for y in below if not any(len(z) == len(y) + 1 and z[:-1] == y for z in nodes)]
        ends = ",".join(str(c) for c in members if len(built[c]) == len(x))
        saved = sum((len(nodes[y]) - 1) * len(y[-1][1].encode()) for y in below if y)
        out.append((members[0], len(x), nodes[x[:-1]][0] if x else None, len(members), sum(len(z) == len(x) + 1 and z[:-1] == x for z in nodes), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def conversations():
    rng = random.Random(4)
    rows = [(c, t, "user" if t % 2 else "bot", rng.choice(["hi", "yes é", "no", "go on"])) for c in range(60) for t in range(rng.randrange(1, 7))]
    long = [("user", f"turn {i % 3}") for i in range(70)]
    rows += [(c, t, *x) for c in (100, 105, 110) for t, x in enumerate(long[: 70 if c < 110 else 40])]
    rows += [(200, None, None, None), (200, 1, "a", "b"), (200, 1, "a", "b"), (200, 1, "a", "a"), (None, 1, "x", "y"), (203, 5, "q", ""), (1_000_003, 1, "only", "own")]
    rows += [(c, t, "user", "same") for c in range(300, 340) for t in range(9)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [4, 4096])
def test_prefix_trie(spark, monkeypatch, block):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    rows = conversations()
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, depth int").repartition(6)
    if block == 4:  # hot digests are looked up apart from others
        monkeypatch.setattr(prefix_trie, "HOT", 0.02)
    assert sorted(map(tuple, prefix_trie.trie(df).collect())) == trie_by_hand(rows)
    if block == 4:
        assert prefix_trie.trie(df.where("false")).count() == 0


def test_conversations_cut_by_tasks(spark):
    """One conversation over many tasks: places and digests go on where the task before ended."""
    rows = [(7, t, "r", f"x{t % 5}") for t in range(4000)] + [(3, 0, "r", "x"), (9, 0, "r", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found, pieces = prefix_trie.ordered(df, "conv_id", "turn", "role", "text")
        assert pieces.where("c = 7").select("task").distinct().count() > 1
        got = [(r["p"], bytes(r["s"])) for r in found.where("c = 7").orderBy("p").collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    s, want = 0, []
    for p, (_, _, role, text) in enumerate(rows[:4000], 1):
        leaf = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
        s = (s * prefix_trie.BASE + int.from_bytes(leaf, "big")) % prefix_trie.PRIME
        want.append((p, s.to_bytes(16, "big")))
    assert got == want


FILE = public_tokenizers.path("word_bpe_49k.json")


def test_word_bpe(spark):
    library = Tokenizer.from_file(FILE)
    rng = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyzABCé '.,-_019\n\t"
    texts = [None, "", " \n", "Hello World don't 123", "<|startoftext|>hi <|endoftext|><|endoftext|>x", "a<|endoftext|", "AΣ ΟΔΟΣ İstanbul ǅ", "é ́a\x1cb \x1f1\x85x", "'S it's 'LL", "日本語 ½ ② 𝒜 \U0001f600\U0001f600", "a" * 3000, "inin" * 500, "x " * 700_000, "é" * 1_200_000]
    texts += ["".join(rng.choices(letters, k=rng.randrange(120))) for _ in range(400)] + ["".join(chr(rng.randrange(32, 0x3000)) for _ in range(60)) for _ in range(100)]
    df = spark.createDataFrame([(i % 50, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")

    def coded(i, text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        plain = library.decode(ids, skip_special_tokens=False)
        return i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(plain.encode()).hexdigest(), tuple(ids), plain

    got = Counter((*r[:4], tuple(r[4]), r[5]) for r in word_bpe.encode(df, FILE, whole=True).collect())
    assert got == Counter(coded(i % 50, t) for i, t in enumerate(texts))
    assert word_bpe.encode(df.where("false"), FILE).count() == 0


def test_merges_in_any_order():
    """Files whose merges can make a pair of lower rank: least rank first, then leftmost, word by word."""
    rng = random.Random(6)
    for _ in range(40):
        vocabulary = {x: i for i, x in enumerate([*word_bpe.byte_letters(), *(x + "</w>" for x in word_bpe.byte_letters())])}
        tokens, merges = [*"abc", *(x + "</w>" for x in "abc")], []
        while len(merges) < 30:
            a, b = rng.choice(tokens), rng.choice(tokens)
            if not a.endswith("</w>") and (a, b) not in merges and len(a + b) < 14:
                merges.append((a, b))
                if a + b not in vocabulary:
                    vocabulary[a + b] = len(vocabulary)
                    tokens.append(a + b)
        rng.shuffle(merges)
        words = [bytes(rng.choices(b"abc", k=rng.randrange(1, 90))) for _ in range(30)]
        ids, count = word_bpe.Merges(vocabulary, merges, "</w>").encode(words)
        rank, at = {m: i for i, m in enumerate(merges)}, 0
        for w, n in zip(words, count.tolist(), strict=True):
            parts = [*w.decode()[:-1], w.decode()[-1] + "</w>"]
            while found := [(rank[p], i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in rank]:
                _, i = min(found)
                parts[i : i + 2] = ["".join(parts[i : i + 2])]
            assert ids[at : at + n].tolist() == [vocabulary[p] for p in parts], w
            at += n


def test_merges_of_long_lists_as_arrays():
    rng = random.Random(7)
    library = Tokenizer.from_file(FILE)
    text = " ".join("".join(rng.choices("aeinrst", k=rng.randrange(1, 40))) for _ in range(4000)) + " " + "ab" * 4000
    with open(FILE, "rb") as f:
        coder = word_bpe.Coder(f.read())
    assert np.frombuffer(coder.code([text], True)[0][3], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
