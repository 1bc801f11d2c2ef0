"""Language identification of words by a linear-chain conditional random field.

A word's score for a language is a sum over its first and last one to three letters, its two- and three-letter
sequences (all of them, however long the word) and the word itself (the lexicon); learned transitions join neighbours. Training cuts labelled documents into
stretches and strings stretches of different ones together, so that labels switch as in mixed text. Forward-backward
gives each word's posterior; a document's language is that of most posterior mass.

Fitting takes at most ``MAX_PER_LABEL`` documents of each language (those whose ids hash lowest; fewer where there are so
many languages that these would be more than ``MAX_ROWS``, but every language teaches) and ``MAX_WORDS`` words of each
language; prediction maps every row's whole text by itself, exactly and in blocks, so that a huge text takes
no more memory than its words. A null text or one without a letter is ``und`` with score 0.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import held_out, read, resident, ship, steps, unused, within

#: What teaches at most: documents and words of each language, documents and bytes of all languages together.
MAX_PER_LABEL, MAX_WORDS, MAX_ROWS, MAX_BYTES = 200, 60_000, 20_000, 96 << 20
#: Each kind of feature has a table of so many weights of its own.
SLOTS = 1 << 16
ROUNDS, RATE, RIDGE = 60, 0.15, 1e-5
SPAN, SEQUENCE, BLOCK = 12, 48, 64
#: Words of more letters have their n-grams made apart, PIECE letters at a time, and count as several in a document's mass.
LETTERS, PIECE = 24, 1 << 16
#: Words and letters of words in a worker's cache before it starts anew; they bound memory.
CACHED, CACHED_LETTERS = 300_000, 8_000_000
#: Bytes of text that are tagged at once; they bound memory, not input.
TEXT_BYTES = 1 << 20
#: Runs of letters and of numerals that are no decimal digits (fractions, circled numbers and the like).
WORD = re.compile(r"[^\W\d_]+")
KINDS = 7  # lexicon, three beginnings, three ends; then n-grams


def words_of(text: str) -> list[str]:
    """Runs of letters."""
    runs = WORD.findall(text)
    if all(map(str.isalpha, runs)):
        return runs
    return [w for r in runs for w in ([r] if r.isalpha() else "".join(c if c.isalpha() else " " for c in r).split())]


def feature_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Weight numbers of each word's features, and which of them exist; n-grams only of words of up to ``LETTERS`` letters."""
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    code = np.zeros((n, LETTERS + 2), np.uint64)
    heads = np.array([w[:LETTERS] for w in words], f"U{LETTERS}").view(np.uint32).reshape(n, LETTERS)
    code[:, 1:-1] = heads
    tails = np.array([w[-3:][::-1] for w in words], "U3").view(np.uint32).reshape(n, 3).astype(np.uint64)
    lexicon = np.fromiter((hash_word(w) for w in words), np.uint64, n)
    out, real = [lexicon], [np.ones(n, bool)]
    mix = np.uint64(0x9E3779B97F4A7C15)
    for k in range(1, 4):
        for side in (code[:, 1:4], tails):
            h = np.zeros(n, np.uint64)
            for i in range(k):
                h = (h ^ side[:, i]) * mix
                h ^= h >> np.uint64(29)
            out.append(h)
            real.append(lengths >= k)
    end = np.where(lengths > LETTERS, -2, lengths)
    for size in (2, 3):
        for i in range(LETTERS + 3 - size):
            exists = i + size <= end + 2
            if not exists.any():
                break
            h = np.zeros(n, np.uint64)
            for j in range(size):
                h = (h ^ code[:, i + j]) * mix
                h ^= h >> np.uint64(29)
            out.append(h)
            real.append(exists)
    kinds = np.array([*range(KINDS), *[KINDS] * (len(out) - KINDS)], np.int64)
    table = (np.stack(out, axis=1) >> np.uint64(20) & np.uint64(SLOTS - 1)).astype(np.int64) + kinds * SLOTS
    return table, np.stack(real, axis=1)


def long_grams(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word and weight number of each two- and three-letter sequence of the words of more than ``LETTERS`` letters; words rise within each pair of arrays."""
    part: list[tuple[int, str]] = []
    total = 0
    for j, w in enumerate(words):
        if len(w) > LETTERS:
            for i in range(0, len(w) + 2, PIECE):
                # pieces overlap by two letters; a zero stands before and after the word
                part.append((j, ("\0" if not i else "") + w[max(i - 1, 0) : i + PIECE + 1] + ("\0" if i + PIECE + 1 > len(w) else "")))
                total += len(part[-1][1])
                if total >= PIECE:
                    yield from _grams(part)
                    part, total = [], 0
    if part:
        yield from _grams(part)


def _grams(part: list[tuple[int, str]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    code = np.frombuffer("".join(x for _, x in part).encode("utf-32-le"), "<u4").astype(np.uint64)
    size = np.array([len(x) for _, x in part])
    piece = np.repeat(np.arange(len(part)), size)
    at = np.arange(len(code)) - np.repeat(np.cumsum(size) - size, size)
    word = np.array([j for j, _ in part])
    mix = np.uint64(0x9E3779B97F4A7C15)
    for n in (2, 3):
        h = np.zeros(max(len(code) - n + 1, 0), np.uint64)
        for j in range(n):
            h = (h ^ code[j : j + len(h)]) * mix
            h ^= h >> np.uint64(29)
        use = (piece[: len(h)] == piece[n - 1 :]) & (at[: len(h)] < PIECE)
        yield word[piece[: len(h)][use]], (h[use] >> np.uint64(20) & np.uint64(SLOTS - 1)).astype(np.int64) + KINDS * SLOTS


def hash_word(w: str) -> int:
    h = 0xCBF29CE484222325
    for b in w.encode():
        h = (h ^ b) * 0x100000001B3 & 0xFFFFFFFFFFFFFFFF
    return h * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF


class Model:
    def __init__(self, labels: list[str], weights: np.ndarray, transitions: np.ndarray):
        self.labels, self.weights, self.transitions = labels, weights.astype(np.float32), transitions

    def emissions(self, words: list[str]) -> np.ndarray:
        """A row of scores for each (lower-case) word."""
        out = np.zeros((len(words), len(self.labels)), np.float32)
        for i in range(0, len(words), 20_000):
            table, real = feature_rows(words[i : i + 20_000])
            part = out[i : i + 20_000]
            for k in range(table.shape[1]):
                part += self.weights[table[:, k]] * real[:, k, None]
            for line, number in long_grams(words[i : i + 20_000]):
                starts = np.flatnonzero(np.diff(line, prepend=-1))
                part[line[starts]] += np.add.reduceat(self.weights[number], starts) if len(starts) else 0
        return out


def messages(e: np.ndarray, a: np.ndarray, first: np.ndarray | None = None) -> np.ndarray:
    """Forward messages, normalised at each place: e is (places, sequences, labels)."""
    out = np.empty_like(e)
    at = None
    for t in range(len(e)):
        at = e[t] * (first if t == 0 and first is not None else 1.0 if t == 0 else at @ a)
        at = at / at.sum(-1, keepdims=True)
        out[t] = at
    return out


def posteriors(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Exact forward-backward over sequences that lie one after the other in ``scores`` (words, labels).

    Each sequence is cut into blocks. What a block does to any incoming message is a small matrix, made for all blocks
    at once; a pass over the blocks of each sequence gives the messages between them, a second pass the words'.
    """
    k, n = scores.shape[1], len(scores)
    if not n or not k:
        return scores.astype(float)
    a = np.exp(transitions - transitions.max())
    counts = -(-lengths // block)
    n_blocks = int(counts.sum())
    size = np.full(n_blocks, block)
    last = np.cumsum(counts) - 1
    used = counts > 0
    size[last[used]] = lengths[used] - (counts[used] - 1) * block
    begin = np.cumsum(size) - size
    place = begin + np.arange(block)[:, None]
    real = np.arange(block)[:, None] < size
    e = np.exp(scores - scores.max(1, keepdims=True)).astype(float)[np.minimum(place, n - 1)]  # (block, blocks, k)
    # forward: the message that enters each block
    enter, leave = np.ones((n_blocks, k)), np.ones((n_blocks, k))
    if counts.max() > 1:
        whole = np.broadcast_to(np.eye(k), (n_blocks, k, k)).copy()
        for t in range(block):
            step = (whole @ a) * e[t][:, None, :]
            step /= step.sum((1, 2), keepdims=True)
            whole = np.where(real[t][:, None, None], step, whole)
        first = last - counts + 1
        for j in range(1, int(counts.max())):
            on = first[counts > j] + j
            if j == 1:  # no transition leads into a sequence's first word
                alpha = messages(e[:, on - 1], a)[-1]
            else:
                alpha = np.einsum("bi,bij->bj", enter[on - 1], whole[on - 1])
            enter[on] = alpha / alpha.sum(1, keepdims=True)
        for j in range(1, int(counts.max())):
            on = last[counts > j] - j
            beta = np.einsum("bij,bj->bi", whole[on + 1], leave[on + 1])
            leave[on] = beta / beta.sum(1, keepdims=True)
    opens = np.zeros(n_blocks, bool)
    opens[(last - counts + 1)[used]] = True
    alpha = np.empty_like(e)
    at = np.where(opens[:, None], 1.0, enter @ a)
    for t in range(block):
        step = e[t] * (at if t == 0 else at @ a)
        step /= step.sum(1, keepdims=True)
        at = np.where(real[t][:, None], step, at) if t else step
        alpha[t] = at
    beta = leave
    out = np.empty((n, k))
    for t in reversed(range(block)):
        p = alpha[t] * beta
        p /= p.sum(1, keepdims=True)
        out[place[t][real[t]]] = p[real[t]]
        back = (e[t] * beta) @ a.T
        back /= back.sum(1, keepdims=True)
        beta = np.where(real[t][:, None], back, beta)
    return out


def fit(rows: list[tuple[str, str]], seed: int = 1) -> Model:
    """Weights by Adam on the likelihood of label sequences strung together from stretches of the rows' words."""
    labels = sorted({y for _, y in rows})
    rng = np.random.default_rng(seed)
    pieces: list[tuple[int, list[str]]] = []
    for i, label in enumerate(labels):
        words = [[w.lower() for w in words_of(x)] for x, y in rows if y == label]
        flat = list(chain.from_iterable(words))[:MAX_WORDS]
        at = 0
        while at < len(flat):
            n = int(rng.integers(2, 2 * SPAN))
            pieces.append((i, flat[at : at + n]))
            at += n
    if not pieces:
        return Model(labels, np.zeros(((KINDS + 1) * SLOTS, len(labels))), np.zeros((len(labels), len(labels))))
    order = rng.permutation(len(pieces))
    flat = [w for p in order for w in pieces[p][1]]
    y = np.array([pieces[p][0] for p in order for _ in pieces[p][1]])
    types = sorted(set(flat))
    number = {w: i for i, w in enumerate(types)}
    ids = np.array([number[w] for w in flat])
    n_seq, k = max(1, len(ids) // SEQUENCE), len(labels)
    use = min(len(ids), n_seq * SEQUENCE)
    ids, y = (x[:use].reshape(n_seq, -1).T for x in (ids, y))  # (places, sequences)
    table, real = feature_rows(types)
    grams = list(long_grams(types))
    feature, kind = np.unique(np.concatenate([table[real], *[g[1] for g in grams]]), return_inverse=True)
    line = np.concatenate([np.nonzero(real)[0], *[g[0] for g in grams]])
    w, tr = np.zeros((len(feature), k)), np.zeros((k, k))
    mw, vw, mt, vt = np.zeros_like(w), np.zeros_like(w), np.zeros_like(tr), np.zeros_like(tr)
    gold_tr = np.zeros((k, k))
    np.add.at(gold_tr, (y[:-1].ravel(), y[1:].ravel()), 1)
    for t in range(1, ROUNDS + 1):
        by_type = np.stack([np.bincount(line, w[kind, c], len(types)) for c in range(k)], 1)
        s = by_type[ids]
        e, a = np.exp(s - s.max(-1, keepdims=True)), np.exp(tr - tr.max())
        alpha = messages(e, a)
        beta, g = np.ones(e.shape[1:]), np.empty_like(e)
        pair = np.zeros((k, k))
        for i in reversed(range(len(e))):
            p = alpha[i] * beta
            g[i] = -p / p.sum(-1, keepdims=True)
            if i:
                right = e[i] * beta
                joint = alpha[i - 1][:, :, None] * a * right[:, None, :]
                pair += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
                beta = right @ a.T
                beta /= beta.sum(-1, keepdims=True)
        np.put_along_axis(g, y[..., None], np.take_along_axis(g, y[..., None], -1) + 1, -1)
        per_type = np.stack([np.bincount(ids.ravel(), g[..., c].ravel(), len(types)) for c in range(k)], 1)
        gw = np.stack([np.bincount(kind, per_type[line, c], len(feature)) for c in range(k)], 1) / use - RIDGE * w
        gt = (gold_tr - pair) / use - RIDGE * tr
        for x, grad, m, v in ((w, gw, mw, vw), (tr, gt, mt, vt)):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad**2 - v)
            x += RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-7)
    weights = np.zeros(((KINDS + 1) * SLOTS, k))
    weights[feature] = w
    return Model(labels, weights, tr)


class Tagger:
    """Scores texts, with a cache of words' emissions that starts anew at a size that only bounds memory."""

    def __init__(self, model: Model):
        self.model = model
        self._reset()

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        self.letters = 0
        self.table = np.zeros((1024, len(self.model.labels)), np.float32)

    def words(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Posteriors (words, labels) and words of each text."""
        return self._tag(batch)[:2]

    def _tag(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Also each word's share of its text's mass: 1, and 1 more for every further ``LETTERS`` letters or part of them."""
        if len(self.known) > CACHED or self.letters > CACHED_LETTERS:
            self._reset()
        cut = [words_of(x.lower()) for x in batch]
        lengths = np.fromiter(map(len, cut), np.int64, len(cut))
        new = sorted({w for x in cut for w in x if w not in self.known})
        if new:
            at = len(self.known)
            self.letters += sum(map(len, new))
            self.known.update(zip(new, range(at, at + len(new)), strict=True))
            if len(self.known) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros((len(self.known), self.table.shape[1]), np.float32)])
            self.table[at : at + len(new)] = self.model.emissions(new)
        ids = np.fromiter(map(self.known.__getitem__, chain.from_iterable(cut)), np.int64, int(lengths.sum()))
        share = -(-np.fromiter(map(len, chain.from_iterable(cut)), np.int64, len(ids)) // LETTERS)
        return posteriors(self.table[ids], lengths, self.model.transitions), lengths, share

    def documents(self, batch: list[str]) -> tuple[list[str], list[float]]:
        p, lengths, share = self._tag(batch)
        k = len(self.model.labels)
        doc = np.repeat(np.arange(len(batch)), lengths)
        mass = np.stack([np.bincount(doc, p[:, c] * share, len(batch)) for c in range(k)], 1) if k else np.zeros((len(batch), 1))
        best = mass.argmax(1)
        score = mass[np.arange(len(batch)), best] / np.maximum(np.bincount(doc, share, len(batch)), 1)
        empty = (lengths == 0) | (k == 0)
        return ["und" if e else self.model.labels[b] for b, e in zip(best.tolist(), empty.tolist(), strict=True)], np.clip(np.where(empty, 0.0, score), 0, 1).tolist()


def sample(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", learn: Column | None = None, per_label: int = MAX_PER_LABEL) -> list[tuple[str, str]]:
    """(text, language) of a bounded sample: at most ``per_label`` rows of each language; only ids and sizes are gathered before ``MAX_BYTES`` is kept."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).where(learn if learn is not None else F.lit(True))
    known = known.select(F.col(id_col).alias("__id"), F.col(lang_col).alias("__lang"), F.col(text_col).alias("__text"), F.xxhash64(id_col).alias("__order"))
    languages = known.agg(F.count_distinct("__lang")).first()[0]
    per_label = max(1, min(per_label, MAX_ROWS // max(1, languages)))
    by = Window.partitionBy("__lang").orderBy("__order", "__id", "__size")
    nth = known.select("__id", "__lang", "__order", F.octet_length("__text").alias("__size")).withColumn("__nth", F.row_number().over(by))
    chosen = nth.where(F.col("__nth") <= per_label).orderBy("__nth", "__lang").collect()  # the first of every language, then the second
    keys = within([((r["__id"], r["__lang"]), r["__size"]) for r in chosen], MAX_BYTES)
    if not keys:
        return []
    some = docs.sparkSession.createDataFrame(list(dict.fromkeys(keys)), known.select("__id", "__lang").schema)
    rows = known.join(F.broadcast(some), ["__id", "__lang"]).select("__text", "__lang", "__order").orderBy("__order", F.xxhash64("__text")).limit(len(keys)).collect()
    return [(r[0], r[1]) for r in rows]


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, out_names: tuple[str, str] = ("__lang_pred", "__score")) -> DataFrame:
    """id (or the columns ``keep``), the predicted language and its score (``out_names``) of each row. Only texts go to the workers and only predictions come back; the other columns stay in the JVM."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # (KINDS + 1) * SLOTS weights for each language

    key = ("language", uuid.uuid4().hex)

    @F.arrow_udf("lang string, score double")
    def tagged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tagger = resident(key, lambda: Tagger(sent.value))
        for column in batches:
            langs: list[str] = []
            scores: list[float] = []
            for b in steps([pa.RecordBatch.from_arrays([column], names=["text"])], "text", rows=1000, size=TEXT_BYTES):
                lang, score = tagger.documents([x or "" for x in b.column(0).to_pylist()])
                langs += lang
                scores += score
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["lang", "score"])

    column = unused(docs, "__tagged")
    out = docs.withColumn(column, tagged(F.col(text_col)))
    return out.select(*([id_col] if keep is None else keep), F.col(f"{column}.lang").alias(out_names[0]), F.col(f"{column}.score").alias(out_names[1]))


def accept(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", at_least: float = 0.35) -> DataFrame:
    """The rows whose text has a letter and whose language has a score of ``at_least``, with all their columns; the model learns from ``docs``."""
    model = fit(sample(docs, id_col=id_col, text_col=text_col, lang_col=lang_col, learn=~held_out(id_col)))
    lang, score = unused(docs, "__lang_pred"), unused(docs, "__score")
    df = predict(docs, model, id_col=id_col, text_col=text_col, keep=docs.columns, out_names=(lang, score))
    return df.where((F.col(lang) != "und") & (F.col(score) >= at_least)).select(*docs.columns)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    df = predict(docs, fit(sample(docs, learn=~held_out())))
    return df.select("doc_id", held_out().alias("held_out"), F.col("__lang_pred").alias("lang_pred"), F.col("__score").alias("score"))
