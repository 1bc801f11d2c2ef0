"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A sentence's score is logistic in the words it has and in their beginnings, so that inflected forms count together. A document is toxic unless none of its sentences is: noisy-or,
p = 1 - (1 - p_1) ... (1 - p_n). Weights are fitted to document labels through that formula, so that scores of
sentences are learned from labels of whole texts, and the sentences above a threshold show where the offence lies.

Fitting takes at most ``MAX_PER_LABEL`` documents of each label (those whose ids hash lowest), whatever the corpus's
size; scoring maps every row by itself. Null and empty texts have no sentence and score 0. Labels of one document that
disagree count as toxic; rows whose label or text is null teach nothing.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, held_out, read, ship, steps, within

#: Documents of each label, and bytes of all their texts, that teach at most.
MAX_PER_LABEL, MAX_BYTES = 2000, 64 << 20
#: A word is a feature if so many sample documents have it.
LEAST_DOCS = 5
ROUNDS, RATE, RIDGE, BIAS = 100, 0.3, 1e-3, -7.0
SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")


def sentences(text: str) -> list[tuple[int, int]]:
    """Code-point spans between full stops, question and exclamation marks and line ends, but for those of white space."""
    return [m.span() for m in SENTENCE.finditer(text) if not m.group().isspace()]


def features(word: str) -> list[str]:
    """The word, and its first four and five letters where it is longer."""
    return [word, *(word[:k] + "-" for k in (4, 5) if len(word) > k)]


def sample(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", learn: Column | None = None, per_label: int = MAX_PER_LABEL) -> list[tuple[str, int]]:
    """(text, label) of a bounded sample; ``learn`` says of an id whether it may teach.

    Only ids and sizes are gathered before ``MAX_BYTES`` is kept, half of it for each label; texts that don't fit are passed over. Rows that
    share an id teach together."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).alias("__label"))
    known = known.where(learn if learn is not None else F.lit(True)).withColumn("__order", F.xxhash64(id_col))
    chosen = None
    for label in (0, 1):
        some = known.where(F.col("__label") == label).orderBy("__order", id_col).limit(per_label)
        chosen = some if chosen is None else chosen.unionAll(some)
    # 2 * per_label ids at most
    known = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).where("__text is not null").join(F.broadcast(chosen.withColumnRenamed(id_col, "__id")), "__id")
    sizes = known.groupBy("__order", "__id").agg(F.sum(F.octet_length("__text")).alias("n"), F.max("__label").alias("label")).orderBy("__order", "__id").collect()
    ids = [i for label in (0, 1) for i in within([(r["__id"], r["n"]) for r in sizes if r["label"] == label], MAX_BYTES // 2)]
    rows = known.where(F.col("__id").isin(ids)).orderBy("__order", F.xxhash64("__text")).select("__text", "__label").limit(4 * per_label).collect() if ids and sizes else []
    return [(r[0], int(r[1])) for r in rows]


def fit(rows: list[tuple[str, int]]) -> tuple[dict[str, float], float]:
    """Weights of words and the bias, by gradient steps (Adam) on the noisy-or likelihood; each label weighs a half."""
    if len({y for _, y in rows}) < 2:
        return {}, BIAS if not any(y for _, y in rows) else -BIAS
    known: dict[str, list[str]] = {}
    bags = [[{f for w in set(WORD.findall(text[i:j].lower())) for f in known.get(w) or known.setdefault(w, features(w))} for i, j in sentences(text)] for text, _ in rows]
    seen = Counter(w for bag in bags for w in set().union(*bag))
    ids = {w: i for i, w in enumerate(sorted(w for w, n in seen.items() if n >= LEAST_DOCS))}
    flat = [(d, [ids[w] for w in s if w in ids]) for d, bag in enumerate(bags) for s in bag]
    doc = np.array([d for d, _ in flat], np.int64)
    size = np.array([len(s) for _, s in flat], np.int64)
    word = np.array([w for _, s in flat for w in s], np.int64)
    line = np.repeat(np.arange(len(flat)), size)
    y = np.array([y for _, y in rows], float)
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    w, b = np.zeros(len(ids)), BIAS
    m, v = np.zeros(len(ids) + 1), np.zeros(len(ids) + 1)
    for t in range(1, ROUNDS + 1):
        z = np.clip(np.bincount(line, w[word], len(flat)) + b, -30, 30)
        p = 1 / (1 + np.exp(-z))
        clear = np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), len(rows))  # log of (1 - p of the document)
        p_doc = -np.expm1(clear)
        # d log-likelihood / d z: -p for label 0; p (1 - p_doc) / p_doc for label 1
        up = np.where(y == 1, np.exp(clear) / np.maximum(p_doc, 1e-9), -1.0) * weight
        g = p * up[doc]
        grad = np.append(np.bincount(word, g[line], len(ids)) / len(rows) - RIDGE * w, g.sum() / len(rows))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w + step[:-1], min(b + step[-1], BIAS)
    return {x: float(w[i]) for x, i in ids.items() if abs(w[i]) > 1e-3}, float(b)


def noisy_or(probabilities: list[float]) -> float:
    return -math.expm1(sum(math.log1p(-min(p, 1 - 1e-12)) for p in probabilities))


class Weights(dict):
    """Summed weights of words, filled as words are met; it starts anew at a size that only bounds memory."""

    def __init__(self, of_features: dict[str, float], most: int = 300_000):
        super().__init__()
        self.of_features, self.most = of_features, most

    def __missing__(self, word: str) -> float:
        if len(self) >= self.most:
            self.clear()
        z = self[word] = sum(self.of_features.get(f, 0.0) for f in features(word))
        return z


def judge(text: str, weights: Weights, bias: float) -> tuple[float, list[tuple[int, int, float]]]:
    """The document's score, and span and score of each sentence."""
    out = []
    base = 1 / (1 + math.exp(-bias))
    for i, j in sentences(text):
        z = 0.0
        for w in set(WORD.findall(text[i:j].lower())):
            z += weights[w]
        out.append((i, j, 1 / (1 + math.exp(-max(-30.0, min(30.0, z + bias)))) if z else base))
    return noisy_or([p for *_, p in out]), out


def score(docs: DataFrame, model: tuple[dict[str, float], float], *, id_col: str = "doc_id", text_col: str = "text", at_least: float = 0.5) -> DataFrame:
    """id, score, n_sentences, offending: the spans (code points) and scores of sentences that reach ``at_least``."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample's vocabulary
    kind = docs.schema[id_col].dataType.simpleString()
    spans = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = Weights(sent.value[0]), sent.value[1]
        for b in steps(batches, text_col):
            got = [judge(x or "", weights, bias) for x in b.column(text_col).to_pylist()]
            hot = [[{"s": i, "e": j, "score": p} for i, j, p in s if p >= at_least] for _, s in got]
            yield pa.RecordBatch.from_arrays([b.column(id_col), pa.array([p for p, _ in got], pa.float64()), pa.array([len(s) for _, s in got], pa.int64()), pa.array(hot, spans)], names=[id_col, "score", "n_sentences", "offending"])

    return arrow_map(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, score double, n_sentences bigint, offending array<struct<s: int, e: int, score: double>>")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fit(sample(docs, read(spark, sf_dir, "labels"), learn=~held_out()))
    df = score(docs, model)
    return df.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_sentences", "offending")
