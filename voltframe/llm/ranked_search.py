"""Ranked lexical search by MaxScore in each shard.

A first pass over the documents writes, for each, its number of terms and how often it holds each term of the queries.
From that come the counts over all documents, so that every posting's part of a score is a whole number before the
search begins. A shard is what a task has read of these rows, up to a bounded number of postings, as one list for each
term. Its documents are taken in blocks: a query's terms, by the most that each gives in the shard, are split into
non-essential ones, which together can't lift a document to the query's k-th best score so far, and the rest. Documents
come from the essential lists only; non-essential ones are probed, largest first, for the documents that can still
qualify. The k-th best scores rise from block to block, and are kept from shard to shard of a task. Last, the k best of
all tasks are merged, in two steps.

Queries are sent to the tasks in parts of about ``PART_BYTES`` of text and ``PART_ITEMS`` texts; each part takes one scan
of the documents. A query's equal texts are searched once.

Null texts, and texts without a term, have no terms and match nothing; items without terms get no rows. Each row of the
queries is an item by itself, whatever its id; each row of the documents is a document. Equal scores go to the smaller
document id, null ids last, whatever becomes of rows that share an id. Empty tables give no rows.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, discard, read, shared, ship, steps, texts
from .decontaminate import FOLD, words

K, PART_BYTES, PART_ITEMS = 50, 8 << 20, 10_000
#: Bytes of a text whose terms are counted at once, postings of a shard, and documents of a block.
PIECE, SHARD, BLOCK = 1 << 20, 2_000_000, 2048


def counted(text: bytes, vocabulary: dict[bytes, int], piece: int = PIECE) -> tuple[int, Counter]:
    """(terms of a text, occurrences of each number of the vocabulary), a piece of the text at a time."""
    n, found = 0, Counter()
    text = text.translate(FOLD)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + piece) if at + piece < len(text) else len(text)
        terms = text[at : end if end >= 0 else len(text)].split()
        at = end if end >= 0 else len(text)
        n += len(terms)
        each = Counter(terms)
        for term in each.keys() & vocabulary.keys():
            found[vocabulary[term]] += each[term]
    return n, found


def postings(docs: DataFrame, vocabulary: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, tfs) of each document with a term: how many terms it has, and which of the vocabulary how often."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = {x: i for i, x in enumerate(sent.value)}
        for b in steps(batches, "text"):
            got = [counted(x, numbers) for x in texts(b, "text")]
            keep = [i for i, x in enumerate(got) if x[0]]
            ends = np.cumsum([0, *(len(got[i][1]) for i in keep)])
            columns = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array([v for i in keep for v in pick(got[i][1])], pa.int32())) for pick in (Counter.keys, Counter.values)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep, pa.int64())), pa.array([got[i][0] for i in keep], pa.int64()), *columns], names=["id", "n", "terms", "tfs"])

    return arrow_map(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), run, f"id {kind}, n bigint, terms array<int>, tfs array<int>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def lengths(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of documents of n terms: 50 and their share of 50 by the mean length, rounded down."""
    if 50 * n_docs * int(n.max(initial=0)) >= 1 << 63:
        return np.array([50 + 50 * x * n_docs // n_terms for x in n.tolist()], np.int64)
    return 50 + 50 * n * n_docs // n_terms


class Best:
    """The k best of each query: (score, id), equal scores by id."""

    def __init__(self, k: int):
        self.k, self.rows, self.least = k, [], 1

    def add(self, scores: list[int], ids: list) -> None:
        self.rows = heapq.nsmallest(self.k, self.rows + [(-s, i is None, i) for s, i in zip(scores, ids, strict=True)], key=lambda x: x if x[2] is not None else x[:2])
        if len(self.rows) == self.k:
            self.least = -self.rows[-1][0]


class Shard:
    """One list for each term of (document, its part of the score), documents ascending."""

    def __init__(self, terms: np.ndarray, docs: np.ndarray, parts: np.ndarray, ids: list, block: int = BLOCK):
        order = np.argsort(terms, kind="stable")
        self.docs, self.parts, self.ids, self.block = docs[order], parts[order], ids, block
        terms = terms[order]
        starts = np.flatnonzero(np.diff(terms, prepend=-1))
        most = np.maximum.reduceat(self.parts, starts) if len(starts) else starts
        #: Where each term's list begins and ends, and the most that it gives.
        self.lists = {t: (s, e, m) for t, s, e, m in zip(terms[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(terms)], most.tolist(), strict=True)}
        self.probed = 0

    def search(self, query: list[int], best: Best) -> None:
        lists = sorted((self.lists[t] for t in query if t in self.lists), key=lambda x: x[2])
        if not lists:
            return
        sums = np.cumsum([x[2] for x in lists]).tolist()
        if sums[-1] < best.least:
            return
        edges = np.arange(0, len(self.ids) + self.block, self.block)
        cuts = [np.searchsorted(self.docs[s:e], edges) + s for s, e, _ in lists]
        cuts = [c.tolist() for c in cuts]
        first = 0
        for k, low in enumerate(edges[:-1].tolist()):
            while first < len(lists) and sums[first] < best.least:
                first += 1
            if first == len(lists):
                return
            score = np.zeros(self.block, np.int64)
            for c in cuts[first:]:
                if c[k] < c[k + 1]:
                    score[self.docs[c[k] : c[k + 1]] - low] += self.parts[c[k] : c[k + 1]]
            rest = sums[first - 1] if first else 0
            live = np.flatnonzero((score > 0) & (score + rest >= best.least))
            for i in range(first - 1, -1, -1):
                live = live[score[live] + sums[i] >= best.least]
                if not len(live):
                    break
                s, e = cuts[i][k], cuts[i][k + 1]
                if s < e:
                    self.probed += len(live)
                    here = self.docs[s:e] - low
                    at = np.minimum(np.searchsorted(here, live), e - s - 1)
                    hit = here[at] == live
                    score[live[hit]] += self.parts[s:e][at[hit]]
            live = live[score[live] >= best.least]
            if len(live):
                if len(live) > best.k:  # rows below the k-th of these can't stay
                    live = live[score[live] >= np.partition(score[live], -best.k)[-best.k]]
                best.add(score[live].tolist(), [self.ids[low + i] for i in live.tolist()])


def _searched(written: DataFrame, queries: list[list[int]], weights: np.ndarray, n_docs: int, n_terms: int, k: int, shard_size: int) -> DataFrame:
    """(query's number, id, score): the k best that each task has read."""
    sent = written.sparkSession.sparkContext.broadcast((queries, weights))
    kind = written.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, w = sent.value
        best = [Best(k) for _ in asked]
        held: list[tuple] = []

        def search() -> None:
            n = np.concatenate([x[0] for x in held])
            count, terms, tf = (np.concatenate([x[i] for x in held]) for i in (1, 2, 3))
            docs = np.repeat(np.arange(len(n)), count)
            tf = tf.astype(np.int64)
            parts = w[terms] * (1_000_000_000 * tf // (1000 * tf + 20 * lengths(n, n_docs, n_terms)[docs]))
            shard = Shard(terms, docs.astype(np.int32), parts, [i for x in held for i in x[4]])
            for query, b in zip(asked, best, strict=True):
                shard.search(query, b)

        size, ids = 0, None
        for whole in batches:
            for b in steps([whole]):
                terms, tfs = b.column("terms"), b.column("tfs")
                held.append((b.column("n").to_numpy(), np.diff(terms.offsets.to_numpy()), terms.flatten().to_numpy(), tfs.flatten().to_numpy(), b.column("id").to_pylist()))
                size += len(held[-1][2])
                if size >= shard_size:
                    search()
                    held, size = [], 0
        if held:
            search()
        ids = [i for b in best for _, _, i in b.rows]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(best)), [len(b.rows) for b in best]), pa.int64()), pa.array(ids, schema_kind), pa.array([-s for b in best for s, _, _ in b.rows], pa.int64())], names=["query", "id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type

    schema_kind = to_arrow_type(written.schema["id"].dataType)
    return arrow_map(written.where(F.size("terms") > 0), run, f"query bigint, id {kind}, score bigint")


def search(docs: DataFrame, items: DataFrame, *, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", part_bytes: int = PART_BYTES, part_items: int = PART_ITEMS, shard_size: int = SHARD) -> DataFrame:
    """item, rank (from 1), doc, score of the k best documents of each item, under the names of both ids."""
    spark = docs.sparkSession
    ship(spark)
    keyed = items.where(F.col(item_text_col).isNotNull()).select(F.col(item_col).alias("item"), F.col(item_text_col).cast("string").alias("text")).withColumn("key", F.sha2("text", 256))
    asked = keyed.select("key", "text").dropDuplicates(["key"])
    size = asked.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n")).first()
    parts = max((size["bytes"] or 0) // part_bytes, size["n"] // part_items) + 1
    found = []
    for part in range(parts):
        rows = [(r["key"], sorted(set(words(r["text"].encode())))) for r in asked.where(F.pmod(F.xxhash64("key"), F.lit(parts)) == part).collect()]
        vocabulary = sorted({t for _, q in rows for t in q})
        if not vocabulary:
            continue
        written = shared(postings(docs, vocabulary, id_col, text_col))
        total = written.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
        if not total["docs"]:
            discard(written)
            continue
        # a row for each term of the part
        df = np.zeros(len(vocabulary), np.int64)
        for r in written.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            df[r["term"]] = r["count"]
        number = {t: i for i, t in enumerate(vocabulary)}
        weights = np.array([weight(total["docs"], x) for x in df.tolist()], np.int64)
        near = _searched(written, [[number[t] for t in q] for _, q in rows], weights, total["docs"], total["terms"], k, shard_size)
        names = spark.createDataFrame([(i, key) for i, (key, _) in enumerate(rows)], "query bigint, key string")
        found.append(near.join(names, "query").select("key", "id", "score"))
    if not found:
        found = [docs.select(F.lit("").alias("key"), F.col(id_col).alias("id"), F.lit(0).cast("long").alias("score")).where("false")]
    best = [F.desc("score"), F.col("id").asc_nulls_last()]
    some = reduce(DataFrame.unionAll, found).withColumn("group", F.pmod(F.xxhash64("id"), F.lit(32)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("key", "group").orderBy(*best))).where(F.col("rank") <= k)
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(*best))).where(F.col("rank") <= k)
    return keyed.select("item", "key").join(some, "key").select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH doc AS (
  SELECT doc_id, len(w) AS n, w
  FROM (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL)
  WHERE len(w) > 0
), total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM doc),
item AS (
  SELECT DISTINCT item_id, term
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
), tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(w) AS term FROM doc) WHERE term IN (SELECT term FROM item) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term),
score AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM item JOIN tf USING (term) JOIN w USING (term), total GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM score WHERE score > 0 QUALIFY rank <= 50
"""
