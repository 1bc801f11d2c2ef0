"""Benchmark decontamination by an FM-index of each training shard.

A shard is what one task reads, up to ``SHARD`` words at a time. Words outside the benchmark's vocabulary can't be part
of a match, so they, and stretches shorter than the shortest window, only separate; what is left is indexed. All
benchmark windows are searched backward at once, their occurrences located through sampled positions, and merged into
spans of words. No text moves. The benchmark is sent to the tasks in parts of at most ``PART_BYTES``; the documents are
scanned once for each part, and spans of several parts are merged by row.

Null, empty and wordless documents have no words and no hits. Benchmark rows with a null text or no words
are no items; rows of one id are one item; words of rows with a null id are hit, but no item is named. Rows that share a doc_id each get their own result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, ranges, read, row_key, ship, steps, texts, unused
from .fm_index import FMIndex

WINDOW, SHARD, PART_BYTES = 13, 2_000_000, 8 << 20
#: A-Z to a-z; all that is no word byte to a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Windows:
    """The distinct windows of items, as rows of word ids from 1, and the items of each; items of no name have windows only."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        self.ids: dict[bytes, int] = {}
        self.names = sorted({x for x, _ in items if x is not None})
        number = {x: i for i, x in enumerate(self.names)}
        parts, owner = [np.zeros((0, window), np.int32)], [np.zeros(0, np.int64)]
        for item, text in items:
            w = np.array([self.ids.setdefault(x, len(self.ids) + 1) for x in words(text)], np.int32)
            if len(w):
                if len(w) < window:
                    w = np.append(w, np.full(window - len(w), -1, np.int32))
                parts.append(np.lib.stride_tricks.sliding_window_view(w, window))
                owner.append(np.full(len(parts[-1]), number.get(item, -1)))
        rows, item = np.concatenate(parts), np.concatenate(owner)
        order = np.lexsort((item, *rows.T[::-1]))
        rows, item = rows[order], item[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]).any(1)
        which = np.cumsum(new) - 1
        self.table = rows[new].astype(np.int64)
        self.lengths = (self.table >= 0).sum(1)
        keep = item >= 0
        keep[1:] &= new[1:] | (item[1:] != item[:-1])
        self.owned = item[keep]
        self.first = np.searchsorted(which[keep], np.arange(len(self.table) + 1))
        self.least = int(self.lengths.min()) if len(self.table) else 0

    def owners(self, w: int) -> list[str]:
        return [self.names[i] for i in self.owned[self.first[w] : self.first[w + 1]].tolist()]


class Shard:
    """Words of many documents, then their hits."""

    def __init__(self, windows: Windows):
        self.windows, self.known = windows, windows.ids
        self.clear()

    def clear(self) -> None:
        self.symbols: list[np.ndarray] = []
        self.runs: list[np.ndarray] = []  # document, first word's index and length of each kept run
        self.docs, self.size = 0, 0
        self.n_words: list[int] = []

    def add(self, batch: list[bytes]) -> None:
        get = self.known.get
        cut = [words(x) for x in batch]
        n = np.fromiter(map(len, cut), np.int64, len(cut))
        self.n_words += n.tolist()
        ids = np.array([get(w, 0) for x in cut for w in x], np.int64)
        if len(ids) and self.windows.least:
            doc = np.repeat(np.arange(len(cut)), n)
            start = np.cumsum(n) - n
            new = np.ones(len(ids), bool)
            new[1:] = (ids[1:] == 0) | (ids[:-1] == 0) | (doc[1:] != doc[:-1])
            at = np.flatnonzero(new)
            length = np.diff(np.append(at, len(ids)))
            at, length = (x[(ids[at] > 0) & (length >= self.windows.least)] for x in (at, length))
            if len(at):
                out = np.zeros(int(length.sum()) + len(at), np.int64)
                first = np.cumsum(length + 1) - length - 1
                out[ranges(first, length)] = ids[ranges(at, length)]
                self.symbols.append(out)
                self.runs.append(np.stack([doc[at] + self.docs, at - start[doc[at]], length]))
                self.size += len(out)
        self.docs += len(cut)

    def found(self) -> tuple[list[list[dict]], list[list[str]]]:
        """Merged spans of hit words, and sorted items, of each document."""
        spans: list[list[dict]] = [[] for _ in range(self.docs)]
        items: list[list[str]] = [[] for _ in range(self.docs)]
        if not self.symbols:
            return spans, items
        text, (doc, first, length) = np.concatenate(self.symbols), np.concatenate(self.runs, axis=1)
        index = FMIndex(text, len(self.known) + 1)
        lo, hi = index.search(self.windows.table, self.windows.lengths)
        which = np.repeat(np.arange(len(lo)), hi - lo)
        if not len(which):
            return spans, items
        at = index.locate(ranges(lo, hi - lo))
        begin = np.cumsum(length + 1) - length - 1
        run = np.searchsorted(begin, at, side="right") - 1
        for d, w in np.unique(np.stack([doc[run], which]), axis=1).T.tolist():
            items[d] += self.windows.owners(w)
        cover = np.zeros(len(text) + 1, np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + self.windows.lengths[which], -1)
        edge = np.diff(np.concatenate([[0], (np.cumsum(cover) > 0).astype(np.int8)]))
        for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            r = int(np.searchsorted(begin, s, side="right")) - 1
            word = int(first[r]) + s - int(begin[r])
            spans[int(doc[r])].append({"s": word, "e": word + e - s})
        return spans, [sorted(set(x)) for x in items]


def _part(docs: DataFrame, items: list[tuple[str | None, bytes]], text_col: str, keep: list[str], names: list[str]) -> DataFrame:
    """The columns ``keep``, and n_words, spans, items under ``names``."""
    windows = docs.sparkSession.sparkContext.broadcast(Windows(items))  # of ``PART_BYTES`` of text at most, or one item
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    out_type = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = Shard(windows.value), []

        def give() -> Iterator[pa.RecordBatch]:
            spans, items = shard.found()
            counts, at = shard.n_words, 0
            for b in held:
                part = slice(at, at + b.num_rows)
                at += b.num_rows
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(counts[part], pa.int64()), pa.array(spans[part], out_type), pa.array(items[part], pa.list_(pa.string()))], names=[*keep, *names])
            held.clear()
            shard.clear()

        for b in steps(batches, text_col):
            shard.add(texts(b, text_col))
            held.append(b.select(keep))
            if shard.size >= SHARD:
                yield from give()
        if held:
            yield from give()

    return arrow_map(docs.select(*dict.fromkeys([*keep, text_col])), run, f"{kinds}, `{names[0]}` bigint, `{names[1]}` array<struct<s: int, e: int>>, `{names[2]}` array<string>")


def _found(docs: DataFrame, benchmark: DataFrame, keep: list[str], id_col: str, text_col: str, item_col: str, item_text_col: str, part_bytes: int) -> tuple[DataFrame, list[str]]:
    """The columns ``keep``, and n_words, spans, items, n_hit under names that no column of ``docs`` has; and these names."""
    ship(docs.sparkSession)
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text") + F.coalesce(F.octet_length("item"), F.lit(0)))).first()[0] or 0
    parts = size // part_bytes + 1
    names = [unused(docs, f"__{c}") for c in ("n_words", "spans", "items", "n_hit")]
    chosen = ([(r["item"], r["text"].encode()) for r in items.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == k).collect()] for k in range(parts))
    if parts == 1:
        df = _part(docs, next(chosen), text_col, keep, names[:3])
    else:
        row = unused(docs, "__row")
        keyed = row_key(docs, id_col, row)
        every = reduce(DataFrame.unionByName, [_part(keyed, c, text_col, [row], names[:3]) for c in chosen])
        merged = every.groupBy(row).agg(F.first(names[0]).alias(names[0]), F.array_sort(F.flatten(F.collect_list(names[1]))).alias(names[1]), F.array_sort(F.array_distinct(F.flatten(F.collect_list(names[2])))).alias(names[2]))
        df = keyed.select(*keep, row).join(merged, row).drop(row)
    hit = F.aggregate(names[1], F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")), lambda a, x: F.struct(F.greatest(a["end"], x["e"]).alias("end"), (a["n"] + F.greatest(x["e"] - F.greatest(a["end"], x["s"]), F.lit(0))).alias("n")), lambda a: a["n"])
    return df.withColumn(names[3], hit), names


def find(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """id, n_words, n_hit, spans (of word numbers, end exclusive), items (sorted) of each row of ``docs``."""
    df, (n_words, spans, items, n_hit) = _found(docs.select(id_col, text_col), benchmark, [id_col], id_col, text_col, item_col, item_text_col, part_bytes)
    return df.select(id_col, *[F.col(c).alias(to) for c, to in ((n_words, "n_words"), (n_hit, "n_hit"), (spans, "spans"), (items, "items"))])


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words") -> Column:
    """The rule: any hit, and a twentieth of the words or more."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def clean(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, with all their columns."""
    df, (n_words, _, _, n_hit) = _found(docs, benchmark, docs.columns, id_col, text_col, item_col, item_text_col, part_bytes)
    return df.where(~contaminated(n_hit, n_words)).select(*docs.columns)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return df.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"))
