"""Repeated windows of a fixed length across a corpus, dealt out by content so that no text meets every other.

A window (``Units.window`` bytes or words) belongs to the anchor that it holds: the place whose ``gram`` hashes lowest
among its first ``reach`` places. Equal windows have equal anchors at equal offsets, so neighbouring windows of one
anchor form a run, and runs are compared only with runs that have the same core (the units from the anchor on that all
its windows hold):

1. every run gives the hash of its core; cores that occur once can't repeat;
2. the other runs' places are written to the shared folder, with a digest of their context (all units of their windows);
3. equal contexts of a core become one, with its first place and its number of copies, partly before the shuffle;
4. one task gets one text of each different context of a core and indexes them by the operators' own suffix structures,
   which compare units and take a context's copies as so many occurrences. Cores with more than ``HOT`` different
   contexts are first dealt out anew by single windows, which go through the same structures, so that a task's share
   stays bounded;
5. what was found goes back to the rows' documents.

No group is ever expanded into pairs. Hashes only deal out what may be equal; structures and digests of bytes decide
(64 bits of BLAKE2b among contexts of equal 64-bit hashes of their cores). A hot core or context is one row before step 4's shuffle; joins by core or context are between written tables, so that
Spark can split a hot key's rows (adaptive skew joins).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, discard, ranges, row_key, settle, shared, ship, steps, texts

#: Different contexts of one core above which it is dealt out by single windows; units that one index holds, about.
HOT, CHUNK = 20_000, 1_500_000
#: Bytes of text hashed at once; the arrays for it take some sixty times as much.
STEP = 1 << 20
#: Words of more bytes are hashed one by one.
LONG_WORD = 64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
PLACE_BITS = 28
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


class Hashes:
    """Hashes of any spans of a sequence of 64-bit units."""

    powers = np.ones(1, np.uint64)
    inverse = np.ones(1, np.uint64)

    def __init__(self, units: np.ndarray):
        n = len(units)
        if len(Hashes.powers) < n + 1:
            ones = np.ones(n + 1, np.uint64)
            ones[1:] = BASE
            Hashes.powers = np.multiply.accumulate(ones)
            ones[1:] = INVERSE
            Hashes.inverse = np.multiply.accumulate(ones)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(units * self.powers[:n], out=self.sums[1:])

    def of(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        return mix((self.sums[e] - self.sums[s]) * self.inverse[s] + (e - s).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return mix((self.sums[k:] - self.sums[:n]) * self.inverse[:n])


@dataclass(frozen=True)
class Units:
    """What windows are made of: ``words`` or bytes."""

    words: bool
    window: int
    gram: int
    reach: int

    @property
    def core(self) -> int:
        return self.window - self.reach + 1

    def cut(self, raw: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The texts (words joined by one space), units of all of them one after the other, each text's count, and where units begin and end."""
        if not self.words:
            data = np.frombuffer(b"".join(raw), np.uint8)
            at = np.arange(len(data) + 1)
            return raw, BYTES[data], np.fromiter(map(len, raw), np.int64, len(raw)), at[:-1], at[1:]
        raw = [b" ".join(t.split()) for t in raw]
        data = np.frombuffer(b"".join(raw), np.uint8)
        n = np.fromiter(map(len, raw), np.int64, len(raw))
        s, e = word_spans(data, n)
        count = np.searchsorted(s, np.cumsum(n)) - np.searchsorted(s, np.cumsum(n) - n)
        return raw, word_hashes(data, s, e), count, s, e


def word_spans(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts that lie one after the other; no word crosses from one to the next."""
    ink = ~SPACE[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.zeros(len(data) + 1, bool)
    first[np.cumsum(lengths) - lengths] = True
    before = np.concatenate([[False], ink[:-1]])
    after = np.concatenate([ink[1:], [False]])
    return np.flatnonzero(ink & (~before | first[:-1])), np.flatnonzero(ink & (~after | first[1:])) + 1


def word_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word. Sums of powers are no good for long words of a pattern, which get a digest each."""
    out = Hashes(BYTES[data]).of(s, e)
    for i in np.flatnonzero(e - s > LONG_WORD).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[s[i] : e[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def runs(units: np.ndarray, lengths: np.ndarray, kind: Units) -> tuple[np.ndarray, ...]:
    """Text number, first window, number of windows, and hash of the core, of each run."""
    none = (*(np.zeros(0, np.int64),) * 3, np.zeros(0, np.uint64))
    if len(units) >= 1 << PLACE_BITS:
        raise ValueError("too many units for one step")
    if len(units) < kind.window:
        return none
    hashes = Hashes(units)
    mask = np.uint64((1 << PLACE_BITS) - 1)
    low = (hashes.grams(kind.gram) & ~mask) | np.arange(len(units) - kind.gram + 1, dtype=np.uint64)
    width = 1
    while 2 * width <= kind.reach:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < kind.reach:
        low = np.minimum(low[: len(low) - (kind.reach - width)], low[kind.reach - width :])
    start = np.cumsum(lengths) - lengths
    n_windows = np.maximum(lengths - kind.window + 1, 0)
    place = ranges(start, n_windows)
    if not len(place):
        return none
    text = np.repeat(np.arange(len(lengths)), n_windows)
    anchor = (low[place] & mask).astype(np.int64)
    new = np.ones(len(place), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(place)))
    s, a = place[at], anchor[at]
    return text[at], s - start[text[at]], n, hashes.of(a, a + kind.core)


RUN = "key long, ctx long, __row long, lo long, n int"
TEXT = "key long, ctx long, __row long, lo long, n int, copies long, text binary"


def word_pieces(text: bytes, kind: Units, step: int) -> Iterator[tuple[bytes, int]]:
    """Pieces of about ``step`` bytes that begin and end between words, and their first words' numbers; each holds the last window - 1 words of the one before."""
    at = first = 0
    while True:
        size = step
        while True:
            gap = SPACES.search(text, at + size)
            piece = text[at : gap.start()] if gap else text[at:]
            s, _ = word_spans(np.frombuffer(piece, np.uint8), np.array([len(piece)]))
            if not gap or len(s) >= 2 * kind.window:
                break
            size *= 2
        yield piece, first
        if not gap:
            return
        back = len(s) - (kind.window - 1)
        at, first = at + int(s[back]), first + back


SPACES = re.compile(rb"[ \t\n\v\f\r]")


def pieces(raw: list[bytes], kind: Units, step: int = STEP) -> Iterator[tuple[int, bytes, int]]:
    """Text number, piece and number of its first unit: texts of more than two steps come in overlapping pieces."""
    for i, t in enumerate(raw):
        if len(t) <= 2 * step:
            yield i, t, 0
        elif kind.words:
            for piece, first in word_pieces(t, kind, step):
                yield i, piece, first
        else:
            for at in range(0, max(1, len(t) - kind.window + 1), step):
                yield i, t[at : at + step + kind.window - 1], at


def _held(batches: Iterator[pa.RecordBatch], text_col: str, kind: Units) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list[bytes], np.ndarray]]:
    """Batch, and text numbers, pieces and first units, a step at a time."""
    for b in steps(batches, text_col, size=STEP):
        held: list[tuple[int, bytes, int]] = []
        size = 0
        for x in pieces(texts(b, text_col), kind):
            if held and size + len(x[1]) > 3 * STEP:
                yield b, *_columns(held)
                held, size = [], 0
            held.append(x)
            size += len(x[1])
        if held:
            yield b, *_columns(held)


def _columns(held: list[tuple[int, bytes, int]]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    return np.array([x[0] for x in held], np.int64), [x[1] for x in held], np.array([x[2] for x in held], np.int64)


def _cores(docs: DataFrame, text_col: str, kind: Units) -> DataFrame:
    """key and count of the cores of each step's runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, raw, _ in _held(batches, text_col, kind):
            _, units, lengths, _, _ = kind.cut(raw)
            key, count = np.unique(runs(units, lengths, kind)[3], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(count)], names=["key", "count"])

    return arrow_map(docs.select(text_col), run, "key long, count long")


def _digests(data: bytes, begin: np.ndarray, end: np.ndarray, size: int = 8) -> np.ndarray:
    view, blake = memoryview(data), hashlib.blake2b
    return np.frombuffer(b"".join([blake(view[i:j], digest_size=size).digest() for i, j in zip(begin.tolist(), end.tolist(), strict=True)]), np.int64)


def _batch(key: np.ndarray, ctx: np.ndarray, row: np.ndarray, lo: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(ctx), pa.array(row), pa.array(lo), pa.array(n.astype(np.int32))], names=["key", "ctx", "__row", "lo", "n"])


def _runs(docs: DataFrame, text_col: str, kind: Units) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, of, raw, first in _held(batches, text_col, kind):
            raw, units, lengths, begin, end = kind.cut(raw)
            text, lo, n, key = runs(units, lengths, kind)
            at = (np.cumsum(lengths) - lengths)[text] + lo
            ctx = _digests(b"".join(raw), begin[at], end[at + n + kind.window - 2])
            yield _batch(key, ctx, b.column("__row").to_numpy()[of][text], lo + first[text], n)

    return arrow_map(docs.select("__row", text_col), run, RUN)


def _wanted(docs: DataFrame, rows: DataFrame, *more: str) -> DataFrame:
    """Documents that have runs in ``rows``, with a list of those."""
    lists = rows.groupBy("__row").agg(F.collect_list(F.struct("lo", "n", *more)).alias("__want"))
    return docs.join(lists, "__row")


def _unpacked(b: pa.RecordBatch, text_col: str, kind: Units) -> tuple:
    """Of a batch of ``_wanted``: texts' bytes, where units begin and end, and each run's text, first unit and other fields."""
    wanted = b.column("__want")
    per = np.diff(wanted.offsets.to_numpy())
    x = wanted.flatten()
    fields = [x.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(x.type.num_fields)]
    raw, _, lengths, begin, end = kind.cut(texts(b, text_col))
    text = np.repeat(np.arange(b.num_rows), per)
    return b"".join(raw), begin, end, text, (np.cumsum(lengths) - lengths)[text] + fields[0], *fields


def _windows(docs: DataFrame, rows: DataFrame, text_col: str, kind: Units) -> DataFrame:
    """Each run of ``rows`` cut into its windows; a window's digest is its key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, text_col, rows=200, size=STEP):
            data, begin, end, text, at, lo, n = _unpacked(b, text_col, kind)
            at, lo, text = ranges(at, n), ranges(lo, n), np.repeat(text, n)
            for i in range(0, len(at), 200_000):
                here = at[i : i + 200_000]
                both = _digests(data, begin[here], end[here + kind.window - 1], 16)
                yield _batch(both[::2], both[1::2], b.column("__row").to_numpy()[text[i : i + 200_000]], lo[i : i + 200_000], np.ones(len(here), np.int32))

    return arrow_map(_wanted(docs, rows), run, RUN)


def _texts(docs: DataFrame, rows: DataFrame, text_col: str, kind: Units) -> DataFrame:
    """``rows`` (key, ctx, __row, lo, n, copies) with the text of each one's context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, text_col, rows=200, size=STEP):
            data, begin, end, text, at, lo, n, key, ctx, copies = _unpacked(b, text_col, kind)
            row = b.column("__row").to_numpy()[text]
            for i in range(0, len(at), 10_000):  # contexts overlap; so many at a time
                part = slice(i, i + 10_000)
                got = [data[s:e] for s, e in zip(begin[at[part]].tolist(), end[at[part] + n[part] + kind.window - 2].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key[part], ctx[part], row[part], lo[part], n[part].astype(np.int32), copies[part])] + [pa.array(got, pa.binary())], names=["key", "ctx", "__row", "lo", "n", "copies", "text"])

    return arrow_map(_wanted(docs, rows, "key", "ctx", "copies"), run, TEXT)


Index = Callable[[list[bytes], np.ndarray, np.ndarray], list[np.ndarray]]


def _indexed(contexts: DataFrame, index: Index) -> DataFrame:
    """key, ctx, first, found: the windows (from 0) of each context's first occurrence that ``index`` marks among all contexts of a core."""
    out_type = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
    place = pa.struct([("__row", pa.int64()), ("lo", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def give(part: list[tuple]) -> pa.RecordBatch:
            part.sort(key=lambda x: (x[2], x[3]))  # in the order of first occurrence
            marks = index([x[6] for x in part], np.array([x[4] for x in part], np.int64), np.array([x[5] for x in part], np.int64))
            found = []
            for m in marks:
                edge = np.diff(np.concatenate([[0], m.astype(np.int8), [0]]))
                found.append([{"s": s, "e": e} for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)])
            first = pa.StructArray.from_arrays([pa.array([x[2] for x in part], pa.int64()), pa.array([x[3] for x in part], pa.int64())], fields=list(place))
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in part], pa.int64()), pa.array([x[1] for x in part], pa.int64()), first, pa.array(found, out_type)], names=["key", "ctx", "first", "found"])

        size = 0
        for b in batches:
            for x in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if size >= CHUNK and held[-1][0] != x[0]:
                    yield give(held)
                    held, size = [], 0
                held.append(x)
                size += len(x[6])
        if held:
            yield give(held)

    ordered = contexts.repartition("key").sortWithinPartitions("key")
    return arrow_map(ordered, run, "key long, ctx long, first struct<__row: long, lo: long>, found array<struct<s: int, e: int>>")


def repeated(docs: DataFrame, kind: Units, index: Index, *, earlier: bool, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """__row, the id, the text, and __found: spans (s, e) of first units of windows that also start elsewhere, or
    earlier (in a smaller row, or before in the same). Null where there are none. One row for each of ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    keyed = row_key(docs.select(id_col, text_col), id_col)
    again = shared(_cores(keyed, text_col, kind).groupBy("key").agg(F.sum("count").alias("count")).where("count > 1").select("key"))
    settle(spark)
    rows = shared(_runs(keyed, text_col, kind).join(again, "key", "left_semi"))
    settle(spark)
    discard(again)

    def different(rows: DataFrame) -> DataFrame:
        """One row for each context of a core: its first place and its copies."""
        return rows.groupBy("key", "ctx").agg(F.min(F.struct("__row", "lo", "n")).alias("first"), F.count("*").alias("copies")).select("key", "ctx", "first.*", "copies")

    unlike = shared(different(rows))
    crowded = shared(unlike.groupBy("key").count().where(F.col("count") > HOT).select("key"))
    members, to_index = [rows], unlike
    if not crowded.isEmpty():
        members = [shared(rows.join(crowded, "key", "left_anti")), shared(_windows(keyed, rows.join(crowded, "key", "left_semi"), text_col, kind))]
        to_index = shared(unlike.join(crowded, "key", "left_anti").unionByName(different(members[1]).where("copies > 1")))
    settle(spark)
    marked = shared(_indexed(_texts(keyed, to_index, text_col, kind), index))
    settle(spark)
    discard(unlike, to_index, crowded)
    full = F.array(F.struct(F.lit(0).alias("s"), F.col("n").alias("e")))
    # a later copy of a context has all its windows before it
    found = F.when(F.col("first") == F.struct("__row", "lo"), F.col("found")).otherwise(full) if earlier else F.col("found")
    known = reduce(DataFrame.unionByName, members).join(marked, ["key", "ctx"]).withColumn("found", found).where(F.size("found") > 0)
    spans = known.select("__row", F.transform("found", lambda x: F.struct((x["s"] + F.col("lo")).alias("s"), (x["e"] + F.col("lo")).alias("e"))).alias("spans"))
    by_row = shared(spans.groupBy("__row").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("__found")))
    settle(spark)
    discard(rows, marked, *members)
    return keyed.join(by_row, "__row", "left")


def covered(found: list[dict] | None, window: int) -> list[tuple[int, int]]:
    """Maximal runs of units that the windows at ``found`` cover."""
    out: list[list[int]] = []
    for x in found or ():
        s, e = x["s"], x["e"] - 1 + window
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]
