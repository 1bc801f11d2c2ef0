"""Word-wise removal of repeats of earlier text, by an FM-index of each shard.

A shard is what one task of ``repeats`` holds: every different context of some cores, in the order of first occurrence,
as a compressed FM-index (wavelet tree over words, sampled suffix positions). The shard's texts are then streamed
against it: backward search gives matching statistics, how many words before each end match elsewhere or here, and the
suffix interval of the match. Intervals of matches that reach the threshold of ``WINDOW`` words are reported, and their
least located position is the earliest start: a window that isn't first is removed. Words that one context alone has
can't be in a match with another and only separate. Later copies of a whole context repeat all its windows.

Words are runs of bytes other than ASCII white space, unchanged. Null is an empty text. Texts under ``WINDOW`` words
lose nothing. Rows that share a doc_id are documents of their own, in the order of ``common.row_key``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import arrow_map, ranges, read, steps, texts
from .fm_index import FMIndex
from .repeats import Units, covered, repeated

WINDOW, REACH, GRAM = 20, 12, 4
#: Windows searched at once; it only bounds memory.
SEARCH = 200_000


def later_starts(contexts: list[bytes], n: np.ndarray, window: int = WINDOW) -> list[np.ndarray]:
    """For each context of n windows, in order, which of them occur in an earlier context (none holds a window twice)."""
    cut = [c.split() for c in contexts]
    seen: dict[bytes, int] = {}  # word: number, and whether a second context has it
    twice: set[bytes] = set()
    for i, ws in enumerate(cut):
        for w in set(ws):
            if seen.setdefault(w, i) != i:
                twice.add(w)
    ids = {w: i for i, w in enumerate(sorted(twice), 1)}
    get = ids.get
    size = np.fromiter(map(len, cut), np.int64, len(cut))
    text = np.zeros(int(size.sum()) + len(cut), np.int64)
    begin = np.cumsum(size + 1) - size - 1
    text[ranges(begin, size)] = np.fromiter((get(w, 0) for w in chain.from_iterable(cut)), np.int64, int(size.sum()))
    start = ranges(begin, n)
    empty = np.concatenate([[0], np.cumsum(text == 0)])
    able = empty[start + window] == empty[start]
    later = np.zeros(len(start), bool)
    todo = np.flatnonzero(able)
    if len(todo):
        index = FMIndex(text, len(ids) + 1, rate=8)
        for i in range(0, len(todo), SEARCH):
            part = todo[i : i + SEARCH]
            at = start[part]
            length, lo, hi = index.statistics(text, at + window, window)
            part, at, lo, hi = (x[length >= window] for x in (part, at, lo, hi))
            first, back = np.unique(lo, return_index=True)
            width = (hi - lo)[back]
            place = index.locate(ranges(first, width))
            least = np.minimum.reduceat(place, np.cumsum(width) - width)
            later[part] = least[np.searchsorted(first, lo)] < at
    return np.split(later, np.cumsum(n)[:-1])


def dedup(docs: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """id, n_words, n_removed, kept_sha256, removed (spans of word numbers), and ``with_text`` kept."""
    reach = max(1, min(REACH, window * 3 // 5))

    def index(contexts: list[bytes], n: np.ndarray, copies: np.ndarray) -> list[np.ndarray]:
        return later_starts(contexts, n, window)

    found = repeated(docs, Units(words=True, window=window, gram=min(GRAM, window - reach + 1), reach=reach), index, earlier=True, id_col=id_col, text_col=text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    spans = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, text_col):
            count, gone, kept = [], [], []
            for t, f in zip(texts(b, text_col), b.column("__found").to_pylist(), strict=True):
                words, cut = t.split(), covered(f, window)
                edges = [0, *(x for span in cut for x in span), len(words)]
                count.append(len(words))
                gone.append(cut)
                kept.append(list(chain.from_iterable(words[i:j] for i, j in zip(edges[::2], edges[1::2], strict=True))))
            joined = [b" ".join(k) for k in kept]
            cols = [
                b.column(id_col),
                pa.array(count, pa.int64()),
                pa.array([c - len(k) for c, k in zip(count, kept, strict=True)], pa.int64()),
                pa.array([hashlib.sha256(j).hexdigest() for j in joined]),
                pa.array([[{"s": s, "e": e} for s, e in x] for x in gone], spans),
            ]
            yield pa.RecordBatch.from_arrays(cols + [pa.array([j.decode("utf-8", "replace") for j in joined])] * with_text, names=[id_col, "n_words", "n_removed", "kept_sha256", "removed", *["kept"] * with_text])

    return arrow_map(found.select(id_col, text_col, "__found"), run, f"`{id_col}` {kind}, n_words long, n_removed long, kept_sha256 string, removed array<struct<s: long, e: long>>" + ", kept string" * with_text)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(read(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")
