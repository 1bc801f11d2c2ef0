"""Byte-wise removal of repeated strings by suffix sorting with bucket-pointer refinement.

Of all texts' suffixes, only those that can share ``LENGTH`` bytes with another meet (see ``repeats``). A task puts the
suffixes of its contexts into buckets by their first eight bytes, then refines buckets by sorting on the bucket
pointers of later offsets; pointers are updated at once, so that each refinement reuses the depth of those before.
Suffixes that still share a bucket at a depth of ``LENGTH`` bytes, or whose context has copies, start repeated strings.

Null is an empty text. Texts shorter than ``LENGTH`` lose nothing. Rows that share a doc_id are documents of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import arrow_map, ranges, read, steps, texts
from .repeats import Units, covered, repeated
from .suffix import first_buckets, refine, shared

LENGTH, GRAM = 200, 8


def repeated_starts(contexts: list[bytes], n: np.ndarray, copies: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each context of n windows, which of them occur twice or more, a context counting as often as it has copies (none holds a window twice)."""
    text = np.frombuffer(b"".join(contexts) + bytes(GRAM), np.uint8).astype(np.uint64)
    size = len(text) - GRAM
    keys = np.zeros(size, np.uint64)
    for i in range(GRAM):
        keys = (keys << np.uint64(8)) | text[i : i + size]
    pointer = first_buckets(keys)
    live, depth = shared(pointer), GRAM
    while depth < length and len(live):
        offset = min(depth, length - depth)
        live = refine(pointer, live, offset)
        depth += offset
    starts = np.cumsum([0, *map(len, contexts[:-1])])
    at = ranges(starts, n)
    many = np.bincount(pointer[at], np.repeat(copies, n), size)[pointer[at]] > 1
    return np.split(many, np.cumsum(n)[:-1])


def dedup(docs: DataFrame, *, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256, removed (byte spans), and ``with_text`` kept (text, broken characters replaced)."""
    reach = length // 2

    def index(contexts: list[bytes], n: np.ndarray, copies: np.ndarray) -> list[np.ndarray]:
        return repeated_starts(contexts, n, copies, length)

    found = repeated(docs, Units(words=False, window=length, gram=min(16, length - reach + 1), reach=reach), index, earlier=False, id_col=id_col, text_col=text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    spans = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, text_col):
            raw, cut, kept = texts(b, text_col), [], []
            for t, f in zip(raw, b.column("__found").to_pylist(), strict=True):
                gone = covered(f, length)
                edges = [0, *(x for span in gone for x in span), len(t)]
                cut.append(gone)
                kept.append(b"".join(t[i:j] for i, j in zip(edges[::2], edges[1::2], strict=True)))
            cols = [
                b.column(id_col),
                pa.array(map(len, raw), pa.int64()),
                pa.array([len(t) - len(k) for t, k in zip(raw, kept, strict=True)], pa.int64()),
                pa.array(map(len, cut), pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                pa.array([[{"s": s, "e": e} for s, e in x] for x in cut], spans),
            ]
            yield pa.RecordBatch.from_arrays(cols + [pa.array([k.decode("utf-8", "replace") for k in kept])] * with_text, names=[id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed", *["kept"] * with_text])

    return arrow_map(found.select(id_col, text_col, "__found"), run, f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<s: long, e: long>>" + ", kept string" * with_text)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(read(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
