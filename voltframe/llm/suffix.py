"""Suffix sorting by bucket pointers, for whole numbers or bytes in memory."""

from __future__ import annotations

import numpy as np


def first_buckets(keys: np.ndarray) -> np.ndarray:
    """Each position's bucket pointer: how many keys are smaller than its own."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    at = np.arange(len(keys), dtype=np.int64)
    pointer = np.empty(len(keys), np.int64)
    pointer[order] = np.maximum.accumulate(np.where(new, at, 0))
    return pointer


def refine(pointer: np.ndarray, live: np.ndarray, offset: int, past: int = -1) -> np.ndarray:
    """Split the buckets of the positions ``live`` by the pointers of the positions ``offset`` further on, in place.

    ``live`` holds whole buckets. A position past the end counts as ``past``. Returns the positions that still share
    a bucket. As pointers are updated at once, a later call with a larger offset reuses all depth that was gained.
    """
    if not len(live):
        return live
    later = live + offset
    inside = later < len(pointer)
    nxt = np.full(len(live), past, np.int64)
    nxt[inside] = pointer[later[inside]]
    key = (pointer[live] << 32) | (nxt + 1)
    order = np.argsort(key)
    key, live = key[order], live[order]
    old = key >> 32
    at = np.arange(len(live), dtype=np.int64)
    bucket = np.ones(len(live), bool)
    bucket[1:] = old[1:] != old[:-1]
    sub = np.ones(len(live), bool)
    sub[1:] = key[1:] != key[:-1]
    pointer[live] = old + np.maximum.accumulate(np.where(sub, at, 0)) - np.maximum.accumulate(np.where(bucket, at, 0))
    alone = sub.copy()
    alone[:-1] &= sub[1:]
    return live[~alone]


def shared(pointer: np.ndarray) -> np.ndarray:
    """The positions whose pointer isn't theirs alone."""
    return np.flatnonzero(np.bincount(pointer, minlength=len(pointer))[pointer] > 1)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Sorted suffixes of non-negative numbers; every 0 is a separator, smaller than all else and unlike any other 0."""
    keys = text.astype(np.int64)
    apart = np.flatnonzero(keys == 0)
    keys += len(apart)
    keys[apart] = np.arange(len(apart))
    pointer = first_buckets(keys)
    live, depth = shared(pointer), 1
    while len(live):
        live = refine(pointer, live, depth)
        depth *= 2
    out = np.empty(len(text), np.int64)
    out[pointer] = np.arange(len(text))
    return out
