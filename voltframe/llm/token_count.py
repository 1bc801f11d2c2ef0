"""Greedy word-piece token counts by a linear longest-match automaton.

A word is a run of characters that aren't white space, together with one leading space; its pieces are the longest
vocabulary entry at its start, then the longest at the start of the rest, and so on. The automaton is the vocabulary's
trie. Where a node has no child for the next byte, its failure link leads to the node of what remains after the pieces
that greedy matching is bound to take, and its popped count says how many pieces those are. Every byte is then read
once, and no piece is ever built.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .bpe import load_ranks, parse_ranks
from .common import arrow_map, read, resident, ship, steps, texts

#: Distinct words whose counts a worker keeps before it starts anew; it only bounds memory.
CACHED = 400_000


class Automaton:
    """``vocabulary`` must hold each single byte, so that every word has pieces."""

    def __init__(self, vocabulary: list[bytes]):
        child: list[dict[int, int]] = [{}]
        whole, edge = [False], [(0, 0)]
        for token in vocabulary:
            at = 0
            for b in token:
                if b not in child[at]:
                    child[at][b] = len(child)
                    child.append({})
                    whole.append(False)
                    edge.append((at, b))
                at = child[at][b]
            whole[at] = True
        link, popped = [-1] * len(child), [0] * len(child)
        todo = deque(child[0].values())
        while todo:
            at = todo.popleft()
            todo.extend(child[at].values())
            if whole[at]:  # the whole string is one piece, and nothing remains
                link[at], popped[at] = 0, 1
                continue
            parent, b = edge[at]
            to, n = link[parent], popped[parent]
            while to >= 0 and b not in child[to]:
                n += popped[to]
                to = link[to]
            if to < 0:
                raise ValueError(f"no piece for byte {b}")
            link[at], popped[at] = child[to][b], n
        self.child, self.link, self.popped = child, link, popped
        self.cache: dict[bytes, int] = {}

    def pieces(self, word: bytes) -> int:
        """How many pieces greedy longest matching cuts ``word`` into."""
        child, link, popped = self.child, self.link, self.popped
        at = n = 0
        for b in word:
            to = child[at].get(b)
            while to is None:
                n += popped[at]
                at = link[at]
                if at < 0:
                    raise ValueError(f"no piece for byte {b}")
                to = child[at].get(b)
            at = to
        while at > 0:
            n += popped[at]
            at = link[at]
        return n

    def count(self, text: bytes) -> tuple[int, int]:
        """(words, pieces) of a text."""
        cache = self.cache
        if len(cache) > CACHED:
            cache.clear()
        words = text.split()
        total = 0
        for w in words:
            n = cache.get(w)
            if n is None:
                n = cache[w] = self.pieces(b" " + w)
            total += n
        return len(words), total


def automaton(content: bytes) -> Automaton:
    return resident(("token_count", hashlib.sha256(content).hexdigest()), lambda: Automaton(list(parse_ranks(content))))


def token_counts(docs: DataFrame, vocabulary_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_tokens of each row. White space is ASCII's (space, \\t \\n \\v \\f \\r). Null and empty texts have neither.

    The vocabulary's file is of fixed size and travels with the tasks; each worker builds the automaton once.
    """
    ship(docs.sparkSession)
    content = docs.sparkSession.sparkContext.broadcast(load_ranks(vocabulary_path))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = automaton(content.value).count
        for b in steps(batches, text_col):
            got = [count(x) for x in texts(b, text_col)]
            yield pa.RecordBatch.from_arrays([b.column(id_col), pa.array([w for w, _ in got], pa.int64()), pa.array([t for _, t in got], pa.int64())], names=[id_col, "n_words", "n_tokens"])

    return arrow_map(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, n_words bigint, n_tokens bigint", resides=True)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
