"""Similarity join on word 5-grams by a MinHash LSH forest, verified exactly.

Words are those of ``decontaminate.words`` (A-Z as a-z; punctuation separates); a text's set holds the hashes of its
runs of five words, or of all its words if they are fewer. Texts of equal sets are one representative with copies.

Each representative has a path of ``DEPTH`` minima in each of ``TREES`` prefix tries. A tree's paths, sorted, are its
trie: representatives that share a prefix lie side by side, however long it is. Matching begins with whole paths and
shortens the prefix a minimum at a time until a pair at the threshold is found with the target recall; that depends on
threshold, target and number of trees alone, so all records stop at one depth, and a deeper match is within it. Tries
lie in sorted order across partitions (no bucket has to fit in one), and each is read once: representatives are linked
to the first of their prefix, and a prefix that goes on in the next partition is joined by its label.

Linked representatives form candidate groups. A task gets the sets of one group, or of two blocks of a group too large
for one task, counts common shingles through inverted lists, and gives each text's number of links (Jaccard similarity
of the threshold or more) and its component; pairs are never emitted. Classes are components of verified links.

Null, empty and wordless texts are classes of their own with no link. Rows that share a doc_id are texts of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, ranges, read, row_key, settle, shared, ship, steps, texts, unused
from .components import components
from .decontaminate import FOLD
from .repeats import Hashes, mix, word_hashes, word_spans

SHINGLE, THRESHOLD, TARGET = 5, 0.8, 0.9999
TREES, DEPTH = 20, 6
#: Shingles that one verifying task holds of a block, about.
BLOCK = 1_500_000


def depth_for(threshold: float, target: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """Shorten the prefix until a pair at ``threshold`` is found in some tree with a probability of ``target``; an error if none does."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < target:
        depth -= 1
    if 1 - (1 - threshold**depth) ** trees < target:
        raise ValueError(f"{trees} trees can't find a pair at {threshold} with a probability of {target}")
    return depth


def shingle_sets(raw: list[bytes], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and each text's count."""
    data = np.frombuffer(b"".join(raw).translate(FOLD), np.uint8)
    n = np.fromiter(map(len, raw), np.int64, len(raw))
    s, e = word_spans(data, n)
    count = np.searchsorted(s, np.cumsum(n)) - np.searchsorted(s, np.cumsum(n) - n)
    hashes = Hashes(word_hashes(data, s, e))
    begin = np.cumsum(count) - count
    many = np.where(count > 0, np.maximum(count - k + 1, 1), 0)
    at = ranges(begin, many)
    text = np.repeat(np.arange(len(raw)), many)
    h = hashes.of(at, np.minimum(at + k, (begin + count)[text]))
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return h[new], np.bincount(text[new], minlength=len(raw))


def paths(h: np.ndarray, size: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> np.ndarray:
    """Paths (texts, trees, depth): 16 bits of a hash of each minimum. Texts need a shingle each."""
    rng = np.random.default_rng(20)
    start = np.cumsum(size) - size
    x = (h >> np.uint64(32)).astype(np.uint32)
    out = np.zeros((len(size), trees, depth), np.uint16)
    # a few texts at a time stay in the processor's cache
    cuts = [0, *(np.flatnonzero(np.diff(start // 40_000)) + 1).tolist(), len(size)]
    salts = rng.integers(0, 1 << 32, (trees, depth), np.uint64).astype(np.uint32)
    factors = rng.integers(0, 1 << 31, (trees, depth), np.uint64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
    for i, j in zip(cuts, cuts[1:], strict=False):
        if i == j:
            continue
        part, at = x[start[i] : start[j - 1] + size[j - 1]], start[i:j] - start[i]
        for t in range(trees):
            for d in range(depth):
                out[i:j, t, d] = mix(np.minimum.reduceat((part ^ salts[t, d]) * factors[t, d], at).astype(np.uint64)) & np.uint64(0xFFFF)
    return out


def _trie_links(entries: DataFrame, depth: int, longest: int) -> DataFrame:
    """a, b, label: links of nodes to the first of their prefix of ``depth`` minima in a partition (label is null), and the label of each partition's first and last prefix with its first node (a = b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def give(a, b, label) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(label, pa.binary())], names=["a", "b", "label"])

        held, head = b"", 0  # the prefix that the last batch ended with, and its first node
        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column("node").to_numpy()
            path = np.frombuffer(b"".join(batch.column("path").to_pylist()), np.uint8).reshape(len(node), 1 + 2 * longest)[:, : 1 + 2 * depth]
            new = np.ones(len(node), bool)
            new[1:] = (path[1:] != path[:-1]).any(1)
            first = path[0].tobytes()
            heads = node[np.maximum.accumulate(np.where(new, np.arange(len(node)), 0))]
            if first == held:
                lead = slice(0, int(np.argmax(new[1:])) + 1 if new[1:].any() else len(node))
                heads[lead] = head
            elif not held:
                yield give([node[0]], [node[0]], [first])
            linked = node != heads
            yield give(node[linked], heads[linked], [None] * int(linked.sum()))
            held, head = path[-1].tobytes(), int(heads[-1])
        if held:
            yield give([head], [head], [held])

    return arrow_map(entries, run, "a long, b long, label binary")


def linked(h: np.ndarray, size: np.ndarray, copies: np.ndarray, side: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Each text's links (copies count) and the least number in its component; with ``side``, only across sides."""
    m = len(size)
    owner = np.repeat(np.arange(m), size)
    order = np.argsort(h, kind="stable")
    ranked = h[order]
    new = np.ones(len(h), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    first = np.flatnonzero(new)
    width = np.diff(np.append(first, len(h)))
    which = np.empty(len(h), np.int64)
    which[order] = np.cumsum(new) - 1
    owners = owner[order]
    links, label = np.zeros(m, np.int64), np.arange(m)
    start = np.cumsum(size) - size
    for d in range(m):
        lists = which[start[d] : start[d] + size[d]]
        common = np.bincount(owners[ranges(first[lists], width[lists])], minlength=m)
        close = common >= threshold * (size[d] + size - common) - 1e-9
        close[d] = False
        if side is not None:
            close &= side != side[d]
        if close.any():
            links[d] = copies[close].sum()
            ends = label[close]
            low = min(ends.min(), label[d])
            label[np.isin(label, np.append(ends, label[d]))] = low
    return links, label


def _verified(blocks: DataFrame, threshold: float) -> DataFrame:
    """node, links, root of each text of each task (component, i, j)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def give() -> pa.RecordBatch:
            held.sort(key=lambda x: x[3])
            sets = [np.frombuffer(x[6], np.uint64) for x in held]
            i, j = held[0][1], held[0][2]
            links, label = linked(np.concatenate(sets), np.array(list(map(len, sets))), np.array([x[5] for x in held]), None if i == j else np.array([x[4] for x in held]), threshold)
            nodes = np.array([x[3] for x in held], np.int64)
            return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(links), pa.array(nodes[label])], names=["node", "links", "root"])

        for b in batches:
            for x in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held and held[0][:3] != x[:3]:
                    yield give()
                    held = []
                held.append(x)
        if held:
            yield give()

    keys = ["component", "i", "j"]
    return arrow_map(blocks.select(*keys, "node", "b", "copies", "shingles").repartition(*keys).sortWithinPartitions(*keys), run, "node long, links long, root long")


def classes(docs: DataFrame, *, threshold: float = THRESHOLD, target: float = TARGET, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """__row (see ``row_key``), the id, class_id (least __row of its class; the least id where ids are unique whole
    numbers), n_links (other texts within the threshold, copies included)."""
    ship(docs.sparkSession)
    keyed = row_key(docs.select(id_col, text_col), id_col)
    depth = depth_for(threshold, target)
    kind = docs.schema[id_col].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, text_col, rows=1000, size=1 << 20):
            h, size = shingle_sets(texts(b, text_col))
            some = size > 0
            start = (np.cumsum(size) - size)[some]
            one, two = np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
            found: list[bytes | None] = [None] * len(size)
            if some.any():
                one[some], two[some] = np.add.reduceat(mix(h), start), np.add.reduceat(mix(~h), start)
                got = paths(h, size[some])
                for i, x in zip(np.flatnonzero(some).tolist(), got, strict=True):
                    found[i] = x.tobytes()
            yield pa.RecordBatch.from_arrays([b.column("__row"), b.column(id_col), pa.array(size, pa.int64()), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(found, pa.binary())], names=["__row", id_col, "n", "h1", "h2", "paths"])

    rows = shared(arrow_map(keyed.select("__row", id_col, text_col), sign, f"__row long, `{id_col}` {kind}, n long, h1 long, h2 long, paths binary"))
    best = F.min(F.struct(F.col("__row").alias("node"), "n", "paths"))
    nodes = shared(rows.where("n > 0").groupBy("h1", "h2").agg(best.alias("x"), F.count("*").alias("copies")).select("h1", "h2", "x.*", "copies"))
    settle(docs.sparkSession)
    by_tree = nodes.select("node", F.col("paths"), F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    step = 2 * DEPTH
    entries = by_tree.select(F.concat(F.unhex(F.lpad(F.hex("tree"), 2, "0")), F.substring("paths", F.col("tree") * step + 1, F.lit(step))).alias("path"), "node")
    tries = entries.repartitionByRange("path", "node").sortWithinPartitions("path", "node")
    links = shared(_trie_links(tries, depth, DEPTH))
    settle(docs.sparkSession)
    ends = links.where("label is not null")
    across = ends.join(ends.groupBy("label").agg(F.min("a").alias("to")), "label").where("a <> to").select("a", F.col("to").alias("b"))
    near = components(links.where("label is null").select("a", "b").unionAll(across))
    member = near.join(nodes.select("node", "n", "copies"), "node")
    size = member.groupBy("component").agg(F.ceil(F.sum("n") / F.lit(block)).cast("int").alias("blocks"))
    member = shared(member.join(size, "component").select("node", "component", "copies", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("b")))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, text_col, rows=1000, size=1 << 20):
            h, size = shingle_sets(texts(b, text_col))
            ends = np.cumsum(size)
            yield pa.RecordBatch.from_arrays([*b.drop_columns([text_col]).columns, pa.array([h[e - s : e].tobytes() for s, e in zip(size.tolist(), ends.tolist(), strict=True)], pa.binary())], names=["node", "component", "copies", "blocks", "b", "shingles"])

    with_text = keyed.select(F.col("__row").alias("node"), text_col).join(member, "node").select("node", "component", "copies", "blocks", "b", text_col)
    of_member = arrow_map(with_text, sets, "node long, component long, copies long, blocks int, b int, shingles binary")
    tasks = of_member.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("component", F.least("b", "k").alias("i"), F.greatest("b", "k").alias("j"), "node", "b", "copies", "shingles")
    found = shared(_verified(tasks, threshold).where("links > 0"))
    if member.where("blocks > 1").isEmpty():
        root = found.select("node", F.col("root").alias("class"))
    else:
        root = components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))).withColumnRenamed("component", "class")
    links = found.groupBy("node").agg(F.sum("links").alias("links")).join(root, "node", "left")
    whole = nodes.select("h1", "h2", "node", "copies").join(links, "node", "left").select("h1", "h2", F.coalesce("class", "node").alias("class"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    alone = rows.where("n = 0").select("__row", id_col, F.col("__row").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return rows.where("n > 0").join(whole, ["h1", "h2"]).select("__row", id_col, F.col("class").alias("class_id"), F.col("links").alias("n_links")).unionAll(alone)


def one_of_each(docs: DataFrame, *, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class of ``docs``, that of the least key, with all columns."""
    row = unused(docs, "__row")
    keyed = row_key(docs, id_col, row)
    gone = classes(keyed.select(F.col(row).alias("__id"), F.col(text_col).alias("__text")), threshold=threshold, id_col="__id", text_col="__text").where("class_id <> __row").select(F.col("__row").alias(row))
    return keyed.join(gone, row, "left_anti").select(*docs.columns)


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(read(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")
