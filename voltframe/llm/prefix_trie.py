"""The prefix trie of conversations, from owned chains that a batched binary search finds.

A prefix's digest is a polynomial of its turns' digests modulo 2**127 - 1, so that runs of turns compose: a conversation
that is spread over several tasks is digested piece by piece, and one that takes over another's first turns needs one
term more. A node is a (depth, digest); its owner is the least conversation that has it. Who owns a prefix owns all longer
ones of the same conversation, so each conversation owns one chain of nodes, from some depth to its end, or none. That
first depth is found by binary search over all conversations at once: round k joins the depths under test, each an odd
multiple of 2**k, with the minima of the digests of that class only, so that every digest is read in one round and no
more. Where the search ends, the chain hangs below the owner of the last prefix that isn't its own.

Values go up the chains: sums to each chain's end first, then each chain's total to every node above it, in one grouped
sum over the prefixes that conversations have but don't own.

Turns are ordered by ``turn``, nulls first, equal ones by a digest of role and text. Null roles and texts are empty.
Rows without a conversation's id belong to none. An empty table has no nodes; repeated rows are turns like others.
Ids must be whole numbers; for negative ones, c - c % 5 goes towards zero.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, discard, read, shared

#: Digests are numbers below PRIME, polynomials at BASE (any fixed large number).
PRIME, BASE = (1 << 127) - 1, 0x5851F42D4C957F2D14057B7EF767814F
#: Depths of a conversation that go to one task together, and ids whose text is made at once.
BLOCK, IDS = 4096, 4096
#: Of all prefixes, a digest that more than this share has is hot; there are at most 1 / HOT of them, which are broadcast.
HOT = 1e-4


def _number(x: bytes) -> int:
    return int.from_bytes(x, "big") % PRIME


def _digest(n: int) -> bytes:
    return n.to_bytes(16, "big")


def ordered(turns: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(written rows of c, p (from 1), s (digest of the first p turns), size (bytes of text)); what to discard.

    Rows are dealt out by ranges of (id, turn, digest, row), so that a conversation may lie in many tasks. Each task
    digests its piece; one row a task, its last, then tells the next tasks what came before.
    """
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in (role_col, text_col))
    leaf = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    rows = turns.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("c"), F.col(turn_col).alias("turn"), leaf.alias("leaf"), F.octet_length(text).cast("long").alias("size"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("c"), F.col("turn").asc_nulls_first(), F.col("leaf"), F.col("row")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("c", "leaf", "size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        at, p, s, held = None, 0, 0, None

        def made(b: pa.RecordBatch, ps: list, ss: list, last: bool) -> pa.RecordBatch:
            ends = np.zeros(b.num_rows, bool)
            ends[-1] = last
            return pa.RecordBatch.from_arrays([pa.array(np.full(b.num_rows, task, np.int32)), b.column("c"), pa.array(ps, pa.int64()), pa.array(ss, pa.binary()), b.column("size"), pa.array(ends)], names=["task", "c", "p", "s", "size", "last"])

        for b in batches:
            if not b.num_rows:
                continue
            if held:
                yield made(*held, False)
            ps, ss = [], []
            for c, leaf in zip(b.column("c").to_pylist(), b.column("leaf").to_pylist(), strict=True):
                if c != at:
                    at, p, s = c, 0, 0
                p += 1
                s = (s * BASE + _number(leaf)) % PRIME
                ps.append(p)
                ss.append(_digest(s))
            held = b, ps, ss
        if held:
            yield made(*held, True)

    pieces = shared(arrow_map(dealt, run, "task int, c bigint, p bigint, s binary, size bigint, last boolean"))
    # one row for each task: where conversations are cut
    carried, before = {}, None
    for r in pieces.where("last").select("task", "c", "p", "s").orderBy("task").collect():
        if before is not None:
            carried[r["task"]] = before
        c, p, s = r["c"], r["p"], _number(bytes(r["s"]))
        before = (c, p + before[1], (before[2] * pow(BASE, p, PRIME) + s) % PRIME) if before is not None and before[0] == c else (c, p, s)
    sent = pieces.sparkSession.sparkContext.broadcast(carried)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p, s, c = b.column("p").to_numpy().copy(), b.column("s"), b.column("c").to_numpy()
            task = b.column("task").to_numpy()
            cut = [(k, sent.value[k]) for k in np.unique(task).tolist() if k in sent.value]
            if any(len(np.flatnonzero((task == k) & (c == x[0]))) for k, x in cut):
                s = s.to_pylist()
                for k, (conv, turns_before, digest) in cut:
                    for i in np.flatnonzero((task == k) & (c == conv)).tolist():
                        s[i] = _digest((digest * pow(BASE, int(p[i]), PRIME) + _number(s[i])) % PRIME)
                        p[i] += turns_before
                s = pa.array(s, pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("c"), pa.array(p, pa.int64()), s, b.column("size")], names=["c", "p", "s", "size"])

    if not carried:
        return pieces.select("c", "p", "s", "size"), pieces
    return arrow_map(pieces.select("task", "c", "p", "s", "size"), joined, "c bigint, p bigint, s binary, size bigint"), pieces


def _blocks(depths: Column) -> Column:
    """The blocks of a conversation of so many turns, the first of them with depth 0."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.floor(depths / BLOCK).cast("long")))


def _block(depth: str) -> Column:
    return F.floor(F.col(depth) / BLOCK).cast("long")


def shared_openings(rows: DataFrame, within: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """Rows of ``ordered`` to (prefixes of the rebuilt conversations: c, d, key, size; conversations: c, n).

    A conversation c takes its first h turns from c - c % ``within``, where h is crc32(c) % (``most`` + 1); its own follow
    from the one after its first h. An opening is at most ``most`` rows, which travel as an array with each conversation.
    """
    h = F.crc32(F.col("c").cast("string").cast("binary")) % (most + 1)
    convs = rows.groupBy("c").agg(F.max("p").alias("n_own"), F.max(F.when(F.col("p") == h, F.col("s"))).alias("s_h")).withColumns({"h": h, "base": F.col("c") - F.col("c") % within})
    heads = rows.where((F.col("p") <= most) & (F.col("c") % within == 0)).groupBy(F.col("c").alias("base")).agg(F.array_sort(F.collect_list(F.struct("p", "s", "size"))).alias("head"))
    convs = convs.join(heads, "base", "left").withColumn("head", F.slice(F.coalesce("head", F.expr("cast(array() as array<struct<p: bigint, s: binary, size: bigint>>)")), F.lit(1), F.col("h").cast("int")))
    n_head = F.size("head").cast("long")
    convs = shared(convs.select("c", "h", "n_own", "s_h", "head", (n_head + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("n")))
    zero = F.lit(bytes(16))
    opening = convs.select("c", F.explode(F.concat(F.array(F.struct(F.lit(0).cast("long").alias("p"), zero.alias("s"), F.lit(0).cast("long").alias("size"))), "head")).alias("x")).select("c", F.col("x.p").alias("d"), F.col("x.s").alias("key"), F.col("x.size").alias("size"))
    # a block of a conversation's turns meets its row; no more than one of BLOCK turns in a task
    told = convs.where("n_own > h").select("c", "h", "s_h", F.size("head").cast("long").alias("n_head"), F.when(F.size("head") > 0, F.element_at("head", -1)["s"]).alias("s_head"), _blocks(F.col("n_own")).alias("block"))
    own = rows.withColumn("block", _block("p")).join(told, ["c", "block"]).where("p > h")
    moved = F.coalesce("s_h", zero) != F.coalesce("s_head", zero)
    own = own.select("c", (F.col("p") - F.col("h") + F.col("n_head")).alias("d"), "s", "size", (F.col("p") - F.col("h")).alias("turns"), F.when(moved, F.coalesce("s_head", zero)).alias("now"), F.when(moved, F.coalesce("s_h", zero)).alias("was"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column("s").to_pylist()
            for i, (now, was, turns) in enumerate(zip(b.column("now").to_pylist(), b.column("was").to_pylist(), b.column("turns").to_pylist(), strict=True)):
                if now is not None:
                    keys[i] = _digest((_number(keys[i]) + (_number(now) - _number(was)) * pow(BASE, turns, PRIME)) % PRIME)
            yield pa.RecordBatch.from_arrays([b.column("c"), b.column("d"), pa.array(keys, pa.binary()), b.column("size")], names=["c", "d", "key", "size"])

    return opening.unionByName(arrow_map(own, run, "c bigint, d bigint, key binary, size bigint")), convs


def _class(d: Column) -> Column:
    """The round that a depth is tested in: how often two divides it; -1 for the root."""
    return F.when(d == 0, -1).otherwise(F.bit_count(d.bitwiseAND(-d) - 1)).cast("int")


def owned_chains(prefixes: DataFrame, minima: DataFrame, convs: DataFrame, longest: int, hot: int) -> DataFrame:
    """c, n, pos, at of each conversation: it owns the depths pos + 1 to n; ``at`` owns its prefix of pos turns.

    ``prefixes`` (c, d, key, k), ``minima`` (d, key, owner, n_convs, k; only keys that several conversations have). ``pos`` is the
    largest depth that it doesn't own, -1 for the least conversation, which owns the root.
    """
    root = convs.agg(F.min("c")).first()[0]
    state = convs.select("c", "n", F.when(F.col("c") == root, -1).otherwise(0).cast("long").alias("pos"), F.lit(root).cast("long").alias("at"))
    written = None
    for k in reversed(range(longest.bit_length())):
        asked = state.where((F.col("c") != root) & (F.col("pos") + (1 << k) <= F.col("n"))).select("c", (F.col("pos") + (1 << k)).alias("d"))
        probes = prefixes.where(F.col("k") == k).join(asked, ["c", "d"]).select("c", "d", "key")
        least = minima.where(F.col("k") == k).select("d", "key", "owner", "n_convs")
        # fewer than 1 / HOT keys are in more than that share of all prefixes
        frequent = F.broadcast(least.where(F.col("n_convs") > hot).select("d", "key", F.col("owner").alias("frequent")))
        probes = probes.join(frequent, ["d", "key"], "left")
        rare = least.where(F.col("n_convs") <= hot).select("d", "key", F.lit(0).cast("long").alias("salt"), "owner")
        probes = probes.withColumn("salt", F.when(F.col("frequent").isNull(), 0).otherwise(F.lit(1) + F.abs(F.col("c")))).join(rare, ["d", "key", "salt"], "left")
        found = probes.select("c", "d", F.coalesce("frequent", "owner").alias("owner")).where("owner < c")
        state = shared(state.join(found, "c", "left").select("c", "n", F.coalesce("d", "pos").alias("pos"), F.coalesce("owner", "at").alias("at")))
        if written is not None:
            discard(written)
        written = state
    return shared(state) if written is None else state


def id_digests(members: DataFrame) -> DataFrame:
    """(a, d, c) to (a, d, ends_sha256): the ids c of each (a, d), ascending, comma-joined and hashed.

    Ids are dealt out by ranges, so that no task has all of a large group; a task makes pieces of text. A hash reads its text
    in order, so a group's pieces then go through one task, as a stream that keeps nothing.
    """
    dealt = members.repartitionByRange("a", "d", "c").sortWithinPartitions("a", "d", "c")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, d, c = (b.column(x).to_numpy() for x in ("a", "d", "c"))
            cuts = np.flatnonzero((a[1:] != a[:-1]) | (d[1:] != d[:-1])) + 1
            starts = [i for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(a)], strict=True) for i in range(s, e, IDS)]
            text = [",".join(map(str, c[s:e][:IDS].tolist())) for s, e in zip(starts, [*starts[1:], len(a)], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(x[starts], pa.int64()) for x in (a, d, c)] + [pa.array(text)], names=["a", "d", "c", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, h = None, None
        for b in batches:
            out = []
            for a, d, ids in zip(*(b.column(x).to_pylist() for x in ("a", "d", "ids")), strict=True):
                if (a, d) != at:
                    if h:
                        out.append((*at, h.hexdigest()))
                    at, h = (a, d), hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            yield _ends(out)
        if h:
            yield _ends([(*at, h.hexdigest())])

    texts = arrow_map(dealt, pieces, "a bigint, d bigint, c bigint, ids string")
    return arrow_map(texts.repartition("a", "d").sortWithinPartitions("a", "d", "c").select("a", "d", "ids"), hashed, "a bigint, d bigint, ends_sha256 string")


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    a, d, digest = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(d, pa.int64()), pa.array(digest, pa.string())], names=["a", "d", "ends_sha256"])


def trie(turns: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", within: int = 5, most: int = 8) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of each node.

    ``within`` and ``most``: which conversations share openings, and how long these may be (see ``shared_openings``).
    """
    rows, pieces = ordered(turns, id_col, turn_col, role_col, text_col)
    prefixes, convs = shared_openings(rows, within, most)
    prefixes = shared(prefixes.withColumn("k", _class(F.col("d"))).sortWithinPartitions("k"))
    # nodes that only one conversation has need no minimum: it is their owner
    minima = shared(prefixes.groupBy("d", "key").agg(F.min("c").alias("owner"), F.count("*").alias("n_convs"), F.first("size").alias("size"), F.first("k").alias("k")).where("n_convs > 1"))
    total = convs.agg(F.max("n").alias("longest"), F.sum(F.col("n") + 1).alias("prefixes")).first()
    chains = owned_chains(prefixes, minima, convs, total["longest"] or 0, int((total["prefixes"] or 0) * HOT))
    held = chains.where("pos < n")

    # what each chain has of its own; nodes of one conversation add nothing to saved tokens
    own = minima.select(F.col("owner").alias("c"), "d", "n_convs", ((F.col("n_convs") - 1) * F.col("size")).alias("saves"))
    hung = held.where("pos >= 0").groupBy(F.col("at").alias("c"), F.col("pos").alias("d")).agg(F.count("*").alias("n_hung"))
    ended = held.select("c", F.col("n").alias("d")).join(hung, ["c", "d"], "left_anti").select("c", F.lit(1).cast("long").alias("leaf"))
    totals = held.select("c").join(own.groupBy("c").agg(F.sum("saves").alias("saved")), "c", "left").join(ended, "c", "left").select("c", F.coalesce("saved", F.lit(0)).alias("saved"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    chains = shared(chains.join(totals, "c", "left"))

    # a conversation's prefixes up to pos are others' nodes, which its chain lies below; the rest is its chain
    told = chains.select("c", "n", "pos", "at", "saved", "leaf", _blocks(F.col("n")).alias("block"))
    met = prefixes.withColumn("block", _block("d")).join(told, ["c", "block"])
    below = met.where("d <= pos and pos < n").groupBy("d", "key").agg(F.sum("saved").alias("saved_below"), F.sum("leaf").alias("leaves_below"))
    below = minima.join(below, ["d", "key"]).select(F.col("owner").alias("c"), "d", "saved_below", "leaves_below")
    nodes = met.where("d > pos").select("c", "d", "n", "pos", "at", "leaf").join(own, ["c", "d"], "left").join(hung, ["c", "d"], "left").join(below, ["c", "d"], "left")
    nodes = nodes.withColumns({x: F.coalesce(x, F.lit(1 if x == "n_convs" else 0)) for x in ("n_convs", "saves", "n_hung", "saved_below", "leaves_below")}).withColumn("block", _block("d"))
    # sums from each node to its chain's end: within blocks of depths, then over the blocks that follow
    later = nodes.groupBy("c", "block").agg(F.sum("saves").alias("in_block")).withColumn("later", F.coalesce(F.sum("in_block").over(Window.partitionBy("c").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).where("later > 0").select("c", "block", "later")
    rest = F.sum("saves").over(Window.partitionBy("c", "block").orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, 0))
    nodes = nodes.withColumn("rest", rest).join(later, ["c", "block"], "left")

    ends = id_digests(chains.select(F.when(F.col("pos") < F.col("n"), F.col("c")).otherwise(F.col("at")).alias("a"), F.col("n").alias("d"), "c")).select(F.col("a").alias("c"), "d", "ends_sha256")
    out = nodes.join(ends, ["c", "d"], "left").select(
        F.col("c").alias("conv_id"),
        F.col("d").alias("depth"),
        F.when(F.col("d") > 0, F.when(F.col("d") > F.col("pos") + 1, F.col("c")).otherwise(F.col("at"))).alias("parent_conv_id"),
        "n_convs",
        (F.col("n_hung") + (F.col("d") < F.col("n")).cast("long")).alias("n_children"),
        (F.col("leaf") + F.col("leaves_below")).alias("n_leaves"),
        (F.col("rest") + F.coalesce("later", F.lit(0)) + F.col("saved_below")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
    discard(pieces)
    return out


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(read(spark, sf_dir, "conversations"))


ORACLE = """
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, left(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32)) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), lengths AS (SELECT c, count(*) AS n FROM t GROUP BY c),
x AS (
  SELECT a.c, a.h, least(a.h, coalesce(b.n, 0)) AS n_head, a.c - a.c % 5 AS base
  FROM (
    SELECT c, xor(list_reduce(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda ch: CAST(ord(ch) AS BIGINT)),
      lambda crc, b: list_reduce(range(8), lambda r, i: xor(r >> 1, 3988292384 * (r & 1)), xor(crc, b)), 4294967295), 4294967295) % 9 AS h
    FROM lengths) a
  LEFT JOIN lengths b ON b.c = a.c - a.c % 5
), rebuilt AS (
  SELECT x.c, t.p AS d, t.role, t.text FROM x JOIN t ON t.c = x.base AND t.p <= x.h
  UNION ALL
  SELECT x.c, t.p - x.h + x.n_head, t.role, t.text FROM x JOIN t ON t.c = x.c AND t.p > x.h
), prefix AS (
  SELECT c, d, sha256(string_agg(strlen(role) || ':' || strlen(text) || ':' || role || text, '') OVER (PARTITION BY c ORDER BY d)) AS key, strlen(text) AS size FROM rebuilt
  UNION ALL
  SELECT c, 0, '', 0 FROM x
), node AS (
  SELECT d, key, min(c) AS owner, count(*) AS n_convs, any_value(size) AS size FROM prefix GROUP BY d, key
), parent AS (
  SELECT n.d, n.key, p.key AS parent_key, q.owner AS parent
  FROM node n LEFT JOIN prefix p ON p.c = n.owner AND p.d = n.d - 1 LEFT JOIN node q ON q.d = p.d AND q.key = p.key
), children AS (SELECT d - 1 AS d, parent_key AS key, count(*) AS n_children FROM parent WHERE d > 0 GROUP BY ALL),
subtree AS (
  SELECT p.d, p.key, sum(CASE WHEN h.n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((m.n_convs - 1) * m.size) AS saved
  FROM node m LEFT JOIN children h ON h.d = m.d AND h.key = m.key JOIN prefix p ON p.c = m.owner AND p.d <= m.d
  GROUP BY p.d, p.key
), ends AS (
  SELECT d, key, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS ends
  FROM (SELECT c, d, key FROM prefix QUALIFY d = max(d) OVER (PARTITION BY c)) GROUP BY d, key
)
SELECT n.owner AS conv_id, CAST(n.d AS BIGINT) AS depth, p.parent AS parent_conv_id, n.n_convs, CAST(coalesce(h.n_children, 0) AS BIGINT) AS n_children,
  CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM node n JOIN parent p ON p.d = n.d AND p.key = n.key LEFT JOIN children h ON h.d = n.d AND h.key = n.key
JOIN subtree s ON s.d = n.d AND s.key = n.key LEFT JOIN ends e ON e.d = n.d AND e.key = n.key
"""
