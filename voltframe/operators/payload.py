"""What a viewer page reads of models: points, branches and loads as JSON, the substations of auction nodes, and pairs side by side."""

from __future__ import annotations

from collections import defaultdict
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workers import discard, shared
from .core import S
from .graph import components


#: Links that one task follows labels over.
FOLLOWED = 100_000


def nearest(a: pd.Series, b: pd.Series, given: list[tuple]) -> dict:
    """node: (links away, label), the least of such pairs that ``given`` (node, links away, label) hand on over links."""
    near = defaultdict(list)
    for u, v in zip(a.tolist(), b.tolist(), strict=True):
        near[u].append(v)
        near[v].append(u)
    best: dict = {}
    queue = [(far, label, node) for node, far, label in given]
    heapify(queue)
    while queue:
        far, label, node = heappop(queue)
        if node not in best:
            best[node] = far, label
            for v in near[node]:
                if v not in best:
                    heappush(queue, (far + 1, label, v))
    return best


def spread_labels(labels: DataFrame, links: DataFrame, followed: int = FOLLOWED) -> DataFrame:
    """node, label: each node has the label (node, label) that is the fewest links (a, b) away, the least of several; nodes that no label reaches aren't listed.

    Links are dealt out by connected parts, many small ones to a task. A part with one label has that label. In others labels are followed within one
    task, or, in a part of more than ``followed`` links, in ranges of its nodes: each range follows what reaches it
    to its edges, and ranges tell each other until nothing gets nearer. So the rounds are those in which a nearest way
    crosses ranges, not its links, and there is no last round but the one that changes nothing.
    """
    known = shared(labels.where("node is not null and label is not null").groupBy("node").agg(F.min("label").alias("label")))
    # as they come: links that lie together stay so, which leaves components little to send
    ways = shared(links.where("a is not null and b is not null and a <> b").select("a", "b", F.lit(0).alias("by")))
    nodes = ways.select("by", F.explode(F.array("a", "b")).alias("node"))
    part = shared(components(nodes, ways, "node", "a", "b", "by", followed).select("node", "component"))
    at = shared(known.join(part, "node"))
    state = shared(at.groupBy("component").agg(F.min("label").alias("only"), F.max("label").alias("other")))
    single = part.join(state.where("only = other").select("component", F.col("only").alias("label")), "component").select("node", "label")
    alone = known.join(part, "node", "left_anti")
    several = part.join(state.where("only <> other").select("component"), "component")
    mixed = shared(ways.join(several.withColumnRenamed("node", "a"), "a").select("component", "a", "b"))
    sizes = shared(mixed.groupBy("component").agg(F.count("*").alias("n_links")))
    n_small, n_large = sizes.agg(*[F.coalesce(F.sum(F.when(x, F.col("n_links"))), F.lit(0)) for x in (F.col("n_links") <= followed, F.col("n_links") > followed)]).first()
    key, label = (df.schema[c].dataType.simpleString() for df, c in ((part, "node"), (known, "label")))

    def follow(key: tuple, way: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        best = nearest(way["a"], way["b"], list(zip(given["node"], given["far"], given["label"], strict=True)))
        return pd.DataFrame([(n, d, x) for n, (d, x) in best.items()], columns=["node", "far", "label"])

    schema = f"node {key}, far long, label {label}"
    out = single.unionAll(alone)
    if n_small:
        # parts have no link between them, so that several can be followed at once
        deal = F.pmod(F.xxhash64("component"), F.lit(-(-n_small // followed))).alias("deal")
        small = sizes.where(F.col("n_links") <= followed).select("component")
        way = mixed.join(small, "component").select(deal, "a", "b")
        given = at.join(small, "component").select(deal.alias("__deal"), "node", F.lit(0).cast("long").alias("far"), "label")
        out = out.unionAll(way.groupBy("deal").cogroup(given.groupBy("__deal")).applyInPandas(follow, schema).select("node", "label"))
    if n_large:
        large = mixed.join(sizes.where(F.col("n_links") > followed).select("component"), "component")
        out = out.unionAll(_followed_in_ranges(large, at, -(-n_large // followed), schema, follow))
    return out.select(F.col("node").cast(key), "label")


def _followed_in_ranges(ways: DataFrame, at: DataFrame, ranges: int, schema: str, follow) -> DataFrame:
    """The part of ``spread_labels`` for parts of many links; a link belongs to the range of its lesser node."""
    dealt = shared(ways.repartitionByRange(ranges, "component", "a").select("a", "b", F.spark_partition_id().alias("range")))
    touched = shared(dealt.select("range", F.col("a").alias("node")).unionAll(dealt.select("range", F.col("b").alias("node"))).distinct())
    best = shared(at.join(touched.select("node").distinct(), "node", "left_semi").select("node", F.lit(0).cast("long").alias("far"), "label"))
    while True:
        given = best.join(touched, "node").select(F.col("range").alias("__r"), "node", "far", "label")
        met = dealt.groupBy("range").cogroup(given.groupBy("__r")).applyInPandas(follow, schema)
        least = F.min(F.struct("far", "label")).alias("x")
        now = shared(met.unionByName(best).groupBy("node").agg(least).select("node", "x.far", "x.label"))
        was = best.withColumnsRenamed({"far": "__f", "label": "__l"})
        done = now.join(was, "node", "left").where("__f is null or __f <> far or __l <> label").isEmpty()
        discard(best)
        best = now
        if done:
            return best.select("node", "label")


def other_ends(labels: DataFrame, lines: DataFrame) -> DataFrame:
    """node, label of line ends without one: a line (a, b) is known to join substations ``sa`` and ``sb``; where one end has one of
    these, the other end has the other, and a line within one substation gives it to both."""
    at = labels.select(F.col("node").alias("__n"), F.col("label").alias("__l"))
    df = lines.where("sa is not null and sb is not null")
    for end in ("a", "b"):
        df = df.join(at.withColumnsRenamed({"__n": end, "__l": f"__{end}"}), end, "left")
    within = df.where("sa = sb").select(F.explode(F.array("a", "b")).alias("node"), F.col("sa").alias("label"))

    def over(mine: str, theirs: str, node: str) -> DataFrame:
        other = F.when(F.col(mine) == F.col("sa"), F.col("sb")).when(F.col(mine) == F.col("sb"), F.col("sa"))
        return df.where(F.col(theirs).isNull()).select(F.col(node).alias("node"), other.alias("label")).where("label is not null")

    found = within.unionAll(over("__a", "__b", "b")).unionAll(over("__b", "__a", "a"))
    return found.groupBy("node").agg(F.min("label").alias("label")).join(labels, "node", "left_anti")


def substations(nodes: DataFrame, inside: DataFrame, lines: DataFrame) -> DataFrame:
    """node, label: substations of auction nodes from those that a match gives (``nodes``), over equipment within one (``inside``: a, b),
    then along matched lines (a, b, sa, sb), in turn until neither adds any: a turn for each matched line that a label has to cross."""
    known = shared(spread_labels(nodes, inside))
    while True:
        more = shared(other_ends(known, lines))
        if more.isEmpty():
            return known
        # what is labelled stays as it is: new labels spread over what is left of the equipment
        left = inside
        for end in ("a", "b"):
            left = left.join(known.select(F.col("node").alias(end)), end, "left_anti")
        before, known = known, shared(known.unionByName(spread_labels(more, left)))
        discard(before, more)


def _list(df: DataFrame, by: list[str], order: Column | str, name: str, *columns: str) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct(F.struct(order).alias("__o"), F.struct(*columns).alias("__x"))))
    return df.groupBy(*by).agg(F.transform(rows, lambda r: r["__x"]).alias(name))


def models(points: DataFrame, branches: DataFrame, loads: DataFrame) -> DataFrame:
    """snapshot_id, payload: each model as JSON text; a model is a page's size, so it is one row."""
    parts = [
        _list(points, [S], "n", "buses", *[c for c in points.columns if c != S]),
        _list(branches, [S], "id", "branches", *[c for c in branches.columns if c != S]),
        _list(loads, [S], "id", "loads", *[c for c in loads.columns if c != S]),
    ]
    df = parts[0].join(parts[1], S, "left").join(parts[2], S, "left")
    return df.select(S, F.to_json(F.struct(F.col(S).alias("id"), "buses", "branches", "loads"), {"ignoreNullFields": "false"}).alias("payload"))


def compared(left: DataFrame, right: DataFrame) -> DataFrame:
    """branch_id, same: branches of both models of one kind (branch_id, x_pu, is_in_service), and whether reactance and state agree."""
    a, b = left.select("branch_id", "x_pu", "is_in_service"), right.select("branch_id", F.col("x_pu").alias("__x"), F.col("is_in_service").alias("__s"))
    return a.join(b, "branch_id").select("branch_id", (F.col("x_pu").eqNullSafe(F.col("__x")) & F.col("is_in_service").eqNullSafe(F.col("__s"))).alias("same"))


def page(payload: str, title: str = "Network") -> str:
    """A page that holds its data; a closing tag within the data can't end it."""
    safe = payload.replace("</", "<\\/")
    return f'<!doctype html><meta charset="utf-8"><title>{title}</title><script type="application/json" id="data">{safe}</script>'
