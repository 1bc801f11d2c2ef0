"""Relational operators on any columns: joins, votes, dedup, signed and normalised sums.

Each keeps one shuffle per key where it can, and none collects a group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, by: list[str], posted: str, ident: str) -> DataFrame:
    """The latest posting of each key: null times first, then by time, then the longer and larger id."""
    order = F.struct(F.col(posted).isNotNull(), F.col(posted), F.length(F.col(ident).cast("string")), F.col(ident))
    return df.groupBy(*by).agg(F.max_by(F.struct(*[c for c in df.columns if c not in by]), order).alias("x")).select(*by, "x.*")


def revision(df: DataFrame, by: list[str], posted: str, ident: str, name: str = "revision") -> DataFrame:
    """Number postings of each key in posting order, from 0."""
    w = Window.partitionBy(*by).orderBy(F.col(posted).asc_nulls_first(), F.length(F.col(ident).cast("string")), ident)
    return df.withColumn(name, F.row_number().over(w) - 1)


def signed_union(parts: list[tuple[DataFrame, str, int]], keys: list[str], value: str = "mw") -> DataFrame:
    """Union of frames as (keys, kind, value with the part's sign); zero and null values go."""
    some = [df.select(*keys, F.lit(kind).alias("kind"), (F.col(value) * sign).alias(value)) for df, kind, sign in parts]
    return reduce(DataFrame.unionByName, some).where(F.col(value).isNotNull() & (F.col(value) != 0))


def net_by_kind(df: DataFrame, keys: list[str], kinds: list[str], kind: str = "kind", value: str = "mw") -> DataFrame:
    """One column of sums for each kind (null where a key has none) and ``net_mw``, their sum."""
    wide = df.groupBy(*keys).agg(*[F.sum(F.when(F.col(kind) == k, F.col(value))).alias(k) for k in kinds])
    return wide.withColumn("net_mw", reduce(lambda a, b: a + b, [F.coalesce(F.col(k), F.lit(0.0)) for k in kinds]))


def balance(df: DataFrame, keys: list[str], kinds: list[str], kind: str = "kind", value: str = "mw") -> DataFrame:
    """Sums of each kind (0 where none), net, supply (their positive ones) and the net's share of supply."""
    wide = net_by_kind(df, keys, kinds, kind, value).fillna(0.0, kinds)
    supply = reduce(lambda a, b: a + b, [F.greatest(F.col(k), F.lit(0.0)) for k in kinds])
    return wide.withColumn("supply_mw", supply).withColumn("net_share", F.try_divide("net_mw", "supply_mw"))


def resolved(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """``is_resolved``: whether the key is known; the key of an unresolved row becomes null."""
    mark = known.select(F.col(key).alias("__k")).where("__k is not null").distinct().withColumn("__has", F.lit(True))
    out = df.join(mark, F.col(key) == F.col("__k"), "left").withColumn("is_resolved", F.coalesce("__has", F.lit(False)))
    return out.withColumn(key, F.when(F.col("is_resolved"), F.col(key))).drop("__k", "__has")


def anti(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key is known and isn't in ``other``; unlike a plain anti join, null keys go."""
    return df.where(F.col(key).isNotNull()).join(other.select(key), key, "left_anti")


def both_ways(edges: DataFrame, a: str, b: str, order: list[str]) -> DataFrame:
    """Edges in both orientations with ``is_swapped``; of equal pairs the direct one stays, then the first by ``order``."""
    swapped = edges.withColumnsRenamed({a: "__x", b: "__y"}).withColumnsRenamed({"__x": b, "__y": a})
    every = edges.withColumn("is_swapped", F.lit(False)).unionByName(swapped.withColumn("is_swapped", F.lit(True)))
    return first_of(every, [a, b], [F.col("is_swapped"), *[F.col(c) for c in order]])


def first_of(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("__n = 1").drop("__n")


def normalized(df: DataFrame, point: str, bus: str, raw: str, ok: str = "is_resolved") -> DataFrame:
    """Raw weights summed by point and bus, and divided by the point's total where that is positive; unresolved rows stay without a weight."""
    sums = df.where(ok).groupBy(point, bus).agg(F.coalesce(F.sum(raw), F.lit(0.0)).alias("raw_weight"))
    total = F.sum("raw_weight").over(Window.partitionBy(point))
    some = sums.withColumn("weight", F.when(total > 0, F.col("raw_weight") / total)).withColumn(ok, F.lit(True))
    rest = df.where(~F.col(ok)).select(point, F.lit(None).cast(df.schema[bus].dataType).alias(bus), F.col(raw).alias("raw_weight"), F.lit(None).cast("double").alias("weight"), F.lit(False).alias(ok))
    return some.select(point, bus, "raw_weight", "weight", ok).unionByName(rest)


def renormalized(weights: DataFrame, keep: DataFrame, point: str, bus: str) -> DataFrame:
    """Weights on kept buses, rescaled to 1 by point, and what each point lost (``weight_dropped``)."""
    mark = keep.select(F.col(bus).alias("__b")).distinct().withColumn("__in", F.lit(True))
    df = weights.join(mark, F.col(bus) == F.col("__b"), "left").withColumn("__w", F.when(F.col("__in"), F.col("weight")).otherwise(0.0))
    by = Window.partitionBy(point)
    df = df.withColumn("__kept", F.sum("__w").over(by)).withColumn("weight_dropped", F.sum("weight").over(by) - F.col("__kept"))
    return df.where(F.col("__in") & (F.col("__kept") > 0)).select(point, bus, (F.col("weight") / F.col("__kept")).alias("weight"), "weight_dropped")


def two_level(df: DataFrame, hub: str, part: str, bus: str) -> DataFrame:
    """Equal weights of a hub's parts, and of the buses within each part."""
    parts = df.select(hub, part).distinct().groupBy(hub).agg(F.count("*").alias("n_parts"))
    w = F.count(bus).over(Window.partitionBy(hub, part))
    return df.withColumn("__n", w).join(parts, hub).select(hub, part, bus, (1.0 / F.col("n_parts") / F.col("__n")).alias("weight"))


def handed_over(df: DataFrame, keys: list[str], amount: str, targets: list[tuple[str, str]]) -> DataFrame:
    """Rows of (keys, target, amount * fraction) for each named target of a row that takes something."""
    pairs = F.array(*[F.struct(F.col(t).alias("target"), F.col(f).alias("fraction")) for t, f in targets])
    return df.select(*keys, amount, F.explode(pairs).alias("x")).where("x.target is not null and x.fraction is not null").select(*keys, F.col("x.target").alias("target"), (F.col(amount) * F.col("x.fraction")).alias("amount"))


def equal_sets(a: DataFrame, b: DataFrame, key_a: str, key_b: str, member: str) -> DataFrame:
    """Pairs of keys whose non-empty member sets are equal, where the set points at one key of ``b`` only."""
    def sets(df: DataFrame, key: str) -> DataFrame:
        return df.where(F.col(member).isNotNull()).groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(F.col(member).cast("string"))), "\x1f").alias("__set"))

    one = sets(b, key_b).groupBy("__set").agg(F.min(key_b).alias(key_b), F.count("*").alias("__n")).where("__n = 1").select("__set", key_b)
    return sets(a, key_a).join(one, "__set").select(key_a, key_b)


def by_prefix(a: DataFrame, b: DataFrame, key_a: str, key_b: str, extra: tuple[int, ...] = (1, 2)) -> DataFrame:
    """Pairs where b's key is a's plus a few characters, as equality of stems."""
    stems = reduce(DataFrame.unionByName, [b.where(F.length(key_b) > n).withColumn("__stem", F.col(key_b).substr(F.lit(1), F.length(key_b) - n)) for n in extra])
    return a.join(stems, F.col(key_a) == F.col("__stem")).drop("__stem")


def mutual_best(votes: DataFrame, a: str, b: str, n: str, least: int = 2) -> DataFrame:
    """Pairs that are each other's only best, with ``least`` votes or as each other's only partner."""
    wa, wb = Window.partitionBy(a), Window.partitionBy(b)
    df = votes.withColumns({"__ma": F.max(n).over(wa), "__mb": F.max(n).over(wb), "__da": F.count("*").over(wa), "__db": F.count("*").over(wb)})
    df = df.where((F.col(n) == F.col("__ma")) & (F.col(n) == F.col("__mb")) & ((F.col(n) >= least) | ((F.col("__da") == 1) & (F.col("__db") == 1))))
    df = df.withColumns({"__na": F.count("*").over(wa), "__nb": F.count("*").over(wb)}).where("__na = 1 and __nb = 1")
    return df.select(a, b, n)


def cascade(a: DataFrame, b: DataFrame, id_a: str, id_b: str, stages: list[tuple[str, Column, Column]]) -> DataFrame:
    """id_a, id_b, method: each stage (name, key of a, key of b) joins what no stage before has matched; only keys that are unique on both sides match; the rest of both sides follow as ``unmatched``."""
    done, left, right = None, a, b
    for name, ka, kb in stages:
        def only(df: DataFrame, ident: str, key: Column) -> DataFrame:
            return df.select(F.col(ident), key.alias("__key")).where("__key is not null").withColumn("__n", F.count("*").over(Window.partitionBy("__key"))).where("__n = 1").select(ident, "__key")

        got = only(left, id_a, ka).join(only(right, id_b, kb), "__key").select(id_a, id_b, F.lit(name).alias("method"))
        done = got if done is None else done.unionByName(got)
        left, right = left.join(got, id_a, "left_anti"), right.join(got, id_b, "left_anti")
    rest_a = left.select(id_a, F.lit(None).cast(b.schema[id_b].dataType).alias(id_b), F.lit("unmatched").alias("method"))
    rest_b = right.select(F.lit(None).cast(a.schema[id_a].dataType).alias(id_a), id_b, F.lit("unmatched").alias("method"))
    return done.unionByName(rest_a).unionByName(rest_b)


def agrees(a: Column, b: Column, tolerance: float = 0.05, floor: float = 5e-4) -> Column:
    """Whether two reactances agree within a share of the larger; small ones count as ``floor``."""
    x, y = F.greatest(F.abs(a), F.lit(floor)), F.greatest(F.abs(b), F.lit(floor))
    return F.abs(x - y) <= tolerance * F.greatest(x, y)
