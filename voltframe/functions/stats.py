"""Distribution summaries of reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import selection


def quantiles(df: DataFrame, value: str, by: list[str] | None = None, within: tuple[float, ...] = (), digits: int = 6, few: int = selection.FEW) -> DataFrame:
    """n, abs_p50, abs_p90, abs_p99, abs_max, median, and counts within tolerances; nulls don't count.

    A group of at most ``few`` values (or of a ten-thousandth of all) is sorted in a task; larger ones are selected from by ranges.
    """
    by, x = by or [], F.col(value)
    counts = [F.count(x).alias("n"), F.max(F.abs(x)).alias("abs_max"), *[F.count_if(F.abs(x) <= t).alias(f"within_{i}") for i, t in enumerate(within)]]
    sort = [F.percentile(F.abs(x), F.array(F.lit(0.5), F.lit(0.9), F.lit(0.99))).alias("p"), F.median(x).alias("median")]
    sizes, n_large = selection.large_groups(df, value, by, few)
    if not n_large:
        out = df.groupBy(*by).agg(*counts, *sort)
    else:
        groups = sizes.select(*[F.col(c).alias(f"__{c}") for c in by])
        same = selection._all([F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by])
        out = df.join(F.broadcast(groups), same, "left_anti").groupBy(*by).agg(*counts, *sort) if by else None
        far = df.join(F.broadcast(groups), same, "left_semi") if by else df
        sign = far.select(*by, x.cast("double").alias("__v"), F.abs(x).cast("double").alias("__a"))
        parts = far.groupBy(*by).agg(*counts)
        for column, probabilities, name in (("__a", [0.5, 0.9, 0.99], "p"), ("__v", [0.5], "median")):
            own = sign.groupBy(*by).agg(F.count(column).alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi"))
            found = selection.select(sign, column, by, own, probabilities, few).groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "quantile"))), lambda q: q["quantile"]).alias("q"))
            found = found.select(*[F.col(c).alias(f"__{c}") for c in by], (F.col("q") if name == "p" else F.col("q")[0]).alias(name))
            parts = parts.join(F.broadcast(found), same).drop(*[f"__{c}" for c in by])
        out = parts if out is None else out.unionByName(parts)
    named = [F.bround(F.col("p")[i], digits).alias(f"abs_{n}") for i, n in enumerate(("p50", "p90", "p99"))]
    return out.select(*by, "n", *named, *[F.bround(c, digits).alias(c) for c in ("abs_max", "median")], *[f"within_{i}" for i in range(len(within))])


def bin_of(x: Column, edges: list[float]) -> Column:
    """The upper edge of a value's bin: bins are closed below and open above, the last one closed; null outside."""
    out = F.when(x == edges[-1], F.lit(float(edges[-1])))
    for lo, hi in zip(edges, edges[1:], strict=False):
        out = out.when((x >= lo) & (x < hi), F.lit(float(hi)))
    return out


def histogram(df: DataFrame, value: str, edges: list[float]) -> DataFrame:
    return df.select(bin_of(F.col(value), edges).alias("upper_edge")).where("upper_edge is not null").groupBy("upper_edge").agg(F.count("*").alias("n"))


def spread(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg((F.max(value) - F.min(value)).alias("spread"))


def weighted_mean(value: Column, weight: Column) -> Column:
    return F.try_divide(F.sum(value * weight), F.sum(weight))
