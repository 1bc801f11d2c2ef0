"""Exact quantiles of groups of any size, without gathering a group: counts in value ranges that get narrower until one fits a task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workers import shared

#: Values of a group that one task sorts; a group of more is selected from by ranges.
FEW = 1_000_000
#: Of all rows, groups that a range join broadcasts have at least one part in so many; so there are no more groups than this.
PARTS = 10_000
#: Ranges that a step cuts a range into.
CUTS = 4096


def large_groups(df: DataFrame, value: str, by: list[str], few: int) -> tuple[DataFrame, int]:
    """(by, n, lo, hi of the groups with more values than a task sorts, written; how many)."""
    total = df.agg(F.count(value)).first()[0]
    limit = max(few, total // PARTS)
    stats = df.groupBy(*by).agg(F.count(value).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")).where(F.col("n") > limit)
    stats = shared(stats)
    return stats, stats.count()


def select(df: DataFrame, value: str, by: list[str], groups: DataFrame, probabilities: list[float], few: int = FEW) -> DataFrame:
    """by, p, quantile of ``groups`` (by, n, lo, hi): linear between the two values that a probability lies between; nulls don't count.

    A step counts the values in each range's cuts, partially on the map side, and keeps the cuts that ranks fall in, down to their
    least and largest value. Ranges that hold ``few`` values or one value alone are done; the rest are cut again. NaN isn't expected.
    """
    place = [F.struct(F.lit(p).alias("p"), ((F.col("n") - 1) * F.lit(p)).alias("at")) for p in probabilities]
    wanted = groups.select(*by, "n", "lo", "hi", F.explode(F.array(*place)).alias("x")).select(*by, "lo", "hi", "x.p", F.floor("x.at").alias("low"), (F.col("x.at") - F.floor("x.at")).alias("part"), F.least(F.floor("x.at") + 1, F.col("n") - 1).alias("high"), "n")
    ranks = shared(wanted.select(*by, "lo", "hi", F.col("n").alias("held"), F.explode(F.array_distinct(F.array("low", "high"))).alias("rank")).distinct().withColumn("skip", F.lit(0).cast("bigint")))
    done = None
    rows = df.select(*by, F.col(value).alias("v")).where("v is not null")
    same = [F.col(f"g.`{c}`").eqNullSafe(F.col(f"r.`{c}`")) for c in by]
    while True:
        settled = (F.col("lo") == F.col("hi")) | (F.col("held") <= few)
        done = ranks.where(settled) if done is None else done.unionByName(ranks.where(settled))
        todo = ranks.where(~settled)
        if todo.isEmpty():
            break
        # at most PARTS groups, each with no more ranges than ranks
        ranges = todo.select(*by, "lo", "hi").distinct()
        met = rows.alias("r").join(F.broadcast(ranges).alias("g"), _all(same) & F.col("r.v").between(F.col("g.lo"), F.col("g.hi"))).select(*[F.col(f"g.`{c}`") for c in by], "g.lo", "g.hi", "r.v")
        cut = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * CUTS).cast("bigint"), F.lit(CUTS - 1))
        counts = met.groupBy(*by, "lo", "hi", cut.alias("cut")).agg(F.count("*").alias("held"), F.min("v").alias("least"), F.max("v").alias("most"))
        above = Window.partitionBy(*by, "lo", "hi").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("before", F.coalesce(F.sum("held").over(above), F.lit(0)))
        k = [F.col(f"t.`{c}`").eqNullSafe(F.col(f"c.`{c}`")) for c in [*by, "lo", "hi"]]
        inside = (F.col("t.rank") - F.col("t.skip") >= F.col("c.before")) & (F.col("t.rank") - F.col("t.skip") < F.col("c.before") + F.col("c.held"))
        ranks = shared(todo.alias("t").join(counts.alias("c"), _all(k) & inside).select(*[F.col(f"t.`{c}`") for c in by], F.col("c.least").alias("lo"), F.col("c.most").alias("hi"), F.col("c.held").alias("held"), "t.rank", (F.col("t.skip") + F.col("c.before")).alias("skip")))
        done = shared(done)
    # ranges of one value have it at every rank; in the others at most ``few`` values are numbered
    done = shared(done)
    single = done.where("lo = hi").select(*by, "rank", F.col("lo").alias("v"))
    ranges = done.where("lo <> hi").select(*by, "lo", "hi", "skip").distinct()
    near = rows.alias("r").join(F.broadcast(ranges).alias("g"), _all(same) & F.col("r.v").between(F.col("g.lo"), F.col("g.hi"))).select(*[F.col(f"g.`{c}`") for c in by], "g.lo", "g.hi", "g.skip", "r.v")
    numbered = near.withColumn("rank", F.row_number().over(Window.partitionBy(*by, "lo", "hi", "skip").orderBy("v")) - 1 + F.col("skip"))
    k = [F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`")) for c in [*by, "rank"]]
    small = numbered.alias("a").join(F.broadcast(done.where("lo <> hi").select(*by, "rank").distinct()).alias("b"), _all(k)).select(*[F.col(f"a.`{c}`") for c in by], "a.rank", "a.v")
    values = shared(single.unionByName(small.select(*by, F.col("rank").cast("bigint").alias("rank"), "v")).distinct())

    def at(name: str) -> DataFrame:
        return values.select(*[F.col(c).alias(f"__{c}") for c in by], F.col("rank").alias(name), F.col("v").alias(f"v_{name}"))

    out = wanted
    for name in ("low", "high"):
        some = at(name).alias("s")
        out = out.alias("w").join(F.broadcast(some), _all([F.col(f"w.`{c}`").eqNullSafe(F.col(f"s.`__{c}`")) for c in by] + [F.col(f"w.{name}") == F.col(f"s.{name}")])).select("w.*", f"s.v_{name}")
    return out.select(*by, "p", (F.col("v_low") + (F.col("v_high") - F.col("v_low")) * F.col("part")).alias("quantile"))


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out
