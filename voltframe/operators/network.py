"""Pieces of network assembly: limits, outage sets, signed members, dense indexes, the slack bus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NO_LIMIT = float("inf")


def limits(ratings: DataFrame) -> DataFrame:
    """limit_mw and contingency_mw of rows with is_secured, base_mw, emergency_mw; infinite where nothing limits."""
    limited = F.coalesce(F.col("is_secured") & (F.col("base_mw") > 0), F.lit(False))
    emergency = F.when(F.col("emergency_mw") > 0, F.col("emergency_mw")).otherwise(F.col("base_mw"))
    return ratings.withColumns({"limit_mw": F.when(limited, F.col("base_mw")).otherwise(NO_LIMIT), "contingency_mw": F.when(limited, emergency).otherwise(NO_LIMIT)})


def outage_sets(outages: DataFrame, by: list[str], branch: str) -> DataFrame:
    """Branches that each contingency takes out (sorted texts joined by ``|``; null if none), and counts of the rest."""
    inside = F.collect_set(F.when(~F.col("is_dropped"), F.col(branch).cast("string")))
    df = outages.groupBy(*by).agg(F.array_sort(inside).alias("s"), F.count_if("is_dropped").alias("n_dropped"), F.count_if("is_unresolved").alias("n_unresolved"), (F.count_if(~F.col("is_dropped")) == 0).alias("is_empty"))
    return df.select(*by, F.when(F.size("s") > 0, F.array_join("s", "|")).alias("branches"), "n_dropped", "n_unresolved", "is_empty")


def signed_factor(factor: Column, direction: Column, is_reversed: Column) -> Column:
    """A member's factor in its branch's own direction."""
    return factor * F.when(F.upper(direction).startswith("TO"), -1).otherwise(1) * F.when(is_reversed, -1).otherwise(1)


def dense_index(df: DataFrame, by: str, ident: str, name: str) -> DataFrame:
    """Numbers from 0 in the order of ``ident`` within each snapshot."""
    return df.withColumn(name, (F.row_number().over(Window.partitionBy(by).orderBy(ident)) - 1).cast("long"))


def slack(buses: DataFrame, degrees: DataFrame, by: str, bus: str) -> DataFrame:
    """by, slack, is_fallback: the busiest swing bus (type 3), else the busiest bus; ties to higher kv, then smaller id."""
    df = buses.join(degrees, [by, bus], "left").fillna(0, ["degree"])
    order = Window.partitionBy(by).orderBy((F.col("bus_type") == 3).desc(), F.col("degree").desc(), F.col("kv").desc_nulls_last(), bus)
    return df.withColumn("__n", F.row_number().over(order)).where("__n = 1").select(by, F.col(bus).alias("slack"), (F.coalesce("bus_type", F.lit(0)) != 3).alias("is_fallback"))
