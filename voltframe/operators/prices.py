"""Price identities: prices at points from shadow prices and shift factors, and prices of obligations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def node_prices(weights: DataFrame, factors: DataFrame, binding: DataFrame) -> DataFrame:
    """snapshot_id, point, price: system price less what each binding branch adds (sign * shadow price * weighted factor)."""
    shift = weights.join(factors, ["snapshot_id", "bus_index"]).groupBy("snapshot_id", "point", "branch_index").agg(F.sum(F.col("weight") * F.col("factor")).alias("factor"))
    rows = shift.join(binding, ["snapshot_id", "branch_index"])
    return rows.groupBy("snapshot_id", "point").agg((F.max("system_price") - F.sum(F.col("sign") * F.col("shadow_price") * F.col("factor"))).alias("price"))


def obligations(awards: DataFrame, prices: DataFrame) -> DataFrame:
    """price (sink less source) and the hour-weighted mean of both ends' prices."""
    s = prices.select(F.col("point").alias("source"), F.col("price").alias("ps"), F.col("hours").alias("hs"))
    k = prices.select(F.col("point").alias("sink"), F.col("price").alias("pk"), F.col("hours").alias("hk"))
    df = awards.join(s, "source", "left").join(k, "sink", "left")
    return df.withColumns({"price": F.col("pk") - F.col("ps"), "mean_price": F.try_divide(F.col("ps") * F.col("hs") + F.col("pk") * F.col("hk"), F.col("hs") + F.col("hk"))})
