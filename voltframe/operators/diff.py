"""Two models of one grid side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def side_by_side(a: DataFrame, b: DataFrame, key: str, n: str) -> DataFrame:
    """Counts of both sides by key; side is matched, a_only or b_only; keys that are null stay on their own side."""
    x, y = a.select(F.col(key).alias("__a"), F.col(n).alias("n_a")), b.select(F.col(key).alias("__b"), F.col(n).alias("n_b"))
    df = x.join(y, F.col("__a") == F.col("__b"), "full")
    side = F.when(F.col("n_b").isNull(), "a_only").when(F.col("n_a").isNull(), "b_only").otherwise("matched")
    zero = F.lit(0).cast("long")
    return df.select(F.coalesce("__a", "__b").alias(key), F.coalesce("n_a", zero).alias("n_a"), F.coalesce("n_b", zero).alias("n_b"), side.alias("side"), (F.coalesce("n_a", zero) == F.coalesce("n_b", zero)).alias("same_n"))
