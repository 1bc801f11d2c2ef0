"""Keys of buses that survive renumbering."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import digest


def with_keys(df: DataFrame, label: str, number: str) -> DataFrame:
    """``bus_key``: digest of the label; rows of one label get an ordinal by number and ``is_ambiguous``."""
    df = df.withColumn("__key", digest(F.col(label)))
    same = Window.partitionBy("__key")
    df = df.withColumns({"__n": F.count("*").over(same), "__i": F.row_number().over(same.orderBy(number))})
    key = F.when(F.col("__n") > 1, F.concat_ws("#", "__key", F.col("__i").cast("string"))).otherwise(F.col("__key"))
    return df.withColumns({"bus_key": key, "is_ambiguous": F.col("__n") > 1}).drop("__key", "__n", "__i")


def attachments(parts: list[tuple[DataFrame, str, str, str]]) -> DataFrame:
    """number, label (``K:NAME``) of everything attached to a bus: (frame, kind letter, number column, name column)."""
    out = None
    for df, kind, number, name in parts:
        some = df.select(F.col(number).alias("number"), F.concat(F.lit(f"{kind}:"), F.upper(F.trim(name))).alias("label")).dropna()
        out = some if out is None else out.unionByName(some)
    return out.distinct()


def bus_labels(buses: DataFrame, attached: DataFrame, number: str, name: str, kv: str) -> DataFrame:
    """Adds attachments (sorted, joined by ``|``), n_attachments, and the label that keys digest."""
    sets = attached.groupBy("number").agg(F.array_sort(F.collect_set("label")).alias("__l"))
    df = buses.join(sets, F.col(number) == F.col("number"), "left").withColumn("__l", F.coalesce("__l", F.array().cast("array<string>")))
    df = df.withColumns({"attachments": F.array_join("__l", "|"), "n_attachments": F.size("__l")})
    return df.withColumn("label", F.concat_ws("|", name, F.col(kv).cast("string"), "attachments")).drop("__l", *({"number"} - {number}))
