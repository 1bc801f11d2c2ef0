"""Tables of an archive: partitioned parquet that is written by whole partitions, merges by key, and what is still to build."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write(df: DataFrame, path: str, by: list[str], order: list[str] | None = None) -> None:
    """Replaces the partitions that the rows belong to and no others; a failed job leaves them as they were. With ``order``, a partition's rows are in
    that order, nulls last, so that the same rows give the same file."""
    rows = df.repartition(*by)
    if order:
        rows = rows.sortWithinPartitions(*by, *[F.col(c).asc_nulls_last() for c in order])
    writer = rows.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(path)


def scan(spark: SparkSession, path: str) -> DataFrame:
    """All packages of a table; columns that some of them lack are null there."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def merged(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows, with new ones in place of those of equal key (nulls are equal) and after them; of equal new ones the last by the other columns."""
    columns = old.columns
    rows = old.withColumn("__at", F.lit(0)).unionByName(new.withColumn("__at", F.lit(1)), allowMissingColumns=True)
    rest = [F.col(c).desc_nulls_last() for c in columns if c not in keys and old.schema[c].dataType.typeName() != "map"]
    order = Window.partitionBy(*keys).orderBy(F.col("__at").desc(), *rest)
    return rows.withColumn("__n", F.row_number().over(order)).where("__n = 1").select(columns)


def added(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows whose key (nulls are equal) no old row has, each key once."""
    some, known = new.dropDuplicates(keys).alias("n"), old.select(*keys).distinct().alias("o")
    cond = [F.col(f"n.`{k}`").eqNullSafe(F.col(f"o.`{k}`")) for k in keys]
    return some.join(known, cond, "left_anti")


def artifact_key(version: str, table: str) -> Column:
    """Digest of a parser's version, a package's bytes and a table's name."""
    return F.sha2(F.concat_ws("|", F.lit(version), "blob_sha256", F.lit(table)), 256)


def pending(packages: DataFrame, artifacts: DataFrame, version: str, table: str) -> DataFrame:
    """Packages that this version of a parser hasn't built this table of (packages without rows of it are artifacts as well)."""
    return packages.withColumn("artifact_key", artifact_key(version, table)).join(artifacts.select("artifact_key"), "artifact_key", "left_anti")


def one_document(docs: DataFrame) -> DataFrame:
    """Listed documents once each: by id, else address, else name and time; the earliest posting stays, without time last."""
    key = F.coalesce(F.concat(F.lit("i"), "doc_id"), F.concat(F.lit("u"), "url"), F.concat_ws("|", F.lit("n"), "name", F.col("posted_at").cast("string")))
    order = Window.partitionBy("__k").orderBy(F.col("posted_at").asc_nulls_last(), "name")
    return docs.withColumn("__k", key).withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__k", "__n")
