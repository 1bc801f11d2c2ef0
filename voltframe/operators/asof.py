"""As-of joins: for each row, the newest row of another frame at or before its instant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of one key and one stretch of time that meet in a task, about.
TOGETHER = 100_000


def newest_before(left: DataFrame, right: DataFrame, by: list[str], left_at: str, right_at: str, columns: list[str], tie: str | None = None, together: int = TOGETHER) -> DataFrame:
    """``left`` with ``columns`` of the row of ``right`` of equal key ``by`` that is the newest at or before ``left_at``; of equal instants the one of the largest ``tie``.

    Both frames go through one window, by key and stretch of time, in which the last posting is carried on; what a stretch begins
    with comes from one row for each stretch before it. A key with very many rows has so many stretches that none holds much
    more than ``together`` rows if they are spread evenly. Rows without a key or an instant get nulls; postings without one never count.
    """
    left_rows = left.select(F.struct(*left.columns).alias("__l"), *[F.col(c).alias(f"__k{i}") for i, c in enumerate(by)], F.col(left_at).cast("timestamp").alias("__at"), F.lit(1).alias("__side"))
    order = F.col(tie) if tie else F.lit(0)
    posted = right.where(F.col(right_at).isNotNull()).select(F.struct(*[F.col(c).alias(f"__c{i}") for i, c in enumerate(columns)]).alias("__r"), *[F.col(c).alias(f"__k{i}") for i, c in enumerate(by)], F.col(right_at).cast("timestamp").alias("__at"), F.lit(0).alias("__side"), order.alias("__tie"))
    keys = [f"__k{i}" for i in range(len(by))]
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    rows = left_rows.unionByName(posted.where(whole), allowMissingColumns=True)
    fits = whole & F.col("__at").isNotNull()
    micros = F.unix_micros("__at")
    # stretches as short as the fullest key needs; one number for the whole join
    most = rows.where(fits).groupBy(*keys).agg(F.count("*").alias("n"), (F.max(micros) - F.min(micros)).alias("span")).agg(F.max("n").alias("n"), F.max("span").alias("span")).first()
    width = max(1, (most["span"] or 0) // max(1, -(-(most["n"] or 1) // together)) + 1)
    rows = rows.withColumn("__stretch", F.floor(micros / F.lit(width)).cast("bigint"))
    w = Window.partitionBy(*keys, "__stretch").orderBy("__at", "__side", "__tie").rowsBetween(Window.unboundedPreceding, 0)
    known = rows.where(fits).withColumn("__last", F.last("__r", ignorenulls=True).over(w))
    ends = rows.where(fits).groupBy(*keys, "__stretch").agg(F.max_by("__r", F.when(F.col("__side") == 0, F.struct("__at", "__tie"))).alias("__end"))
    before = Window.partitionBy(*keys).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("__before", F.last("__end", ignorenulls=True).over(before)).where("__before is not null").select(*keys, "__stretch", "__before")
    found = known.where("__side = 1").join(carried, [*keys, "__stretch"], "left").select("__l", F.coalesce("__last", "__before").alias("__r"))
    rest = rows.where(~fits & (F.col("__side") == 1)).select("__l", F.lit(None).cast(found.schema["__r"].dataType).alias("__r"))
    return found.unionByName(rest).select("__l.*", *[_named(F.col("__r")[f"__c{i}"], c, left.columns) for i, c in enumerate(columns)])


def _named(value: Column, name: str, taken: list[str]) -> Column:
    if name.lower() in {c.lower() for c in taken}:
        raise ValueError(f"both frames have a column {name!r}")
    return value.alias(name)
