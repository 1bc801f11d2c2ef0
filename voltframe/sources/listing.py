"""Listings of published documents: typed rows, what was listed twice, how far back they go, and helpers of a fetch."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Sequence
from typing import TypeVar
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .archive import one_document

T = TypeVar("T")
MARKET = "America/Chicago"
# Fixed value: a published file's name begins with its report type's eight digits.
TYPE_IN_NAME = r"^rpt\.(\d{8})\."


def posted(text: Column) -> Column:
    """An instant from ISO text; text without a zone is market time, anything else null."""
    zoned = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    plain = F.try_to_timestamp(text).cast("timestamp_ntz")
    return F.when(zoned, F.try_to_timestamp(text)).otherwise(F.convert_timezone(F.lit(MARKET), F.lit("UTC"), plain).cast("timestamp"))


def documents(fields: DataFrame) -> DataFrame:
    """Typed rows of a listing's texts (URL, fileName, reportGroup, operatingDate, created, size, format, report_type_id)."""
    doc = F.nullif(F.regexp_extract("URL", r"[?&]doclookupId=([^&#]*)", 1), F.lit(""))
    size = F.coalesce(F.expr("try_cast(size as bigint)"), F.lit(0))
    names = {"fileName": "file_name", "reportGroup": "report_group", "operatingDate": "operating_date", "format": "format"}
    return fields.select("report_type_id", doc.alias("doc_id"), *[F.coalesce(F.col(a), F.lit("")).alias(b) for a, b in names.items()], posted(F.col("created")).alias("posted_at"), size.cast("long").alias("size_bytes"), F.nullif(F.col("URL"), F.lit("")).alias("url"))


def probed(unbounded: DataFrame, older: DataFrame) -> DataFrame:
    """Documents of two listings of one product, each once; without names and addresses, which may name a participant."""
    both = unbounded.unionByName(older).withColumnRenamed("file_name", "name")
    return one_document(both).drop("name", "url")


def summary(docs: DataFrame, cutoff: Column, by: str = "report_type_id") -> DataFrame:
    """by, n_docs, n_before (posted before the cutoff), first and last posting and operating date, bytes."""
    date = F.nullif(F.col("operating_date"), F.lit(""))
    return docs.groupBy(by).agg(
        F.count("*").alias("n_docs"), F.count_if(F.col("posted_at") < cutoff).alias("n_before"), F.min("posted_at").alias("earliest_posted"), F.max("posted_at").alias("latest_posted"),
        F.min(date).alias("earliest_date"), F.max(date).alias("latest_date"), F.sum("size_bytes").alias("total_bytes"),
    )


def groups(docs: DataFrame, by: str = "report_type_id") -> DataFrame:
    return docs.groupBy(by, "report_group").agg(F.count("*").alias("n"))


def product_of_name(name: Column) -> Column:
    """The report type that a file's name begins with, as a number; null if it doesn't."""
    return F.nullif(F.regexp_extract(name, TYPE_IN_NAME, 1), F.lit("")).cast("long")


def bound(value: dt.date | dt.datetime | str | None) -> dt.datetime | None:
    """A bound of posting times: a date is its midnight in market time, a time without a zone is market time."""
    if value is None:
        return None
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    return value if value.tzinfo else value.replace(tzinfo=ZoneInfo(MARKET))


def as_date(value: dt.date | str) -> dt.date:
    if isinstance(value, str):
        return dt.date.fromisoformat(value)
    return value.date() if isinstance(value, dt.datetime) else value


def planned(listed: DataFrame, archived: DataFrame, dates: Sequence[dt.date | str] | None = None) -> DataFrame:
    """Listed documents (each once) that aren't archived, of the operating dates given."""
    some = one_document(listed.withColumnRenamed("file_name", "name")).withColumnRenamed("name", "file_name")
    if dates is not None:
        some = some.where(F.to_date(F.substring("operating_date", 1, 10)).isin([as_date(d) for d in dates]))
    return some.join(archived.select("doc_id").where("doc_id is not null").distinct(), "doc_id", "left_anti")


class TooLarge(ValueError):
    """A fetch of more bytes than allowed."""


def within_limit(plan: DataFrame, most_bytes: int) -> DataFrame:
    total = plan.agg(F.sum("size_bytes")).first()[0] or 0
    if total > most_bytes:
        raise TooLarge(f"{total} bytes listed, {most_bytes} allowed")
    return plan


def retrying(call: Callable[[], T], transient: tuple[type[BaseException], ...], delays: Sequence[float] = (1.0, 4.0, 16.0), sleep: Callable[[float], None] = time.sleep) -> T:
    """What ``call`` returns; after a transient error it is tried again, once for each delay."""
    for delay in delays:
        try:
            return call()
        except transient:
            sleep(delay)
    return call()


def at_risk(listed: DataFrame, archived: DataFrame, now: Column, display_days: int, margin_days: int) -> DataFrame:
    """Documents not archived whose display ends within a margin of days, first to go first."""
    left = F.date_add(F.to_date("posted_at"), display_days)
    return planned(listed, archived).withColumn("display_ends", left).where(F.datediff("display_ends", now) <= margin_days).orderBy("display_ends", "doc_id")
