"""Market clock as column expressions: local hours to instants, and calendar blocks. The session's zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ZONE = "America/Chicago"


def study_hour_start(day: Column, hour: Column, zone: str = ZONE) -> Column:
    """Start of the n-th hour (from 1) of a local day of 23, 24 or 25 hours."""
    return F.to_utc_timestamp(day.cast("timestamp"), zone) + F.make_interval(hours=hour.cast("int") - 1)


def local_instant(local: Column, repeated: Column | None = None, zone: str = ZONE) -> Column:
    """The instant of a local time: the earlier one of a repeated hour, or where ``repeated`` holds the later one; a
    local time that the clock skips is an error."""
    first = F.to_utc_timestamp(local, zone)
    hour = F.make_interval(hours=F.lit(1))
    twice = F.from_utc_timestamp(first + hour, zone) == local
    later = F.coalesce(repeated, F.lit(False)) if repeated is not None else F.lit(False)
    gap = F.raise_error(F.concat(F.lit("no such local time: "), local.cast("string"))).cast("timestamp")
    return F.when(F.from_utc_timestamp(first, zone) != local, gap).when(later & twice, first + hour).otherwise(first)


def hour_ending_start(day: Column, hour_ending: Column, flag: Column | None = None, zone: str = ZONE) -> Column:
    """Start of the hour that ends at ``HH:00`` of a local day; a flag that begins with Y names the repeated hour."""
    local = day.cast("timestamp") + F.make_interval(hours=F.substring_index(hour_ending, ":", 1).cast("int") - 1)
    return local_instant(local, None if flag is None else F.upper(flag).startswith("Y"), zone)


def _nth_weekday(first_of_month: Column, weekday: str, n: int) -> Column:
    return F.date_add(F.next_day(F.date_sub(first_of_month, 1), weekday), 7 * (n - 1))


def is_holiday(day: Column) -> Column:
    """New Year, Memorial Day, Independence Day, Labor Day, Thanksgiving, Christmas; a Sunday's moves to Monday."""
    month, of_month, sunday_before = F.month(day), F.dayofmonth(day), F.dayofweek(day) == 2
    start = F.trunc(day, "month")

    def fixed(m: int, d: int) -> Column:
        return (month == m) & (((of_month == d) & (F.dayofweek(day) != 1)) | ((of_month == d + 1) & sunday_before))

    memorial = (month == 5) & (F.dayofweek(day) == 2) & (F.month(F.date_add(day, 7)) == 6)
    labor = (month == 9) & (day == _nth_weekday(start, "MON", 1))
    thanks = (month == 11) & (day == _nth_weekday(start, "THU", 4))
    return fixed(1, 1) | memorial | fixed(7, 4) | labor | thanks | fixed(12, 25)


def block_hours(months: DataFrame, month: str = "month") -> DataFrame:
    """month, peak_wd, peak_we, off_peak: sixteen peak hours on working days, on other days, and eight hours each day."""
    days = months.select(F.trunc(month, "month").alias("month")).distinct().withColumn("day", F.explode(F.sequence("month", F.last_day("month"))))
    work = (F.dayofweek("day").between(2, 6)) & ~is_holiday(F.col("day"))
    return days.groupBy("month").agg((16 * F.count_if(work)).alias("peak_wd"), (16 * F.count_if(~work)).alias("peak_we"), (8 * F.count("*")).alias("off_peak"))


def months_of(spark: SparkSession, first: str, last: str) -> DataFrame:
    return spark.sql(f"SELECT explode(sequence(DATE '{first}', DATE '{last}', INTERVAL 1 MONTH)) AS month")
