import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltframe.functions import clock


def one(spark, column):
    return spark.range(1).select(column.cast("timestamp_ntz")).first()[0]


@pytest.mark.parametrize(
    ("day", "hour", "utc"),
    [("2026-09-30", 1, (2026, 9, 30, 5)), ("2026-11-01", 3, (2026, 11, 1, 7)), ("2026-11-01", 25, (2026, 11, 2, 5)), ("2026-03-08", 3, (2026, 3, 8, 8))],
)
def test_study_hour(spark, day, hour, utc):
    assert one(spark, clock.study_hour_start(F.lit(day).cast("date"), F.lit(hour))) == dt.datetime(*utc)


@pytest.mark.parametrize(
    ("day", "ending", "flag", "utc"),
    [("2026-11-01", "01:00", "N", 5), ("2026-11-01", "02:00", "N", 6), ("2026-11-01", "02:00", "Y", 7), ("2026-11-01", "03:00", "N", 8), ("2026-03-08", "02:00", "N", 7)],
)
def test_hour_ending(spark, day, ending, flag, utc):
    assert one(spark, clock.hour_ending_start(F.lit(day).cast("date"), F.lit(ending), F.lit(flag))).hour == utc


def test_skipped_hour_is_an_error(spark):
    with pytest.raises(Exception, match="no such local time"):
        one(spark, clock.hour_ending_start(F.lit("2026-03-08").cast("date"), F.lit("03:00")))


def test_block_hours(spark):
    got = {r["month"].month: tuple(r)[1:] for r in clock.block_hours(clock.months_of(spark, "2026-03-01", "2026-11-01")).collect()}
    assert got[11] == (320, 160, 240) and got[3] == (352, 144, 248)


def test_holidays_move_from_sunday(spark):
    days = spark.sql("select explode(sequence(date '2023-01-01', date '2023-12-31')) d").where(clock.is_holiday(F.col("d")))
    assert [str(r[0]) for r in days.orderBy("d").collect()] == ["2023-01-02", "2023-05-29", "2023-07-04", "2023-09-04", "2023-11-23", "2023-12-25"]
