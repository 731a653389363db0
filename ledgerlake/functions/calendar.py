"""Czech working days as a calendar dimension with running counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Holidays on fixed dates.
FIXED_HOLIDAYS = ["01-01", "05-01", "05-08", "07-05", "07-06", "09-28", "10-28", "11-17", "12-24", "12-25", "12-26"]


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter by the usual computus in integer arithmetic."""
    div = lambda a, b: F.floor(a / b)
    golden, century = year % 19, div(year, 100)
    moon = (19 * golden + century - div(century, 4) - div(century - div(century + 8, 25) + 1, 3) + 15) % 30
    week = (32 + 2 * (century % 4) + 2 * div(year % 100, 4) - moon - (year % 100) % 4) % 7
    days = moon + week - 7 * div(golden + 11 * moon + 22 * week, 451) + 114
    return F.make_date(year, div(days, 31).cast("int"), (days % 31 + 1).cast("int"))


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """(day, working, n): n counts working days up to and with the day.  Its size is the span of years, whatever the data."""
    days = spark.sql(f"SELECT explode(sequence(date'{first}', date'{last}', interval 1 day)) AS day")
    easter = easter_sunday(F.year("day"))
    holiday = F.date_format("day", "MM-dd").isin(FIXED_HOLIDAYS) | (F.col("day") == F.date_sub(easter, 2)) | (F.col("day") == F.date_add(easter, 1))
    days = days.select("day", (~holiday & (F.weekday("day") < 5)).alias("working"))
    return days.withColumn("n", F.sum(F.col("working").cast("int")).over(W.orderBy("day")))


def working_days(df: DataFrame, cal: DataFrame, start: str, end: str, out: str) -> DataFrame:
    """Working days after ``start`` up to and with ``end``: a difference of two running counts."""
    a = F.broadcast(cal.select(F.col("day").alias(start), F.col("n").alias("__a")))
    b = F.broadcast(cal.select(F.col("day").alias(end), F.col("n").alias("__b")))
    return df.join(a, start, "left").join(b, end, "left").withColumn(out, F.greatest(F.col("__b") - F.col("__a"), F.lit(0))).drop("__a", "__b")


def month_back(day: Column) -> Column:
    """The same day one month before, or that month's last."""
    return F.add_months(day, -1)
