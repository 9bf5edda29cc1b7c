"""Calendar spines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def date_spine(spark: SparkSession, start, end, out: str = "day") -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(1).select(F.explode(days_between(start, end)).alias(out))


def days_between(start, end) -> Column:
    """Array of the days from start to end; dates, ISO text or columns."""
    return F.sequence(_date(start), _date(end), F.expr("interval 1 day"))


def with_days(df: DataFrame, start, end, out: str = "day") -> DataFrame:
    """Every row once per day. The days are generated inside the row, so nothing is joined."""
    return df.withColumn(out, F.explode(days_between(start, end)))


def month_spine(spark: SparkSession, year: int, out: str = "month") -> DataFrame:
    """The twelve months of a year as ``yyyy-MM``."""
    months = F.sequence(_date(f"{year}-01-01"), _date(f"{year}-12-01"), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias("__d")).select(F.date_format("__d", "yyyy-MM").alias(out))


def _date(value) -> Column:
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")
