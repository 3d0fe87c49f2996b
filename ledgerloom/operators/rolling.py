"""Rolling statistics over an ordered series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

from ledgerloom.functions.dates import tolerant_date
from ledgerloom.functions.labels import deviation_status


def daily_totals(df: DataFrame, day: str, amount: str, tolerant: bool = False) -> DataFrame:
    """Sum per calendar day; rows without a day form one more group.

    A text that is no date fails the query, or counts as no day if ``tolerant``.
    """
    is_text = df.schema[day].dataType == T.StringType()
    value = tolerant_date(F.col(day)) if tolerant and is_text else F.col(day).cast("date")
    return df.groupBy(value.alias("order_day")).agg(
        F.sum(amount).alias("daily_revenue")
    )


def rolling_anomalies(days: DataFrame, rows: int = 7, sigmas: float = 2.0) -> DataFrame:
    """Mean and sample deviation of the last ``rows`` days, and a status.

    ``days`` has one row per calendar day, so one ordered partition holds it at
    any data size. The frame counts rows, not dates, and includes its own row.
    """
    frame = Window.orderBy(F.col("order_day").asc_nulls_last()).rowsBetween(1 - rows, 0)
    value = F.col("daily_revenue").cast("double")
    return days.select(
        "order_day",
        "daily_revenue",
        F.avg(value).over(frame).alias("rolling_avg_7d"),
        F.stddev_samp(value).over(frame).alias("rolling_std_7d"),
    ).withColumn(
        "status",
        deviation_status(value, F.col("rolling_avg_7d"), F.col("rolling_std_7d"), sigmas),
    )
