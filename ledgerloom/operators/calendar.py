"""Day series."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F


def day_span(df: DataFrame, day: str, as_of: date) -> DataFrame:
    """One row: first and last day, or a year either side of ``as_of`` if there is none."""
    today = F.lit(as_of)
    return df.agg(
        F.coalesce(F.min(day), F.date_sub(today, 365)).alias("first_day"),
        F.coalesce(F.max(day), F.date_add(today, 365)).alias("last_day"),
    )


def day_series(span: DataFrame, max_days: int | None = None) -> DataFrame:
    """Every day of the span. A span of more than ``max_days`` is an error, never cut.

    Dates lie in the years 1 to 9999, so a span has 3.65 million days at most.
    """
    days = F.sequence("first_day", "last_day")
    if max_days is not None:
        too_long = F.raise_error(F.lit(f"the calendar spans more than {max_days} days"))
        length = F.date_diff("last_day", "first_day") + 1
        days = F.when(length > max_days, too_long.cast("array<date>")).otherwise(days)
    return span.select(F.explode(days).alias("d"))
