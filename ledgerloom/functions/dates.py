"""Date parsing and calendar columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Shapes of the accepted layouts YYYY-MM-DD, YYYY/MM/DD and MM/DD/YYYY.
ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}$"
SLASHED_SHAPE = r"^\d{4}/\d{2}/\d{2}$"
MONTH_FIRST_SHAPE = r"^\d{2}/\d{2}/\d{4}$"
# What a plain cast may get: a four-digit year, month and day, and possibly a time of day.
PLAIN_SHAPE = r"^\s*\d{4}-\d{1,2}-\d{1,2}([T ].*)?$"


def tolerant_date(value: Column) -> Column:
    """Any of the three layouts, else a plain cast; NULL if none fits.

    Years have four digits and start at 1, so no text becomes a far-off day.

    A text is brought into ISO shape and cast once: parsing by pattern raises
    and catches an error inside Spark for every text that is in another layout.
    No text has two of the shapes; the usual one is asked for first.
    """
    month_first = F.concat_ws(
        "-", F.substring(value, 7, 4), F.substring(value, 1, 2), F.substring(value, 4, 2)
    )
    iso = (
        F.when(value.rlike(PLAIN_SHAPE), value)
        .when(value.rlike(SLASHED_SHAPE), F.translate(value, "/", "-"))
        .when(value.rlike(MONTH_FIRST_SHAPE), month_first)
    )
    day = iso.try_cast("date")
    return F.when(day >= F.lit("0001-01-01").cast("date"), day)


def strict_date(value: Column) -> Column:
    """ISO date; a text that is none fails the query (ANSI mode)."""
    return F.to_date(value, "yyyy-MM-dd")


def iso_date_or_null(value: Column) -> Column:
    """ISO date; NULL for any other text."""
    return F.when(value.rlike(ISO_SHAPE), value.try_cast("date"))


def calendar_columns(day: Column) -> list[Column]:
    """The columns of a date dimension for ``day``."""
    return [
        day.alias("date_key"),
        F.year(day).alias("year"),
        F.lpad(F.month(day).cast("string"), 2, "0").alias("month_num"),
        F.monthname(day).alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        F.date_format(day, "yyyy-MM-dd").alias("date_iso"),
    ]
