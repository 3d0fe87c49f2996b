"""Row counts, missing and repeated keys, numeric profiles, defaults."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and row count."""
    counts = [
        df.agg(F.count("*").alias("total_rows")).select(
            F.lit(name).alias("table_name"), "total_rows"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def missing_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: for each column, how many rows lack it."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in columns])


def repeated_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys held by more than one row; keys with a NULL part are not tested."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    counts = df.where(known).groupBy(*columns).agg(F.count("*").alias("n_rows"))
    return counts.where(F.col("n_rows") > 1)


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows that lack ``column``."""
    return df.where(F.col(column).isNull())


def numeric_profile(
    df: DataFrame,
    columns: dict[str, str],
    distinct: dict[str, str] | None = None,
    approximate: bool = False,
) -> DataFrame:
    """One row with min, max and mean of each column, from one pass.

    The values of both maps name the outputs. ``distinct`` adds counts of
    distinct non-null values, which ``approximate`` takes from a sketch.
    """
    count = F.approx_count_distinct if approximate else F.count_distinct
    parts = [count(c).alias(name) for c, name in (distinct or {}).items()]
    for column, name in columns.items():
        parts += [
            F.min(column).alias(f"min_{name}"),
            F.max(column).alias(f"max_{name}"),
            F.avg(column).alias(f"avg_{name}"),
        ]
    return df.agg(F.count("*").alias("total_rows"), *parts)


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Put a default in place of NULL, per column."""
    return df.na.fill(defaults)
