"""Outliers by z-score, and their replacement by the median."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.operators.quantiles import exact_quantiles

# Halving a double 1,074 times leaves nothing, so only that many replaced rows
# can shift the median of those after them.
MEDIAN_STEPS = 1_074


def zscore_flags(
    df: DataFrame,
    columns: list[str],
    threshold: float = 3.0,
    null_policy: str = "propagate",
) -> dict[str, Column]:
    """Per column the condition ``|z| > threshold``, with the population deviation.

    Under ``propagate`` a single missing value leaves the column without flags;
    ``omit`` leaves missing values out. The statistics of all columns come from
    one aggregate, read as a scalar subquery.
    """
    if null_policy not in ("propagate", "omit"):
        raise ValueError(f"unknown null_policy: {null_policy}")
    parts = []
    for c in columns:
        value = F.col(c).cast("double")
        known = F.when(~F.isnan(value), value)
        parts += [
            F.avg(known).alias(f"{c}_mean"),
            F.stddev_pop(known).alias(f"{c}_dev"),
            F.count_if(known.isNull()).alias(f"{c}_gaps"),
        ]
    stats = df.agg(F.struct(*parts).alias("stats")).scalar()
    flags = {}
    for c in columns:
        value = F.col(c).cast("double")
        usable = (stats[f"{c}_dev"] > 0) & value.isNotNull() & ~F.isnan(value)
        if null_policy == "propagate":
            usable = usable & (stats[f"{c}_gaps"] == 0)
        far = F.abs(value - stats[f"{c}_mean"]) > threshold * stats[f"{c}_dev"]
        flags[c] = F.coalesce(usable & far, F.lit(False))
    return flags


def impute_with_median(df: DataFrame, column: str, flag: str, order_by: list[str]) -> DataFrame:
    """Replace flagged values by the median, taken anew after each replacement.

    Rows are visited in the order of ``order_by``, which has to tell the
    flagged rows apart. The column becomes a double.

    With the middle values a and b of the column and w = b - a, the j-th
    flagged row gets a + w/2^j + the sum of w/2^i over the earlier flagged rows
    i that lay below the middle. So when a = b, or the row count is odd, the
    fill is the plain median. Otherwise only the first rows differ: they come
    from a top-k, and the rest share one value.
    """
    middle = exact_quantiles(df, column, [0.5])[0]
    value = F.col(column).cast("double")
    if middle is None:
        return df.withColumn(column, value)
    if middle.low == middle.high or middle.part == 0.0:
        return df.withColumn(column, F.when(F.col(flag), F.lit(middle.low)).otherwise(value))

    width = middle.high - middle.low
    ordered = Window.orderBy(*order_by)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    step = F.lit(width) / F.pow(F.lit(2.0), F.col("_j"))
    lifted = F.when(F.col("_v") <= middle.low, step).otherwise(0.0)
    head = (
        df.where(F.col(flag))
        .select(*order_by, value.alias("_v"))
        .orderBy(*order_by)
        .limit(MEDIAN_STEPS)
        .withColumn("_j", F.row_number().over(ordered))
        .withColumn("_lift", lifted)
        .withColumn("_before", F.sum("_lift").over(earlier))
        .withColumn("_fill", middle.low + step + F.coalesce(F.col("_before"), F.lit(0.0)))
    )
    last = head.agg(middle.low + F.sum("_lift")).scalar()
    # At most MEDIAN_STEPS rows, whatever the size of the table.
    fills = head.groupBy(*order_by).agg(F.min_by("_fill", "_j").alias("_fill"))
    renamed = fills.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(order_by)], F.col("_fill")
    )
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(order_by)]
    joined = df.join(
        F.broadcast(renamed), functools.reduce(lambda a, b: a & b, same, F.col(flag)), "left"
    )
    filled = F.when(F.col(flag), F.coalesce(F.col("_fill"), last)).otherwise(value)
    return joined.withColumn(column, filled).select(*df.columns)
