"""Equal-frequency tiers and shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.operators.quantiles import exact_quantiles

TIERS = ("Low", "Medium", "High")


def tercile_segments(df: DataFrame, measure: str, bracketed: bool = True) -> DataFrame:
    """Add ``segment`` and ``segment_rank`` by the terciles of ``measure``.

    Bins are closed on the right, the lowest value included; equal edges are an
    error. Rows without a measure get no segment.
    """
    quarts = exact_quantiles(df, measure, [0.0, 1 / 3, 2 / 3, 1.0], bracketed)
    value = F.col(measure).cast("double")
    if None in quarts:
        return df.withColumn("segment", F.lit(None).cast("string")).withColumn(
            "segment_rank", F.lit(None).cast("int")
        )
    edges = [q.value for q in quarts]
    if len(set(edges)) < len(edges):
        raise ValueError(f"tercile edges of {measure} are not distinct: {edges}")
    rank = F.when(value <= edges[1], 1).when(value <= edges[2], 2).when(value.isNotNull(), 3)
    name = F.when(rank == 1, TIERS[0]).when(rank == 2, TIERS[1]).when(rank == 3, TIERS[2])
    return df.withColumn("segment", name).withColumn("segment_rank", rank)


def segment_totals(segmented: DataFrame, measure: str) -> DataFrame:
    """Rows and summed measure per segment."""
    return segmented.groupBy("segment", "segment_rank").agg(
        F.count("*").alias("members"), F.sum(measure).alias("total_revenue")
    )


def with_share(grouped: DataFrame, measure: str, name: str = "share") -> DataFrame:
    """Add each group's part of the whole; ``grouped`` has one row per group, few in all."""
    whole = F.sum(measure).over(Window.partitionBy()).cast("double")
    return grouped.withColumn(name, F.try_divide(F.col(measure).cast("double"), whole))
