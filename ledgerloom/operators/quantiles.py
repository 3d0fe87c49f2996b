"""Exact quantiles without a sort of the whole column."""

from __future__ import annotations

import math
import struct
import sys
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerloom.session import stored


#: A pass tells apart so many cells of each range it looks at.
CELLS = 1 << 16


class Middle(NamedTuple):
    """Order statistics around a quantile, with the place between them."""

    low: float
    high: float
    part: float
    rows: int

    @property
    def value(self) -> float:
        return self.low + (self.high - self.low) * self.part


def exact_quantiles(
    df: DataFrame, column: str, probabilities: list[float], bracketed: bool = True
) -> list[Middle | None]:
    """Exact interpolated quantiles of the non-null values, as plain numbers.

    Runs jobs at once, as ``approxQuantile`` does; give it a stored table
    rather than a long plan. ``bracketed=False`` orders all distinct values in one
    task: one job, for input that is known to be small. Otherwise the ranks are
    found digit by digit: a double's bits, read as a number that grows with it,
    have four digits of 16 bits. Each of at most four passes counts the rows by their
    next digit within the ranges that the digits so far leave, combined before the
    shuffle; so no task orders more than 65,536 counts for each rank, however the
    values lie and however many there are. None stands for an empty column.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where(
        F.col("v").isNotNull() & ~F.isnan("v")
    )
    if bracketed:
        return _by_digits(values, probabilities)
    return _by_one_order(values, probabilities)


def _running(values: DataFrame) -> DataFrame:
    """Distinct values with their row count and the running count up to them."""
    counted = values.groupBy("v").agg(F.count("*").alias("n"))
    ordered = Window.orderBy("v")
    return counted.withColumn(
        "upto", F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    )


def _at_rank(rank: Column) -> Column:
    return F.min(F.when(F.col("upto") > rank, F.col("v")))


def _place(rows: int, p: float) -> tuple[int, int, float]:
    """Ranks (from 0) on both sides of the quantile, and the part between them."""
    place = (rows - 1) * p
    low = math.floor(place)
    return low, min(low + 1, rows - 1), place - low


def _by_one_order(values: DataFrame, probabilities: list[float]) -> list[Middle | None]:
    ordered = _running(values).withColumn("rows", F.sum("n").over(Window.partitionBy()))
    picks = []
    for p in probabilities:
        low = F.floor((F.col("rows") - 1) * F.lit(p))
        picks += [_at_rank(low), _at_rank(F.least(low + 1, F.col("rows") - 1))]
    found = ordered.agg(F.max("rows"), *picks).first()
    rows = found[0]
    if not rows:
        return [None] * len(probabilities)
    return [
        Middle(found[1 + 2 * i], found[2 + 2 * i], _place(rows, p)[2], rows)
        for i, p in enumerate(probabilities)
    ]


def _with_bits(values: DataFrame) -> DataFrame:
    """(v, b): b is a long that orders as the doubles do, their bits, those of negative ones counted down from 0.

    Powers of two are exact, so is a division by one; the logarithm may be one
    off, which the quotient shows. Below the smallest normal number the distance
    to 0 counts steps of 2**-1074. One step to a projection, so that none is
    computed twice.
    """
    sized = values.select("v", F.abs("v").alias("a"))
    sized = sized.select("v", "a", F.greatest(F.least(F.floor(F.log2("a")), F.lit(1023)), F.lit(-1022)).cast("double").alias("e"))
    sized = sized.select("v", "a", "e", (F.col("a") / F.pow(F.lit(2.0), F.col("e"))).alias("m"))
    off = F.when(F.col("m") < 1, -1).when(F.col("m") >= 2, 1).otherwise(0)
    sized = sized.select("v", "a", "e", "m", off.alias("off"))
    m = F.when(F.col("off") < 0, F.col("m") * 2).when(F.col("off") > 0, F.col("m") / 2).otherwise(F.col("m"))
    normal = (F.col("e").cast("long") + F.col("off") + 1023) * F.lit(1 << 52) + ((m - 1.0) * float(1 << 52)).cast("long")
    steps = (F.col("a") * float(2**537) * float(2**537)).cast("long")
    bits = F.when(F.col("a") == float("inf"), F.lit(0x7FF << 52)).when(F.col("a") < sys.float_info.min, steps).otherwise(normal)
    sized = sized.select("v", bits.alias("b"))
    return sized.select("v", F.when(F.col("v") < 0, -F.col("b")).otherwise(F.col("b")).alias("b"))


def _double(bits: int) -> float:
    """Inverse of :func:`_with_bits`."""
    value = struct.unpack(">d", struct.pack(">q", abs(bits)))[0]
    return -value if bits < 0 else value


def _small(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """A few rows of numbers as an inline table, to be broadcast."""
    values = ", ".join(f"({', '.join(f'{x}L' if x > -(1 << 63) else f'-{(1 << 63) - 1}L - 1L' for x in row)})" for row in rows)
    return F.broadcast(spark.sql(f"SELECT * FROM VALUES {values} AS t({names})"))


def _by_digits(values: DataFrame, probabilities: list[float]) -> list[Middle | None]:
    spark = values.sparkSession
    # The passes read this one narrow column, ranges by their bounds.
    keyed = stored(_with_bits(values).select("b"), "quantile-bits")
    rows = keyed.count()
    if not rows:
        return [None] * len(probabilities)
    # A wanted rank, where the range of bits [low, low + width) that holds it starts, and the rows below that.
    width, whole = 1 << 64, -(1 << 63)
    wanted = [(rank, whole, 0) for p in probabilities for rank in _place(rows, p)[:2]]
    inside = rows
    while width > 1:
        cells = keyed.withColumn("low", F.lit(whole))
        if width < 1 << 64:
            lows = sorted({low for _, low, _ in wanted})
            near = keyed.where(F.col("b").between(lows[0], lows[-1] + width - 1))
            few = _small(spark, [(low,) for low in lows], "low")
            cells = near.withColumn("of", F.col("b").bitwiseAND(F.lit(-width))).join(few, F.col("of") == F.col("low"))
        # No more rows than a pass has cells: all remaining digits at once.
        width = 1 if inside <= CELLS else width // CELLS
        counted = cells.groupBy("low", F.col("b").bitwiseAND(F.lit(-width)).alias("cell")).agg(F.count("*").alias("n"))
        order = Window.partitionBy("low").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
        running = counted.withColumn("upto", F.sum("n").over(order))
        asked = _small(spark, [(i, low, rank - below) for i, (rank, low, below) in enumerate(wanted)], "i, own, rank")
        holds = (F.col("low") == F.col("own")) & (F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("n") <= F.col("rank"))
        found = running.join(asked, holds).select("i", "cell", F.col("upto") - F.col("n"), "n").collect()
        for i, cell, under, _ in found:
            wanted[i] = (wanted[i][0], cell, wanted[i][2] + under)
        inside = sum({cell: n for _, cell, _, n in found}.values())
    ends = [_double(low) for _, low, _ in wanted]
    return [Middle(ends[2 * i], ends[2 * i + 1], _place(rows, p)[2], rows) for i, p in enumerate(probabilities)]
