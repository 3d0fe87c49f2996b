"""Joins of a large table with a lookup table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ledgerloom.session import stored

def lookup_join(
    fact: DataFrame, lookup: DataFrame, key: str, how: str = "left", shuffled: bool = False
) -> DataFrame:
    """Join ``fact`` with ``lookup`` on the column ``key`` of both.

    Spark broadcasts a lookup below its threshold. Beyond it both sides are
    shuffled once, and adaptive execution splits the partitions that a hot key
    or the NULL key makes large; ``shuffled`` asks for that way at any size.
    ``how`` is ``inner``, ``left`` or ``left_anti``.
    """
    return fact.join(lookup.hint("merge") if shuffled else lookup, key, how)


def missing_lookup(
    fact: DataFrame, lookup: DataFrame, key: str, flag: str, large: bool = False
) -> DataFrame:
    """Add ``flag``: true where ``key`` is NULL or not found in ``lookup``.

    The rows are joined with the known keys. With ``large``, meant for a lookup
    far beyond the broadcast threshold with few lost keys, the keys are taken
    from the distinct keys of ``fact`` instead; those not found are stored and
    joined back by their real size, so the rows are mostly not shuffled.
    """
    known = lookup.select(key).where(F.col(key).isNotNull()).distinct()
    if not large:
        marked = lookup_join(fact, known.withColumn("_known", F.lit(True)), key)
        return marked.withColumn(flag, F.col("_known").isNull()).drop("_known")
    seen = fact.select(key).where(F.col(key).isNotNull()).distinct()
    lost = stored(seen.join(known, key, "left_anti"), "lost-keys")
    marked = lookup_join(fact, lost.withColumn("_lost", F.lit(True)), key)
    return marked.withColumn(flag, F.col("_lost").isNotNull() | F.col(key).isNull()).drop("_lost")


def orphan_rows(fact: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Rows of ``fact`` whose key is NULL or not found in ``lookup``."""
    return lookup_join(fact, lookup.select(key).distinct(), key, "left_anti")


def orphan_count(fact: DataFrame, lookup: DataFrame, key: str, name: str) -> DataFrame:
    """One row: how many rows ``orphan_rows`` would give.

    Rows are counted per key before the join, so a hot key travels once.
    """
    per_key = fact.groupBy(key).agg(F.count("*").alias("_rows"))
    lost = per_key.join(lookup.select(key), key, "left_anti")
    return lost.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias(name))


def orphan_counts(fact: DataFrame, lookups: dict[str, DataFrame]) -> DataFrame:
    """One row per key column (missing, n): rows whose key is NULL or in no row of its lookup.

    One pass over the rows counts all keys at once, combined before the
    shuffle; then each distinct key meets its lookup once.
    """
    names = list(lookups)
    pairs = F.array(*[F.struct(F.lit(n).alias("missing"), F.col(n).cast("string").alias("key")) for n in names])
    per_key = (
        fact.select(F.explode(pairs).alias("p"))
        .groupBy("p.missing", "p.key")
        .agg(F.count("*").alias("rows"))
    )
    known = reduce(
        DataFrame.unionByName,
        [
            lookups[n].select(F.lit(n).alias("missing"), F.col(n).cast("string").alias("key")).where(F.col("key").isNotNull())
            for n in names
        ],
    ).distinct()
    known = known.withColumn("found", F.lit(True))
    return (
        per_key.join(known, ["missing", "key"], "left")
        .groupBy("missing")
        .agg(F.coalesce(F.sum(F.when(F.col("found").isNull(), F.col("rows"))), F.lit(0)).alias("n"))
    )
