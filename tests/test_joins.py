"""The shuffled join gives what the broadcast one gives, and splits hot keys."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.joins import lookup_join, orphan_counts


def skewed(spark, rows=30_000):
    """A third of the rows on one key, a third without a key, the rest spread."""
    k = (
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string")))
    )
    return spark.range(rows).select("id", k.alias("k"))


def lookup(spark):
    keys = spark.range(0, 4000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"))
    twice = spark.createDataFrame([("hot",), ("hot",), (None,)], "k string")
    return keys.union(twice).withColumn("v", F.xxhash64("k"))


@pytest.mark.parametrize("how", ["left", "inner", "left_anti"])
def test_shuffled_equals_broadcast(spark, how):
    fact, dim = skewed(spark), lookup(spark)
    plain = lookup_join(fact, dim, "k", how)
    shuffled = lookup_join(fact, dim, "k", how, shuffled=True)
    assert "SortMergeJoin" in shuffled._jdf.queryExecution().toString()
    assert plain.columns == shuffled.columns
    assert plain.count() == shuffled.count()
    assert plain.exceptAll(shuffled).count() == 0


def test_equal_rows_of_a_hot_key_are_split(spark, tmp_path):
    """With thresholds of a test's size, one key's equal rows go to several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
    }
    keep = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        fact = spark.range(180_000).select(F.lit("hot").alias("k"), F.lit(1).alias("n"))
        fact = fact.unionByName(spark.range(2000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(1).alias("n")))
        joined = lookup_join(fact.repartition(16), lookup(spark), "k", "left", shuffled=True)
        marked = joined.select("k", F.spark_partition_id().alias("p"))
        marked.write.parquet(str(tmp_path / "joined"))
        counts = spark.read.parquet(str(tmp_path / "joined")).where("k = 'hot'").groupBy("p").count().collect()
    finally:
        for key, value in keep.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert sum(r["count"] for r in counts) == 360_000
    assert len(counts) > 3 and max(r["count"] for r in counts) < 200_000


def test_orphans_of_all_keys_in_one_pass(spark):
    fact = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("x", None)], "c string, p int")
    known = {"c": spark.createDataFrame([("a",), (None,)], "c string"), "p": spark.createDataFrame([(1,), (1,)], "p int")}
    assert {r.missing: r.n for r in orphan_counts(fact, known).collect()} == {"c": 2, "p": 3}


def test_copies_of_a_lookup_key_multiply_rows(spark):
    fact = spark.createDataFrame([("a", 1)], "k string, n int")
    dim = spark.createDataFrame([("a", "x"), ("a", "y")], "k string, v string")
    assert lookup_join(fact, dim, "k").count() == 2
