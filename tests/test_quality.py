"""Z-scores, medians after each replacement, orphan keys, issue log."""

from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import outliers
from ledgerloom.operators.checks import missing_counts, null_rows, repeated_keys
from ledgerloom.operators.joins import missing_lookup, orphan_count, orphan_rows
from ledgerloom.operators.outliers import impute_with_median
from ledgerloom.plans.quality import flag_outliers, high_value_orders, run_quality


def numbers(spark, values):
    rows = [(i, None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id long, x double")


def flagged_ids(df, **options):
    return [r.id for r in flag_outliers(df, ["x"], **options).where("outlier_x").collect()]


def test_one_far_value_is_flagged(spark):
    assert flagged_ids(numbers(spark, [5.0] * 11 + [500.0])) == [11]


def test_ten_values_cannot_be_flagged(spark):
    assert flagged_ids(numbers(spark, [5.0] * 9 + [500.0])) == []


def test_gap_poisons_the_column_unless_omitted(spark):
    for gap in (None, float("nan")):
        df = numbers(spark, [5.0] * 20 + [500.0, gap])
        assert flagged_ids(df) == []
        assert flagged_ids(df, null_policy="omit") == [20]
    with pytest.raises(ValueError):
        flag_outliers(df, ["x"], null_policy="other")


def test_constant_column_has_no_outliers(spark):
    assert flagged_ids(numbers(spark, [0.1] * 30)) == []


def one_by_one(values):
    """The loop that the closed form replaces."""
    mean = statistics.fmean(values)
    dev = statistics.pstdev(values)
    out = list(values)
    if dev == 0:
        return out
    for i, v in enumerate(values):
        if abs(v - mean) / dev > 3:
            out[i] = statistics.median(out)
    return out


def imputed(df):
    flagged = flag_outliers(df, ["x"])
    rows = impute_with_median(flagged, "x", "outlier_x", ["id"]).select("id", "x").collect()
    return [r.x for r in sorted(rows)]


def test_even_count_with_gap_in_the_middle(spark):
    """Outliers above, below, above move the median of those after them."""
    values = [10.0 + i * 0.01 for i in range(19)] + [20.0 + i * 0.01 for i in range(18)]
    values[5:5] = [5000.0]
    values[15:15] = [-5000.0]
    values[30:30] = [5000.0]
    assert len(values) == 40
    got = imputed(numbers(spark, values))
    assert got == pytest.approx(one_by_one(values))
    a, b = sorted(values)[19:21]
    w = b - a
    assert [got[5], got[15], got[30]] == pytest.approx(
        [a + w / 2, a + w / 4, a + w / 4 + w / 8]
    )


@pytest.mark.parametrize("steps", [3, 1074])
def test_random_columns_match_the_loop(spark, monkeypatch, steps):
    """A shorter step limit shows that the rows past it share one value."""
    monkeypatch.setattr(outliers, "MEDIAN_STEPS", steps)
    rng = random.Random(7)
    for size in (60, 61, 200):
        values = [rng.choice([-1, 1]) * (10 + rng.random()) for _ in range(size)]
        for place in rng.sample(range(size), size // 40):
            values[place] = rng.choice([-1, 1]) * 900.0 * (1 + rng.random())
        assert imputed(numbers(spark, values)) == pytest.approx(
            one_by_one(values), abs=1e-9 if steps > 3 else 5.0
        )


def test_orphans_count_missing_keys_and_survive_null_in_dimension(spark):
    fact = spark.createDataFrame(
        [("1", "a"), ("2", "b"), ("3", None)], "order_id string, customer_id string"
    )
    dim = spark.createDataFrame([("a",), (None,), ("a",)], "customer_id string")
    assert sorted(r.order_id for r in orphan_rows(fact, dim, "customer_id").collect()) == ["2", "3"]
    assert orphan_count(fact, dim, "customer_id", "n").first().n == 2
    for large in (False, True):
        marked = missing_lookup(fact, dim, "customer_id", "lost", large)
        assert {r.order_id: r.lost for r in marked.collect()} == {"1": False, "2": True, "3": True}


def test_orphan_count_of_nothing_is_zero(spark):
    fact = spark.createDataFrame([("1", "a")], "order_id string, customer_id string")
    assert orphan_count(fact, fact, "customer_id", "n").first().n == 0


def test_quality_run(spark):
    rows = [(f"o{i:02d}", "c1", "p1", 2, 10.0) for i in range(20)]
    rows += [("o20", "c9", "p1", 2, 10.0), ("o21", None, "p1", 2, 10.0)]
    rows += [("o22", "c1", "p9", 400, 10.0), ("o23", "c1", "p1", 2, 9000.0)]
    fact = spark.createDataFrame(
        rows, "order_id string, customer_id string, product_id string, quantity int, price double"
    )
    customers = spark.createDataFrame([("c1",)], "customer_id string")
    products = spark.createDataFrame([("p1",)], "product_id string")
    clean, issues = run_quality(fact, customers, products, "r1")
    assert clean.count() == fact.count()
    done = {r.order_id: r for r in clean.collect()}
    assert done["o20"].customer_id == "-1" and done["o21"].customer_id == "-1"
    assert done["o22"].product_id == "-1" and done["o22"].quantity == 2.0
    assert done["o23"].price == 10.0
    assert dict(clean.dtypes)["customer_id"] == "string"
    texts = {r.issue_type: r.issue_description for r in issues.collect() if r.order_id != "o21"}
    assert texts == {
        "outlier_quantity": "Flagged Order ID: o22 for unusual quantity=400. "
        "Suggestion: Compare with average quantity across products.",
        "outlier_price": "Flagged Order ID: o23 for unusual price=9000.0. "
        "Suggestion: Compare with average price across products.",
        "orphan_customer_id": "Order ID: o20 has invalid customer_id=c9. "
        "Suggestion: Check customer table or assign to 'Unknown Customer'.",
        "orphan_product_id": "Order ID: o22 has invalid product_id=p9. "
        "Suggestion: Validate product mapping or assign to 'Unknown Product'.",
    }
    assert issues.count() == 5
    assert all(r.run_id == "r1" for r in issues.collect())


def test_key_tests_of_the_starter_models(spark):
    first = spark.createDataFrame([(1,), (None,)], "id int")
    second = first.where(F.col("id") == 1)
    assert null_rows(first, "id").count() == 1 and null_rows(second, "id").count() == 0
    assert repeated_keys(first, ["id"]).count() == 0
    assert repeated_keys(first.union(first), ["id"]).collect()[0].n_rows == 2
    assert missing_counts(first, ["id"]).first().missing_id == 1


def test_high_value_is_strict_and_drops_missing_amounts(spark):
    rows = [(str(i), float(i)) for i in range(1, 12)] + [("x", None)]
    df = spark.createDataFrame(rows, "order_id string, order_amount double")
    assert [r.order_id for r in high_value_orders(df).collect()] == ["11"]
    empty = df.where("order_id = 'x'")
    assert high_value_orders(empty).count() == 0
