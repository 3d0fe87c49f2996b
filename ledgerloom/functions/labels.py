"""Names, buckets, status labels and issue texts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def trimmed(*names: str) -> list[Column]:
    """Text columns without blanks at their ends."""
    return [F.trim(F.col(n)).alias(n) for n in names]


def full_name(first: str = "first_name", last: str = "last_name") -> Column:
    """First and last name; NULL if either is NULL."""
    return F.concat(F.col(first), F.lit(" "), F.col(last))


def price_bucket(price: Column) -> Column:
    """High from 100, Medium from 50, else Low (also without a price)."""
    return F.when(price >= 100, "High").when(price >= 50, "Medium").otherwise("Low")


def deviation_status(value: Column, mean: Column, deviation: Column, sigmas: float) -> Column:
    """ANOMALY beyond ``sigmas`` deviations; NORMAL also where that is unknown."""
    return F.when(F.abs(value - mean) > sigmas * deviation, "ANOMALY").otherwise("NORMAL")


# Wording of the issue log.
OUTLIER_TEXT = "Flagged Order ID: %s for unusual %s=%s. Suggestion: %s"
ORPHAN_TEXT = "Order ID: %s has invalid %s=%s. Suggestion: %s"
SUGGESTIONS = {
    "quantity": "Compare with average quantity across products.",
    "price": "Compare with average price across products.",
    "customer_id": "Check customer table or assign to 'Unknown Customer'.",
    "product_id": "Validate product mapping or assign to 'Unknown Product'.",
}


def issue(kind: str, order_id: Column, column: str) -> Column:
    """One issue as a struct; ``kind`` is ``outlier`` or ``orphan``."""
    template = OUTLIER_TEXT if kind == "outlier" else ORPHAN_TEXT
    bad = F.col(column).cast("string")
    shown = [F.coalesce(c.cast("string"), F.lit("None")) for c in (order_id, bad)]
    return F.struct(
        F.lit(f"{kind}_{column}").alias("issue_type"),
        order_id.cast("string").alias("order_id"),
        F.lit(column).alias("column_name"),
        bad.alias("bad_value"),
        F.lit(SUGGESTIONS[column]).alias("suggestion"),
        F.format_string(
            template, shown[0], F.lit(column), shown[1], F.lit(SUGGESTIONS[column])
        ).alias("issue_description"),
    )
