"""Quality run over a fact table: flag, log, repair."""

from __future__ import annotations

from decimal import ROUND_HALF_EVEN, Decimal
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F, types as T

from ledgerloom.functions.labels import issue
from ledgerloom.operators.joins import missing_lookup
from ledgerloom.operators.outliers import impute_with_median, zscore_flags
from ledgerloom.operators.quantiles import exact_quantiles
from ledgerloom.session import stored

UNKNOWN_KEY = "-1"  # fixed value: placeholder of an orphan key
MEASURES = ("quantity", "price")


def flag_outliers(
    fact: DataFrame, columns: list[str], threshold: float = 3.0, null_policy: str = "propagate"
) -> DataFrame:
    """Add ``outlier_<column>`` for each column."""
    flags = zscore_flags(fact, columns, threshold, null_policy)
    return fact.withColumns({f"outlier_{c}": flag for c, flag in flags.items()})


def flag_fact(
    fact: DataFrame, customers: DataFrame, products: DataFrame, null_policy: str = "propagate"
) -> DataFrame:
    """Add the four flags of the quality run to each row."""
    flagged = flag_outliers(fact, list(MEASURES), null_policy=null_policy)
    flagged = missing_lookup(flagged, customers, "customer_id", "orphan_customer_id")
    return missing_lookup(flagged, products, "product_id", "orphan_product_id")


def issue_log(flagged: DataFrame, run_id: str) -> DataFrame:
    """One row per raised flag, from one pass; most rows have none and leave early."""
    kinds = [("outlier", c) for c in MEASURES]
    kinds += [("orphan", c) for c in ("customer_id", "product_id")]
    any_flag = reduce(lambda a, b: a | b, [F.col(f"{kind}_{c}") for kind, c in kinds])
    raised = F.array(
        *[F.when(F.col(f"{kind}_{c}"), issue(kind, F.col("order_id"), c)) for kind, c in kinds]
    )
    return (
        flagged.where(any_flag)
        .select(F.explode(F.array_compact(raised)).alias("i"))
        .select(F.lit(run_id).alias("run_id"), "i.*")
    )


def clean_fact(flagged: DataFrame, order_by: list[str]) -> DataFrame:
    """Outliers replaced by the median, orphan keys by the placeholder."""
    cleaned = flagged
    for c in MEASURES:
        cleaned = impute_with_median(cleaned, c, f"outlier_{c}", order_by)
    for c in ("customer_id", "product_id"):
        cleaned = cleaned.withColumn(
            c, F.when(F.col(f"orphan_{c}"), UNKNOWN_KEY).otherwise(F.col(c))
        )
    return cleaned.drop(
        *[f"outlier_{c}" for c in MEASURES], "orphan_customer_id", "orphan_product_id"
    )


class QualityRun(NamedTuple):
    clean: DataFrame
    issues: DataFrame


def run_quality(
    fact: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    run_id: str,
    order_by: list[str] | None = None,
    null_policy: str = "propagate",
) -> QualityRun:
    """Cleaned fact and issue log; both read the flagged rows, stored once."""
    flagged = stored(flag_fact(fact, customers, products, null_policy), "flagged")
    return QualityRun(
        clean_fact(flagged, order_by or ["order_id"]), issue_log(flagged, run_id)
    )


def high_value_orders(fact: DataFrame, share: float = 0.9) -> DataFrame:
    """Orders above the given quantile of the order amount.

    The limit is found first and filters as a literal of the column's own type,
    so it reaches the scan. Decimals of up to 15 digits are exact.
    """
    limit = exact_quantiles(fact, "order_amount", [share])[0]
    if limit is None:
        return fact.where(F.lit(False))
    dtype = fact.schema["order_amount"].dataType
    # No value lies between the two order statistics around the quantile, so
    # "above the quantile" is "above the lower one", which is a value of the column.
    bound = limit.low
    if isinstance(dtype, T.DecimalType):
        bound = Decimal(bound).quantize(Decimal(1).scaleb(-dtype.scale), ROUND_HALF_EVEN)
    return fact.where(F.col("order_amount") > F.lit(bound).cast(dtype))
