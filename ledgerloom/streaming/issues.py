"""Alerts of a stream in the issue table that batch runs write to."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.sources.store import append_run

ALERT_TEXT = "Click ID: %s has %s %s=%s. Suggestion: %s"
ALERT_WORDS = {"outlier": "unusual", "orphan": "invalid"}
ALERT_SUGGESTIONS = {
    "outlier": "Compare with the stored history of this measure.",
    "orphan": "Check customer table or assign to 'Unknown Customer'.",
}


def alert_issues(alerts: DataFrame, click_key: str, customer_key: str, measure: str) -> DataFrame:
    """Rows of ``alert_batch`` in the columns of the issue log; the click stands where the order does."""

    def one(kind: str, column: str) -> Column:
        bad = F.col(column).cast("string")
        shown = [F.coalesce(c, F.lit("None")) for c in (F.col(click_key).cast("string"), bad)]
        text = F.format_string(
            ALERT_TEXT, shown[0], F.lit(ALERT_WORDS[kind]), F.lit(column), shown[1], F.lit(ALERT_SUGGESTIONS[kind])
        )
        return F.struct(
            F.col("issue_type"),
            F.col(click_key).cast("string").alias("order_id"),
            F.lit(column).alias("column_name"),
            bad.alias("bad_value"),
            F.lit(ALERT_SUGGESTIONS[kind]).alias("suggestion"),
            text.alias("issue_description"),
        )

    outlying = F.col("issue_type") == f"outlier_{measure}"
    row = F.when(outlying, one("outlier", measure)).otherwise(one("orphan", customer_key))
    return alerts.select(row.alias("i")).select("i.*")


def batch_run(name: str, batch_id: int) -> str:
    """The run under which a batch of the stream ``name`` stands in the table."""
    return f"{name}.{batch_id:012d}"


def drain_to_issues(
    stream: DataFrame,
    find: Callable[[DataFrame], DataFrame],
    database: str,
    name: str,
    checkpoint: str,
    table: str = "data_quality_issues",
) -> None:
    """Run over all that has arrived and append what ``find`` makes of each batch to the issue table.

    A batch is one run of the table, named by stream and batch id: after a crash
    between its write and the stream's own commit it is written again and takes
    the place of its first try. ``name`` tells streams that share the table apart.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        append_run(find(batch), database, table, batch_run(name, batch_id))

    query = (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
