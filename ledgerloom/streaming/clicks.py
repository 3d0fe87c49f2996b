"""Click streams: exactly-once rows, windows, sessions, alerts, enrichment.

Event times are wall-clock times in UTC, so the session zone has to be UTC.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerloom.operators.joins import lookup_join, missing_lookup

DELAY = "1 hour"
SESSION_GAP = "30 minutes"
SALTS = 64
MERGE_SESSIONS_EARLY = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def click_source(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Stream of the files that ``path`` (a folder or a glob) holds or will hold."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def parse_messages(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Click columns out of JSON messages as a Kafka source delivers them.

    Adds ``place``, the position of the message, for ``unique_clicks``.
    """
    position = [F.col(c).cast("string") for c in ("topic", "partition", "offset")]
    place = F.concat_ws("/", *position)
    body = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(body.alias("body"), place.alias("place")).select("body.*", "place")


def with_event_time(clicks: DataFrame, column: str, delay: str = DELAY) -> DataFrame:
    """``column`` as a timestamp with a bound on late rows; unreadable times are NULL."""
    return clicks.withColumn(column, F.col(column).try_cast("timestamp")).withWatermark(
        column, delay
    )


def unique_clicks(
    clicks: DataFrame, key: str = "click_id", place: str | None = None
) -> DataFrame:
    """Drop repeats of ``key`` that arrive within the late bound.

    ``place`` names a column that says where a row was read, such as a file
    position or an offset. With it the copies of a key are first thinned out in
    ``SALTS`` groups, so a key with very many copies does not load one task.
    """
    if place is None:
        return clicks.dropDuplicatesWithinWatermark([key])
    salt = F.pmod(F.xxhash64(place), F.lit(SALTS)).cast("int")
    thinned = clicks.withColumn("_salt", salt).dropDuplicatesWithinWatermark([key, "_salt"])
    return thinned.drop("_salt").dropDuplicatesWithinWatermark([key])


def windowed_counts(
    clicks: DataFrame, column: str, groups: list[str], width: str = "1 day"
) -> DataFrame:
    """Clicks per window and group; partial counts are made before the shuffle."""
    counted = clicks.groupBy(F.window(column, width), *groups).agg(F.count("*").alias("clicks"))
    return counted.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *groups,
        "clicks",
    )


def click_sessions(
    clicks: DataFrame, column: str, key: str, gap: str = SESSION_GAP
) -> DataFrame:
    """Clicks per session of a customer; a session ends ``gap`` after its last click."""
    counted = clicks.groupBy(F.session_window(column, gap), key).agg(
        F.count("*").alias("clicks")
    )
    return counted.select(
        key,
        F.col("session_window.start").alias("session_start"),
        F.col("session_window.end").alias("session_end"),
        "clicks",
    )


def drain_to_files(stream: DataFrame, target: str) -> DataFrame:
    """Run over all that has arrived and return the rows that are final.

    Windows that the late bound has not passed stay open and are not written.
    """
    spark = stream.sparkSession
    before = spark.conf.get(MERGE_SESSIONS_EARLY)
    # Sessions are built before the shuffle, so a hot customer travels as few rows.
    spark.conf.set(MERGE_SESSIONS_EARLY, "true")
    try:
        query = (
            stream.writeStream.outputMode("append")
            .format("parquet")
            .option("path", f"{target}/rows")
            .option("checkpointLocation", f"{target}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        spark.conf.set(MERGE_SESSIONS_EARLY, before)
    return spark.read.schema(stream.schema).parquet(f"{target}/rows")


def drain_batches(
    stream: DataFrame,
    target: str,
    handle: Callable[[DataFrame], DataFrame] | None = None,
    mode: str = "append",
    schema: T.StructType | str | None = None,
    partition_by: tuple[str, ...] = (),
) -> DataFrame:
    """Run over all that has arrived; each batch overwrites its own partition.

    ``handle`` turns a batch, a plain DataFrame, into the rows to store. A batch
    that is tried again replaces what its first try wrote. The result has the
    column ``batch_id``. ``partition_by`` names columns whose values become folders
    inside a batch's own.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = handle(batch) if handle else batch
        parts = rows.write.mode("overwrite").partitionBy(*partition_by)
        parts.parquet(f"{target}/rows/batch_id={batch_id}")

    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(store)
        .option("checkpointLocation", f"{target}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    shape = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema or stream.schema
    shape = T.StructType(shape.fields + [T.StructField("batch_id", T.LongType())])
    return stream.sparkSession.read.schema(shape).parquet(f"{target}/rows")


def latest_counts(updates: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """The last state of each window out of an update stream."""
    return updates.groupBy(*keys).agg(F.max_by(measure, "batch_id").alias(measure))


def enrich_batch(customers: DataFrame, key: str) -> Callable[[DataFrame], DataFrame]:
    """Batch handler that adds the customer columns to the clicks.

    Inside a batch the join is an ordinary one, so a hot customer's rows are split
    when the customer table is too large to broadcast.
    """
    return lambda batch: lookup_join(batch, customers, key, "left")


class Reference(NamedTuple):
    """Mean and population deviation of a measure over its stored history."""

    mean: float | None
    deviation: float | None


def reference_of(history: DataFrame, measure: str) -> Reference:
    return Reference(*history.agg(F.avg(measure), F.stddev_pop(measure)).first())


def alert_batch(
    customers: DataFrame,
    click_key: str,
    customer_key: str,
    measure: str,
    reference: Reference,
    threshold: float = 3.0,
) -> Callable[[DataFrame], DataFrame]:
    """Batch handler that lists unknown customers and outlying measures.

    A measure is held against the ``reference``, not against its own batch, so
    the alerts do not depend on how the stream is cut into batches.
    """
    far = F.abs(F.col(measure) - F.lit(reference.mean)) > F.lit(threshold) * F.lit(reference.deviation)

    def find(batch: DataFrame) -> DataFrame:
        outlying = batch.withColumn(f"outlier_{measure}", F.coalesce(far, F.lit(False)))
        flagged = missing_lookup(outlying, customers.select(customer_key), customer_key, "orphan")
        raised = F.array(
            F.when(F.col("orphan"), F.lit(f"orphan_{customer_key}")),
            F.when(F.col(f"outlier_{measure}"), F.lit(f"outlier_{measure}")),
        )
        return flagged.where(F.col("orphan") | F.col(f"outlier_{measure}")).select(
            click_key,
            customer_key,
            measure,
            F.explode(F.array_compact(raised)).alias("issue_type"),
        )

    return find
