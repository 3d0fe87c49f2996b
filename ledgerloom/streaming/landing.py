"""Raw landing of click messages: accepted and rejected rows from one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ledgerloom.sources.csv_files import check_rows
from ledgerloom.sources.schemas import text_schema
from ledgerloom.streaming.clicks import drain_batches

OUTCOMES = ("accepted", "rejected")
_BROKEN = "_broken"


def checked_messages(
    messages: DataFrame,
    table: str = "raw_clicks",
    key: str = "click_id",
    times: tuple[str, ...] = ("click_timestamp",),
) -> DataFrame:
    """Columns of ``table`` out of JSON messages, with the place, day and outcome of each.

    ``messages`` has the columns of a Kafka source: value, topic, partition,
    offset, timestamp. Every message gives one row. ``reject_reason`` is NULL or
    the first fault: ``broken_message`` (no JSON object), ``missing:<key>``,
    ``bad_time:<column>`` (present but unreadable), then the faults that files of
    the table are checked for. Rejected rows keep the message as it came.
    """
    schema = T.StructType([*text_schema(table).fields, T.StructField(_BROKEN, T.StringType())])
    text = F.col("value").cast("string")
    body = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN})
    place = F.concat_ws("/", *[F.col(c).cast("string") for c in ("topic", "partition", "offset")])
    rows = messages.select(
        body.alias("body"),
        text.alias("message"),
        place.alias("place"),
        F.to_date("timestamp").alias("arrival_day"),
    )
    rows = rows.select("body.*", F.col("body").isNull().alias("_none"), "message", "place", "arrival_day")
    object_like = F.col("message").rlike(r"^\s*\{")
    broken = F.col("_none") | F.col(_BROKEN).isNotNull() | ~F.coalesce(object_like, F.lit(False))
    faults = [F.when(broken, F.lit("broken_message")), F.when(F.col(key).isNull(), F.lit(f"missing:{key}"))]
    for c in times:
        unread = F.col(c).isNotNull() & F.col(c).try_cast("timestamp").isNull()
        faults.append(F.when(unread, F.lit(f"bad_time:{c}")))
    checked = check_rows(rows, table)
    reason = F.coalesce(*faults, F.col("reject_reason"))
    checked = checked.withColumn("reject_reason", reason)
    bad = F.col("reject_reason").isNotNull()
    return checked.select(
        *[F.col(f.name) for f in text_schema(table)],
        "place",
        "reject_reason",
        F.when(bad, F.col("message")).alias("message"),
        F.when(bad, OUTCOMES[1]).otherwise(OUTCOMES[0]).alias("outcome"),
        "arrival_day",
    )


def land_messages(
    messages: DataFrame,
    target: str,
    table: str = "raw_clicks",
    key: str = "click_id",
    times: tuple[str, ...] = ("click_timestamp",),
) -> tuple[DataFrame, DataFrame]:
    """Write all that has arrived below ``target``; (accepted rows, rejected rows).

    Each batch is parsed once and written once, in folders by outcome and arrival
    day; a batch that is tried again replaces what its first try wrote. Readers
    of one outcome or day meet only the files of that outcome or day.
    """
    checked = checked_messages(messages, table, key, times)
    rows = drain_batches(checked, target, partition_by=("outcome", "arrival_day"))
    good = rows.where(F.col("outcome") == OUTCOMES[0]).drop("outcome", "reject_reason", "message")
    bad = rows.where(F.col("outcome") == OUTCOMES[1]).drop("outcome")
    return good, bad
