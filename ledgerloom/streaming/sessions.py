"""Sessions with their clicks in order: devices and the path of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.streaming.clicks import SESSION_GAP

#: A session of more clicks is an error: its path is one value, held by one task.
MAX_CLICKS = 1_000_000


def session_paths(
    clicks: DataFrame,
    column: str,
    key: str,
    click_key: str = "click_id",
    page: str = "page_url",
    device: str = "device_type",
    gap: str = SESSION_GAP,
    max_clicks: int = MAX_CLICKS,
) -> DataFrame:
    """One row per session of a ``key``: bounds, clicks, device, devices, path.

    Clicks are kept in the session's state as small structs and ordered when it
    ends: by time, then by ``click_key``. ``path`` holds the page of every click,
    NULL where one has none; ``devices`` the known devices by first use, and
    ``device`` the first of them. A session ends ``gap`` after its last click.
    Nothing is ever cut: a session of more than ``max_clicks`` fails the query.
    """
    step = F.struct(
        F.col(column).alias("at"),
        F.col(click_key).alias("click"),
        F.col(page).alias("page"),
        F.col(device).alias("device"),
    )
    grouped = clicks.groupBy(F.session_window(column, gap), key).agg(
        F.collect_list(step).alias("steps")
    )
    told = F.format_string(
        f"a session has %d clicks, more than max_clicks={max_clicks}", F.size("steps")
    )
    whole = F.when(F.size("steps") > max_clicks, F.raise_error(told).cast(grouped.schema["steps"].dataType))
    ordered = grouped.withColumn("steps", whole.otherwise(F.array_sort("steps")))
    used = F.transform("steps", lambda s: s["device"])
    devices = F.array_distinct(F.filter(used, lambda d: d.isNotNull()))
    return ordered.select(
        key,
        F.col("session_window.start").alias("session_start"),
        F.col("session_window.end").alias("session_end"),
        F.size("steps").cast("long").alias("clicks"),
        F.get(devices, F.lit(0)).alias("device"),
        devices.alias("devices"),
        F.transform("steps", lambda s: s["page"]).alias("path"),
    )
