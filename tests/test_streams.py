"""Repeats, sessions, batch retries."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

import pytest

from ledgerloom.sources.schemas import text_schema
from ledgerloom.sources.store import append_run, open_database
from ledgerloom.streaming import clicks
from ledgerloom.streaming.issues import alert_issues, drain_to_issues
from ledgerloom.streaming.landing import checked_messages, land_messages
from ledgerloom.streaming.sessions import session_paths

START = datetime(2024, 1, 1)


@pytest.fixture
def feed(spark, tmp_path):
    """Writes files of (id, user, minutes) and streams them one file per batch."""
    folder = str(tmp_path / "clicks")
    schema = "click_id long, customer_id long, ts timestamp_ntz"

    def put(*files):
        for rows in files:
            data = [(i, u, START + timedelta(minutes=m)) for i, u, m in rows]
            spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(folder)
        source = clicks.click_source(
            spark, folder, spark.read.parquet(folder).schema, maxFilesPerTrigger="1"
        )
        return clicks.with_event_time(source, "ts")

    return put


def test_repeat_within_the_bound_is_dropped_and_past_it_kept(spark, feed, tmp_path):
    stream = feed([(1, 7, 0), (1, 7, 1)], [(1, 7, 30), (2, 7, 31)], [(3, 7, 600)], [(4, 7, 650)], [(1, 7, 700)])
    rows = clicks.drain_to_files(clicks.unique_clicks(stream), str(tmp_path / "o")).collect()
    assert sorted(r.click_id for r in rows) == [1, 1, 2, 3, 4]


def test_thinning_by_place_keeps_each_key_once(spark, feed, tmp_path):
    stream = feed([(i % 5, i, i % 3) for i in range(300)], [(i % 7, i, 20) for i in range(300)])
    unique = clicks.unique_clicks(stream, place="customer_id")
    rows = clicks.drain_to_files(unique, str(tmp_path / "o")).collect()
    assert sorted(r.click_id for r in rows) == list(range(7))


def test_messages_become_clicks(spark):
    body = '{"click_id": "k1", "click_timestamp": "2024-01-01 10:00:00", "other": 1}'
    messages = spark.createDataFrame(
        [(bytearray(body, "utf-8"), "clicks", 3, 99), (bytearray(b"broken"), "clicks", 3, 100)],
        "value binary, topic string, partition int, offset long",
    )
    rows = clicks.parse_messages(messages, text_schema("raw_clicks"))
    got = [(r.click_id, r.click_timestamp, r.device_type, r.place) for r in rows.collect()]
    assert got == [
        ("k1", "2024-01-01 10:00:00", None, "clicks/3/99"),
        (None, None, None, "clicks/3/100"),
    ]


def test_two_clicks_31_minutes_apart_are_two_sessions(spark, feed, tmp_path):
    stream = feed([(1, 7, 0), (2, 7, 31), (3, 7, 40), (4, 8, 5)], [(9, 9, 600)], [(10, 9, 2000)])
    sessions = clicks.click_sessions(stream, "ts", "customer_id")
    rows = clicks.drain_to_files(sessions, str(tmp_path / "o")).collect()
    assert sorted((r.customer_id, r.clicks) for r in rows) == [(7, 1), (7, 2), (8, 1), (9, 1)]


def test_updates_add_up_over_batches(spark, feed, tmp_path):
    stream = feed([(1, 7, 0), (2, 7, 10)], [(3, 7, 20)], [(4, 7, 60 * 24)])
    counts = clicks.windowed_counts(stream, "ts", [])
    updates = clicks.drain_batches(counts, str(tmp_path / "o"), mode="update")
    rows = clicks.latest_counts(updates, ["window_start"], "clicks").collect()
    assert sorted(r.clicks for r in rows) == [1, 3]


def test_restart_goes_on_where_it_stopped(spark, feed, tmp_path):
    target = str(tmp_path / "o")
    clicks.drain_batches(feed([(1, 7, 0)]), target)
    rows = clicks.drain_batches(feed([(2, 7, 1)]), target)
    assert sorted(r.click_id for r in rows.collect()) == [1, 2]


def test_alerts_do_not_depend_on_batches(spark, tmp_path):
    rows = [(i, i % 9, START, 1000.0 if i % 100 == 7 else float(i % 10)) for i in range(1000)] + [(2000, 1, START, None)]
    history = spark.createDataFrame(rows, "click_id long, customer_id long, ts timestamp_ntz, value double")
    known = spark.createDataFrame([(i,) for i in range(8)], "customer_id long")
    find = clicks.alert_batch(known, "click_id", "customer_id", "value", clicks.reference_of(history, "value"))
    found = []
    for files in (1, 25):
        folder = str(tmp_path / f"in{files}")
        history.repartition(files).write.parquet(folder)
        stream = clicks.click_source(spark, folder, history.schema, maxFilesPerTrigger="1")
        schema = "click_id long, customer_id long, value double, issue_type string"
        got = clicks.drain_batches(stream, str(tmp_path / f"out{files}"), find, schema=schema)
        found.append(sorted((r.click_id, r.issue_type) for r in got.collect()))
    assert found[0] == found[1]
    assert sum(kind == "outlier_value" for _, kind in found[0]) == 10
    assert sum(kind == "orphan_customer_id" for _, kind in found[0]) == 111


@pytest.fixture
def pages(spark, tmp_path):
    """Writes files of (id, user, minutes, page, device) and streams them one file per batch."""
    folder = str(tmp_path / "pages")
    schema = "click_id long, customer_id long, ts timestamp_ntz, page_url string, device_type string"

    def put(*files):
        for rows in files:
            data = [(i, u, START + timedelta(minutes=m), p, d) for i, u, m, p, d in rows]
            spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(folder)
        source = clicks.click_source(spark, folder, spark.read.parquet(folder).schema, maxFilesPerTrigger="1")
        return clicks.with_event_time(source, "ts")

    return put


def test_session_paths_are_in_order_across_batches(spark, pages, tmp_path):
    stream = pages(
        [(3, 7, 20, "/c", "phone"), (1, 7, 0, "/a", None)], [(5, 7, 20, "/e", None), (2, 7, 10, None, "tablet")], [(4, 7, 20, "/d", "phone"), (9, 8, 5, "/x", None)],
        [(10, 9, 600, "/z", "tv")], [(11, 9, 2000, "/z", "tv")],
    )
    rows = clicks.drain_to_files(session_paths(stream, "ts", "customer_id"), str(tmp_path / "o")).collect()
    got = {r.customer_id: (r.clicks, r.device, r.devices, r.path) for r in rows}
    assert got[7] == (5, "tablet", ["tablet", "phone"], ["/a", None, "/c", "/d", "/e"])
    assert got[8] == (1, None, [], ["/x"]) and got[9] == (1, "tv", ["tv"], ["/z"])


def test_one_customer_with_very_many_clicks(spark, tmp_path):
    folder = str(tmp_path / "many")
    n = 100_000
    rows = spark.range(n).selectExpr(
        "id AS click_id", "1L AS customer_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id DIV 3) AS ts", "concat('/', id) AS page_url", "'phone' AS device_type"
    )
    late = spark.createDataFrame([(n, 2, START + timedelta(days=9), "/", "tv")], rows.schema)
    rows.repartition(3).write.parquet(folder)
    late.write.mode("append").parquet(folder)
    stream = clicks.with_event_time(clicks.click_source(spark, folder, rows.schema), "ts")
    (one,) = clicks.drain_to_files(session_paths(stream, "ts", "customer_id"), str(tmp_path / "o")).collect()
    assert one.clicks == n and one.path == [f"/{i}" for i in range(n)]
    again = clicks.with_event_time(clicks.click_source(spark, folder, rows.schema), "ts")
    with pytest.raises(Exception, match="more than max_clicks=99999"):
        clicks.drain_to_files(session_paths(again, "ts", "customer_id", max_clicks=n - 1), str(tmp_path / "p"))


MESSAGES = [
    ('{"click_id": "k1", "customer_id": "c", "click_timestamp": "2024-01-01 10:00:00", "other": 1}', None),
    ('{"click_id": "k2", "click_timestamp": null}', None),
    ('{"click_id": "k3", "click_time', "broken_message"), ("null", "broken_message"), ("", "broken_message"), (None, "broken_message"), ("[1]", "broken_message"), ('"k"', "broken_message"),
    ('{"customer_id": "c"}', "missing:click_id"), ('{"click_id": "k4", "click_timestamp": "soon"}', "bad_time:click_timestamp"),
    ('{"click_id": "' + "k" * 51 + '"}', "too_long:click_id"), ('{"click_id": 17, "page_url": "/ä"}', None),
]


def message_rows(spark, copies=1):
    data = [(bytearray(m, "utf-8") if m is not None else None, "clicks", i % 3, i, START + timedelta(days=i % 2)) for i, (m, _) in enumerate(MESSAGES * copies)]
    return spark.createDataFrame(data, "value binary, topic string, partition int, offset long, timestamp timestamp")


def test_messages_land_with_their_reason(spark):
    rows = checked_messages(message_rows(spark)).collect()
    got = sorted((int(r.place.rsplit("/", 1)[1]), r.reject_reason, r.message) for r in rows)
    assert got == [(i, reason, m if reason else None) for i, (m, reason) in enumerate(MESSAGES)]
    assert {r.click_id for r in rows if r.outcome == "accepted"} == {"k1", "k2", "17"}


@pytest.mark.parametrize("files", [1, 6])
def test_every_message_lands_once_by_outcome_and_day(spark, tmp_path, files):
    source = message_rows(spark, 4)
    folder = str(tmp_path / "in")
    source.repartition(files).write.parquet(folder)

    def land():
        stream = clicks.click_source(spark, folder, source.schema, maxFilesPerTrigger="1")
        return land_messages(stream, str(tmp_path / "out"))

    good, bad = land()
    assert (good.count(), bad.count()) == (12, 36)
    # The last batch's commit is lost: it runs again and replaces what it wrote.
    commits = sorted((tmp_path / "out" / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    (tmp_path / "out" / "checkpoint" / "commits" / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    good, bad = land()
    assert (good.count(), bad.count()) == (12, 36)
    assert len({(r.place) for r in good.union(good).collect()} | {r.place for r in bad.collect()}) == 48
    assert sorted({r.arrival_day.isoformat() for r in good.collect()}) == ["2024-01-01", "2024-01-02"]


@pytest.mark.parametrize("files", [1, 15])
def test_alerts_join_the_issue_table_once(spark, tmp_path, files):
    history = spark.createDataFrame([(i, i % 9, START, 1000.0 if i % 100 == 7 else float(i % 10)) for i in range(1000)], "click_id long, customer_id long, ts timestamp_ntz, value double")
    known = spark.createDataFrame([(i,) for i in range(8)], "customer_id long")
    find = clicks.alert_batch(known, "click_id", "customer_id", "value", clicks.reference_of(history, "value"))
    folder, db = str(tmp_path / "in"), f"i_{uuid.uuid4().hex}"
    history.repartition(files).write.parquet(folder)
    open_database(spark, db, str(tmp_path / "db"))
    order = spark.createDataFrame([("outlier_price", "o1", "price", "9", "s", "d")], "issue_type string, order_id string, column_name string, bad_value string, suggestion string, issue_description string")
    append_run(order, db, "data_quality_issues", "run-1")

    def drain():
        stream = clicks.click_source(spark, folder, history.schema, maxFilesPerTrigger="1")
        drain_to_issues(stream, lambda b: alert_issues(find(b), "click_id", "customer_id", "value"), db, "clicks", str(tmp_path / "checkpoint"))

    drain()
    want = 1 + 10 + 111
    assert spark.table(f"{db}.data_quality_issues").count() == want
    last = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))[-1]
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    drain()
    rows = spark.table(f"{db}.data_quality_issues").collect()
    assert len(rows) == want and sum(r.issue_type == "orphan_customer_id" for r in rows) == 111
    text = next(r.issue_description for r in rows if r.order_id == "8")
    assert text == "Click ID: 8 has invalid customer_id=8. Suggestion: Check customer table or assign to 'Unknown Customer'."
    spark.sql(f"DROP DATABASE {db} CASCADE")
