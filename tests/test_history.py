"""Loads that skip what they have loaded."""

from __future__ import annotations

import os
import uuid

import pytest

from ledgerloom.sources import history
from ledgerloom.sources.store import open_database

HEADER = "ticket_id,customer_id,issue_category,created_at,status,resolution_time_hours\n"


@pytest.fixture
def db(spark, tmp_path):
    name = f"h_{uuid.uuid4().hex}"
    open_database(spark, name, str(tmp_path / "db"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def put(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def write(name, *ids, when=None):
        path = folder / name
        path.write_text(HEADER + "".join(f'{i},c1,"late,\nvery",2024-01-01,open,3\n' for i in ids))
        if when:
            os.utime(path, (when, when))
        return str(folder)

    return write


def ids(spark, db, table="raw_support_tickets"):
    return sorted(r.ticket_id for r in spark.table(f"{db}.{table}").collect())


def load(spark, db, path, run):
    return history.load_new_files(spark, path, "raw_support_tickets", db, run)


def test_a_load_that_comes_again_adds_nothing(spark, db, put):
    put("a.csv", "t1", "t2", when=1_700_000_000)
    path = put("b.csv", "t3", "t" * 60, when=1_700_000_000)
    assert load(spark, db, path, "r1") == (2, 0, 3, 1)
    assert load(spark, db, path, "r1") == (0, 2, 0, 0)
    assert load(spark, db, path, "r2") == (0, 2, 0, 0)
    put("c.csv", "t4", when=1_700_000_000)
    assert load(spark, db, path, "r3") == (1, 2, 1, 0)
    assert ids(spark, db) == ["t1", "t2", "t3", "t4"]
    assert ids(spark, db, "raw_support_tickets_rejected") == ["t" * 60]
    told = history.ledger(spark, db).groupBy("status").count().collect()
    assert [(r.status, r["count"]) for r in told] == [("loaded", 3)]


def test_a_touched_file_is_skipped_and_a_changed_one_loaded(spark, db, put):
    path = put("a.csv", "t1", when=1_700_000_000)
    load(spark, db, path, "r1")
    put("a.csv", "t1", when=1_700_000_500)
    assert load(spark, db, path, "r2") == (0, 1, 0, 0)
    put("a.csv", "t1", "t9", when=1_700_000_900)
    assert load(spark, db, path, "r3") == (1, 0, 2, 0)
    assert ids(spark, db) == ["t1", "t1", "t9"]
    assert sorted(r.status for r in history.ledger(spark, db).collect()) == ["loaded", "loaded", "unchanged"]


def test_a_broken_off_load_is_repeated_and_a_finished_run_is_closed(spark, db, put, monkeypatch):
    path = put("a.csv", "t1", "t2")
    plain = history.append_run

    def crash(df, database, name, run):
        if name == history.LEDGER:
            raise RuntimeError("lost")
        return plain(df, database, name, run)

    monkeypatch.setattr(history, "append_run", crash)
    with pytest.raises(RuntimeError, match="lost"):
        load(spark, db, path, "r1")
    monkeypatch.setattr(history, "append_run", plain)
    assert load(spark, db, path, "r1") == (1, 0, 2, 0)
    assert ids(spark, db) == ["t1", "t2"]
    put("b.csv", "t3")
    with pytest.raises(ValueError, match="already loaded"):
        load(spark, db, path, "r1")
    assert load(spark, db, path, "r2") == (1, 1, 1, 0)


def test_empty_files_and_folders(spark, db, put, tmp_path):
    path = put("a.csv")
    (tmp_path / "in" / "nothing.csv").write_text("")
    # Files without a byte are not listed.
    assert load(spark, db, path, "r1") == (1, 0, 0, 0)
    assert load(spark, db, path, "r2") == (0, 1, 0, 0)
