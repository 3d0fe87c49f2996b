"""Tables, views, reruns."""

from __future__ import annotations

import uuid

import pytest

from ledgerloom.plans.warehouse import gate
from ledgerloom.session import shared_folder
from ledgerloom.sources import store


@pytest.fixture
def db(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    store.open_database(spark, name, str(tmp_path / "db"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_replace_may_read_the_table_it_replaces(spark, db):
    store.replace_table(spark.range(3), db, "t")
    old = spark.table(f"{db}.t")
    store.replace_table(old.selectExpr("id + 10 as id", "'x' as extra"), db, "t")
    again = spark.table(f"{db}.t")
    assert ids(again) == [10, 11, 12] and again.columns == ["id", "extra"]
    assert ids(old) == [0, 1, 2]


def test_create_refuses_an_existing_table(spark, db):
    store.create_table(spark.range(1), db, "t")
    with pytest.raises(ValueError, match="exists"):
        store.create_table(spark.range(2), db, "t")
    assert ids(spark.table(f"{db}.t")) == [0]


def test_snapshot_does_not_follow_the_table(spark, db):
    store.replace_table(spark.range(2), db, "t")
    store.snapshot_table(spark, db, "t")
    store.replace_table(spark.range(5), db, "t")
    assert ids(spark.table(f"{db}.t_backup")) == [0, 1]


def test_append_skips_empty_runs_and_replaces_reruns(spark, db):
    assert store.append_run(spark.range(0), db, "log", "r0") is None
    store.append_run(spark.range(3), db, "log", "r1")
    store.append_run(spark.range(2), db, "log", "r2")
    log = store.append_run(spark.range(1), db, "log", "r1")
    assert sorted((r.run_id, r.id) for r in log.collect()) == [("r1", 0), ("r2", 0), ("r2", 1)]
    emptied = store.append_run(spark.range(0), db, "log", "r2")
    assert [(r.run_id, r.id) for r in emptied.collect()] == [("r1", 0)]
    with pytest.raises(ValueError, match="plain word"):
        store.append_run(spark.range(1), db, "log", "../x")


def test_incremental_load_adds_new_keys_once(spark, db):
    store.append_new_keys(spark.range(3), db, "t", ["id"])
    store.append_new_keys(spark.range(5), db, "t", ["id"])
    assert ids(store.append_new_keys(spark.range(5), db, "t", ["id"])) == [0, 1, 2, 3, 4]


def test_materialize_and_listing(spark, db):
    inline = spark.createDataFrame([(1,), (None,)], "id int")
    first = store.materialize(inline, "first_model", "table", db)
    second = store.materialize(first.where("id = 1"), "second_model")
    assert ids(second) == [1]
    listed = {r.table_name: r.is_temporary for r in store.list_tables(spark, db).collect()}
    assert listed["first_model"] is False and listed["second_model"] is True
    columns = store.list_columns(spark, f"{db}.first_model").collect()
    assert [(r.col_name, r.data_type) for r in columns] == [("id", "int")]
    with pytest.raises(ValueError):
        store.materialize(inline, "m", "other")


def test_preview_is_ordered(spark):
    assert [r.id for r in store.preview(spark.range(9).orderBy("id", ascending=False), "id", 2).collect()] == [0, 1]


def test_gate_names_the_failing_tests(spark):
    fact = spark.createDataFrame([("1",), ("1",)], "order_id string")
    dim = spark.createDataFrame([("a",), (None,)], "customer_id string")
    assert gate(fact, {"customer_id": dim}) == ["not_null:customer_id", "unique:order_id"]


def test_work_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark, "x")
    assert folder.endswith("/x") and folder != shared_folder(spark, "x")
    if base:
        assert folder.startswith(base)


def test_repeats_within_a_load_are_added_once(spark, db):
    load = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "id int, v string")
    store.append_new_keys(load.where("id = 1"), db, "t", ["id"])
    rows = store.append_new_keys(load.orderBy("v"), db, "t", ["id"]).collect()
    assert sorted(str(r.id) for r in rows) == ["1", "2", "None"]


def test_replacing_equal_columns_keeps_the_table(spark, db):
    store.replace_table(spark.range(2), db, "t")
    store.replace_table(spark.range(5, 7), db, "t")
    assert ids(spark.table(f"{db}.t")) == [5, 6]


def folders(tmp_path):
    return sorted(p.name for p in (tmp_path / "db").iterdir())


def test_a_clone_copies_nothing_and_goes_its_own_way(spark, db, tmp_path):
    store.append_new_keys(spark.range(3), db, "t", ["id"])
    before = folders(tmp_path)
    store.clone_table(spark, db, "t", "c")
    assert folders(tmp_path) == before
    # Appending to either leaves the shared folder alone.
    store.append_new_keys(spark.range(5), db, "t", ["id"])
    assert ids(spark.table(f"{db}.c")) == [0, 1, 2] and ids(spark.table(f"{db}.t")) == [0, 1, 2, 3, 4]
    store.append_new_keys(spark.range(10, 11), db, "c", ["id"])
    assert ids(spark.table(f"{db}.c")) == [0, 1, 2, 10] and ids(spark.table(f"{db}.t")) == [0, 1, 2, 3, 4]


def test_a_clone_of_runs_keeps_its_runs(spark, db):
    store.append_run(spark.range(2), db, "log", "r1")
    store.clone_table(spark, db, "log", "kept")
    store.append_run(spark.range(7, 8), db, "log", "r1")
    store.append_run(spark.range(1), db, "log", "r2")
    assert [(r.run_id, r.id) for r in spark.table(f"{db}.kept").orderBy("id").collect()] == [("r1", 0), ("r1", 1)]


def test_vacuum_removes_what_nothing_points_at(spark, db, tmp_path):
    store.replace_table(spark.range(2), db, "t")
    store.clone_table(spark, db, "t", "c")
    store.replace_table(spark.range(3), db, "t")
    store.replace_table(spark.range(4), db, "t")
    store.append_run(spark.range(2), db, "log", "r1")
    store.append_run(spark.range(5), db, "log", "r1")
    (tmp_path / "db" / "not-ours").mkdir()
    assert store.vacuum(spark, db) == []  # all of them are young
    gone = store.vacuum(spark, db, older_than_hours=0.0)
    assert len(gone) == 2 and all("/t-" in g or "/r1-" in g for g in gone)
    assert store.vacuum(spark, db, older_than_hours=0.0) == []
    assert ids(spark.table(f"{db}.t")) == [0, 1, 2, 3] and ids(spark.table(f"{db}.c")) == [0, 1]
    assert spark.table(f"{db}.log").count() == 5 and "not-ours" in folders(tmp_path)


def test_views_last_and_are_made_in_order(spark, db):
    store.replace_table(spark.range(6), db, "t")
    store.publish_views(spark, db, {"top": "SELECT max(id) AS id FROM even", "even": "SELECT id FROM t WHERE id % 2 = 0"})
    other = spark.newSession()
    assert ids(other.table(f"{db}.top")) == [4]
    store.replace_table(spark.range(20), db, "t")
    assert ids(spark.newSession().table(f"{db}.top")) == [18]
    other.catalog.refreshTable(f"{db}.t")
    assert ids(other.table(f"{db}.top")) == [18]
    with pytest.raises(ValueError, match="read each other"):
        store.publish_views(spark, db, {"x": "SELECT * FROM y", "y": "SELECT * FROM x"})
    kinds = {r.relation: r.kind for r in store.list_relations(spark, db).collect()}
    assert kinds["t"] == "table" and kinds["top"] == kinds["even"] == "view"


def test_incremental_load_opens_only_files_that_may_hold_its_keys(spark, db, monkeypatch):
    for low in range(0, 400, 100):
        store.append_new_keys(spark.range(low, low + 100).selectExpr("id", "id AS v"), db, "t", ["id"])
    chosen = []
    plain = store._files_with_keys
    monkeypatch.setattr(store, "_files_with_keys", lambda *a: chosen.append(plain(*a)) or chosen[-1])
    rows = store.append_new_keys(spark.range(150, 160).union(spark.range(400, 410)).selectExpr("id", "-1L AS v"), db, "t", ["id"])
    files = rows.inputFiles()
    assert 0 < len(chosen[0]) < len(files) / 2
    assert rows.count() == 410 and rows.where("v < 0").count() == 10
    store.append_new_keys(spark.range(1000, 1001).selectExpr("id", "0L AS v"), db, "t", ["id"])
    assert chosen[1] == []


def test_incremental_load_with_two_keys_and_nulls(spark, db):
    load = spark.createDataFrame([("a", 1, 0), ("a", None, 1), (None, None, 2), ("b", 1, 3)], "k string, n int, v int")
    store.append_new_keys(load, db, "t", ["k", "n"])
    rows = store.append_new_keys(load.selectExpr("k", "n", "v + 10 AS v"), db, "t", ["k", "n"])
    assert sorted(r.v for r in rows.collect()) == [0, 1, 2, 3, 11, 12]
