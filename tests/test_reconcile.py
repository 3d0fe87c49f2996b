"""Layers compared by digests."""

from __future__ import annotations

from ledgerloom.operators import reconcile as r

SHAPE = "id string, a int, b string"


def found(spark, before, after, **options):
    a, b = (spark.createDataFrame(rows, SHAPE) for rows in (before, after))
    rows = r.reconcile(a, b, ["id"], ["a", "b"], **options).collect()
    return sorted(((x.id, x.kind, x["columns"], x.n_before, x.n_after) for x in rows), key=repr)


def test_kinds_of_difference(spark):
    before = [("1", 1, "x"), ("2", 2, "x"), ("3", 3, None), (None, 4, "n"), ("5", 5, "y"), ("5", 6, "z"), ("6", 1, "s"), ("7", 7, "t")]
    after = [("1", 1, "x"), ("3", 3, ""), (None, 4, "m"), ("5", 5, "z"), ("5", 6, "y"), ("6", 1, "s"), ("6", 1, "s"), ("8", 8, "u"), ("7", 7, "t")]
    want = sorted([
        ("2", "lost", None, 1, 0), ("8", "added", None, 0, 1), ("3", "changed", ["b"], 1, 1), (None, "changed", ["b"], 1, 1),
        ("5", "changed", ["rows"], 2, 2), ("6", "changed", ["n_rows", "a", "b"], 1, 2),
    ], key=repr)
    for buckets in (1, 2, 4096):
        assert found(spark, before, after, buckets=buckets) == want


def test_equal_layers_in_another_order_have_no_difference(spark):
    rows = [(str(i % 50), i, None if i % 3 else "q") for i in range(300)]
    assert found(spark, rows, rows[::-1]) == []
    assert found(spark, [], []) == [] and len(found(spark, rows, [])) == 50


def test_only_differing_buckets_are_looked_at(spark):
    before = spark.range(5000).selectExpr("id", "id * 2 AS v")
    after = before.selectExpr("id", "IF(id = 77, 0, v) AS v")
    assert len(r.differing_buckets(before, after, ["id"], ["v"])) == 1
    layers = {"one": before, "two": after, "three": after.selectExpr("id", "CAST(v AS STRING) AS v", "1 AS extra")}
    got = r.reconcile_layers(layers, ["id"], ["v", "extra"]).collect()
    assert [(x.layer, x.next_layer, x.id, x["columns"]) for x in got] == [("one", "two", "77", ["v"])]
    counts = {x.layer: (x.n, x.h0) for x in r.layer_counts(layers, ["id"], ["v"]).collect()}
    assert counts["two"] == counts["three"] != counts["one"]


def test_only_rows_of_differing_keys_are_grouped_by_column(spark, monkeypatch):
    before = spark.range(3000).selectExpr("id", "id * 2 AS v")
    after = before.selectExpr("id", "IF(id = 77, 0, v) AS v").where("id <> 5")
    seen, plain = [], r._both
    monkeypatch.setattr(r, "_both", lambda a, b, *rest: seen.append((a.count(), b.count())) or plain(a, b, *rest))
    got = r.reconcile(before, after, ["id"], ["v"], buckets=1)
    assert seen == [(3000, 2999), (2, 1)]
    assert sorted((x.id, x.kind) for x in got.collect()) == [("5", "lost"), ("77", "changed")]


def test_values_that_move_to_a_gap_of_their_row_are_changes(spark):
    rows = [("1", "x", None), ("2", "", None), (None, "k", "k"), (None, "k", "k")]
    moved = [("1", None, "x"), ("2", None, ""), (None, "k", "k"), (None, "k", None)]
    a, b = (spark.createDataFrame(x, "id string, a string, b string") for x in (rows, moved))
    got = r.reconcile(a, b, ["id"], ["a", "b"]).collect()
    assert sorted(((x.id, x["columns"], x.n_before, x.n_after) for x in got), key=repr) == [
        ("1", ["a", "b"], 1, 1), ("2", ["a", "b"], 1, 1), (None, ["b"], 2, 2),
    ]
