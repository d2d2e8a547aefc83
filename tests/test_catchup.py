"""Catch-up by units and by rows on small tables."""

import pytest
from pyspark.sql import functions as F

from tablebridge.operators import catchup
from tablebridge.operators.catchup import CatchUpSpec

SCHEMA = "id bigint, exam string, child int, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def tables(spark):
    source = [(None, "1", 1, "a"), (None, "1", 2, "b"), (None, "1", 2, "c"), (None, "2", 1, "d"), (None, "3", 1, "e"), (None, "a,b", 1, "f"), (None, None, 1, "x")]
    snapshot = source + [(None, "9", 1, "gone")]
    target = [(5, "1", 2, "old"), (6, "3", 1, "e"), (7, "1", 8, "surplus"), (8, None, 1, "blank")]
    return [spark.createDataFrame(x, SCHEMA) for x in (source, snapshot, target)]


def run(tables, spec, **options):
    source, snapshot, target = tables
    return catchup.catch_up_units(source, snapshot, target, spec, "id", [F.col("v")], ~F.col("exam").rlike("[,;\\s]"), **options)


def test_units_are_replaced_as_one_and_ids_follow_the_ordinal(tables):
    out, plan = run(tables, CatchUpSpec("exam", ["child"], multiset=True))
    assert rows(out) == sorted([
        (6, "3", 1, "e", "kept"), (8, None, 1, "blank", "kept"), (5, "1", 2, "b", "replaced"),
        (9, "1", 1, "a", "inserted"), (10, "1", 2, "c", "inserted"), (11, "2", 1, "d", "inserted"),
    ], key=str)
    assert rows(plan) == [("1", 2, 2, 3, "replaced"), ("2", 1, 0, 1, "loaded"), ("9", 1, 0, 0, "not_found"), ("a,b", 1, 0, 0, "unsendable")]


def test_without_multiset_a_key_counts_once(tables):
    out, plan = run(tables, CatchUpSpec("exam", ["child"]))
    assert ("1", 2, "b", "replaced") in [r[1:] for r in rows(out)] and not [r for r in rows(out) if r[3] == "c"]
    assert ("1", 1, 2, 2, "replaced") in rows(plan)


def test_partial_units_are_reported_only(tables):
    out, plan = run(tables, CatchUpSpec("exam", ["child"], replace_partial=False))
    assert ("1", 1, 2, 0, "partial") in rows(plan) and (7, "1", 8, "surplus", "kept") in rows(out)


def test_the_rest_is_loaded_by_a_second_run(tables):
    spec = CatchUpSpec("exam", ["child"], multiset=True)
    out, plan = run(tables, spec, max_units=1)
    assert {r.exam: r.action for r in plan.collect()} == {"1": "replaced", "2": "postponed", "9": "not_found", "a,b": "unsendable"}
    again, plan = run([tables[0], tables[1], out.drop("merge_action")], spec, max_units=1)
    assert {r.exam: r.action for r in plan.collect()} == {"2": "loaded", "9": "not_found", "a,b": "unsendable"}
    whole, _ = run(tables, spec)
    assert rows(again.select("exam", "child", "v")) == rows(whole.select("exam", "child", "v"))
    done, plan = run([tables[0], tables[1], again.drop("merge_action")], spec)
    assert rows(done.select("exam", "child", "v")) == rows(whole.select("exam", "child", "v"))
    assert {r.action for r in plan.collect()} == {"not_found", "unsendable"}


def test_log_rows_are_appended_by_ordinal(spark):
    log = lambda data: spark.createDataFrame(data, "k string, at int")
    source = log([("a", 1), ("a", 1), ("a", 2), ("b", 1), ("c", 1)])
    snapshot = source.unionByName(log([("c", 2)]))
    out, plan = catchup.catch_up_rows(source, snapshot, log([("a", 1), ("z", 9)]), ["k"], [F.col("at")])
    assert rows(out) == [("a", 1, "appended"), ("a", 1, "kept"), ("a", 2, "appended"), ("b", 1, "appended"), ("c", 1, "appended"), ("z", 9, "kept")]
    assert rows(plan) == [("a", 2, 1, 2, "partial"), ("b", 1, 0, 1, "loaded"), ("c", 2, 0, 1, "not_found")]


def test_keys_that_count_once_are_not_ranked(spark, tables, monkeypatch):
    monkeypatch.setattr(catchup, "rank_in_group", None)
    out, _ = run(tables, CatchUpSpec("exam", ["child"]))
    assert rows(out) == sorted([
        (6, "3", 1, "e", "kept"), (8, None, 1, "blank", "kept"), (5, "1", 2, "b", "replaced"), (9, "1", 1, "a", "inserted"), (10, "2", 1, "d", "inserted"),
    ], key=str)
    # Of held rows of a key one without an id comes first, as in an ordering.
    twice = tables[2].unionByName(spark.createDataFrame([(None, "1", 2, "y"), (4, "1", 2, "z")], SCHEMA))
    out, _ = run([*tables[:2], twice], CatchUpSpec("exam", ["child"]))
    assert (10, "1", 2, "b", "inserted") in rows(out)


def test_snapshot_and_target_are_counted_once(tables):
    source, snapshot, target = tables
    plan = catchup.unit_plan(snapshot, target, source, CatchUpSpec("exam", ["child"], multiset=True))
    assert "Union" not in plan._jdf.queryExecution().optimizedPlan().toString()
