"""Collections of two levels in parts, ids of wanted groups, and the category of a prior result."""

import json
from collections import defaultdict
from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablebridge.operators import document, profile
from tablebridge.plans import loads

ORDERS, LINES = "parent int, id int, place int, note string", "item int, n int, word string"


def nested(spark, parents, children, leaves, size):
    inner = document.ChildCollection("leaves", spark.createDataFrame(leaves, LINES), "item", ["n", "word"], ["n", "word"])
    kids = document.NestedCollection("kids", spark.createDataFrame(children, ORDERS), "parent", ["place"], ["id", "note"], "id", inner)
    top = spark.createDataFrame([(p,) for p in parents], "key int")
    out = document.build_snapshot_doc(top, "key", [kids], ["key"], max_items=size).collect()
    assert len({(r.key, r.part) for r in out}) == len(out)
    return {(r.key, r.part): json.loads(r.document)["kids"] for r in out}


@pytest.mark.parametrize("size", [1, 2, 3, 100])
def test_two_levels_by_parts(spark, size):
    children = [(1, 10, 2, "b"), (1, 11, 1, "a"), (1, 12, 2, "b"), (2, 20, None, "n"), (9, 90, 1, "x"), (None, 91, 1, "x"), (1, None, 0, "no key")]
    leaves = [(10, i // 2, "w") for i in range(11)] + [(11, None, "null")] + [(20, 5, "q"), (20, 4, "p"), (90, 1, "far"), (None, 1, "lost"), (77, 1, "nobody")]
    docs = nested(spark, [1, 2, 3], children, leaves, size)
    below = defaultdict(list)
    for item, n, word in leaves:
        below[item].append((n is not None, n or 0, word))
    for parent in (1, 2):
        mine = sorted((c for c in children if c[0] == parent and c[1] is not None), key=lambda c: (c[2] is not None, c[2] or 0, c[1]))
        flat = [(c[1], x) for c in mine for x in (sorted(below[c[1]]) or [None])]
        parts = [flat[i : i + size] for i in range(0, len(flat), size)]
        assert sorted(p for k, p in docs if k == parent) == list(range(len(parts)))
        for number, part in enumerate(parts):
            want = []
            for item, leaf in part:
                if not want or want[-1]["id"] != item:
                    want.append({"id": item, "note": next(c[3] for c in mine if c[1] == item), "leaves": []})
                if leaf is not None:
                    want[-1]["leaves"].append({"n": leaf[1], "word": leaf[2]} if leaf[0] else {"word": leaf[2]})
            assert docs[parent, number] == want
    assert docs[3, 0] == []


def test_two_levels_of_empty_tables(spark):
    assert nested(spark, [1], [], [], 2) == {(1, 0): []}
    assert nested(spark, [], [(1, 1, 1, "a")], [], 2) == {}


def test_ids_of_wanted_groups(spark):
    rows = [("a", 3, 1, True), ("a", 1, 9, None), ("a", 1, 9, None), ("a", None, 4, False), ("b", 1, 1, False), (None, 7, None, True), ("c", None, 2, True)]
    df = spark.createDataFrame(rows, "g string, id int, t int, flag boolean")
    got = sorted((tuple(r) for r in profile.group_ids_having_any(df, ["g"], F.col("flag"), "t", "id", 2).collect()), key=str)
    assert got == [("a", 0, [1, 1], 9, 4), ("a", 1, [3], 9, 4), ("c", 0, [], 2, 1), (None, 0, [7], None, 1)]
    assert profile.group_ids_having_any(df.limit(0), ["g"], F.col("flag"), "t", "id").count() == 0


def test_category_of_the_picked_exam(spark):
    day = lambda d: dt(2024, 1, d)
    appointments = spark.createDataFrame(
        [(1, 7, day(9), None, "own", True), (2, 7, day(9), None, "own", False), (3, 7, day(2), None, "own", True), (4, 8, day(9), None, "own", True), (5, 7, day(9), None, "own", None)],
        "id int, party int, at timestamp_ntz, payload string, category string, is_migrated boolean",
    )
    exams = spark.createDataFrame([(100, 7, 55), (101, 7, None), (200, 8, 4), (201, 8, None)], "exam_id int, party int, appointment int")
    findings = spark.createDataFrame(
        [(100, day(3), 1, True), (100, day(4), 2, False), (101, day(8), 3, False), (200, day(5), 4, True), (201, day(4), 5, True)],
        "exam_id int, found_at timestamp_ntz, finding_id int, signed boolean",
    )
    general = spark.createDataFrame([(100, 2, "later"), (100, 1, "first"), (None, 0, "nobody")], "exam_id int, general_id int, category string")
    out = loads.prior_result_with_category(appointments, exams, findings, general, F.col("signed"))
    got = {r.id: (r.picked_exam, r.payload, r.category, r.is_updated) for r in out.collect()}
    assert got == {
        1: (100, '[{"finding_id":1},{"finding_id":2}]', "first", True), 2: (None, None, "own", False), 3: (None, None, "own", False),
        4: (201, '[{"finding_id":5}]', None, True), 5: (None, None, "own", False),
    }
