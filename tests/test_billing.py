"""Rules that need each other, companions on both sides, and a second run of the billing load."""

from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablebridge.operators.companion import Companions, CompanionSpec
from tablebridge.operators.rules import Rule, derive_by_rules, in_levels
from tablebridge.plans.bookings import Published
from tablebridge.plans.queries_billing import BILL_PEOPLE, BILL_PLACES, BILL_ROWS, BILLS_HELD, EXAMS_HELD, VISITS_HELD, WORKS_HELD
from tablebridge.plans.billing import BillingLoad
from tablebridge.plans.registry import Tables
from tablebridge.session import new_run_folder

col = F.col


def test_rules_read_what_others_filled(spark):
    df = spark.createDataFrame([(1, None, None, None), (2, " 0 ", "x", None), (3, "7", None, "z"), (None, None, None, None)], "a int, b string, c string, d string")
    rules = [
        Rule("d", F.concat("c", F.lit("!")), ["c"]), Rule("c", F.concat("b", F.lit("?")), ["b"]),
        Rule("b", col("a").cast("string"), ["a"], empty=["0"]), Rule("absent", F.lit(1)), Rule("a", col("absent"), ["absent"]),
    ]
    assert [[r.column for r in level] for level in in_levels(rules[:3])] == [["b"], ["c"], ["d"]]
    got = [tuple(r) for r in derive_by_rules(df, rules).collect()]
    assert got == [(1, "1", "1?", "1?!"), (2, "2", "x", "x!"), (3, "7", "7?", "z"), (None, None, None, None)]
    part = derive_by_rules(df, rules, col("a") == 1).collect()
    assert tuple(part[0]) == (1, "1", "1?", "1?!") and tuple(part[1]) == (2, " 0 ", "x", None) and part[3].b is None


def test_cycles_and_double_rules_are_errors():
    # Built without a session's columns being resolved: only names count.
    with pytest.raises(ValueError, match="read each other"):
        in_levels([Rule("a", F.lit(1), ["b"]), Rule("b", F.lit(1), ["a"])])
    with pytest.raises(ValueError, match="two rules"):
        in_levels([Rule("a", F.lit(1)), Rule("a", F.lit(2))])
    assert len(in_levels([Rule("a", F.lit(1), ["a"])])) == 1


SPEC = CompanionSpec("id", "work", "id", "bill", {"first": col("first"), "second": col("second")}, col("place"), values={"status": F.lit("3")})
WORK = "id bigint, bill bigint, date_created timestamp_ntz, location int, status string"


def companions(spark, parents, works):
    places = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    parents = spark.createDataFrame(parents, "id bigint, work bigint, first timestamp_ntz, second timestamp_ntz, place int")
    return Companions(parents, spark.createDataFrame(works, WORK), places, "id", SPEC)


def test_companions_of_all_kinds(spark):
    a, b = dt(2024, 1, 1), dt(2024, 2, 2)
    parents = [
        (1, None, a, b, 1), (2, None, None, b, 9), (3, None, None, None, None), (4, 50, a, b, 1), (5, 51, a, None, 1), (6, 51, a, None, 1),
        (7, None, b, None, 2), (8, 99, a, a, 1), (None, None, a, a, 9),
    ]
    works = [(50, 4, None, 2, "1"), (51, 77, b, 2, "1"), (52, 7, b, 1, "1"), (53, 7, b, 1, "1"), (54, None, None, None, "1"), (55, 4, a, None, "1")]
    c = companions(spark, parents, works)
    got = {r.id: tuple(r)[1:] for r in c.companion_rows.collect()}
    assert got == {
        50: (4, a, 2, "1", "first", "dated"), 51: (5, b, 2, "1", None, "relinked"), 52: (7, b, 1, "1", None, "kept"), 53: (7, b, 1, "1", None, "kept"),
        54: (None, None, None, "1", None, "kept"), 55: (4, a, None, "1", None, "kept"),
        56: (1, a, 1, "3", "first", "made"), 57: (2, b, None, "3", "second", "made"), 58: (3, None, None, "3", None, "made"),
    }
    assert {r.id: r.work for r in c.parent_rows.collect()} == {1: 56, 2: 57, 3: 58, 4: 50, 5: 51, 6: 51, 7: 52, 8: 99, None: None}
    assert [tuple(r) for r in c.issues.collect()] == [("2", "location", "location_not_resolved", "9")]


def test_no_companions_yet_and_no_parents(spark):
    a = dt(2024, 1, 1)
    first = companions(spark, [(3, None, a, None, 1), (1, None, a, None, 1)], [])
    assert {r.bill: r.id for r in first.companion_rows.collect()} == {1: 1, 3: 2}
    assert companions(spark, [], [(1, 2, a, 1, "1")]).companion_rows.count() == 1
    # A run that was lost after its companions were written: the parents do not know them yet.
    again = companions(spark, [(3, None, a, None, 1), (1, None, a, None, 1)], [tuple(r)[:5] for r in first.companion_rows.select("id", "bill", "date_created", "location", "status").collect()])
    assert again.made.count() == 0 and {r.id: r.work for r in again.parent_rows.collect()} == {1: 1, 3: 2}


def test_a_second_run_makes_nothing(spark, folder):
    t = Tables(spark, folder)
    rows, bills, exams, visits, works, people, places = [t.derive(x) for x in (BILL_ROWS, BILLS_HELD, EXAMS_HELD, VISITS_HELD, WORKS_HELD, BILL_PEOPLE, BILL_PLACES)]
    store = Published(spark, new_run_folder(spark, "test"))
    first = BillingLoad(rows, bills, exams, visits, works, people, places)
    store.publish({"bills": first.bill_rows.drop("merge_action"), "works": first.work_rows.drop("merge_action", "date_origin")})
    again = BillingLoad(rows, store.read("bills"), exams, visits, store.read("works"), people, places)
    assert again.work_rows.filter("merge_action in ('made', 'relinked', 'dated')").count() == 0
    after = again.bill_rows.drop("merge_action")
    assert after.exceptAll(store.read("bills")).count() == store.read("bills").exceptAll(after).count() == 0
    # Bills of the new system are as they were.
    new = bills.filter("old_exam_id is null")
    assert new.count() > 0 and new.exceptAll(after).count() == 0


def test_facts_of_exams_are_gathered_once(spark, folder):
    exams = spark.createDataFrame([(1, 5, None, None), (1, 4, None, None), (None, 3, None, None)], "id bigint, appointment bigint, location bigint, exam_date timestamp_ntz")
    facts = BillingLoad(None, None, exams, None, None, None, None)._exam_facts
    assert "Aggregate" not in facts._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r)[:2] for r in facts.collect()] == [(1, 4)]
