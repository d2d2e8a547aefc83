"""The billing load with all of its targets: bills, their finance works, and the bookings they belong to."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebridge.functions import clean as c
from tablebridge.operators import merge
from tablebridge.operators.companion import Companions, CompanionSpec
from tablebridge.operators.dedup import distinct_on
from tablebridge.operators.merge import ACTION
from tablebridge.operators.rules import Rule, derive_by_rules
from tablebridge.operators.skew import left_lookup
from tablebridge.plans import loads
from tablebridge.session import cut_lineage
from tablebridge.spec import FieldSpec, RelationSpec, TableSpec

# Status of a paid work, the place of exams without one, the place without overtime, overtime slots.
PAID, DEFAULT_PLACE, EXEMPT_PLACE, OVERTIME_SLOTS = "3", 1, 3, (25, 26, 27, 28)
ZONE = "Asia/Bangkok"
#: Columns that `_with_context` adds to a bill.
CONTEXT = ("_place", "_exam_date", "_visit_at", "_slot", "_is_new", "_booked")


def billing_rules() -> list[Rule]:
    """What the finance form would have set. Rules read each other's results: the invoice flag follows the method."""
    col = F.col
    late = F.coalesce(col("_slot").isin(*OVERTIME_SLOTS), F.lit(False)) | F.coalesce(c.is_weekend(col("_visit_at")), F.lit(False))
    newcomer = F.when(col("_is_new") == 1, "1").when(col("_is_new").isin(0, 2), "2")
    return [
        Rule("is_invoice_requested", col("payment_method") == "3", ["payment_method"]),
        Rule("payment_method", loads.payment_method(col("care_type"), col("payment_type")), ["care_type", "payment_type"], empty=["0"]),
        *[Rule(name, col("total"), ["total"]) for name in ("total_exam", "service_total", "last_total")],
        Rule("final_total", F.coalesce("receipt", "total"), ["receipt", "total"]),
        Rule("is_overtime", F.when(col("_place") == EXEMPT_PLACE, False).when(col("_booked"), late), ["_place", "_slot", "_visit_at", "_booked"]),
        Rule("patient_category", F.when(col("care_type") == "3", "3").otherwise(newcomer), ["care_type", "_is_new"]),
    ]


class BillingLoad:
    """Bills arrive per exam and replace the bill of that exam, whose id and finance work stay.

    `staging`: row_id, exam_id, exam_date, cust_key, total, receipt, care_type, payment_type, all but the first as text.
    `bills`: id, old_exam_id, exam, appointment, patient, exam_datetime, total, total_exam, service_total, last_total,
    receipt, final_total, care_type, payment_type, payment_method, is_invoice_requested, is_overtime, patient_category,
    finance_work. `exams`: id, old_exam_id, appointment, location, exam_date. `bookings`: id, appointment_datetime,
    time_slot, is_new_patient, care_type, payment_type. `works`: id, billing, exam, appointment, status, location,
    date_created. `people`: id, old_id. `places`: id. Steps, each a table on demand:

    1. Bills are cleansed, resolved and replaced; empty columns of migrated bills follow `billing_rules`.
       Bills of the new system (no old_exam_id) are not touched.
    2. Every migrated bill has a finance work and points at it, and back; its date is that of the exam, of the bill
       or of the booking, as an instant. A place that the master lacks becomes an issue.
    3. Of all bills of a booking in the source the one with the highest exam sets the booking's care and payment type.
    """

    def __init__(
        self, staging: DataFrame, bills: DataFrame, exams: DataFrame, bookings: DataFrame, works: DataFrame, people: DataFrame, places: DataFrame
    ) -> None:
        self.staging, self.bills, self.exams, self.bookings = staging, bills, exams, bookings
        self.works, self.people, self.places = works, people, places

    @cached_property
    def load(self) -> loads.LoadResult:
        exams = self.exams.select(F.col("old_exam_id").cast("string").alias("old_id"), "id")
        moment = lambda x: c.be_to_timestamp(x, 2400, time_after_t=False)
        spec = TableSpec(
            "billing", "row_id", ["old_exam_id"], ["row_id"],
            [
                FieldSpec("old_exam_id", "exam_id", c.to_int_strict, "invalid_key"),
                FieldSpec("exam_datetime", "exam_date", moment, "timestamp_parse_failed"),
                FieldSpec("total", "total", c.to_real_lenient, "numeric_parse_failed"),
                FieldSpec("receipt", "receipt", c.to_real_lenient, "numeric_parse_failed"),
                FieldSpec("care_type", "care_type"), FieldSpec("payment_type", "payment_type"),
            ],
            [RelationSpec("patient", "cust_key", self.people, ["old_id"]), RelationSpec("exam", "exam_id", exams, ["old_id"])],
            mode="replace", keep=["finance_work"], transform=self._with_booking,
        )
        return loads.run_load(spec, self.staging, self.bills)

    @cached_property
    def _exam_facts(self) -> DataFrame:
        """One row per exam id; of repeated ids the first in order of booking, place and date."""
        order = [x for n in ("appointment", "location", "exam_date") for x in (F.col(n).isNull(), F.col(n))]
        return cut_lineage(distinct_on(self.exams.filter("id is not null"), ["id"], order, ["id", "appointment", "location", "exam_date"]))

    def _with_booking(self, rows: DataFrame) -> DataFrame:
        return left_lookup(rows, self._exam_facts.select(F.col("id").alias("exam"), "appointment"), ["exam"], sparse=True)

    def _with_context(self, bills: DataFrame) -> DataFrame:
        exam = self._exam_facts.select(F.col("id").alias("exam"), F.col("location").alias("_place"), F.col("exam_date").alias("_exam_date"))
        facts = ["appointment_datetime", "time_slot", "is_new_patient"]
        order = [x for n in facts for x in (F.col(n).isNull(), F.col(n))]
        booking = distinct_on(self.bookings.filter("id is not null"), ["id"], order, ["id", *facts]).select(
            F.col("id").alias("appointment"), F.col("appointment_datetime").alias("_visit_at"), F.col("time_slot").alias("_slot"),
            F.col("is_new_patient").alias("_is_new"), F.lit(True).alias("_booked"),
        )
        both = left_lookup(left_lookup(bills, exam, ["exam"], sparse=True), booking, ["appointment"], sparse=True)
        return both.withColumn("_place", F.coalesce("_place", F.lit(DEFAULT_PLACE)))

    @cached_property
    def _derived(self) -> tuple[DataFrame, DataFrame]:
        """(migrated bills with their context, bills of the new system)."""
        rows = cut_lineage(self._with_context(self.load.rows))
        migrated = derive_by_rules(rows.filter("old_exam_id is not null"), billing_rules())
        return migrated, rows.filter("old_exam_id is null").drop(*CONTEXT)

    @cached_property
    def _works(self) -> Companions:
        def instant(x: Column) -> Column:
            return c.wall_clock_to_instant(x, ZONE)

        dates = {"exam": instant(F.col("_exam_date")), "bill": instant(F.col("exam_datetime")), "booking": instant(F.col("_visit_at"))}
        spec = CompanionSpec(
            "id", "finance_work", "id", "billing", dates, F.col("_place"),
            values={"status": F.lit(PAID), "exam": F.col("exam"), "appointment": F.col("appointment")},
        )
        return Companions(self._derived[0], self.works, self.places, "id", spec)

    @cached_property
    def bill_rows(self) -> DataFrame:
        """Bills with the action of the merge."""
        return self._works.parent_rows.drop(*CONTEXT).unionByName(self._derived[1])

    @cached_property
    def work_rows(self) -> DataFrame:
        """Finance works with what happened to them."""
        return self._works.companion_rows

    @cached_property
    def booking_rows(self) -> DataFrame:
        """Bookings with the care and payment type of their latest bill in the source."""
        loaded = self.load.rows.filter(F.col(ACTION).isin("replaced", "inserted")).filter("appointment is not null")
        named = self.bookings.withColumnRenamed("id", "appointment")
        out = merge.latest_child_to_parent(named, loaded, "appointment", [-F.col("old_exam_id")], {x: x for x in ("care_type", "payment_type")})
        return out.withColumnRenamed("appointment", "id").select(*self.bookings.columns)

    @cached_property
    def issues(self) -> DataFrame:
        return self.load.issues.unionByName(self._works.issues)
