"""The billing load with all of its targets: SURVEY section O, billing."""

from __future__ import annotations

from tablebridge.plans.billing import BillingLoad
from tablebridge.plans.inputs import sql_blank
from tablebridge.plans.registry import Tables, plain, query

# Bills per exam. Some exams are unknown, some dates and totals are unreadable, care and payment types lack here and there.
BILL_ROWS = """
SELECT o_orderkey AS row_id, CAST(o_orderkey AS STRING) AS exam_id, CASE WHEN o_orderkey % 43 = 0 THEN 'soon' WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS STRING) END AS exam_date,
  CAST(o_custkey AS STRING) AS cust_key, CASE WHEN o_orderkey % 31 = 0 THEN 'abc' ELSE CAST(o_totalprice AS STRING) END AS total,
  CASE WHEN o_orderpriority = '1-URGENT' THEN ' 12.5 ' END AS receipt, CASE WHEN o_orderkey % 29 > 0 THEN CAST(o_custkey % 3 + 1 AS STRING) END AS care_type,
  CASE WHEN o_orderkey % 23 > 0 THEN CAST(o_custkey % 26 AS STRING) END AS payment_type FROM {orders}
"""
# Bills loaded before 1996 have a finance work, some of them none yet; bills of the new system have no old exam.
BILLS_HELD = """
SELECT o_orderkey + 7 AS id, CASE WHEN o_orderkey % 5 > 0 THEN CASE WHEN o_orderkey % 37 = 0 THEN -o_orderkey ELSE o_orderkey END END AS old_exam_id, o_orderkey + 3 AS exam, CAST(floor(o_orderkey / 3) AS BIGINT) AS appointment,
  CAST(NULL AS BIGINT) AS patient, o_orderdate AS exam_datetime, o_totalprice - 5 AS total, CASE WHEN o_orderstatus = 'F' THEN 1.5E0 END AS total_exam,
  CAST(NULL AS DOUBLE) AS service_total, CAST(NULL AS DOUBLE) AS last_total, CAST(NULL AS DOUBLE) AS receipt, CAST(NULL AS DOUBLE) AS final_total,
  '3' AS care_type, ' ' AS payment_type, '0' AS payment_method, CAST(NULL AS BOOLEAN) AS is_invoice_requested, CAST(NULL AS BOOLEAN) AS is_overtime, ' ' AS patient_category,
  CASE WHEN o_orderpriority <> '2-HIGH' THEN o_orderkey + 9 END AS finance_work FROM {orders} WHERE year(o_orderdate) < 1996
"""
EXAMS_HELD = """
SELECT o_orderkey + 3 AS id, o_orderkey AS old_exam_id, CASE WHEN o_orderkey % 17 > 0 THEN CAST(floor(o_orderkey / 3) AS BIGINT) END AS appointment,
  CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey % 30 END AS location, CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS exam_date FROM {orders} WHERE o_orderkey % 13 > 0
"""
VISITS_HELD = """
SELECT CAST(floor(o_orderkey / 3) AS BIGINT) AS id, max(o_orderdate) AS appointment_datetime, max(o_custkey % 40) AS time_slot, min(o_custkey % 4) AS is_new_patient,
  'held' AS care_type, 'held' AS payment_type FROM {orders} WHERE o_orderkey % 19 > 0 GROUP BY CAST(floor(o_orderkey / 3) AS BIGINT)
"""
# Works of bills, pointing at them or (urgent) at nobody; some works of a lost run point at bills that don't know them.
WORKS_HELD = """
SELECT o_orderkey + 9 AS id, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderkey + 7 END AS billing, CAST(NULL AS BIGINT) AS exam, CAST(NULL AS BIGINT) AS appointment, '1' AS status,
  CAST(NULL AS BIGINT) AS location, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN o_orderdate END AS date_created FROM {orders} WHERE year(o_orderdate) < 1996 AND (o_orderpriority <> '2-HIGH' OR o_orderstatus = 'F')
"""
BILL_PEOPLE = "SELECT c_custkey AS id, CAST(c_custkey AS STRING) AS old_id FROM {customer} WHERE c_mktsegment <> 'FURNITURE'"
BILL_PLACES = "SELECT n_nationkey AS id FROM {nation}"

SQL_BILLING = f"""
WITH b AS ({plain(BILLS_HELD)}), e AS ({plain(EXAMS_HELD)}), v AS ({plain(VISITS_HELD)}), w AS ({plain(WORKS_HELD)}), people AS ({plain(BILL_PEOPLE)}), places AS ({plain(BILL_PLACES)}),
r AS ({plain(BILL_ROWS)}),
s AS (SELECT CAST(exam_id AS BIGINT) AS old_exam_id, try_cast(r.exam_date AS TIMESTAMP) AS exam_datetime, try_cast(total AS DOUBLE) AS total, try_cast({sql_blank('receipt')} AS DOUBLE) AS receipt,
  care_type, payment_type, people.id AS patient, e.id AS exam, e.appointment FROM r LEFT JOIN people ON old_id = cust_key LEFT JOIN e ON e.old_exam_id = CAST(exam_id AS BIGINT)),
m AS (SELECT b.id, s.old_exam_id, s.exam, s.appointment, s.patient, s.exam_datetime, s.total, NULL::DOUBLE AS total_exam, s.receipt, s.care_type, s.payment_type, NULL AS payment_method, b.finance_work, 'replaced' AS merge_action
    FROM b JOIN s USING (old_exam_id)
  UNION ALL SELECT id, old_exam_id, exam, appointment, patient, exam_datetime, total, total_exam, receipt, care_type, payment_type, payment_method, finance_work, 'kept' FROM b WHERE old_exam_id IS NULL OR old_exam_id NOT IN (SELECT old_exam_id FROM s)
  UNION ALL SELECT (SELECT max(id) FROM b) + row_number() OVER (ORDER BY old_exam_id), old_exam_id, exam, appointment, patient, exam_datetime, total, NULL, receipt, care_type, payment_type, NULL, NULL, 'inserted'
    FROM s WHERE old_exam_id NOT IN (SELECT old_exam_id FROM b WHERE old_exam_id IS NOT NULL)),
x AS (SELECT m.*, coalesce(e.location, 1) AS place, e.exam_date, v.appointment_datetime AS visit_at, v.time_slot, v.is_new_patient, v.id IS NOT NULL AS booked,
    CASE WHEN m.care_type = '2' OR m.care_type = '1' AND m.payment_type IN ('3', '4', '5', '6') THEN '3' WHEN m.care_type = '1' AND m.payment_type IN ('1', '2') THEN '1' ELSE '2' END AS pay
  FROM m LEFT JOIN e ON e.id = m.exam LEFT JOIN v ON v.id = m.appointment WHERE m.old_exam_id IS NOT NULL),
asked AS (SELECT x.*, coalesce(finance_work, (SELECT min(w.id) FROM w WHERE w.billing = x.id AND w.id NOT IN (SELECT finance_work FROM x WHERE finance_work IS NOT NULL))) AS link,
  coalesce(exam_date, exam_datetime, visit_at) - INTERVAL 7 HOUR AS work_date, CASE WHEN exam_date IS NOT NULL THEN 'exam' WHEN exam_datetime IS NOT NULL THEN 'bill' WHEN visit_at IS NOT NULL THEN 'booking' END AS origin FROM x),
made AS (SELECT (SELECT max(id) FROM w) + row_number() OVER (ORDER BY id) AS work, * FROM asked WHERE link IS NULL)
"""


def billing_load(t: Tables) -> BillingLoad:
    return BillingLoad(*[t.derive(x) for x in (BILL_ROWS, BILLS_HELD, EXAMS_HELD, VISITS_HELD, WORKS_HELD, BILL_PEOPLE, BILL_PLACES)])


@query(f"""{SQL_BILLING}
SELECT asked.id, asked.old_exam_id, asked.exam, asked.appointment, asked.patient, asked.exam_datetime, asked.total, coalesce(asked.total_exam, asked.total) AS total_exam, asked.total AS service_total, asked.total AS last_total,
  asked.receipt, coalesce(asked.receipt, asked.total) AS final_total, asked.care_type, asked.payment_type, asked.pay AS payment_method, asked.pay = '3' AS is_invoice_requested,
  CASE WHEN asked.place = 3 THEN false WHEN asked.booked THEN coalesce(asked.time_slot BETWEEN 25 AND 28, false) OR isodow(asked.visit_at) IN (6, 7) END AS is_overtime,
  CASE WHEN asked.care_type = '3' THEN '3' WHEN asked.is_new_patient = 1 THEN '1' WHEN asked.is_new_patient IN (0, 2) THEN '2' END AS patient_category,
  coalesce(asked.link, made.work) AS finance_work, asked.merge_action FROM asked LEFT JOIN made ON made.id = asked.id
UNION ALL SELECT *, 'kept' FROM b WHERE old_exam_id IS NULL""")
def load_billing_bills(t: Tables):
    return billing_load(t).bill_rows


@query(f"""{SQL_BILLING}, owner AS (SELECT link, id AS bill, work_date, origin FROM asked WHERE link IS NOT NULL QUALIFY row_number() OVER (PARTITION BY link ORDER BY id) = 1)
SELECT w.id, coalesce(bill, w.billing) AS billing, w.exam, w.appointment, w.status, w.location, coalesce(w.date_created, work_date) AS date_created,
  CASE WHEN w.date_created IS NULL AND work_date IS NOT NULL THEN origin END AS date_origin,
  CASE WHEN bill IS NOT NULL AND w.billing IS DISTINCT FROM bill THEN 'relinked' WHEN w.date_created IS NULL AND work_date IS NOT NULL THEN 'dated' ELSE 'kept' END AS merge_action
FROM w LEFT JOIN owner ON link = w.id
UNION ALL SELECT work, made.id, exam, appointment, '3', places.id, work_date, origin, 'made' FROM made LEFT JOIN places ON places.id = place""")
def load_billing_works(t: Tables):
    return billing_load(t).work_rows


@query(f"""
WITH last AS (SELECT e.appointment, r.care_type, r.payment_type FROM ({plain(BILL_ROWS)}) r JOIN ({plain(EXAMS_HELD)}) e ON e.old_exam_id = r.row_id WHERE e.appointment IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY e.appointment ORDER BY r.row_id DESC) = 1)
SELECT id, appointment_datetime, time_slot, is_new_patient, CASE WHEN appointment IS NULL THEN v.care_type ELSE last.care_type END AS care_type,
  CASE WHEN appointment IS NULL THEN v.payment_type ELSE last.payment_type END AS payment_type FROM ({plain(VISITS_HELD)}) v LEFT JOIN last ON appointment = id""")
def load_billing_bookings(t: Tables):
    return billing_load(t).booking_rows


@query(f"""{SQL_BILLING}, i AS (
SELECT exam_id AS record_id, 'exam_datetime' AS field, 'timestamp_parse_failed' AS reason, exam_date AS source_raw FROM r WHERE exam_date = 'soon'
UNION ALL SELECT exam_id, 'total', 'numeric_parse_failed', total FROM r WHERE total = 'abc'
UNION ALL SELECT exam_id, 'patient', 'patient_not_resolved', cust_key FROM r WHERE cust_key NOT IN (SELECT old_id FROM people)
UNION ALL SELECT exam_id, 'exam', 'exam_not_resolved', exam_id FROM r WHERE row_id NOT IN (SELECT old_exam_id FROM e)
UNION ALL SELECT CAST(id AS VARCHAR), 'location', 'location_not_resolved', CAST(place AS VARCHAR) FROM made WHERE place NOT IN (SELECT id FROM places))
SELECT record_id, field, reason, source_raw FROM i""")
def load_billing_issues(t: Tables):
    return billing_load(t).issues.select("record_id", "field", "reason", "source_raw")
