"""The booking load with all of its targets: SURVEY section O, appointment."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablebridge.plans.bookings import BookingLoad, Published
from tablebridge.plans.registry import Tables, plain, query
from tablebridge.session import new_run_folder

PHONE = "concat('08', lpad(CAST(c_custkey AS STRING), 8, '0'))"
# Urgent bookings come before the person has an id.
BOOKING_SOURCE = f"""
SELECT o_orderkey AS booking, o_orderdate AS visit_at, CASE WHEN o_orderpriority <> '1-URGENT' THEN c_name END AS pid, c_name AS first_name,
  c_mktsegment AS last_name, {PHONE} AS phone, upper(concat(' user ', o_orderpriority)) AS login, o_orderstatus AS channel
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
"""
# One segment is unknown, one is known by placeholders only, two have generated persons; of one of these the real person has another name.
BOOKING_PEOPLE = f"""
SELECT c_custkey AS id, c_name AS pid, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'INFERRED' ELSE c_name END AS first_name,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN concat('PID ', c_name) WHEN c_mktsegment = 'HOUSEHOLD' THEN 'another' ELSE c_mktsegment END AS last_name,
  CASE WHEN c_mktsegment <> 'MACHINERY' THEN {PHONE} END AS phone, false AS is_generated, 'old' AS channel
FROM {{customer}} WHERE c_mktsegment <> 'FURNITURE'
UNION ALL SELECT 1000000 + c_custkey, concat('K', CAST(1000000 + c_custkey AS STRING)), c_name, c_mktsegment, {PHONE}, true, 'old'
FROM {{customer}} WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD')
"""
BOOKING_TARGET = """
SELECT o_orderkey + 7 AS id, o_orderkey AS booking, o_orderdate AS visit_at, CAST(NULL AS BIGINT) AS user_id,
  CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') AND o_orderpriority IN ('1-URGENT', '5-LOW') THEN 1000000 + c_custkey
    WHEN o_orderpriority <> '2-HIGH' THEN c_custkey END AS patient
FROM {orders} JOIN {customer} ON o_custkey = c_custkey WHERE year(o_orderdate) < 1999
"""
USERS = "SELECT DISTINCT concat('user ', o_orderpriority) AS login, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS user_id FROM {orders} WHERE o_orderpriority <> '3-MEDIUM'"

SQL_BOOKINGS = f"""
WITH p AS ({plain(BOOKING_PEOPLE)}), s AS ({plain(BOOKING_SOURCE)}), t AS ({plain(BOOKING_TARGET)}),
made AS (SELECT (SELECT max(id) FROM p) + row_number() OVER (ORDER BY pid) AS id, pid FROM (SELECT DISTINCT pid FROM s WHERE pid IS NOT NULL AND pid NOT IN (SELECT pid FROM p))),
names AS (SELECT DISTINCT pid, first_name, last_name, phone FROM s WHERE pid IS NOT NULL),
real AS (SELECT id, pid, CASE WHEN f THEN n.first_name ELSE q.first_name END AS first_name, CASE WHEN f THEN n.last_name ELSE q.last_name END AS last_name,
    CASE WHEN f THEN n.phone ELSE q.phone END AS phone, channel
  FROM (SELECT *, first_name = 'INFERRED' AND EXISTS (FROM names WHERE names.pid = p.pid) AS f FROM p WHERE NOT is_generated
    UNION ALL SELECT id, pid, 'INFERRED', 'PID ' || pid, NULL, false, NULL, true FROM made) q LEFT JOIN names n USING (pid)),
named AS (SELECT first_name, last_name, min(id) AS id, count(*) AS n FROM real WHERE first_name <> 'INFERRED' GROUP BY ALL),
a AS (SELECT s.*, coalesce(real.id, CASE WHEN s.pid IS NULL AND named.n = 1 THEN named.id END) AS real_id FROM s LEFT JOIN real ON real.pid = s.pid
  LEFT JOIN named ON named.first_name = s.first_name AND named.last_name = s.last_name),
k AS (SELECT first_name, last_name, phone, min(booking) AS booking FROM a WHERE real_id IS NULL GROUP BY ALL),
fresh AS (SELECT (SELECT greatest((SELECT max(id) FROM p), coalesce((SELECT max(id) FROM made), 0))) + row_number() OVER (ORDER BY booking) AS id, first_name, last_name, phone FROM k
  WHERE NOT EXISTS (FROM p WHERE is_generated AND p.first_name = k.first_name AND p.last_name = k.last_name AND p.phone = k.phone)),
gen AS (SELECT id, first_name, last_name, phone FROM p WHERE is_generated UNION ALL FROM fresh),
b AS (SELECT a.* EXCLUDE (real_id), real_id, coalesce(real_id, gen.id) AS patient FROM a LEFT JOIN gen USING (first_name, last_name, phone)),
m AS (SELECT t.id, t.booking, b.visit_at, coalesce(b.user_id, t.user_id) AS user_id,
    CASE WHEN t.patient >= 1000000 AND real_id IS NOT NULL THEN real_id ELSE coalesce(t.patient, b.patient) END AS patient,
    CASE WHEN t.patient >= 1000000 AND real_id IS NOT NULL THEN 'relinked' WHEN t.patient IS NULL OR b.user_id IS NOT NULL THEN 'updated' ELSE 'unchanged' END AS merge_action
  FROM t JOIN (SELECT b.*, u.user_id FROM b LEFT JOIN ({plain(USERS)}) u ON lower(u.login) = lower(trim(b.login))) b USING (booking)
  UNION ALL SELECT (SELECT max(id) FROM t) + row_number() OVER (ORDER BY booking), booking, visit_at, user_id, patient, 'inserted'
  FROM (SELECT b.*, u.user_id FROM b LEFT JOIN ({plain(USERS)}) u ON lower(u.login) = lower(trim(b.login))) WHERE booking NOT IN (SELECT booking FROM t)),
last AS (SELECT patient AS id, arg_max(channel, (visit_at, booking)) AS channel FROM b GROUP BY 1)"""


def booking_load(t: Tables) -> BookingLoad:
    return BookingLoad(t.derive(BOOKING_SOURCE), t.derive(BOOKING_TARGET), t.derive(BOOKING_PEOPLE), t.derive(USERS), "channel")


@query(SQL_BOOKINGS + " SELECT * FROM m")
def load_bookings(t: Tables):
    return booking_load(t).booking_rows


@query(SQL_BOOKINGS + """
SELECT id, pid, first_name, last_name, phone, is_generated, coalesce(last.channel, x.channel) AS channel FROM (
  SELECT id, pid, first_name, last_name, phone, false AS is_generated, channel FROM real
  UNION ALL SELECT id, pid, first_name, last_name, phone, true, channel FROM p WHERE is_generated AND id IN (SELECT patient FROM m)
  UNION ALL SELECT id, 'K' || id, first_name, last_name, phone, true, NULL FROM fresh) x LEFT JOIN last USING (id)""")
def load_booking_people(t: Tables):
    return booking_load(t).people_rows


@query(SQL_BOOKINGS + """
SELECT 'made' AS what, id, pid FROM made UNION ALL SELECT 'generated', id, 'K' || id FROM fresh
UNION ALL SELECT 'freed', id, pid FROM p WHERE is_generated AND id NOT IN (SELECT patient FROM m WHERE patient IS NOT NULL)""")
def load_booking_parents(t: Tables):
    load = booking_load(t)
    named = lambda df, what: df.select(F.lit(what).alias("what"), "id", "pid")
    return named(load.people_made, "made").unionByName(named(load.people_generated, "generated")).unionByName(named(load.people_freed, "freed"))


@query(SQL_BOOKINGS + """
SELECT 'bookings' AS name, count(*) AS n_rows, count(DISTINCT patient) AS n_people FROM m
UNION ALL SELECT 'people', (SELECT count(*) FROM real) + (SELECT count(*) FROM p WHERE is_generated AND id IN (SELECT patient FROM m)) + (SELECT count(*) FROM fresh),
  (SELECT count(*) FROM real) + (SELECT count(*) FROM p WHERE is_generated AND id IN (SELECT patient FROM m)) + (SELECT count(*) FROM fresh)""")
def publish_bookings(t: Tables):
    # Both targets change at once; what is read back belongs together.
    store = Published(t.spark, new_run_folder(t.spark, "bookings"))
    store.publish(booking_load(t).outputs())
    counts = lambda name, key: store.read(name).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_people"))
    return counts("bookings", "patient").unionByName(counts("people", "id"))
