"""Reports with collections of two levels, and prior results with the category of their exam: SURVEY section O."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablebridge.operators import document, profile
from tablebridge.operators.skew import left_lookup
from tablebridge.plans import loads
from tablebridge.plans.registry import Tables, query

col = F.col
#: Small parts, so that lists continue in further ones.
LEAVES, IDS, INTERVIEWS = 7, 3, 3
BE = "strftime({0}, '%d/%m/') || (year({0}) + 543)"


@query(f"""
WITH target AS (SELECT c_custkey, max(CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderdate AS DATE) END) AS day FROM customer JOIN orders ON o_custkey = c_custkey
  GROUP BY 1 HAVING bool_or(o_orderstatus = 'F') AND NOT bool_or(o_orderkey IN (SELECT user_id FROM events WHERE event_type = 'error'))),
past AS (SELECT c_custkey, o.* FROM target JOIN orders o ON o_custkey = c_custkey AND CAST(o_orderdate AS DATE) <= day),
dates AS (SELECT c_custkey, max(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate END) AS u, max(CASE WHEN o_orderpriority = '5-LOW' THEN o_orderdate END) AS l FROM past GROUP BY 1),
newest AS (SELECT c_custkey, o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM past),
interview AS (SELECT c_custkey, o_orderkey FROM newest WHERE n <= {INTERVIEWS} QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderpriority <> '2-HIGH', n) = 1),
leaf AS (SELECT o_custkey, o_orderkey, o_orderstatus, l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS n
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE o_custkey IN (SELECT c_custkey FROM target)),
per_order AS (SELECT o_custkey, (n - 1) // {LEAVES} AS part, o_orderkey, any_value(o_orderstatus) AS o_orderstatus, min(n) AS place,
  coalesce(list({{'l_linenumber': l_linenumber, 'l_partkey': l_partkey}} ORDER BY n) FILTER (l_orderkey IS NOT NULL), []) AS lines FROM leaf GROUP BY 1, 2, 3),
orders_of AS (SELECT o_custkey AS k, part, list({{'o_orderkey': o_orderkey, 'o_orderstatus': o_orderstatus, 'lines': lines}} ORDER BY place) AS orders FROM per_order GROUP BY 1, 2),
events_of AS (SELECT user_id AS k, (n - 1) // {LEAVES} AS part, list({{'event_id': event_id}} ORDER BY n) AS visits FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events
  WHERE user_id IN (SELECT c_custkey FROM target)) GROUP BY 1, 2),
both_of AS (SELECT k, part, orders, visits FROM orders_of FULL JOIN events_of USING (k, part))
SELECT c_custkey, part, to_json({{'c_custkey': c_custkey, 'c_name': c_name, 'nation': n_name, 'history': concat_ws(chr(10), CASE WHEN u IS NOT NULL THEN 'Urgent dated ' || {BE.format('u')} END, CASE WHEN l IS NOT NULL THEN 'Low dated ' || {BE.format('l')} END),
  'interview': coalesce(CAST(interview.o_orderkey AS VARCHAR), 'none'), 'orders': coalesce(orders, []), 'visits': coalesce(visits, [])}}) AS document
FROM target JOIN customer USING (c_custkey) JOIN nation ON n_nationkey = c_nationkey JOIN both_of ON k = c_custkey LEFT JOIN dates USING (c_custkey) LEFT JOIN interview USING (c_custkey)""")
def report_history_nested(t: Tables):
    """A report of each customer who has a finished order and no stored report: orders with their lines, visits, history up to the latest open order."""
    general = t.orders.select("o_custkey", "o_orderkey")
    flags = document.eligible_targets(
        t.customer, "c_custkey", [(t.orders.filter("o_orderstatus = 'F'"), "o_custkey")], general, "o_custkey", "o_orderkey",
        t.events.filter("event_type = 'error'"), "user_id",
    )
    targets = t.customer.join(flags.filter("is_target").select("c_custkey"), "c_custkey", "left_semi").select("c_custkey", "c_name", "c_nationkey")
    day = t.orders.filter("o_orderstatus = 'O'").groupBy(col("o_custkey").alias("c_custkey")).agg(F.to_date(F.max("o_orderdate")).alias("day"))
    named = left_lookup(targets, t.nation.select(col("n_nationkey").alias("c_nationkey"), col("n_name").alias("nation")), ["c_nationkey"])
    probes = left_lookup(named, day, ["c_custkey"]).withColumn("party", col("c_custkey"))
    marks = {"urgent": "1-URGENT", "low": "5-LOW"}
    past = t.orders.select(
        col("o_custkey").alias("party"), "o_orderdate", "o_orderkey", "o_orderpriority",
        *[F.when(col("o_orderpriority") == v, col("o_orderdate")).alias(n) for n, v in marks.items()],
    )
    dated = document.max_per_column(probes, past, "party", "day", "o_orderdate", list(marks))
    asked = document.top_n_history(
        dated, past, "party", "day", "o_orderdate", "o_orderkey", INTERVIEWS, lambda x: x["o_orderpriority"] == "2-HIGH", ["o_orderkey", "o_orderpriority"]
    )
    parents = asked.withColumn("history", document.history_lines([("Urgent dated", col("urgent")), ("Low dated", col("low"))])).withColumn(
        "interview", F.coalesce(col("history_o_orderkey").cast("string"), F.lit("none"))
    )
    lines = document.ChildCollection("lines", t.lineitem, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], ["l_linenumber", "l_partkey"])
    collections = [
        document.NestedCollection("orders", t.orders, "o_custkey", ["o_orderdate"], ["o_orderkey", "o_orderstatus"], "o_orderkey", lines),
        document.ChildCollection("visits", t.events, "user_id", ["event_id"], ["event_id"]),
    ]
    return document.build_snapshot_doc(parents, "c_custkey", collections, ["c_custkey", "c_name", "nation", "history", "interview"], max_items=LEAVES)


@query(f"""
WITH g AS (SELECT l_orderkey, max(l_shipdate) AS latest, count(*) AS members, list(l_partkey ORDER BY l_partkey) AS ids FROM lineitem GROUP BY 1 HAVING bool_or(l_returnflag = 'R'))
SELECT l_orderkey, part, list_aggregate(ids[{IDS} * part + 1:{IDS} * (part + 1)], 'string_agg', ',') AS ids, latest, members
FROM (SELECT *, unnest(range(0, (len(ids) + {IDS} - 1) // {IDS})) AS part FROM g)""")
def group_ids_having_any(t: Tables):
    parts = profile.group_ids_having_any(t.lineitem, ["l_orderkey"], col("l_returnflag") == "R", "l_shipdate", "l_partkey", IDS)
    return parts.withColumn("ids", F.array_join("ids", ","))


@query(f"""
WITH se AS (SELECT l_orderkey AS exam_id, max(l_shipdate) AS exam_at, any_value(o_custkey) AS party, any_value(o_orderkey + 1) AS appointment,
  list({{'finding_id': l_partkey}} ORDER BY l_partkey) AS found FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1 HAVING bool_or(l_returnflag = 'R')),
g AS (SELECT user_id AS exam_id, event_type AS category FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1),
a AS (SELECT o_orderkey AS id, o_custkey, o_orderdate, CASE WHEN o_orderstatus = 'P' THEN 'view' END AS category, o_orderpriority <> '3-MEDIUM' AS migrated FROM orders),
picked AS (SELECT a.*, CASE WHEN migrated THEN (SELECT exam_id FROM se WHERE se.party = a.o_custkey AND se.exam_at < date_trunc('day', a.o_orderdate) AND se.appointment IS DISTINCT FROM a.id
  ORDER BY se.exam_at DESC, se.exam_id DESC LIMIT 1) END AS exam FROM a),
parts AS (SELECT exam_id, found, unnest(range(0, (len(found) + {IDS} - 1) // {IDS})) AS part FROM se)
SELECT id, picked.exam AS picked_exam, coalesce(part, 0) AS part, to_json(found[{IDS} * part + 1:{IDS} * (part + 1)]) AS payload,
  CASE WHEN picked.exam IS NULL THEN picked.category ELSE g.category END AS category, picked.exam IS NOT NULL AS is_updated
FROM picked LEFT JOIN parts ON parts.exam_id = exam LEFT JOIN g ON g.exam_id = exam""")
def prior_result_category(t: Tables):
    appointments = t.orders.select(
        col("o_orderkey").alias("id"), col("o_custkey").alias("party"), col("o_orderdate").alias("at"), F.lit(None).cast("string").alias("payload"),
        F.when(col("o_orderstatus") == "P", "view").alias("category"), (col("o_orderpriority") != "3-MEDIUM").alias("is_migrated"),
    )
    exams = t.orders.select(col("o_orderkey").alias("exam_id"), col("o_custkey").alias("party"), (col("o_orderkey") + 1).alias("appointment"))
    findings = t.lineitem.select(
        col("l_orderkey").alias("exam_id"), col("l_shipdate").alias("found_at"), col("l_partkey").alias("finding_id"), "l_returnflag"
    )
    general = t.events.select(col("user_id").alias("exam_id"), col("event_id").alias("general_id"), col("event_type").alias("category"))
    filled = loads.prior_result_with_category(appointments, exams, findings, general, col("l_returnflag") == "R", IDS)
    return filled.select("id", "picked_exam", "part", "payload", "category", "is_updated")
