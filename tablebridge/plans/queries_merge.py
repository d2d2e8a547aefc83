"""Write modes: SURVEY section E. Most merge the same nightly source into the same target."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablebridge.operators import ids, merge
from tablebridge.operators.dedup import distinct_on
from tablebridge.operators.merge import MergeSpec
from tablebridge.operators.skew import spread
from tablebridge.plans.inputs import KNOWN_CUSTOMERS, ORDERS_SOURCE, ORDERS_TARGET, PEOPLE, WHOLE_TARGET
from tablebridge.plans.registry import Tables, plain, query

col = F.col
ORDERS = MergeSpec(keys=["order_key"], id_col="id")

CTE = f"""WITH t AS ({plain(ORDERS_TARGET)}), s AS ({plain(ORDERS_SOURCE)}),
fresh AS (SELECT (SELECT max(id) FROM t) + row_number() OVER (ORDER BY order_key) AS id, order_key, cust_key, total, status,
  NULL AS note, 'inserted' AS merge_action FROM s WHERE order_key NOT IN (SELECT order_key FROM t))"""


def merged_sql(cust: str, total: str, status: str, note: str = "t.note", action: str | None = None) -> str:
    """Checking SQL of an update-and-insert merge, given the new value of each column."""
    same = f"({cust}) IS NOT DISTINCT FROM t.cust_key AND ({total}) IS NOT DISTINCT FROM t.total AND ({status}) IS NOT DISTINCT FROM t.status"
    action = action or f"CASE WHEN {same} THEN 'unchanged' ELSE 'updated' END"
    hit = "s.order_key IS NOT NULL"
    return f"""{CTE}
SELECT t.id, t.order_key, CASE WHEN {hit} THEN {cust} ELSE t.cust_key END AS cust_key,
  CASE WHEN {hit} THEN {total} ELSE t.total END AS total, CASE WHEN {hit} THEN {status} ELSE t.status END AS status,
  CASE WHEN {hit} THEN {note} ELSE t.note END AS note, CASE WHEN {hit} THEN {action} ELSE 'kept' END AS merge_action
FROM t LEFT JOIN s USING (order_key) UNION ALL SELECT * FROM fresh"""


def sides(t: Tables):
    return t.derive(ORDERS_TARGET), t.derive(ORDERS_SOURCE)


@query(f"{CTE} SELECT *, 'kept' AS merge_action FROM t UNION ALL SELECT * FROM fresh")
def merge_insert_only(t: Tables):
    return merge.merge_insert_only(*sides(t), ORDERS)


@query(merged_sql("s.cust_key", "s.total", "s.status", action="'updated'"))
def merge_overwrite(t: Tables):
    return merge.merge_overwrite(*sides(t), ORDERS)


@query(merged_sql("s.cust_key", "s.total", "s.status"))
def merge_if_changed(t: Tables):
    return merge.merge_if_changed(*sides(t), ORDERS)


@query(merged_sql("coalesce(t.cust_key, s.cust_key)", "coalesce(t.total, s.total)", "coalesce(t.status, s.status)",
                  action="CASE WHEN t.cust_key IS NULL AND s.cust_key IS NOT NULL THEN 'filled' ELSE 'unchanged' END"))
def fill_null_only(t: Tables):
    return merge.fill_null_only(*sides(t), ORDERS)


@query(merged_sql("coalesce(s.cust_key, t.cust_key)", "coalesce(s.total, t.total)", "coalesce(s.status, t.status)"))
def prefer_source_keep_target(t: Tables):
    return merge.prefer_source_keep_target(*sides(t), ORDERS)


@query(merged_sql("coalesce(t.cust_key, s.cust_key)", "CASE WHEN t.note = 'seen' AND t.status <> 'F' THEN s.total ELSE t.total END",
                  "CASE WHEN t.status = 'N' THEN s.status ELSE t.status END"))
def column_policy_merge(t: Tables):
    policies = {
        "cust_key": merge.only_if_null,
        "total": merge.if_condition((col("note") == "seen") & (col("status") != "F")),
        "status": merge.only_if("N"),
    }
    return merge.column_policy_merge(*sides(t), MergeSpec(["order_key"], "id", policies=policies))


@query(merged_sql("s.cust_key", "s.total", "s.status", "NULL", "'replaced'"))
def replace_keep_id(t: Tables):
    return merge.replace_keep_id(*sides(t), ORDERS)


ARRIVED_PEOPLE = "SELECT c_name AS pid, concat('Given ', c_name) AS first_name, c_mktsegment AS last_name FROM {customer}"
STORED_PEOPLE = f"SELECT * FROM ({PEOPLE}) WHERE id < 1000000 AND last_name <> 'FURNITURE'"


@query(f"""
WITH t AS ({plain(STORED_PEOPLE)}), s AS ({plain(ARRIVED_PEOPLE)})
SELECT t.id, t.pid, t.old_db_id, CASE WHEN t.first_name = 'INFERRED' THEN s.first_name ELSE t.first_name END AS first_name,
  CASE WHEN t.first_name = 'INFERRED' THEN s.last_name ELSE t.last_name END AS last_name,
  CASE WHEN t.first_name = 'INFERRED' THEN 'upgraded' ELSE 'unchanged' END AS merge_action FROM t JOIN s USING (pid)
UNION ALL SELECT (SELECT max(id) FROM t) + row_number() OVER (ORDER BY pid), pid, NULL, first_name, last_name, 'inserted'
FROM s WHERE pid NOT IN (SELECT pid FROM t)""")
def upgrade_placeholder(t: Tables):
    return merge.upgrade_placeholder(
        t.derive(STORED_PEOPLE), t.derive(ARRIVED_PEOPLE), MergeSpec(["pid"], "id"), col("first_name") == "INFERRED"
    )


@query(f"""
WITH t AS ({plain(KNOWN_CUSTOMERS)}) SELECT (SELECT max(id) FROM t) + row_number() OVER (ORDER BY c_name) AS id, c_name AS pid
FROM customer WHERE c_name NOT IN (SELECT pid FROM t)""")
def assign_ids(t: Tables):
    known = t.derive(KNOWN_CUSTOMERS)
    fresh = t.customer.select(col("c_name").alias("pid")).join(known.select("pid"), "pid", "left_anti")
    return ids.assign_ids(fresh, [col("pid")], known, "id").select("id", "pid")


# Lines of finished orders come anew; those without quantity or price payload are not stored.
NEW_LINES = """
SELECT l_orderkey, l_linenumber AS line_no, CASE WHEN l_quantity > 10 THEN l_partkey END AS part,
  CASE WHEN l_quantity > 10 THEN l_suppkey END AS supplier, CASE WHEN l_quantity > 25 THEN l_extendedprice END AS price
FROM {lineitem}
"""
OLD_LINES = """
SELECT l_orderkey * 10 + l_linenumber AS line_id, l_orderkey, CAST(min(l_partkey) AS BIGINT) AS part, CAST(min(l_suppkey) AS BIGINT) AS supplier,
  min(l_extendedprice) AS price FROM {lineitem} GROUP BY l_orderkey, l_linenumber
"""


@query(f"""
WITH old AS ({plain(OLD_LINES)}), p AS (SELECT o_orderkey AS l_orderkey FROM orders WHERE o_orderstatus = 'F'),
n AS (SELECT (SELECT max(line_id) FROM old) + row_number() OVER (ORDER BY l_orderkey, part, supplier, price NULLS FIRST) AS line_id,
   l_orderkey, part, supplier, price FROM ({plain(NEW_LINES)}) WHERE part IS NOT NULL AND l_orderkey IN (SELECT l_orderkey FROM p))
SELECT 'line' AS kind, line_id, l_orderkey, part, supplier, price FROM old WHERE l_orderkey NOT IN (SELECT l_orderkey FROM p)
UNION ALL SELECT 'line', line_id, l_orderkey, part, supplier, price FROM n
UNION ALL SELECT 'pointer', min(n.line_id), p.l_orderkey, NULL, NULL, NULL FROM p LEFT JOIN n USING (l_orderkey) GROUP BY p.l_orderkey""")
def replace_children(t: Tables):
    parents = t.orders.filter("o_orderstatus = 'F'").select(col("o_orderkey").alias("l_orderkey"))
    # One shuffle serves grouping the lines and comparing them with the parents.
    lines = t.derive(OLD_LINES, lineitem=spread(t.lineitem, ["l_orderkey"], t.lineitem.count()))
    rows, pointers = merge.replace_children(
        lines, parents, t.derive(NEW_LINES), "l_orderkey", ["part", "supplier", "price"], "line_id"
    )
    links = pointers.select(F.lit("pointer").alias("kind"), col("child_pointer").alias("line_id"), "l_orderkey")
    return rows.withColumn("kind", F.lit("line")).unionByName(links, allowMissingColumns=True)


@query("""
SELECT event_id, user_id, event_type FROM events WHERE ts < TIMESTAMP '2024-01-15'
UNION ALL SELECT event_id, user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-10'""")
def append_log(t: Tables):
    at = lambda d: F.lit(d).cast("timestamp_ntz")
    columns = ["event_id", "user_id", "event_type"]
    loaded = t.events.filter(col("ts") < at("2024-01-15")).select(columns)
    arrived = t.events.filter(col("ts") >= at("2024-01-10")).select(columns)
    return merge.append_log(loaded, arrived)


@query("""
SELECT c_custkey, coalesce((SELECT max_by(event_type, (ts, event_id)) FROM events WHERE user_id = c_custkey), c_mktsegment) AS activity
FROM customer""")
def last_wins_attribute(t: Tables):
    parents = t.customer.select("c_custkey", col("c_mktsegment").alias("activity"))
    rows = t.events.select(col("user_id").alias("c_custkey"), "event_type", "ts", "event_id")
    return merge.last_wins_attribute(parents, rows, "c_custkey", "event_type", [col("ts"), col("event_id")], "activity")


@query("""
SELECT o_orderkey, l_partkey AS last_part, l_shipdate AS last_ship FROM orders LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_shipdate DESC NULLS LAST, l_partkey DESC) AS rn FROM lineitem)
ON l_orderkey = o_orderkey AND rn = 1""")
def latest_child_to_parent(t: Tables):
    parents = t.orders.select(
        "o_orderkey", F.lit(None).cast("bigint").alias("last_part"), F.lit(None).cast("timestamp_ntz").alias("last_ship")
    )
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    order = [-col("l_linenumber"), -F.unix_date(F.to_date("l_shipdate")), -col("l_partkey")]
    return merge.latest_child_to_parent(
        parents, lines, "o_orderkey", order, {"last_part": "l_partkey", "last_ship": "l_shipdate"}
    )


@query("""
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' AND c_nationkey > 0 THEN n_name WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS region_name
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""")
def backfill_from_lookup(t: Tables):
    rows = t.customer.select(
        "c_custkey", "c_nationkey", F.when(col("c_mktsegment") != "BUILDING", col("c_mktsegment")).alias("region_name")
    )
    return merge.backfill_from_lookup(rows, t.nation, "c_nationkey", "n_nationkey", "n_name", "region_name").drop("c_nationkey")


COMPANIONS = "SELECT event_id AS work_id, event_id AS order_key, 'old' AS status FROM {events} WHERE event_type = 'purchase'"


@query(f"""
WITH c AS ({plain(COMPANIONS)}), m AS (SELECT (SELECT max(work_id) FROM c) + row_number() OVER (ORDER BY o_orderkey) AS work_id,
  o_orderkey AS order_key, '3' AS status, CASE WHEN o_custkey < 100 THEN o_custkey ELSE 1 END AS location,
  o_orderdate - INTERVAL 7 HOUR AS made_at FROM orders WHERE o_orderkey NOT IN (SELECT order_key FROM c))
SELECT o_orderkey AS order_key, coalesce(c.work_id, m.work_id) AS work_id, m.status, m.location, m.made_at FROM orders
LEFT JOIN c ON c.order_key = o_orderkey LEFT JOIN m ON m.order_key = o_orderkey""")
def create_companion(t: Tables):
    from tablebridge.functions.clean import wall_clock_to_instant
    from tablebridge.operators.skew import left_lookup

    parents = t.orders.withColumnRenamed("o_orderkey", "order_key")
    linked, made = merge.create_companion(
        parents, t.derive(COMPANIONS), "order_key", "order_key", "work_id",
        {
            "status": F.lit("3"),
            "location": F.when(col("o_custkey") < 100, col("o_custkey")).otherwise(F.lit(1)),
            "made_at": wall_clock_to_instant(F.coalesce(F.lit(None).cast("timestamp_ntz"), col("o_orderdate")), "Asia/Bangkok"),
        },
    )
    return left_lookup(linked.select("order_key", "work_id"), made.drop("work_id"), ["order_key"])


# Bills with gaps: totals, payment method, invoice and overtime flags to be derived.
BILLS = """
SELECT o_orderkey AS bill, o_totalprice AS total,
  CASE WHEN o_orderstatus = 'P' THEN o_totalprice - 1 END AS receipt,
  CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS last_total, CAST(NULL AS DOUBLE) AS final_total,
  CASE WHEN o_orderpriority = '2-HIGH' THEN '0' WHEN o_orderpriority = '1-URGENT' THEN '2' END AS method,
  CAST(NULL AS BOOLEAN) AS is_invoice, CAST(NULL AS BOOLEAN) AS is_overtime,
  CAST(o_custkey % 3 + 1 AS STRING) AS care, CAST(o_custkey % 9 AS STRING) AS right_code, CASE WHEN o_custkey % 7 > 0 THEN o_orderdate END AS visit_at,
  o_custkey % 30 AS slot, o_custkey % 4 AS location FROM {orders}
"""
OVERTIME_SLOTS, EXEMPT_LOCATION = (3, 11, 19), 2


@query(f"""
WITH b AS (SELECT *, coalesce(nullif(method, '0'), CASE WHEN care = '2' OR (care = '1' AND right_code BETWEEN '3' AND '6') THEN '3'
    WHEN care = '1' AND right_code IN ('1', '2') THEN '1' ELSE '2' END) AS pay FROM ({plain(BILLS)}))
SELECT bill, coalesce(last_total, total) AS last_total, coalesce(receipt, total) AS final_total, pay AS method, pay = '3' AS is_invoice,
  CASE WHEN visit_at IS NOT NULL THEN location <> {EXEMPT_LOCATION} AND (slot IN {OVERTIME_SLOTS} OR isodow(visit_at) IN (6, 7)) END AS is_overtime FROM b""")
def derive_if_null(t: Tables):
    from tablebridge.functions.clean import is_weekend
    from tablebridge.plans.loads import payment_method

    bills = t.derive(BILLS).withColumn("method", F.nullif(col("method"), F.lit("0")))
    method = F.coalesce(col("method"), payment_method(col("care"), col("right_code")))
    rules = {
        "last_total": col("total"),
        "final_total": F.coalesce(col("receipt"), col("total")),
        "method": method,
        "is_invoice": method == "3",
        "is_overtime": F.when(
            col("visit_at").isNotNull(),
            (col("location") != EXEMPT_LOCATION) & (col("slot").isin(*OVERTIME_SLOTS) | is_weekend(col("visit_at"))),
        ),
    }
    return merge.derive_if_null(bills, rules).select("bill", *rules)


@query(f"""
SELECT order_key, CASE WHEN turns THEN 'done' ELSE status END AS status, CASE WHEN turns THEN 'updated' ELSE 'kept' END AS merge_action
FROM (SELECT order_key, status, status = 'N' AND order_key IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS turns
  FROM ({plain(WHOLE_TARGET)}))""")
def exists_complete(t: Tables):
    returned = t.lineitem.filter("l_returnflag = 'R'")
    return merge.exists_complete(
        t.derive(WHOLE_TARGET).select("order_key", "status"), returned, "order_key", "l_orderkey", "status", "N", "done"
    )


ARRAYS = """
SELECT event_id, CASE WHEN event_type = 'click' THEN concat('[', props, ']') WHEN event_type = 'view' THEN '[1,2]' WHEN event_type = 'error' THEN '["{{free text}}"]' END AS codes FROM {events}
"""
NEW_ARRAYS = "SELECT event_id, concat('[', CAST(user_id AS STRING), ']') AS codes FROM {events} WHERE event_type <> 'signup'"


@query("""
SELECT event_id, CASE WHEN event_type = 'click' THEN '[' || props || ']' WHEN event_type <> 'signup' THEN '[' || user_id || ']' END AS codes,
  CASE WHEN event_type = 'signup' THEN 'kept' WHEN event_type = 'click' THEN 'unchanged' 
    WHEN event_type = 'view' AND '[' || user_id || ']' = '[1,2]' THEN 'unchanged' ELSE 'updated' END AS merge_action FROM events""")
def array_overwrite_unless_object(t: Tables):
    return merge.array_overwrite_unless_object(
        t.derive(ARRAYS), t.derive(NEW_ARRAYS), MergeSpec(["event_id"]), "codes"
    )


@query(f"""
WITH m AS ({merged_sql("s.cust_key", "s.total", "s.status")}) SELECT merge_action, count(*)::BIGINT AS rows FROM m GROUP BY 1
UNION ALL SELECT CASE status WHEN 'P' THEN 'skipped' ELSE 'duplicate' END, count(*)::BIGINT FROM ({plain(ORDERS_SOURCE)}) WHERE status IN ('P', 'F') GROUP BY 1""")
def merge_metrics(t: Tables):
    target, source = sides(t)
    unkeyed = source.filter("status = 'P'").withColumn("order_key", F.lit(None).cast("bigint"))
    read = source.unionByName(unkeyed).unionByName(source.filter("status = 'F'"))
    loaded = distinct_on(read.filter("order_key is not null"), ["order_key"], [col("total")])
    return merge.merge_metrics(merge.merge_if_changed(target, loaded, ORDERS), read, ["order_key"])

