"""Profiles, paging, sets, quality and comparison: SURVEY sections F to J."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablebridge.functions import clean as c
from tablebridge.functions import keys as k
from tablebridge.operators import compare, document, page, profile, quality, sets
from tablebridge.plans.inputs import (
    KNOWN_CUSTOMERS,
    ORDERS_COPY,
    ORDERS_SOURCE,
    ORDERS_TARGET,
    RAW_ORDERS,
    WHOLE_SOURCE,
    WHOLE_TARGET,
    sql_blank,
    sql_strip,
)
from tablebridge.plans.queries_rows import SQL_NUMBER, SQL_PRICE, sql_era
from tablebridge.plans.registry import Tables, plain, query

col = F.col
RAW, KNOWN, COPY = plain(RAW_ORDERS), plain(KNOWN_CUSTOMERS), plain(ORDERS_COPY)

# --- F: aggregations --------------------------------------------------------------------------

SQL_SUMMARY = """CASE WHEN {n} = 0 THEN '1' WHEN {n} = 1 THEN '2' ELSE '3' END AS {x},
  CASE WHEN {n} = 0 THEN 'No {x}' WHEN {n} = 1 THEN 'Single {x}' ELSE 'Multiple {x}' END AS {x}_des,
  CASE WHEN {n} > 1 THEN CAST({n} AS VARCHAR) ELSE '' END AS {x}_number"""


@query(f"""
SELECT o_orderkey, {SQL_SUMMARY.format(x='mass', n='m')}, {SQL_SUMMARY.format(x='cal', n='c')} FROM (
  SELECT o_orderkey, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') AS m,
    (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'A') AS c FROM orders)""")
def child_count_summary(t: Tables):
    children = {
        "mass": (t.lineitem.filter("l_returnflag = 'R'"), "l_orderkey"),
        "cal": (t.lineitem.filter("l_returnflag = 'A'"), "l_orderkey"),
    }
    labels = {x: (f"No {x}", f"Single {x}", f"Multiple {x}") for x in children}
    return profile.child_count_summary(t.orders.select("o_orderkey"), "o_orderkey", children, labels)


@query("""
SELECT o_custkey, part, to_json(list({'o_orderkey': o_orderkey, 'o_orderstatus': o_orderstatus} ORDER BY rn)) AS items FROM (
  SELECT *, CAST(floor((rn - 1) / 1000) AS INTEGER) AS part FROM (SELECT o_custkey, o_orderkey, o_orderstatus,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)) GROUP BY o_custkey, part""")
def group_to_struct_array(t: Tables):
    grouped = document.group_to_struct_array(
        t.orders, ["o_custkey"], [col("o_orderdate"), col("o_orderkey")], ["o_orderkey", "o_orderstatus"], max_items=1000
    )
    return grouped.withColumn("items", F.to_json("items"))


@query("""
SELECT l_orderkey, max(l_shipdate) AS latest, count(*)::BIGINT AS members FROM lineitem GROUP BY 1 HAVING bool_or(l_returnflag = 'R')""")
def group_having_any(t: Tables):
    return profile.group_having_any(t.lineitem, ["l_orderkey"], col("l_returnflag") == "R", "l_shipdate")


@query("""
SELECT count(*)::BIGINT AS total, (count(*) FILTER (WHERE o_orderstatus = 'P'))::BIGINT AS open_orders,
  (count(*) FILTER (WHERE o_totalprice > 250000))::BIGINT AS large_orders, count(DISTINCT o_custkey)::BIGINT AS customers FROM orders""")
def filtered_counts(t: Tables):
    return profile.filtered_counts(
        t.orders, {"open_orders": col("o_orderstatus") == "P", "large_orders": col("o_totalprice") > 250000},
        {"customers": "o_custkey"},
    )


@query(f"""
SELECT 'customer' AS relation, count(*)::BIGINT AS with_key, count(k.id)::BIGINT AS resolved FROM orders LEFT JOIN ({KNOWN}) k ON k.id = o_custkey
UNION ALL SELECT 'nation', count(k.id)::BIGINT, count(k.c_nationkey)::BIGINT FROM orders LEFT JOIN ({KNOWN}) k ON k.id = o_custkey""")
def resolution_rate(t: Tables):
    known = t.derive(KNOWN_CUSTOMERS).select(col("id").alias("o_custkey"), "id", "c_nationkey")
    rows = t.orders.select("o_custkey").join(known, "o_custkey", "left")
    rows = rows.select(col("o_custkey").cast("string").alias("old_id"), "id", col("id").cast("string").alias("found"), "c_nationkey")
    return profile.resolution_rate(rows, {"customer": ("old_id", "id"), "nation": ("found", "c_nationkey")})


def order_rules():
    number = c.to_int_strict(col("order_key"))
    priority, cut = c.clamp_text(col("priority"), 8)
    return [
        quality.FieldRule("ordered_at", "order_date", c.be_to_timestamp(col("order_date"), 2400), "datetime_parse_failed", required=True),
        quality.FieldRule("total", "total_price", c.to_real_lenient(col("total_price")), "real_parse_failed", required=True),
        quality.FieldRule("is_done", "is_done", c.to_bool(col("is_done"), "sql"), "boolean_parse_failed"),
        quality.FieldRule("priority", "priority", priority, "text_truncated", flag=cut),
        quality.FieldRule("order_key", "order_key", number, "invalid_key", flag=c.norm_key(col("order_key")).isNull()),
    ]


SQL_ISSUES = f"""
SELECT CAST(row_id AS VARCHAR) AS record_id, 'ordered_at' AS field, 'datetime_parse_failed' AS reason, order_date AS source_raw, NULL AS mapped
  FROM ({RAW}) WHERE {sql_era(2400)} IS NULL
UNION ALL SELECT CAST(row_id AS VARCHAR), 'total', 'real_parse_failed', total_price, NULL
  FROM (SELECT *, {SQL_NUMBER} AS n FROM ({RAW})) WHERE {SQL_PRICE} IS NULL
UNION ALL SELECT CAST(row_id AS VARCHAR), 'is_done', 'boolean_parse_failed', is_done, NULL FROM ({RAW}) WHERE is_done = 'P'
UNION ALL SELECT CAST(row_id AS VARCHAR), 'priority', 'text_truncated', priority, left(priority, 8) FROM ({RAW}) WHERE length(priority) > 8
UNION ALL SELECT CAST(row_id AS VARCHAR), 'order_key', 'invalid_key', order_key, NULL FROM ({RAW}) WHERE {sql_strip('order_key')} = ''"""


@query(f"SELECT field, reason, count(*)::BIGINT AS issues FROM ({SQL_ISSUES}) GROUP BY ALL")
def issue_summary(t: Tables):
    return profile.issue_summary(quality.field_issues(t.derive(RAW_ORDERS), col("row_id"), order_rules()))


@query("""
SELECT column_name, value, count(*)::BIGINT AS n, min(price) AS min_price, max(price) AS max_price FROM (
  SELECT 'l_returnflag' AS column_name, l_returnflag AS value, l_extendedprice AS price FROM lineitem
  UNION ALL SELECT 'l_linestatus', l_linestatus, l_quantity FROM lineitem) GROUP BY ALL""")
def value_profile(t: Tables):
    return profile.value_profile(t.lineitem, {"l_returnflag": "l_extendedprice", "l_linestatus": "l_quantity"})


@query("""
SELECT l_returnflag, count(*)::BIGINT AS n, 0::BIGINT AS a_null, count_if(l_discount = l_tax)::BIGINT AS a_eq_b, count_if(l_discount < l_tax)::BIGINT AS a_lt_b,
  count_if(l_discount > l_tax)::BIGINT AS a_gt_b, count_if(l_discount = 0)::BIGINT AS a_zero, round(avg(l_discount), 6) AS avg_a, round(avg(l_tax), 6) AS avg_b
FROM lineitem GROUP BY 1""")
def group_compare_profile(t: Tables):
    out = profile.group_compare_profile(t.lineitem, ["l_returnflag"], "l_discount", "l_tax")
    return out.withColumns({n: F.round(n, 6) for n in ("avg_a", "avg_b")})


@query("""
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(19,4)) AS head_total, s AS line_sum, s - CAST(o_totalprice AS DECIMAL(19,4)) AS gap FROM orders JOIN (
  SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(19,4))) AS s FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
WHERE s <> CAST(o_totalprice AS DECIMAL(19,4)) ORDER BY abs(gap) DESC, o_orderkey LIMIT 100""")
def sum_check(t: Tables):
    return profile.sum_check(t.orders, "o_orderkey", "o_totalprice", t.lineitem, "l_orderkey", col("l_extendedprice"), 100)


@query("""
SELECT 'label' AS finding, p_brand AS code, p_type AS label, count(*)::BIGINT AS n FROM part GROUP BY ALL
UNION ALL SELECT CASE WHEN code IS NULL THEN 'children_without_parent' WHEN code = CASE WHEN n = 0 THEN '1' WHEN n = 1 THEN '2' ELSE '3' END THEN 'code_fits'
    WHEN n = 0 THEN 'code_without_children' ELSE 'code_differs' END, NULL, NULL, count(*)::BIGINT
  FROM (SELECT p.code, coalesce(l.n, 0) AS n FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '2' ELSE '3' END AS code FROM orders WHERE o_orderpriority <> '5-LOW') p
    FULL JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) l ON l_orderkey = o_orderkey) GROUP BY 1""")
def code_label_freq(t: Tables):
    labels = profile.code_label_freq(t.part, "p_brand", "p_type").withColumn("finding", F.lit("label"))
    parents = t.orders.filter("o_orderpriority <> '5-LOW'")
    code = F.when(col("o_orderstatus") == "F", "2").otherwise("3")
    fit = profile.code_child_mismatch(
        parents, "o_orderkey", code, t.lineitem.filter("l_returnflag = 'R'"), "l_orderkey"
    )
    return labels.unionByName(fit, allowMissingColumns=True)


@query("""
SELECT e.event_id, (SELECT max(h.value) FROM events h WHERE h.user_id = e.user_id AND CAST(h.ts AS DATE) <= CAST(e.ts AS DATE) AND h.event_type = 'purchase') AS purchase,
  (SELECT max(h.value) FROM events h WHERE h.user_id = e.user_id AND CAST(h.ts AS DATE) <= CAST(e.ts AS DATE) AND h.event_type = 'error') AS error FROM events e""")
def max_per_column(t: Tables):
    history = t.events.select(
        "user_id", "ts", *[F.when(col("event_type") == n, col("value")).alias(n) for n in ("purchase", "error")]
    )
    probes = t.events.select("event_id", "user_id", F.to_date("ts").alias("day"))
    return document.max_per_column(probes, history, "user_id", "day", "ts", ["purchase", "error"]).drop("user_id", "day")


@query(f"""
SELECT count(*)::BIGINT AS source_keys, count(t.order_key)::BIGINT AS matched, (count(*) - count(t.order_key))::BIGINT AS failed,
  min(CASE WHEN t.order_key IS NULL THEN s.order_key END) AS first_failed
FROM ({plain(ORDERS_SOURCE)}) s LEFT JOIN ({plain(ORDERS_TARGET)}) t USING (order_key)""")
def load_outcome(t: Tables):
    return profile.load_outcome(t.derive(ORDERS_SOURCE), t.derive(ORDERS_TARGET), ["order_key"])


@query("SELECT event_type, count(*)::BIGINT AS n FROM events GROUP BY 1")
def category_counter(t: Tables):
    return profile.category_counter(t.events, "event_type")


# --- G: cursors and pages ---------------------------------------------------------------------

HOURLY = """
SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('hour', ts) END AS seen_at FROM {events}
"""
CURSOR = {"seen_at": "2024-01-10 05:00:00", "user_id": 60, "event_id": 0}
ORDER = ["seen_at", "user_id", "event_id"]
SQL_AFTER = """seen_at IS NOT NULL AND (seen_at > TIMESTAMP '2024-01-10 05:00:00' OR (seen_at = TIMESTAMP '2024-01-10 05:00:00'
  AND (user_id > 60 OR (user_id = 60 AND event_id > 0))))"""


def hourly(t: Tables):
    return t.derive(HOURLY).withColumn("seen_at", col("seen_at").cast("timestamp_ntz"))


@query(f"""
SELECT * FROM (SELECT * FROM ({plain(HOURLY)}) WHERE {SQL_AFTER} ORDER BY seen_at, user_id, event_id LIMIT 2000)""")
def keyset_page(t: Tables):
    return page.keyset_page(hourly(t), ORDER, CURSOR, 2000)


@query(f"""
SELECT count(*)::BIGINT AS total, count_if({SQL_AFTER})::BIGINT AS after, least(count(*) - count_if(coalesce({SQL_AFTER}, false)), 150)::BIGINT AS position FROM ({plain(HOURLY)})""")
def count_after_cursor(t: Tables):
    return page.count_after_cursor(hourly(t), ORDER, CURSOR, offset=150)


@query(f"""
SELECT * FROM (SELECT seen_at, user_id, event_id FROM ({plain(HOURLY)}) ORDER BY seen_at NULLS FIRST, user_id, event_id LIMIT 2000)
ORDER BY seen_at DESC NULLS LAST, user_id DESC, event_id DESC LIMIT 1""")
def next_cursor(t: Tables):
    return page.next_cursor(page.keyset_page(hourly(t), ORDER, None, 2000), ORDER)


@query(f"""
WITH o AS (SELECT *, row_number() OVER (ORDER BY seen_at NULLS FIRST, user_id, event_id) AS position FROM ({plain(HOURLY)}))
SELECT DISTINCT o.* FROM o JOIN o b ON b.position % 500 = 0 AND o.seen_at IS NOT DISTINCT FROM b.seen_at AND o.position > b.position""")
def boundary_tie_audit(t: Tables):
    return page.boundary_tie_audit(hourly(t), ["seen_at"], ORDER, 500)


@query("""
SELECT event_id, coalesce(list_filter(seen, lambda x: x.v > 50)[1].i, seen[1].i) AS history_event_id,
  coalesce(list_filter(seen, lambda x: x.v > 50)[1].v, seen[1].v) AS history_value FROM (
  SELECT e.event_id, (SELECT list({'i': h.event_id, 'v': h.value} ORDER BY h.ts DESC, h.event_id DESC) FROM events h
    WHERE h.user_id = e.user_id AND CAST(h.ts AS DATE) <= CAST(e.ts AS DATE))[1:5] AS seen FROM events e)""")
def top_n_history(t: Tables):
    probes = t.events.select("event_id", "user_id", F.to_date("ts").alias("day"))
    history = t.events.select("event_id", "user_id", "ts", "value")
    found = document.top_n_history(
        probes, history, "user_id", "day", "ts", "event_id", 5, lambda x: x["value"] > 50, ["event_id", "value"]
    )
    return found.select("event_id", "history_event_id", "history_value")


@query("""
SELECT max(CASE WHEN r THEN o_orderkey END) AS max_read, min(CASE WHEN NOT r THEN o_orderkey END) AS min_unread,
  max(CASE WHEN r THEN o_orderkey END) < min(CASE WHEN NOT r THEN o_orderkey END) AS is_ordered,
  (SELECT max(o_orderkey) FROM orders WHERE o_orderkey < (SELECT min(o_orderkey) FROM orders WHERE NOT (o_orderstatus <> 'P' OR o_totalprice > 400000))) AS split_key
FROM (SELECT o_orderkey, o_orderstatus <> 'P' OR o_totalprice > 400000 AS r FROM orders)""")
def split_point(t: Tables):
    return page.split_point(t.orders, "o_orderkey", (col("o_orderstatus") != "P") | (col("o_totalprice") > 400000))


@query(f"""
SELECT o_orderkey FROM orders WHERE o_orderkey < (SELECT max(order_key) FROM ({plain(ORDERS_TARGET)}))
  AND o_orderkey NOT IN (SELECT order_key FROM ({plain(ORDERS_TARGET)}))""")
def gap_ids(t: Tables):
    return page.gap_ids(t.orders, t.derive(ORDERS_TARGET).select(col("order_key").alias("o_orderkey")), "o_orderkey")


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey DESC LIMIT 1000")
def ordered_limit(t: Tables):
    return page.ordered_limit(t.orders.select("o_orderkey", "o_custkey"), [col("o_orderkey").desc()], 1000)


@query(f"""
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT order_key FROM ({plain(ORDERS_TARGET)}))""")
def cap_to_snapshot(t: Tables):
    snapshot = t.derive(ORDERS_TARGET).select(col("order_key").alias("o_orderkey"))
    return page.cap_to_snapshot(t.orders.select("o_orderkey", "o_totalprice"), snapshot, ["o_orderkey"])


# --- H: sets ----------------------------------------------------------------------------------


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(c_acctbal AS VARCHAR) AS balance FROM customer
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, CAST(s_acctbal AS VARCHAR) FROM supplier""")
def union_all(t: Tables):
    names = ["id", "name", "balance"]
    return sets.union_all(
        t.customer.select("c_custkey", "c_name", "c_acctbal").toDF(*names),
        t.supplier.select("s_suppkey", "s_name", "s_acctbal").toDF(*names),
    )


@query("""
SELECT o_custkey AS party FROM orders WHERE o_orderstatus = 'F' UNION SELECT user_id FROM events WHERE event_type = 'purchase'""")
def union_distinct(t: Tables):
    return sets.union_distinct(
        t.orders.filter("o_orderstatus = 'F'").select(col("o_custkey").alias("party")),
        t.events.filter("event_type = 'purchase'").select(col("user_id").alias("party")),
    )


@query(f"""
SELECT s.order_key, s.cust_key IS NOT DISTINCT FROM t.cust_key AND s.total IS NOT DISTINCT FROM t.total AS is_same
FROM ({plain(WHOLE_SOURCE)}) s JOIN ({plain(WHOLE_TARGET)}) t USING (order_key)""")
def null_safe_equal(t: Tables):
    s, o = t.derive(WHOLE_SOURCE).alias("s"), t.derive(WHOLE_TARGET).alias("o")
    same = k.null_safe_equal([col("s.cust_key"), col("s.total")], [col("o.cust_key"), col("o.total")])
    return s.join(o, "order_key").select("order_key", same.alias("is_same"))


PART_OLD = "SELECT p_partkey, p_name, p_size FROM {part} WHERE p_type <> 'SMALL'"
PART_NEW = """SELECT p_partkey, CASE WHEN p_size > 40 THEN concat(p_name, '!') ELSE p_name END AS p_name, p_size FROM {part} WHERE p_brand <> 'Brand#1'"""


@query(f"""
SELECT coalesce(o.p_partkey, n.p_partkey) AS p_partkey, CASE WHEN o.p_partkey IS NULL THEN 'added' WHEN n.p_partkey IS NULL THEN 'removed'
  WHEN o.p_name = n.p_name AND o.p_size = n.p_size THEN 'unchanged' ELSE 'changed' END AS status
FROM ({plain(PART_OLD)}) o FULL JOIN ({plain(PART_NEW)}) n ON o.p_partkey = n.p_partkey""")
def set_diff(t: Tables):
    return sets.set_diff(t.derive(PART_OLD), t.derive(PART_NEW), "p_partkey", ["p_name", "p_size"])


UNITS = """SELECT concat(CAST(user_id AS STRING), ':', event_type) AS unit,
  CASE WHEN event_type = 'view' THEN concat('x', CAST(user_id AS STRING)) ELSE concat(CAST(user_id AS STRING), CAST(length(event_type) AS STRING)) END AS send, event_id FROM {events}"""
HELD_UNITS = f"SELECT * FROM ({UNITS}) WHERE event_id >= 2000 AND unit NOT LIKE '%signup'"


@query(f"""
WITH s AS (SELECT unit, min(send) AS send, count(*) AS need FROM ({plain(UNITS)}) GROUP BY 1),
h AS (SELECT unit, count(*) AS have FROM ({plain(HELD_UNITS)}) GROUP BY 1)
SELECT unit, send, (need - coalesce(have, 0))::BIGINT AS missing_rows, CASE WHEN send IN (SELECT send FROM ({plain(HELD_UNITS)})) THEN 'partial'
  WHEN regexp_matches(send, '^[0-9]+$') THEN 'send' ELSE 'unsendable' END AS action FROM s LEFT JOIN h USING (unit) WHERE need > coalesce(have, 0)""")
def multiset_missing(t: Tables):
    return sets.multiset_missing(
        t.derive(UNITS), t.derive(HELD_UNITS), "unit", "send", col("send").rlike("^[0-9]+$")
    )


# --- I: data quality --------------------------------------------------------------------------


@query(SQL_ISSUES)
def field_issues(t: Tables):
    return quality.field_issues(t.derive(RAW_ORDERS), col("row_id"), order_rules())


SQL_UNRESOLVED = f"""
SELECT CAST(row_id AS VARCHAR) AS record_id, 'customer' AS field, 'customer_not_resolved' AS reason, cust_key AS source_raw FROM ({RAW})
  WHERE cust_key <> '0' AND CAST(cust_key AS BIGINT) NOT IN (SELECT id FROM ({KNOWN}))
UNION ALL SELECT CAST(row_id AS VARCHAR), 'events', 'events_not_resolved', cust_key FROM ({RAW})
  WHERE CAST(cust_key AS BIGINT) NOT IN (SELECT user_id FROM events)"""


def relations(t: Tables):
    known = t.derive(KNOWN_CUSTOMERS).select(col("id").cast("string").alias("id"))
    users = t.events.select(col("user_id").cast("string").alias("user_id")).distinct()
    return [
        quality.Relation("customer", "cust_key", known, "id", ["0"]),
        quality.Relation("events", "cust_key", users, "user_id"),
    ]


@query(SQL_UNRESOLVED)
def unresolved_relations(t: Tables):
    return quality.unresolved_relations(t.derive(RAW_ORDERS), "row_id", relations(t))


@query("""
SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE (l_orderkey, l_linenumber) NOT IN (
  SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE l_returnflag <> 'R')""")
def missing_after_load(t: Tables):
    return quality.missing_after_load(
        t.lineitem, t.lineitem.filter("l_returnflag <> 'R'"), ["l_orderkey", "l_linenumber"]
    )


@query(f"""
SELECT record_id, 0 AS part, to_json(list({{'field': field, 'reason': reason, 'source_raw': source_raw}} ORDER BY field, reason, source_raw)) AS issues
FROM (SELECT record_id, field, reason, source_raw FROM ({SQL_ISSUES}) UNION ALL ({SQL_UNRESOLVED})) GROUP BY 1""")
def issue_log(t: Tables):
    raw = t.derive(RAW_ORDERS)
    parts = [
        quality.field_issues(raw, col("row_id"), order_rules()).drop("mapped"),
        quality.unresolved_relations(raw, "row_id", relations(t)),
    ]
    return quality.issue_log(parts).withColumn("issues", F.to_json("issues"))


# Run log derived from orders: one chunk of keys per customer and run.
RUN_LOG = """
SELECT year(o_orderdate) AS run_id, CASE WHEN o_orderstatus = 'F' THEN 'ok' ELSE 'failed' END AS status,
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderpriority = '2-HIGH' THEN 0 ELSE o_orderkey END AS first_id,
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderpriority = '2-HIGH' THEN CASE WHEN o_orderkey = (SELECT min(o_orderkey) FROM {orders} WHERE o_orderpriority = '2-HIGH' AND o_orderstatus <> 'F' AND year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM {orders})) THEN 150000 ELSE 5 END ELSE o_orderkey + 2 END AS last_id, o_orderkey
FROM {orders}
"""


@query(f"""
WITH f AS (SELECT * FROM ({plain(RUN_LOG)}) WHERE status = 'failed' AND run_id = (SELECT max(year(o_orderdate)) FROM orders))
SELECT DISTINCT CAST(i AS VARCHAR) AS source_id FROM (
  SELECT unnest(range(first_id, last_id + 1)) AS i FROM f
  UNION ALL SELECT o_orderkey * 2 FROM f UNION ALL SELECT CAST(record_id AS BIGINT) FROM ({SQL_ISSUES}))""")
def repair_ids(t: Tables):
    log = t.derive(RUN_LOG).withColumn("ids", F.array(col("o_orderkey") * 2))
    issues = quality.field_issues(t.derive(RAW_ORDERS), col("row_id"), order_rules())
    return quality.repair_ids(log, issues)


def repaired(t: Tables):
    return t.orders, t.orders.filter("o_orderstatus = 'P'"), t.orders.filter("o_orderpriority = '5-LOW'"), "o_orderkey"


@query("""
SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'not_found' WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'success' END AS outcome, count(*)::BIGINT AS ids
FROM orders GROUP BY 1""")
def repair_summary(t: Tables):
    return quality.repair_summary(*repaired(t))


@query("""
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'not_found' WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'success' END AS outcome FROM orders""")
def repair_outcomes(t: Tables):
    return quality.repair_outcomes(*repaired(t))


@query(f"""
SELECT row_id, concat_ws(',', CASE WHEN d IS NULL THEN 'ordered_at' END, CASE WHEN p IS NULL THEN 'total' END) AS failed_fields,
  d IS NOT NULL AND p IS NOT NULL AS is_good FROM (SELECT row_id, {sql_era(2400)} AS d, {SQL_PRICE} AS p FROM (SELECT *, {SQL_NUMBER} AS n FROM ({RAW})))""")
def quarantine_bad_rows(t: Tables):
    good, bad = quality.quarantine_bad_rows(t.derive(RAW_ORDERS), order_rules())
    ok = good.select("row_id", F.lit("").alias("failed_fields"), F.lit(True).alias("is_good"))
    return ok.unionByName(bad.select("row_id", "failed_fields", F.lit(False).alias("is_good")))


@query(f"""
SELECT CAST(row_id AS VARCHAR) AS record_id, concat_ws(',', CASE WHEN {sql_blank('order_key')} IS NULL THEN 'order' END,
  CASE WHEN cust_key NOT SIMILAR TO '[0-9]{{1,3}}' THEN 'customer' END) AS bad_parts FROM ({RAW})
WHERE {sql_blank('order_key')} IS NULL OR cust_key NOT SIMILAR TO '[0-9]{{1,3}}'""")
def key_not_mappable(t: Tables):
    parts = {"order": c.to_int_strict(col("order_key")), "customer": c.to_int_strict(col("cust_key"), max_digits=3)}
    return quality.key_not_mappable(t.derive(RAW_ORDERS), col("row_id"), parts)


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS record_id, 'o_orderstatus' AS field, 'code_not_allowed' AS reason, o_orderstatus AS source_raw
FROM orders WHERE o_orderstatus NOT IN ('F', 'O')""")
def code_validity(t: Tables):
    return quality.code_validity(t.orders, "o_orderkey", "o_orderstatus", ["F", "O"])


# --- J: comparison ----------------------------------------------------------------------------


@query("""
SELECT o_orderkey, 'n:' || o_orderkey AS key_text, CASE WHEN o_totalprice = floor(o_totalprice) THEN 'n:' || CAST(o_totalprice AS BIGINT) ELSE 'f:' || o_totalprice END AS price_text,
  't:' || o_orderpriority AS priority_text, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 't:' || o_orderstatus END AS status_text FROM orders""")
def canonical_value(t: Tables):
    padded = F.concat(F.lit(" 00"), col("o_orderkey").cast("string"))
    status = F.when(col("o_orderstatus") == "P", "  ").otherwise(col("o_orderstatus"))
    return t.orders.select(
        "o_orderkey", compare.canonical_value(padded).alias("key_text"),
        compare.canonical_value(col("o_totalprice"), t.orders.schema["o_totalprice"].dataType).alias("price_text"),
        compare.canonical_value(col("o_orderpriority")).alias("priority_text"),
        compare.canonical_value(status).alias("status_text"),
    )


@query(f"""
WITH a AS (SELECT o_custkey, o_orderstatus, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS o_orderpriority, count(*) AS n FROM orders GROUP BY ALL),
b AS (SELECT o_custkey, o_orderstatus, nullif(o_orderpriority, '') AS o_orderpriority, count(*) AS n FROM ({COPY}) GROUP BY ALL)
SELECT (SELECT sum(n) FROM a)::BIGINT AS left_rows, (SELECT sum(n) FROM b)::BIGINT AS right_rows, sum(least(a.n, b.n))::BIGINT AS overlap
FROM a JOIN b ON a.o_custkey = b.o_custkey AND a.o_orderstatus = b.o_orderstatus AND a.o_orderpriority IS NOT DISTINCT FROM b.o_orderpriority""")
def hash_overlap(t: Tables):
    shown = F.when(col("o_orderpriority") != "5-LOW", col("o_orderpriority"))
    left = t.orders.withColumn("o_orderpriority", shown)
    return compare.hash_overlap(left, t.derive(ORDERS_COPY), ["o_custkey", "o_orderstatus", "o_orderpriority"])


# Lines repeat (order, line) keys; the copy lacks some lines and has changed quantities.
LINES_COPY = """
SELECT concat(CAST(l_orderkey AS STRING), '_', CAST(l_linenumber AS STRING)) AS id, l_partkey, l_suppkey,
  CASE WHEN l_returnflag = 'A' THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
  CASE WHEN l_linestatus = 'F' THEN lower(l_returnflag) ELSE l_returnflag END AS l_returnflag, l_extendedprice FROM {lineitem} WHERE year(l_shipdate) < 2001
"""
LINES = """
SELECT concat(CAST(l_orderkey AS STRING), '_', CAST(l_linenumber AS STRING)) AS line_key, l_partkey, l_suppkey, l_quantity, l_returnflag, l_extendedprice
FROM {lineitem}
"""
LINE_ORDER = "l_partkey, l_suppkey, l_extendedprice, l_quantity"
SQL_DIFF = f"""
SELECT coalesce(a.line_key, b.id) AS key, coalesce(a.k, b.k)::BIGINT AS k,
  CASE WHEN b.id IS NULL THEN 'missing_right' WHEN a.line_key IS NULL THEN 'missing_left'
    WHEN a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey AND a.l_quantity = b.l_quantity AND a.l_returnflag = b.l_returnflag THEN 'match' ELSE 'field_mismatch' END AS status,
  CASE WHEN a.line_key IS NULL OR b.id IS NULL THEN '' ELSE concat_ws(',', CASE WHEN a.l_partkey <> b.l_partkey THEN 'l_partkey' END, CASE WHEN a.l_suppkey <> b.l_suppkey THEN 'l_suppkey' END,
    CASE WHEN a.l_quantity <> b.l_quantity THEN 'l_quantity' END, CASE WHEN a.l_returnflag <> b.l_returnflag THEN 'l_returnflag' END) END AS fields
FROM (SELECT *, row_number() OVER (PARTITION BY line_key ORDER BY {LINE_ORDER}) AS k FROM ({plain(LINES)})) a
FULL JOIN (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {LINE_ORDER}) AS k FROM ({plain(LINES_COPY)})) b ON a.line_key = b.id AND a.k = b.k"""
LINE_SPEC = compare.CompareSpec(
    "line_key", "id", ["l_partkey", "l_suppkey", "l_quantity", "l_returnflag"],
    ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"],
)


def line_diff(t: Tables):
    return compare.compare_by_key(t.derive(LINES), t.derive(LINES_COPY), LINE_SPEC)


@query(SQL_DIFF)
def compare_by_key(t: Tables):
    return line_diff(t).withColumn("fields", F.array_join("fields", ","))


@query(f"""
SELECT field, count(*)::BIGINT AS n FROM (SELECT unnest(string_split(fields, ',')) AS field FROM ({SQL_DIFF}) WHERE fields <> '') GROUP BY 1""")
def field_mismatch_counts(t: Tables):
    return compare.field_mismatch_counts(line_diff(t))


@query("""
SELECT c AS column_name, CASE WHEN l AND r THEN 'shared' WHEN l THEN 'left' ELSE 'right' END AS side,
  (SELECT count(*) FROM customer) AS left_rows, (SELECT count(*) FROM supplier) AS right_rows
FROM (VALUES ('custkey', true, false), ('name', true, true), ('nationkey', true, true), ('acctbal', true, true), ('mktsegment', true, false), ('suppkey', false, true)) v(c, l, r)""")
def column_set_diff(t: Tables):
    return compare.column_set_diff(t.customer, t.supplier, "c_", "s_")


@query("""
SELECT p_partkey, p_size <= 40 AS is_equal FROM part""")
def pair_multiset_equal(t: Tables):
    mobile = F.concat(F.lit("08-"), F.lpad(col("p_partkey").cast("string"), 8, "0"))
    land = F.concat(F.lit("02 "), F.lpad(col("p_size").cast("string"), 7, "0"))
    digits = lambda x: F.regexp_replace(x, "[^0-9]", "")
    biz = F.when(col("p_size") > 20, F.concat(mobile, F.lit(" / "), land)).otherwise(mobile)
    home = F.when(col("p_size") > 20, F.lit("stale 1")).otherwise(land)
    right_home = F.when(col("p_size") > 40, F.lit("021")).otherwise(digits(land))
    return t.part.select(
        "p_partkey", compare.pair_multiset_equal(home, biz, right_home, digits(mobile)).alias("is_equal")
    )


@query("""
SELECT check_name, s AS source_rows, h AS target_rows, s = h AS is_ok, CASE WHEN h < s THEN 'target_short' WHEN h > s THEN 'target_surplus' ELSE 'equal' END AS reason FROM (
  SELECT 'all' AS check_name, count(*)::BIGINT AS s, count_if(event_type <> 'signup' OR value > 50)::BIGINT AS h FROM events
  UNION ALL SELECT event_type, count(*)::BIGINT, count_if(event_type <> 'signup' OR value > 50)::BIGINT FROM events GROUP BY 1 HAVING event_type IN ('signup', 'purchase'))""")
def parity_check(t: Tables):
    held = t.events.filter((col("event_type") != "signup") | (col("value") > 50))
    checks = {"all": F.lit(True)} | {kind: col("event_type") == kind for kind in ("signup", "purchase")}
    return compare.parity_check(t.events, held, checks)


@query(f"""
SELECT row_id, order_key AS key, priority FROM ({RAW}) WHERE try_cast({sql_blank('order_key')} AS BIGINT) BETWEEN 500 AND 12000
  AND order_key = {sql_strip('order_key')}""")
def key_alias_range(t: Tables):
    rows = t.derive(RAW_ORDERS).select("row_id", "order_key", "priority")
    return compare.key_alias_range(rows, "order_key", 500, 12000)
