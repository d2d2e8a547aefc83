"""Documents, configuration references and incremental loads: SURVEY sections K to M."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablebridge.functions import clean as c
from tablebridge.functions import keys as k
from tablebridge.operators import document, jsonrefs, resolve
from tablebridge.operators.document import ChildCollection
from tablebridge.operators.merge import MergeSpec, merge_if_changed
from tablebridge.plans.inputs import FLOWS, ORDERS_TARGET
from tablebridge.plans.registry import Tables, plain, query
from tablebridge.session import new_run_folder
from tablebridge.sources.sinks import key_snapshot
from tablebridge.streaming import incremental, progress

col = F.col

# --- K: documents -----------------------------------------------------------------------------

LINES_JSON = """SELECT l_orderkey, list({'l_linenumber': l_linenumber, 'l_partkey': l_partkey, 'l_quantity': l_quantity}
  ORDER BY l_linenumber, l_partkey, l_quantity) AS lines FROM lineitem GROUP BY 1"""
SQL_DOC = f"""
SELECT c_custkey, 0 AS part, to_json({{'c_custkey': c_custkey, 'c_name': c_name, 'orders': coalesce(os, []), 'events': coalesce(es, [])}}) AS document
FROM customer LEFT JOIN (SELECT o_custkey, list({{'o_orderkey': o_orderkey, 'o_orderstatus': o_orderstatus, 'lines': lines}} ORDER BY o_orderkey) AS os
  FROM orders JOIN ({LINES_JSON}) ON l_orderkey = o_orderkey GROUP BY 1) ON o_custkey = c_custkey
LEFT JOIN (SELECT user_id, list({{'event_id': event_id, 'event_type': event_type}} ORDER BY event_id) AS es FROM events GROUP BY 1) ON user_id = c_custkey
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')"""


def collections(t: Tables) -> list[ChildCollection]:
    lines = ChildCollection(
        "lines", t.lineitem, "l_orderkey", ["l_linenumber", "l_partkey", "l_quantity"],
        ["l_linenumber", "l_partkey", "l_quantity"],
    )
    orders = document.nest_child(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), "o_orderkey", lines)
    orders = orders.filter(col("lines").isNotNull())
    return [
        ChildCollection("orders", orders, "o_custkey", ["o_orderkey", "part"], ["o_orderkey", "o_orderstatus", "lines"]),
        ChildCollection("events", t.events, "user_id", ["event_id"], ["event_id", "event_type"]),
    ]


@query(SQL_DOC)
def build_snapshot_doc(t: Tables):
    signed = t.orders.filter("o_orderstatus = 'P'").select(col("o_custkey").alias("c_custkey"))
    parents = t.customer.join(signed, "c_custkey", "left_semi")
    return document.build_snapshot_doc(parents, "c_custkey", collections(t), ["c_custkey", "c_name"])


@query(SQL_DOC.replace("WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')",
                       "WHERE c_custkey IN (SELECT s_suppkey FROM supplier)"))
def nested_sample(t: Tables):
    ids = t.supplier.select(col("s_suppkey").alias("c_custkey"))
    return document.nested_sample(t.customer, "c_custkey", ids, collections(t), ["c_custkey", "c_name"])


@query("""
SELECT user_id, concat_ws(chr(10), CASE WHEN p IS NOT NULL THEN 'Purchase dated ' || strftime(p, '%d/%m/') || (year(p) + 543) END,
  CASE WHEN e IS NOT NULL THEN 'Error dated ' || strftime(e, '%d/%m/') || (year(e) + 543) END) AS lines FROM (
  SELECT user_id, max(CASE WHEN event_type = 'purchase' THEN ts END) AS p, max(CASE WHEN event_type = 'error' THEN ts END) AS e FROM events GROUP BY 1)""")
def history_lines(t: Tables):
    last = t.events.groupBy("user_id").agg(
        F.max(F.when(col("event_type") == "purchase", col("ts"))).alias("p"),
        F.max(F.when(col("event_type") == "error", col("ts"))).alias("e"),
    )
    lines = document.history_lines([("Purchase dated", col("p")), ("Error dated", col("e"))])
    return last.select("user_id", lines.alias("lines"))


@query("""
WITH r AS (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' UNION SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'O'),
g AS (SELECT l_orderkey, min(l_partkey) AS general_id, bool_or(l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 45)) AS kept
  FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1)
SELECT o_orderkey, o_orderkey IN (SELECT l_orderkey FROM r) AS has_report, general_id, coalesce(kept, false) AS has_history,
  o_orderkey IN (SELECT l_orderkey FROM r) AND general_id IS NOT NULL AND NOT coalesce(kept, false) AS is_target
FROM orders LEFT JOIN g ON l_orderkey = o_orderkey""")
def eligible_targets(t: Tables):
    reports = [
        (t.lineitem.filter("l_returnflag = 'R'"), "l_orderkey"),
        (t.lineitem.filter("l_returnflag = 'A' and l_linestatus = 'O'"), "l_orderkey"),
    ]
    return document.eligible_targets(
        t.orders, "o_orderkey", reports, t.lineitem.filter("l_linestatus = 'F'"), "l_orderkey", "l_partkey",
        t.part.filter("p_size > 45"), "p_partkey",
    )


@query("""
SELECT o_orderkey, coalesce(greatest(max(CASE WHEN l_returnflag = 'R' THEN l_shipdate END), max(CASE WHEN l_returnflag = 'A' THEN l_shipdate - INTERVAL 7 HOUR END)),
  any_value(o_orderdate)) AS signed_at FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
def signed_at(t: Tables):
    sent = t.lineitem.groupBy(col("l_orderkey").alias("o_orderkey")).agg(
        F.max(F.when(col("l_returnflag") == "R", col("l_shipdate"))).alias("r"),
        F.max(F.when(col("l_returnflag") == "A", col("l_shipdate"))).alias("a"),
    )
    local = c.wall_clock_to_instant(col("a"), "Asia/Bangkok")
    return t.orders.join(sent, "o_orderkey", "left").select(
        "o_orderkey", document.signed_at(col("r"), local, fallback=col("o_orderdate")).alias("signed_at")
    )


@query("""
WITH p AS (SELECT e.*, (SELECT s.event_id FROM events s WHERE s.event_type = 'purchase' AND s.user_id = e.user_id AND s.ts < date_trunc('day', e.ts)
  ORDER BY s.ts DESC, s.event_id DESC LIMIT 1) AS pick FROM events e)
SELECT p.event_id, coalesce(s.props, p.event_type) AS payload, coalesce(s.value, 0) AS amount,
  s.event_id IS NOT NULL AND (s.props <> p.event_type OR s.value <> 0) AS is_updated FROM p LEFT JOIN events s ON s.event_id = p.pick""")
def denormalise_to_parent(t: Tables):
    sales = t.events.filter("event_type = 'purchase'")
    asked = t.events.select("event_id", "user_id", "ts", col("event_type").alias("payload"), F.lit(0.0).alias("amount"))
    cand = sales.select("user_id", col("ts").alias("sale_ts"), col("event_id").alias("sale"))
    picked = resolve.asof_before_day(asked, cand, "user_id", "ts", "sale_ts", "sale", out="pick")
    payload = sales.select("event_id", col("props").alias("payload"), col("value").alias("amount"))
    return document.denormalise_to_parent(picked, "pick", payload, "event_id", ["payload", "amount"]).select(
        "event_id", "payload", "amount", "is_updated"
    )


# --- L: configuration rows --------------------------------------------------------------------


@query("""
SELECT page_id, 'url' AS kind, unnest(regexp_extract_all(html, 'https?://[^\\s''"\\\\]+')) AS ref FROM pages
UNION ALL SELECT page_id, 'link', unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) FROM pages
UNION ALL SELECT page_id, 'env', unnest(regexp_extract_all(html, 'process\\.env\\.([A-Za-z_][A-Za-z0-9_]*)', 1)) FROM pages""")
def extract_refs(t: Tables):
    patterns = {
        "url": (jsonrefs.URL_SHAPE, 0), "link": ('href="([^"]+)"', 1), "env": (jsonrefs.ENV_SHAPE, 1),
    }
    return jsonrefs.extract_refs(t.pages, "page_id", "html", patterns)


@query("""
SELECT event_id AS flow_id, 'url' AS kind, 'https://h' || user_id || '.example.org/x' AS ref FROM events
UNION ALL SELECT event_id, 'collection', event_type FROM events
UNION ALL SELECT event_id, 'folder', unnest(['f' || user_id, 'f' || event_id]) FROM events""")
def extract_config_refs(t: Tables):
    # A list of folders beside the rest: each of them is a reference.
    folders = F.concat(F.lit(', "folders": ["f'), F.regexp_extract("options", '"role": "r([0-9]+)"', 1), F.lit('", "f'), col("flow_id").cast("string"), F.lit('"]}'))
    flows = t.derive(FLOWS).withColumn("options", F.concat(F.regexp_replace("options", "}$", ""), folders))
    return jsonrefs.extract_refs(
        flows, "flow_id", "options",
        {"url": (jsonrefs.URL_SHAPE, 0), "uuid": (jsonrefs.UUID_IN_TEXT, 0)},
        {"collection": "$.collection", "cron": "$.cron", "permissions": "$.permissions", "folder": "$.folders"},
    )


@query("""
SELECT event_id AS flow_id, 'top.owner.role' AS path, '"r' || user_id || '"' AS value FROM events
UNION ALL SELECT event_id, 'top.steps[0].team_role', CAST(event_id AS VARCHAR) FROM events
UNION ALL SELECT event_id, 'a.b.c.d.e.f.g.role', CAST(event_id AS VARCHAR) FROM events""")
def walk_json_paths(t: Tables):
    deep = F.concat(
        F.lit('{"top":'), col("options"), F.lit(',"a":{"b":{"c":{"d":{"e":{"f":{"g":{"role":'), col("flow_id").cast("string"), F.lit("}}}}}}}}")
    )
    return jsonrefs.walk_json_paths(t.derive(FLOWS).withColumn("options", deep), "flow_id", "options")


# Flows of operations, each followed by two others; some lead nowhere, into another flow, or start a flow that is not there.
OPS_BY_FLOW = "SELECT event_id, user_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM {events}"
FLOW_OPERATIONS = f"""
SELECT a.event_id AS op_id, a.user_id AS flow_id, CASE a.event_type WHEN 'purchase' THEN 'trigger' WHEN 'click' THEN 'item-read' ELSE a.event_type END AS op_type,
  CASE a.event_type WHEN 'purchase' THEN concat('{{{{"flow": "', CAST(a.user_id * 2 AS STRING), '"}}}}')
    WHEN 'click' THEN concat('{{{{"collection": ["c', CAST(a.user_id AS STRING), '", "{{{{{{{{own}}}}}}}}"]}}}}') ELSE '{{{{"flow": "none"}}}}' END AS options,
  CASE WHEN a.event_type = 'error' AND a.value > 40 THEN -1 - a.event_id WHEN a.event_type = 'signup' AND a.value > 90 THEN d.event_id ELSE b.event_id END AS resolve,
  c.event_id AS reject
FROM ({OPS_BY_FLOW}) a LEFT JOIN ({OPS_BY_FLOW}) b ON b.user_id = a.user_id AND b.rn = a.rn * 2
  LEFT JOIN ({OPS_BY_FLOW}) c ON c.user_id = a.user_id AND c.rn = a.rn * 2 + 1 LEFT JOIN ({OPS_BY_FLOW}) d ON d.user_id = a.user_id + 1 AND d.rn = 1
"""
FLOW_STARTS = "SELECT user_id AS flow_id, min(event_id) AS first_op FROM {events} GROUP BY user_id"


@query("""
SELECT event_id AS op_id, user_id AS flow_id, 'flow' AS kind, CAST(user_id * 2 AS VARCHAR) AS ref FROM events WHERE event_type = 'purchase'
UNION ALL SELECT event_id, user_id, 'collection', 'c' || user_id FROM events WHERE event_type = 'click'""")
def operation_refs(t: Tables):
    rules = [("item-", "$.collection", "collection"), ("trigger", "$.flow", "flow")]
    return jsonrefs.operation_refs(t.derive(FLOW_OPERATIONS), "op_type", "options", rules, ["op_id", "flow_id"])


@query(f"""
WITH RECURSIVE o AS ({plain(FLOW_OPERATIONS)}), f AS ({plain(FLOW_STARTS)}),
steps AS (SELECT op_id, flow_id, unnest([resolve, reject]) AS next FROM o),
placed AS (SELECT s.*, o.flow_id AS there FROM steps s LEFT JOIN o ON o.op_id = s.next WHERE next IS NOT NULL),
way AS (SELECT first_op AS node FROM f UNION SELECT next FROM way JOIN placed ON op_id = node WHERE there = flow_id)
SELECT flow_id, op_id, 'trigger_missing' AS issue, CAST(flow_id * 2 AS VARCHAR) AS detail FROM o WHERE op_type = 'trigger' AND flow_id * 2 NOT IN (SELECT flow_id FROM f)
UNION ALL SELECT flow_id, op_id, 'next_missing', CAST(next AS VARCHAR) FROM placed WHERE there IS NULL
UNION ALL SELECT flow_id, op_id, 'next_elsewhere', CAST(next AS VARCHAR) FROM placed WHERE there <> flow_id
UNION ALL SELECT flow_id, op_id, 'unreachable', NULL FROM o WHERE op_id NOT IN (SELECT node FROM way)""")
def flow_graph_issues(t: Tables):
    return jsonrefs.flow_graph_issues(t.derive(FLOW_STARTS), t.derive(FLOW_OPERATIONS))


@query("""
WITH l AS (SELECT page_id, html, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS ref FROM pages)
SELECT page_id, ref FROM l WHERE ref NOT IN (SELECT ref FROM l WHERE html LIKE '%lang="en"%')""")
def missing_refs(t: Tables):
    links = {"link": ('href="([^"]+)"', 1)}
    refs = jsonrefs.extract_refs(t.pages, "page_id", "html", links).select("page_id", "ref")
    known = jsonrefs.extract_refs(t.pages.filter(col("html").contains('lang="en"')), "page_id", "html", links)
    return jsonrefs.missing_refs(refs, known.select(col("ref").alias("name")), "ref", "name")


@query("""
SELECT event_id, payload, sha256(payload) AS fingerprint FROM (SELECT event_id,
  '{"event_id":' || event_id || ',"event_type":"' || event_type || '","props":"{\\"k\\":' || json_extract_string(props, '$.k') || '}"}' AS payload FROM events)""")
def canonical_json_fingerprint(t: Tables):
    rows = t.events.select("event_id", "event_type", "props", "ts")
    return jsonrefs.canonical_json_fingerprint(rows, "event_id", drop=["ts"], json_columns=["props"])


# --- M: incremental loads ---------------------------------------------------------------------


def arrivals_of(t: Tables, df, max_files: int | None = None):
    """The rows as files of an inbox folder, read as a stream."""
    inbox = new_run_folder(t.spark, "inbox")
    df.write.parquet(inbox)
    return incremental.read_arrivals(t.spark, inbox, df.schema, max_files=max_files)


@query("SELECT event_id, ts, user_id, event_type, value FROM events")
def incremental_append(t: Tables):
    rows = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    replayed = rows.unionByName(rows.filter("event_type = 'purchase'")).repartition(4, "user_id")
    home = new_run_folder(t.spark, "load")
    table = incremental.BatchFolders(t.spark, f"{home}/table", rows.schema)
    incremental.incremental_append(
        arrivals_of(t, replayed, max_files=2), table, ["event_id"], [col("ts")], f"{home}/position"
    )
    return table.read_all()


@query("""
SELECT o_orderkey AS order_key, o_custkey AS cust_key, CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS total FROM orders""")
def incremental_load(t: Tables):
    rows = t.orders.select(col("o_orderkey").alias("order_key"), col("o_custkey").alias("cust_key"), col("o_totalprice").alias("total"))
    changed = t.orders.filter("o_orderstatus = 'P'").select(
        col("o_orderkey").alias("order_key"), col("o_custkey").alias("cust_key"), (col("o_totalprice") + 1).alias("total")
    )
    home = new_run_folder(t.spark, "load")
    table = incremental.VersionedBuckets(t.spark, f"{home}/table", rows.schema, ["order_key"])
    merge = lambda target, batch: merge_if_changed(target, batch, MergeSpec(["order_key"]))
    inbox = f"{home}/inbox"
    # Two nights: the second brings two versions of each changed row and continues behind the first.
    earlier = changed.withColumn("total", col("total") - 0.5)
    for night in (rows, changed.unionByName(earlier)):
        night.write.mode("append").parquet(inbox)
        stream = incremental.read_arrivals(t.spark, inbox, rows.schema)
        incremental.incremental_load(stream, table, merge, f"{home}/position", [col("total")])
    return table.current()


@query("""
SELECT check_name, a AS source_value, b AS target_value, a = b AS is_ok, CASE WHEN a = b THEN 'equal' ELSE reason END AS reason FROM (
  SELECT 'batches' AS check_name, '2' AS a, '2' AS b, '' AS reason
  UNION ALL SELECT 'rows', (SELECT count(*)::VARCHAR FROM events), (SELECT count(*)::VARCHAR FROM events WHERE event_type <> 'error'), 'behind'
  UNION ALL SELECT 'keys', (SELECT count(*)::VARCHAR FROM events WHERE event_type <> 'error'), (SELECT count(*)::VARCHAR FROM events WHERE event_type <> 'error' AND (event_type <> 'click' OR value <= 50)), 'behind'
  UNION ALL SELECT 'highest_key', (SELECT max(event_id)::VARCHAR FROM events WHERE event_type <> 'error'), (SELECT max(event_id)::VARCHAR FROM events WHERE event_type <> 'error' AND (event_type <> 'click' OR value <= 50)), 'behind')""")
def parity_progress(t: Tables):
    # Two deliveries are loaded, a third one waits in the inbox, and the target has lost some rows since.
    home = new_run_folder(t.spark, "progress")
    rows = t.events.select("event_id", "user_id", "event_type", "value")
    table = incremental.BatchFolders(t.spark, f"{home}/table", rows.schema)
    for part in ("event_type IN ('click', 'view')", "event_type NOT IN ('click', 'view', 'error')"):
        rows.filter(part).write.mode("append").parquet(f"{home}/inbox")
        stream = incremental.read_arrivals(t.spark, f"{home}/inbox", rows.schema)
        incremental.incremental_append(stream, table, ["event_id"], [col("event_id")], f"{home}/position")
    rows.filter("event_type = 'error'").write.mode("append").parquet(f"{home}/inbox")
    held = table.read_all().filter("event_type <> 'click' OR value <= 50")
    return progress.parity_progress(t.spark.read.schema(rows.schema).parquet(f"{home}/inbox"), held, f"{home}/position", "event_id")


SQL_LATE = f"SELECT order_key, cust_key, total, status FROM ({plain(ORDERS_TARGET)})"


@query(f"""
SELECT 'row' AS kind, order_key, status AS detail FROM ({SQL_LATE})
UNION ALL SELECT 'row', o_orderkey, o_orderstatus FROM orders WHERE o_orderpriority <> '3-MEDIUM' AND o_orderkey NOT IN (SELECT order_key FROM ({SQL_LATE}))
UNION ALL SELECT 'plan', o_orderkey, 'loaded' FROM orders WHERE o_orderpriority <> '3-MEDIUM' AND o_orderkey NOT IN (SELECT order_key FROM ({SQL_LATE}))""")
def catch_up_late(t: Tables):
    target = t.derive(ORDERS_TARGET).select("order_key", "cust_key", "total", "status")
    source = t.orders.select(
        col("o_orderkey").alias("order_key"), col("o_custkey").alias("cust_key"), col("o_totalprice").alias("total"), col("o_orderstatus").alias("status")
    )
    counted = t.orders.filter("o_orderpriority <> '3-MEDIUM'")
    snapshot = key_snapshot(counted, col("o_orderkey"), col("o_orderkey"), new_run_folder(t.spark, "snapshot"))
    loaded, plan = incremental.catch_up_late(source, snapshot, target, MergeSpec(["order_key"]), "order_key")
    rows = loaded.select(F.lit("row").alias("kind"), "order_key", col("status").alias("detail"))
    return rows.unionByName(
        plan.select(F.lit("plan").alias("kind"), col("key").cast("bigint").alias("order_key"), col("action").alias("detail"))
    )


@query("""
SELECT DISTINCT l_orderkey AS o_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def snapshot_closure(t: Tables):
    children = t.lineitem.select(col("l_orderkey").alias("o_orderkey"))
    return incremental.snapshot_closure(children, t.orders.filter("o_orderstatus <> 'P'"), ["o_orderkey"])


@query("""
SELECT event_id, user_id, sha256('E:' || event_id || '|T:' || event_type) AS fingerprint FROM events""")
def stream_append_log(t: Tables):
    rows = t.events.select("event_id", "user_id", "event_type", col("ts").cast("timestamp").alias("ts"))
    replayed = rows.unionByName(rows.filter("event_type = 'view'"))
    home = new_run_folder(t.spark, "log")
    fingerprint = k.row_fingerprint({"E": col("event_id"), "T": col("event_type")}, {})
    incremental.stream_append_log(
        arrivals_of(t, replayed), "ts", fingerprint, "60 days", f"{home}/table", f"{home}/position"
    )
    return t.spark.read.parquet(f"{home}/table").select("event_id", "user_id", "fingerprint")
