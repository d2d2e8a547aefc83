"""Deduplication and resolution of references: SURVEY sections C and D."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablebridge.functions import clean as c
from tablebridge.operators import dedup, resolve
from tablebridge.plans.inputs import (
    BOM,
    KNOWN_CUSTOMERS,
    PARTY_ORDERS,
    PEOPLE,
    PERSON_PROBES,
    PERSONS,
    sql_blank,
)
from tablebridge.plans.registry import Tables, plain, query

col = F.col

# Orders whose customer is found in the target, or is written in another case, or is not known.
PARTIES, CROWD, KNOWN = plain(PARTY_ORDERS), plain(PEOPLE), plain(KNOWN_CUSTOMERS)

# --- C: one row per key -----------------------------------------------------------------------

KEYED_EVENTS = f"""
SELECT event_id, ts, value, CASE WHEN event_type = 'error' THEN '' WHEN event_type = 'view'
  THEN concat('{BOM}', CAST(user_id AS STRING), ' ') ELSE CAST(user_id AS STRING) END AS user_key FROM {{events}}
"""


@query(f"""
SELECT user_key, event_id, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts, event_id) AS rn
  FROM (SELECT *, {sql_blank('user_key')} AS k FROM ({plain(KEYED_EVENTS)})) WHERE k IS NOT NULL) WHERE rn = 1""")
def first_by_key(t: Tables):
    return dedup.first_by_key(t.derive(KEYED_EVENTS), col("user_key"), [col("ts"), col("event_id")]).select(
        "user_key", "event_id", "ts", "value"
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (SELECT *, row_number() OVER (
  PARTITION BY l_orderkey ORDER BY l_linenumber, l_extendedprice, l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn = 1""")
def distinct_on(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    order = [col(n) for n in ("l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey")]
    return dedup.distinct_on(rows, ["l_orderkey"], order)


# One id for several rows: visits per user and day, some without the optional reference.
VISITS = """
SELECT concat(CAST(user_id AS STRING), '-', CAST(CAST(ts AS DATE) AS STRING)) AS visit, event_id,
  CASE WHEN event_type IN ('purchase', 'signup') THEN event_id END AS sale FROM {events}
"""


@query(f"""
SELECT visit, event_id, sale, sale IS NULL AS is_unkeyed FROM (SELECT *, row_number() OVER (
  PARTITION BY visit ORDER BY sale IS NULL, event_id) AS rn FROM ({plain(VISITS)})) WHERE rn = 1""")
def keyed_else_unkeyed(t: Tables):
    return dedup.keyed_else_unkeyed(t.derive(VISITS), "visit", "sale", [col("event_id")])


@query("""
SELECT l_orderkey, l_linenumber, count(*)::BIGINT AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def duplicate_keys(t: Tables):
    return dedup.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


ARCHIVE = "SELECT o_orderkey - 500 AS id, o_totalprice AS total FROM {orders} WHERE o_orderstatus <> 'P' OR o_orderpriority = '5-LOW'"
INCOME = "SELECT o_orderkey AS id, o_totalprice AS total FROM {orders} WHERE o_orderpriority <> '5-LOW'"


@query(f"""
SELECT id, total, 0 AS source_rank FROM ({plain(ARCHIVE)}) WHERE id + 500 NOT IN (SELECT id FROM ({plain(INCOME)}))
UNION ALL SELECT id, total, 1 FROM ({plain(INCOME)})""")
def drop_archived_copies(t: Tables):
    return dedup.drop_archived_copies(t.derive(INCOME), t.derive(ARCHIVE), "id", 500)


@query("""
SELECT l_orderkey, CASE WHEN count(DISTINCT l_returnflag) = 1 THEN min(l_returnflag) END AS l_returnflag,
  count(DISTINCT l_returnflag) > 1 AS is_ambiguous FROM lineitem GROUP BY l_orderkey""")
def unanimous_or_null(t: Tables):
    return dedup.unanimous_or_null(t.lineitem, ["l_orderkey"], "l_returnflag")


# --- D: joins and resolution ------------------------------------------------------------------


@query(f"""
SELECT o_orderkey, id AS parent_id FROM (
  SELECT o.o_orderkey, p.id, row_number() OVER (PARTITION BY o.o_orderkey ORDER BY p.first_name = 'INFERRED',
    CASE WHEN p.pid = o.party THEN 0 WHEN lower(p.pid) = lower(o.party) THEN 1 ELSE 2 END, p.id) AS rn
  FROM (SELECT * EXCLUDE party, {sql_blank('party')} AS party FROM ({PARTIES})) o
  LEFT JOIN (SELECT id, pid, first_name, lower(pid) AS k, pid AS shown FROM ({CROWD})
    UNION ALL SELECT id, pid, first_name, lower(old_db_id), old_db_id FROM ({CROWD})) p ON p.k = lower(o.party)
) WHERE rn = 1""")
def lookup_preferred(t: Tables):
    fake = c.is_placeholder(col("first_name"), "INFERRED")
    return resolve.lookup_preferred(
        t.derive(PARTY_ORDERS), t.derive(PEOPLE), col("party"), ["pid", "old_db_id"], "id", fake
    ).select("o_orderkey", "parent_id")


@query("""
SELECT o_orderkey, (SELECT min(l_partkey) FROM lineitem WHERE l_orderkey = o_orderkey) AS parent_id FROM orders""")
def lookup_first(t: Tables):
    return resolve.lookup_first(t.orders.select("o_orderkey"), t.lineitem, "o_orderkey", "l_orderkey", "l_partkey")


@query(f"""
SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT id FROM ({KNOWN})) THEN o_custkey END AS o_custkey,
  NULL AS reason FROM orders
UNION ALL SELECT o_orderkey, o_custkey, 'fk_not_in_master' FROM orders WHERE o_custkey NOT IN (SELECT id FROM ({KNOWN}))""")
def null_invalid_fk(t: Tables):
    rows, issues = resolve.null_invalid_fk(
        t.orders.select("o_orderkey", "o_custkey"), "o_custkey", t.derive(KNOWN_CUSTOMERS), "id", "o_orderkey"
    )
    logged = issues.select(
        col("record_id").cast("bigint").alias("o_orderkey"), col("source_raw").cast("bigint").alias("o_custkey"), "reason"
    )
    return rows.withColumn("reason", F.lit(None).cast("string")).unionByName(logged)


PARENT = resolve.ParentTemplate("pid", "id", "first_name", "last_name", "INFERRED", "PID ")


@query(f"""
WITH k AS (SELECT id, pid, first_name, last_name FROM ({KNOWN})),
w AS (SELECT min(p) AS pid FROM (SELECT {sql_blank('party')} AS p FROM ({PARTIES})) WHERE p IS NOT NULL
      GROUP BY lower(p) HAVING lower(min(p)) NOT IN (SELECT lower(pid) FROM k))
SELECT * FROM k UNION ALL
SELECT (SELECT max(id) FROM k) + row_number() OVER (ORDER BY pid), pid, 'INFERRED', 'PID ' || pid FROM w""")
def ensure_parent(t: Tables):
    known = t.derive(KNOWN_CUSTOMERS).drop("c_nationkey")
    return resolve.ensure_parent(t.derive(PARTY_ORDERS), col("party"), known, PARENT)[0]


@query("""
WITH d AS (SELECT n_nationkey + 1 AS id, n_name AS name FROM nation WHERE n_regionkey < 3),
m AS (SELECT id, name FROM d UNION ALL SELECT (SELECT max(id) FROM d) + row_number() OVER (ORDER BY name), name
  FROM (SELECT DISTINCT n_name AS name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name NOT IN (SELECT name FROM d)))
SELECT c_custkey, m.id FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN m ON m.name = n_name""")
def find_or_create_dim(t: Tables):
    named = t.customer.join(t.nation, col("c_nationkey") == col("n_nationkey")).select(
        "c_custkey", F.concat(F.lit(" "), col("n_name")).alias("doctor")
    )
    dim = t.nation.filter("n_regionkey < 3").select((col("n_nationkey") + 1).cast("bigint").alias("id"), col("n_name").alias("name"))
    return resolve.find_or_create_dim(named, "doctor", dim, "name", "id")[0].select("c_custkey", "id")


# Entities asked for by (name, surname, phone); every eleventh size leaves no usable phone.
SIGNERS = """
SELECT p_partkey AS row_id, p_name AS first_name, p_brand AS last_name,
  CASE WHEN p_size % 11 = 0 THEN '12' ELSE concat('02', lpad(CAST(p_size AS STRING), 7, '0')) END AS phone FROM {part}
"""
KNOWN_SIGNERS = """
SELECT min(p_partkey) + 5 AS entity_id, concat(p_name, chr(1), p_brand, chr(1), '02', lpad(CAST(p_size AS STRING), 7, '0')) AS match_key
FROM {part} WHERE p_type = 'ECONOMY' AND p_size % 11 <> 0 GROUP BY p_name, p_brand, p_size
"""


@query(f"""
WITH r AS (SELECT row_id, CASE WHEN length(phone) >= 9 THEN first_name || chr(1) || last_name || chr(1) || phone END AS match_key
  FROM ({plain(SIGNERS)})),
e AS ({plain(KNOWN_SIGNERS)}),
fresh AS (SELECT match_key, min(row_id) AS first_row FROM r WHERE match_key IS NOT NULL AND match_key NOT IN (SELECT match_key FROM e) GROUP BY 1
  UNION ALL SELECT NULL, row_id FROM r WHERE match_key IS NULL),
made AS (SELECT match_key, first_row, (SELECT max(entity_id) FROM e) + row_number() OVER (ORDER BY first_row) AS entity_id FROM fresh)
SELECT r.row_id, coalesce((SELECT min(entity_id) FROM e WHERE e.match_key = r.match_key), m.entity_id, n.entity_id) AS entity_id
FROM r LEFT JOIN made m ON m.match_key = r.match_key
LEFT JOIN made n ON r.match_key IS NULL AND n.match_key IS NULL AND n.first_row = r.row_id""")
def find_or_create_entity(t: Tables):
    key = resolve.entity_key(col("first_name"), col("last_name"), col("phone"))
    rows, _ = resolve.find_or_create_entity(t.derive(SIGNERS), key, "row_id", t.derive(KNOWN_SIGNERS), "entity_id")
    return rows.select("row_id", "entity_id")


@query(f"""
WITH q AS (SELECT row_id, trim(first_name) AS f, last_name AS l, '0' || substr(phone, 4) AS phone, phone <> '12' AS has_phone FROM ({plain(PERSON_PROBES)})),
p AS (SELECT person_id, first_name AS f, last_name AS l, left(phone, 10) AS phone FROM ({plain(PERSONS)})),
n AS (SELECT f, l, count(*) AS n, min(person_id) AS low FROM p GROUP BY ALL),
h AS (SELECT f, l, phone, count(DISTINCT person_id) AS k, min(person_id) AS low FROM p GROUP BY ALL)
SELECT q.row_id, coalesce(n.n, 0)::BIGINT AS name_matches,
  CASE WHEN n.n = 1 THEN n.low WHEN h.k = 1 AND q.has_phone THEN h.low END AS person_id,
  coalesce(n.n > 1 AND NOT coalesce(h.k = 1 AND q.has_phone, false), false) AS is_ambiguous
FROM q LEFT JOIN n USING (f, l) LEFT JOIN h ON h.f = q.f AND h.l = q.l AND h.phone = q.phone AND n.n > 1""")
def match_by_name_phone(t: Tables):
    return resolve.match_by_name_phone(t.derive(PERSON_PROBES), "row_id", t.derive(PERSONS), "person_id")


@query("""
SELECT e.event_id, CASE WHEN e.event_type = 'click' THEN e.event_id ELSE (SELECT min(p.event_id) FROM events p
  WHERE p.event_type = 'purchase' AND p.user_id = e.user_id AND CAST(p.ts AS DATE) = CAST(e.ts AS DATE)) END AS sale FROM events e""")
def fallback_same_day(t: Tables):
    sales = t.events.filter("event_type = 'purchase'").select("user_id", "ts", col("event_id").alias("sale_id"))
    rows = t.events.withColumn("sale", F.when(col("event_type") == "click", col("event_id")))
    return resolve.fallback_same_day(rows, sales, "user_id", "ts", "sale_id", "sale").select("event_id", "sale")


@query("""
SELECT e.event_id, (SELECT p.event_id FROM events p WHERE p.event_type = 'purchase' AND p.user_id = e.user_id
  AND p.ts < date_trunc('day', e.ts) AND CAST(floor(p.value / 40) AS BIGINT) <> e.event_id % 3
  ORDER BY p.ts DESC, p.event_id DESC LIMIT 1) AS last_sale FROM events e""")
def asof_before_day(t: Tables):
    # Sales carry an owner number; a row passes over the sales of its own number.
    sales = t.events.filter("event_type = 'purchase'").select(
        "user_id", col("ts").alias("sale_ts"), col("event_id").alias("sale_id"),
        F.floor(col("value") / 40).alias("owner"),
    )
    rows = t.events.withColumn("own", col("event_id") % 3)
    return resolve.asof_before_day(rows, sales, "user_id", "ts", "sale_ts", "sale_id", ("own", "owner"), "last_sale").select(
        "event_id", "last_sale"
    )


@query("""
SELECT e.event_id, s.slot AS slot_id FROM events e LEFT JOIN (
  SELECT strftime(ts, '%H:%M') AS clock, min(event_id) AS slot FROM events WHERE event_type = 'signup' AND user_id <> 7 GROUP BY 1) s
ON s.clock = strftime(e.ts, '%H:%M')""")
def lookup_slot(t: Tables):
    slots = t.events.filter("event_type = 'signup'").select(
        c.clock_slot(col("ts")).alias("clock"), col("event_id").alias("slot"), (col("user_id") == 7).alias("is_special")
    )
    return resolve.lookup_slot(
        t.events.select("event_id", "ts"), slots, c.clock_slot(col("ts")), "clock", "slot", col("is_special")
    ).select("event_id", "slot_id")


@query(f"""
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT id FROM ({KNOWN}))""")
def new_rows_only(t: Tables):
    known = t.derive(KNOWN_CUSTOMERS).select(col("id").alias("o_custkey"))
    return resolve.new_rows_only(t.orders.select("o_orderkey", "o_custkey"), known, ["o_custkey"])


@query("""
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def exists_filter(t: Tables):
    return resolve.exists_filter(
        t.customer.select("c_custkey", "c_name"), t.orders.filter("o_orderstatus = 'P'"), "c_custkey", "o_custkey"
    )


# The target holds customers under their old key; the source renamed those with a high balance.
OLD_PARTIES = """
SELECT c_custkey AS id, concat('T', CAST(c_custkey AS STRING)) AS pid, concat('T', CAST(c_custkey AS STRING)) AS old_db_id,
  CASE WHEN c_nationkey = 3 THEN 'twin' ELSE c_name END AS first_name, c_mktsegment AS last_name,
  concat('19', lpad(CAST(c_nationkey AS STRING), 2, '0'), '-01-01') AS birth_date,
  CASE WHEN c_nationkey = 5 THEN 'A' ELSE 'B' END AS national_id FROM {customer}
"""
NEW_PARTIES = """
SELECT concat('N', CAST(c_custkey AS STRING)) AS pid,
  CASE WHEN c_nationkey = 3 THEN 'twin' ELSE c_name END AS first_name,
  CASE WHEN c_nationkey = 4 THEN 'MARRIED' ELSE c_mktsegment END AS last_name,
  concat('19', lpad(CAST(c_nationkey AS STRING), 2, '0'), '-01-01') AS birth_date, 'B' AS national_id
FROM {customer} WHERE c_acctbal > 5000
"""
RENAMES = """
SELECT concat('t', CAST(c_custkey AS STRING)) AS old_pid, concat('n', CAST(c_custkey AS STRING)) AS new_pid
FROM {customer} WHERE c_nationkey < 12
UNION ALL SELECT concat('T', CAST(c_custkey AS STRING)), concat('N', CAST(c_custkey AS STRING)) FROM {customer} WHERE c_nationkey IN (1, 2)
"""
LIVE = "SELECT concat('T', CAST(c_custkey AS STRING)) AS pid FROM {customer} WHERE c_acctbal <= 5000 OR c_nationkey IN (7, 20)"
HELD = "SELECT concat('N', CAST(c_custkey AS STRING)) AS pid FROM {customer} WHERE c_nationkey = 9"


@query(f"""
WITH s AS ({plain(NEW_PARTIES)}), o AS ({plain(OLD_PARTIES)}),
l AS (SELECT DISTINCT lower(new_pid) AS n, lower(old_pid) AS o FROM ({plain(RENAMES)})),
live AS (SELECT DISTINCT lower(pid) AS pid FROM ({plain(LIVE)})), held AS (SELECT DISTINCT lower(pid) AS pid FROM ({plain(HELD)})),
via AS (SELECT s.pid, count(DISTINCT o.id) AS n, min(o.id) AS id FROM s JOIN l ON l.n = lower(s.pid) JOIN o ON lower(o.pid) = l.o
  AND o.birth_date = s.birth_date AND (o.first_name = s.first_name OR o.last_name = s.last_name) GROUP BY 1),
st AS (SELECT first_name, last_name, birth_date, count(*) AS n, min(id) AS id FROM o
  WHERE lower(pid) NOT IN (SELECT pid FROM live) GROUP BY 1, 2, 3),
tw AS (SELECT first_name, last_name, birth_date, count(*) AS n FROM s GROUP BY 1, 2, 3),
j AS (SELECT s.*, CASE WHEN via.pid IS NOT NULL THEN 'log' ELSE 'identity' END AS route,
    CASE WHEN via.n > 1 THEN 'log_points_to_several' WHEN via.pid IS NULL AND (st.n > 1 OR tw.n > 1) THEN 'identity_not_unique' END AS unclear,
    CASE WHEN via.n = 1 THEN via.id WHEN via.pid IS NULL AND st.n = 1 AND tw.n = 1 THEN st.id END AS row_id
  FROM s LEFT JOIN via USING (pid) LEFT JOIN st USING (first_name, last_name, birth_date) LEFT JOIN tw USING (first_name, last_name, birth_date)
  WHERE via.pid IS NOT NULL OR st.n IS NOT NULL),
g AS (SELECT j.*, o.pid AS old_pid, coalesce(unclear, CASE WHEN o.national_id <> j.national_id THEN 'national_id_differs' END,
    CASE WHEN lower(j.pid) IN (SELECT pid FROM held) THEN 'placeholder_exists' END) AS why FROM j LEFT JOIN o ON o.id = j.row_id)
SELECT g.pid AS new_pid, row_id, old_pid, route, coalesce(why, CASE WHEN cl.n > 1 THEN 'claimed_by_several' END) IS NULL AS is_paired,
  coalesce(why, CASE WHEN cl.n > 1 THEN 'claimed_by_several' END) AS reason,
  CASE WHEN old_pid IS NOT NULL THEN lower(old_pid) IN (SELECT pid FROM live) END AS old_pid_alive
FROM g LEFT JOIN (SELECT row_id AS r, count(*) AS n FROM g WHERE why IS NULL GROUP BY 1) cl ON cl.r = g.row_id""")
def pair_renamed(t: Tables):
    return resolve.pair_renamed(
        t.derive(NEW_PARTIES), t.derive(OLD_PARTIES), t.derive(RENAMES), t.derive(LIVE), t.derive(HELD)
    )


# Real parents found for orders of generated customers; some orders have two, so they stay.
RELINKS = """
SELECT o_orderkey, o_custkey + 5000 AS real_id FROM {orders} WHERE o_orderpriority <> '5-LOW'
UNION ALL SELECT o_orderkey, o_custkey + 6000 FROM {orders} WHERE o_orderpriority = '1-URGENT'
"""


@query(f"""
WITH p AS (SELECT o_orderkey, min(real_id) AS real_id FROM ({plain(RELINKS)}) GROUP BY 1 HAVING count(DISTINCT real_id) = 1),
g AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY'),
m AS (SELECT o.o_orderkey, o.o_custkey, p.real_id, p.real_id IS NOT NULL AND o.o_custkey IN (SELECT c_custkey FROM g) AS moves
  FROM orders o LEFT JOIN p USING (o_orderkey))
SELECT 'order' AS kind, o_orderkey AS item, CASE WHEN moves THEN real_id ELSE o_custkey END AS parent, moves AS is_relinked FROM m
UNION ALL SELECT DISTINCT 'freed', o_custkey, NULL, NULL FROM m WHERE moves""")
def relink_fk(t: Tables):
    fakes = t.customer.filter("c_mktsegment = 'MACHINERY'")
    rows, freed = resolve.relink_fk(
        t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", "o_custkey", t.derive(RELINKS), fakes, "c_custkey"
    )
    moved = rows.select(F.lit("order").alias("kind"), col("o_orderkey").alias("item"), col("o_custkey").alias("parent"), "is_relinked")
    return moved.unionByName(freed.select(F.lit("freed").alias("kind"), col("c_custkey").alias("item")), allowMissingColumns=True)


@query("""
SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'MACHINERY'
  AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
  AND c_custkey NOT IN (SELECT user_id FROM events)""")
def orphan_generated(t: Tables):
    urgent = t.orders.filter("o_orderstatus = 'F' and o_orderpriority = '1-URGENT'")
    return resolve.orphan_generated(
        t.customer.select("c_custkey", "c_name", "c_mktsegment"), "c_custkey", col("c_mktsegment") == "MACHINERY",
        [(urgent, "o_custkey"), (t.events, "user_id")],
    ).select("c_custkey", "c_name")


ARCHIVED_ORDERS = """
SELECT o_orderkey + 500 AS o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderpriority = '5-LOW' THEN o_custkey + 1 ELSE o_custkey END AS o_custkey FROM {orders}
"""


@query("""
SELECT o_orderkey, o_orderstatus = 'P' AS o_totalprice_differs, o_orderpriority = '5-LOW' AS o_custkey_differs
FROM orders""")
def self_pair_diff(t: Tables):
    return resolve.self_pair_diff(t.orders, t.derive(ARCHIVED_ORDERS), "o_orderkey", 500, ["o_totalprice", "o_custkey"])


@query("""
SELECT c_custkey, CASE WHEN c_nationkey < 20 THEN n_nationkey ELSE c_nationkey END AS nation_id,
  CASE WHEN c_nationkey < 20 THEN n_regionkey ELSE 0 END AS region_id, c_nationkey < 20 AND n_regionkey <> 0 AS is_updated
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def attribute_by_login(t: Tables):
    people = t.customer.select(
        "c_custkey", F.concat(F.lit(" nation_"), col("c_nationkey").cast("string")).alias("login"),
        col("c_nationkey").alias("nation_id"), F.lit(0).alias("region_id"),
    )
    dim = t.nation.filter("n_nationkey < 20")
    return resolve.attribute_by_login(
        people, "login", dim, "n_name", {"nation_id": "n_nationkey", "region_id": "n_regionkey"}
    ).drop("login")
