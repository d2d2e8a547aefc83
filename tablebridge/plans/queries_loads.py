"""Table loads end to end on the driver tables: SURVEY section O."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablebridge.functions import clean as c
from tablebridge.functions import keys as k
from tablebridge.operators import document, merge, profile, resolve, shape
from tablebridge.operators.dedup import distinct_on, drop_archived_copies, duplicate_keys
from tablebridge.plans import loads
from tablebridge.plans.inputs import (
    BOM,
    KNOWN_CUSTOMERS,
    PEOPLE,
    RAW_ORDERS,
    sql_blank,
)
from tablebridge.plans.queries_rows import SQL_NUMBER, SQL_PRICE, sql_era
from tablebridge.plans.registry import Tables, plain, query
from tablebridge.spec import FieldSpec, RelationSpec, TableSpec

col = F.col
RAW, KNOWN, CROWD = plain(RAW_ORDERS), plain(KNOWN_CUSTOMERS), plain(PEOPLE)


def integer(x):
    return c.to_int_strict(x)


def real(x):
    return c.to_real_lenient(x)


def era(threshold: int, **options):
    return lambda x: c.be_to_timestamp(x, threshold, **options)


def sql_merge(target: str, source: str, key: str, columns: list[str], id_col: str | None = "id", action: str = "changed") -> str:
    """Checking SQL of an update-and-insert load of `source` into `target`."""
    same = " AND ".join(f"s.{x} IS NOT DISTINCT FROM t.{x}" for x in columns)
    did = f"CASE WHEN {same} THEN 'unchanged' ELSE 'updated' END" if action == "changed" else f"'{action}'"
    values = ", ".join(f"CASE WHEN s.{key} IS NOT NULL THEN s.{x} ELSE t.{x} END AS {x}" for x in columns)
    first = f"t.{id_col}, " if id_col else ""
    made = f"(SELECT max({id_col}) FROM t) + row_number() OVER (ORDER BY {key}), " if id_col else ""
    return f"""WITH t AS ({target}), s AS ({source})
SELECT {first}t.{key}, {values}, CASE WHEN s.{key} IS NULL THEN 'kept' ELSE {did} END AS merge_action FROM t LEFT JOIN s USING ({key})
UNION ALL SELECT {made}{key}, {', '.join(columns)}, 'inserted' FROM s WHERE {key} NOT IN (SELECT {key} FROM t)"""


# --- lookup table -----------------------------------------------------------------------------

PLACES = "SELECT concat(' ', CAST(n_nationkey AS STRING)) AS code, concat(n_name, ' ') AS label FROM {nation}"
PLACES_TARGET = """
SELECT n_nationkey AS place, CASE WHEN n_regionkey = 1 THEN 'renamed' ELSE n_name END AS label FROM {nation} WHERE n_regionkey < 3
"""


@query(sql_merge(plain(PLACES_TARGET), "SELECT n_nationkey AS place, n_name AS label FROM nation", "place", ["label"], None))
def load_lookup_table(t: Tables):
    spec = TableSpec(
        "places", "code", ["place"], ["label"],
        [FieldSpec("place", "code", integer, "integer_parse_failed"), FieldSpec("label", "label")], id_col=None,
    )
    target = t.derive(PLACES_TARGET).withColumn("place", col("place").cast("bigint"))
    return loads.run_load(spec, t.derive(PLACES), target).rows


# --- party and address ------------------------------------------------------------------------

# Two deliveries of some customers; the first wins.
PARTY_ROWS = f"""
SELECT 1 AS delivery, c_name AS pid, concat(' ', CAST(c_acctbal AS STRING)) AS balance, concat('Ms  ', c_mktsegment) AS name,
  concat('02', lpad(CAST(c_custkey AS STRING), 7, '0'), '/08', lpad(CAST(c_custkey AS STRING), 8, '0')) AS phone,
  CASE WHEN c_nationkey < 5 THEN ' ' ELSE CAST(c_nationkey AS STRING) END AS area FROM {{customer}}
UNION ALL SELECT 2, concat('{BOM}', c_name), '0', 'later', NULL, '99' FROM {{customer}} WHERE c_mktsegment = 'BUILDING'
"""
PARTY_TARGET = """
SELECT c_custkey AS id, c_name AS pid, CAST(c_acctbal AS DOUBLE) AS balance, 'old name' AS name, CAST(NULL AS STRING) AS mobile,
  CAST(NULL AS STRING) AS home FROM {customer} WHERE c_mktsegment <> 'FURNITURE'
"""


@query(sql_merge(plain(PARTY_TARGET), """SELECT c_name AS pid, c_acctbal AS balance, 'Ms ' || c_mktsegment AS name,
  '08' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS mobile, '02' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS home FROM customer""",
  "pid", ["balance", "name", "mobile", "home"], action="updated"))
def load_parties(t: Tables):
    phones = lambda x: c.split_phones(x, F.lit(None).cast("string"))
    spec = TableSpec(
        "parties", "pid", ["pid"], ["delivery"],
        [
            FieldSpec("pid", "pid", c.norm_key, "invalid_key"),
            FieldSpec("balance", "balance", real, "real_parse_failed"),
            FieldSpec("name", "name", c.clean_person_name),
            FieldSpec("mobile", "phone", lambda x: phones(x)[0]),
            FieldSpec("home", "phone", lambda x: phones(x)[1]),
        ],
        mode="overwrite",
    )
    return loads.run_load(spec, t.derive(PARTY_ROWS), t.derive(PARTY_TARGET)).rows


ADDRESSES = "SELECT c_custkey * 2 AS address_id, c_name AS pid, CAST(c_nationkey AS STRING) AS area FROM {customer} WHERE c_mktsegment <> 'MACHINERY'"


@query(f"""
WITH a AS ({plain(ADDRESSES)}), n AS (SELECT (SELECT max(address_id) FROM a) + row_number() OVER (ORDER BY c_name) AS address_id, c_name AS pid,
  CAST(c_nationkey AS VARCHAR) AS area FROM customer WHERE c_nationkey >= 5 AND c_mktsegment <> 'FURNITURE')
SELECT address_id, pid, area FROM a WHERE pid NOT IN (SELECT c_name FROM customer WHERE c_mktsegment <> 'FURNITURE')
UNION ALL SELECT * FROM n""")
def load_party_addresses(t: Tables):
    # Addresses of the updated parties are replaced; those without any content are not stored.
    parties = t.derive(PARTY_TARGET).select("pid")
    rows = distinct_on(
        t.derive(PARTY_ROWS).withColumn("pid", c.norm_key(col("pid"))), ["pid"], [col("delivery")]
    ).select("pid", c.null_if_blank(col("area")).alias("area"))
    return merge.replace_children(t.derive(ADDRESSES), parties, rows, "pid", ["area"], "address_id")[0]


# --- appointment ------------------------------------------------------------------------------

APPOINTMENTS = f"""
SELECT r.*, concat('Customer#', lpad(r.cust_key, 9, '0')) AS party FROM ({RAW_ORDERS}) r
"""
APPOINTMENT_TARGET = """
SELECT o_orderkey AS id, CAST(o_orderkey AS STRING) AS schedule, o_custkey AS patient, o_orderdate AS visit_at,
  CASE WHEN o_orderstatus = 'P' THEN 'cancelled' ELSE 'waiting' END AS status,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'phone' END AS channel, CAST(NULL AS BIGINT) AS slot FROM {orders} WHERE year(o_orderdate) < 1999
"""
SLOTS = "SELECT event_id AS slot_id, date_format(ts, 'HH:mm') AS clock FROM {events}"
LABELS = {"no_show": "no show", "completed": "completed", "default": "waiting"}


@query(f"""
WITH t AS ({plain(APPOINTMENT_TARGET)}), crowd AS ({CROWD}),
asked AS (SELECT DISTINCT 'Customer#' || lpad(cust_key, 9, '0') AS pid FROM ({RAW})),
known AS (SELECT pid, first_name, id FROM crowd UNION ALL SELECT pid, 'INFERRED', (SELECT max(id) FROM crowd) + row_number() OVER (ORDER BY pid)
  FROM asked WHERE lower(pid) NOT IN (SELECT lower(pid) FROM crowd)),
s AS (SELECT {sql_blank('order_key')} AS schedule, {sql_era(2200)} AS visit_at, 'Customer#' || lpad(cust_key, 9, '0') AS party, is_done FROM ({RAW}) WHERE {sql_blank('order_key')} IS NOT NULL),
f AS (SELECT schedule, visit_at, CASE WHEN is_done = 'P' THEN 'no show' WHEN visit_at < TIMESTAMP '1999-06-01' THEN 'completed' ELSE 'waiting' END AS status,
  (SELECT id FROM known WHERE lower(pid) = lower(party) ORDER BY first_name = 'INFERRED', pid <> party, id LIMIT 1) AS patient,
  (SELECT min(event_id) FROM events WHERE strftime(ts, '%H:%M') = strftime(visit_at, '%H:%M')) AS slot FROM s)
SELECT t.id, t.schedule, CASE WHEN f.schedule IS NULL THEN t.patient ELSE f.patient END AS patient, CASE WHEN f.schedule IS NULL THEN t.visit_at ELSE f.visit_at END AS visit_at,
  CASE WHEN f.schedule IS NOT NULL AND t.status = 'waiting' THEN f.status ELSE t.status END AS status,
  CASE WHEN f.schedule IS NULL THEN t.channel ELSE coalesce(t.channel, 'walk in') END AS channel, CASE WHEN f.schedule IS NULL THEN t.slot ELSE f.slot END AS slot
FROM t LEFT JOIN f USING (schedule)
UNION ALL SELECT (SELECT max(id) FROM t) + row_number() OVER (ORDER BY schedule), schedule, patient, visit_at, status, 'walk in', slot
FROM f WHERE schedule NOT IN (SELECT schedule FROM t)""")
def load_appointments(t: Tables):
    people = t.derive(PEOPLE)
    slots = t.events.select(col("event_id").alias("slot_id"), c.clock_slot(col("ts")).alias("clock"))

    def finish(df):
        as_of = F.lit("1999-06-01").cast("timestamp_ntz")
        status = c.derive_status(col("visit_at"), col("is_done").isNull(), as_of, LABELS)
        out = df.withColumn("status", status).withColumn("channel", F.lit("walk in"))
        return resolve.lookup_slot(out, slots, c.clock_slot(col("visit_at")), "clock", "slot_id", out="slot")

    spec = TableSpec(
        "appointments", "row_id", ["schedule"], ["row_id"],
        [
            FieldSpec("schedule", "order_key", c.norm_key, "invalid_key"),
            FieldSpec("visit_at", "order_date", era(2200), "datetime_parse_failed"),
            FieldSpec("is_done", "is_done", lambda x: c.to_bool(x, "sql")),
        ],
        [
            RelationSpec(
                "patient", "party", people, ["pid"], placeholder=lambda: c.is_placeholder(col("first_name"), "INFERRED"),
                ensure=resolve.ParentTemplate("pid", "id", "first_name", "last_name", "INFERRED", "PID "),
            )
        ],
        mode="policy", transform=finish,
        policies={"status": merge.only_if("waiting"), "channel": merge.only_if_null},
    )
    rows = loads.run_load(spec, t.derive(APPOINTMENTS), t.derive(APPOINTMENT_TARGET)).rows
    return rows.select("id", "schedule", "patient", "visit_at", "status", "channel", "slot")


# --- logs -------------------------------------------------------------------------------------

RESCHEDULES = """
SELECT event_id AS row_id, CAST(user_id * 7 AS STRING) AS schedule, concat(CAST(year(ts) + 543 AS STRING), substr(CAST(ts AS STRING), 5, 15)) AS moved_to
FROM {events} WHERE event_type <> 'click'
"""


@query(f"""
SELECT event_id AS log_id, NULL::BIGINT AS appointment, ts AS moved_to, NULL::BIGINT AS slot FROM events WHERE event_type = 'click'
UNION ALL SELECT NULL, (SELECT o_orderkey FROM orders WHERE o_orderkey = user_id * 7), date_trunc('second', ts),
  (SELECT min(e.event_id) FROM events e WHERE strftime(e.ts, '%H:%M') = strftime(events.ts, '%H:%M')) FROM events WHERE event_type <> 'click'""")
def load_reschedule_log(t: Tables):
    slots = t.events.select(col("event_id").alias("slot_id"), c.clock_slot(col("ts")).alias("clock"))
    appointments = t.orders.select(col("o_orderkey").cast("string").alias("old_id"), col("o_orderkey").alias("id"))
    spec = TableSpec(
        "reschedules", "row_id", [], [], [FieldSpec("moved_to", "moved_to", era(2200), "datetime_parse_failed")],
        [RelationSpec("appointment", "schedule", appointments, ["old_id"])], mode="append",
        transform=lambda df: resolve.lookup_slot(df, slots, c.clock_slot(col("moved_to")), "clock", "slot_id", out="slot"),
    )
    target = t.events.filter("event_type = 'click'").select(
        col("event_id").alias("log_id"), F.lit(None).cast("bigint").alias("appointment"),
        col("ts").alias("moved_to"), F.lit(None).cast("bigint").alias("slot"),
    )
    return loads.run_load(spec, t.derive(RESCHEDULES), target).rows.drop("merge_action")


@query("""
SELECT event_id AS log_id, c_custkey AS patient, event_type AS kind FROM events LEFT JOIN customer ON c_custkey = user_id AND c_mktsegment <> 'FURNITURE'""")
def load_patient_log(t: Tables):
    staging = t.events.select("event_id", F.lower(F.concat(F.lit("CUSTOMER#"), F.lpad(col("user_id").cast("string"), 9, "0"))).alias("pid"), "event_type")
    spec = TableSpec(
        "patient_log", "event_id", [], [],
        [FieldSpec("log_id", "event_id", lambda x: x), FieldSpec("kind", "event_type")],
        [RelationSpec("patient", "pid", t.derive(KNOWN_CUSTOMERS), ["pid"], placeholder=lambda: F.lit(False))], mode="append",
    )
    target = t.spark.createDataFrame([], "log_id bigint, patient bigint, kind string")
    return loads.run_load(spec, staging, target).rows.drop("merge_action")


# --- examination ------------------------------------------------------------------------------

DOCTORS = "SELECT DISTINCT CAST(o_orderpriority = '3-MEDIUM' AS BIGINT) + 40 AS id, o_orderpriority AS name FROM {orders} WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM')"
EXAM_TARGET = """
SELECT o_orderkey * 2 AS id, o_orderkey AS exam, o_custkey AS patient, o_orderdate AS examined_at, o_totalprice AS price, CAST(NULL AS BIGINT) AS doctor,
  CAST(NULL AS BIGINT) AS appointment FROM {orders} WHERE o_orderstatus = 'F'
"""


SQL_EXAMS = f"""
WITH t AS ({plain(EXAM_TARGET)}),
known AS ({plain(DOCTORS)}),
d AS (SELECT id, name FROM known UNION ALL SELECT (SELECT max(id) FROM known) + row_number() OVER (ORDER BY o_orderpriority), o_orderpriority FROM
  (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority NOT IN (SELECT name FROM known))),
s AS (SELECT try_cast({sql_blank('order_key')} AS BIGINT) AS exam, CASE WHEN cust_key <> '0' THEN (SELECT id FROM ({KNOWN}) WHERE id = CAST(cust_key AS BIGINT)) END AS patient,
  {sql_era(2400, after_t=False)} AS examined_at, {SQL_PRICE} AS price, priority FROM (SELECT *, {SQL_NUMBER} AS n FROM ({RAW}))),
f AS (SELECT s.exam, s.patient, s.examined_at, s.price, d.id AS doctor, a.id AS appointment FROM s JOIN d ON d.name = s.priority
  LEFT JOIN (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, min(o_orderkey) AS id FROM orders WHERE o_orderstatus = 'O' GROUP BY ALL) a
  ON a.o_custkey = s.patient AND a.day = CAST(s.examined_at AS DATE) WHERE s.exam IS NOT NULL)
SELECT *, 'kept' AS merge_action FROM t UNION ALL
SELECT (SELECT max(id) FROM t) + row_number() OVER (ORDER BY exam), *, 'inserted' FROM f WHERE exam NOT IN (SELECT exam FROM t)"""


@query(SQL_EXAMS)
def load_examinations(t: Tables):
    return exam_load(t)[0].rows


EXAM_BOOKINGS = "SELECT o_orderkey AS id, CASE WHEN o_orderpriority = '5-LOW' THEN '9' ELSE '0' END AS status FROM {orders} WHERE o_orderstatus = 'O'"


@query(f"""
SELECT id, CASE WHEN status = '0' AND e THEN '2' ELSE status END AS status, CASE WHEN status = '0' AND e THEN 'updated' ELSE 'kept' END AS merge_action
FROM (SELECT *, id IN (SELECT appointment FROM ({SQL_EXAMS}) WHERE appointment IS NOT NULL) AS e FROM ({plain(EXAM_BOOKINGS)}))""")
def load_exam_bookings(t: Tables):
    # Bookings that an exam of the load belongs to are completed, unless they have a status of their own.
    return merge.exists_complete(t.derive(EXAM_BOOKINGS), exam_load(t)[0].rows, "id", "appointment", "status", "0", "2")


@query(f"""
SELECT x.* EXCLUDE (patient), coalesce(patient, CASE WHEN exam > 0 THEN o_custkey END) AS patient
FROM ({SQL_EXAMS}) x LEFT JOIN (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'F') ON o_orderkey = exam""")
def load_exam_patients(t: Tables):
    # Exams whose person is not known by the own key take the one that was booked under the same number.
    booked = t.orders.filter("o_orderstatus <> 'F'")
    return merge.backfill_from_lookup(exam_load(t)[0].rows, booked, "exam", "o_orderkey", "o_custkey", "patient")


@query(f"""
WITH known AS ({plain(DOCTORS)})
SELECT id, name FROM known UNION ALL SELECT (SELECT max(id) FROM known) + row_number() OVER (ORDER BY o_orderpriority), o_orderpriority FROM
  (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority NOT IN (SELECT name FROM known))""")
def load_exam_doctors(t: Tables):
    # The dimension as the load leaves it: exams refer to the doctors it made.
    load, made = exam_load(t)
    load.shaped  # noqa: B018
    return made["doctors"].select("id", "name")


def exam_load(t: Tables):
    """(the load, other tables it changes: filled when its rows are shaped)."""
    made = {}
    parents = t.derive(KNOWN_CUSTOMERS).select(col("id").cast("string").alias("old_id"), "id")
    bookings = t.orders.filter("o_orderstatus = 'O'").select(
        col("o_custkey").alias("patient"), col("o_orderdate").alias("examined_at"), col("o_orderkey").alias("booking")
    )

    def finish(df):
        named, made["doctors"] = resolve.find_or_create_dim(df, "doctor_name", t.derive(DOCTORS), "name", "id")
        named = named.withColumnRenamed("id", "doctor").withColumn("appointment", F.lit(None).cast("bigint"))
        return resolve.fallback_same_day(named, bookings, "patient", "examined_at", "booking", "appointment")

    spec = TableSpec(
        "examinations", "row_id", ["exam"], ["row_id"],
        [
            FieldSpec("exam", "order_key", integer, "invalid_key"),
            FieldSpec("examined_at", "order_date", era(2400, time_after_t=False), "timestamp_parse_failed"),
            FieldSpec("price", "total_price", real, "real_parse_failed"),
            FieldSpec("doctor_name", "priority"),
        ],
        [RelationSpec("patient", "cust_key", parents, ["old_id"], sentinels=["0"])], mode="insert_only", transform=finish,
    )
    return loads.run_load(spec, t.derive(RAW_ORDERS), t.derive(EXAM_TARGET)), made


# --- billing ----------------------------------------------------------------------------------

BILL_TARGET = """
SELECT o_orderkey + 7 AS id, o_orderkey AS exam, CAST(NULL AS BIGINT) AS patient, o_totalprice - 5 AS total, CAST(NULL AS DOUBLE) AS final_total,
  '0' AS method, o_orderkey AS finance_work, 'note' AS remark FROM {orders} WHERE o_orderpriority = '1-URGENT'
"""


@query(f"""
WITH t AS ({plain(BILL_TARGET)}),
s AS (SELECT try_cast({sql_blank('order_key')} AS BIGINT) AS exam, (SELECT id FROM ({KNOWN}) WHERE id = CAST(cust_key AS BIGINT)) AS patient, {SQL_PRICE} AS total, is_done, priority[1] AS care_right
  FROM (SELECT *, {SQL_NUMBER} AS n FROM ({RAW})) WHERE {sql_blank('order_key')} IS NOT NULL),
f AS (SELECT exam, patient, total, total AS final_total, CASE WHEN is_done = 'Y' OR is_done = 'No' AND care_right IN ('3', '4', '5', '6') THEN '3' WHEN is_done = 'No' THEN '1' ELSE '2' END AS method FROM s)
SELECT t.id, t.exam, CASE WHEN f.exam IS NULL THEN t.patient ELSE f.patient END AS patient, CASE WHEN f.exam IS NULL THEN t.total ELSE f.total END AS total,
  CASE WHEN f.exam IS NULL THEN t.total ELSE f.total END AS final_total, CASE WHEN f.exam IS NULL THEN '2' ELSE f.method END AS method, t.finance_work, CASE WHEN f.exam IS NULL THEN t.remark END AS remark
FROM t LEFT JOIN f USING (exam)
UNION ALL SELECT (SELECT max(id) FROM t) + row_number() OVER (ORDER BY exam), exam, patient, total, final_total, method, NULL, NULL FROM f WHERE exam NOT IN (SELECT exam FROM t)""")
def load_billing(t: Tables):
    parents = t.derive(KNOWN_CUSTOMERS).select(col("id").cast("string").alias("old_id"), "id")

    def derive(df):
        df = df.withColumn("method", F.nullif(col("method"), F.lit("0")))
        return merge.derive_if_null(df, {"final_total": col("total"), "method": F.lit("2")})

    spec = TableSpec(
        "billing", "row_id", ["exam"], ["row_id"],
        [
            FieldSpec("exam", "order_key", integer, "invalid_key"),
            FieldSpec("total", "total_price", real, "numeric_parse_failed"),
            FieldSpec("care", "is_done", lambda x: F.when(x == "Y", "2").when(x == "No", "1")),
            FieldSpec("right", "priority", lambda x: F.substring(x, 1, 1)),
        ],
        [RelationSpec("patient", "cust_key", parents, ["old_id"])], mode="replace", keep=["finance_work"],
        transform=lambda df: df.withColumn("method", loads.payment_method(col("care"), col("right"))),
        post_load=derive,
    )
    return loads.run_load(spec, t.derive(RAW_ORDERS), t.derive(BILL_TARGET)).rows.drop("merge_action")


# --- exam general, recommendation -------------------------------------------------------------

GENERAL_ROWS = """
SELECT event_id AS row_id, CAST(user_id AS STRING) AS exam, concat(CAST(user_id AS STRING), '|6') AS screening, event_type AS category,
  CASE WHEN event_id % 3 = 0 THEN ' ' ELSE props END AS remark, CASE WHEN event_type = 'view' THEN ' seen ' END AS finding FROM {events}
"""
GENERAL_TARGET = "SELECT c_custkey + 3 AS id, c_custkey AS exam, '[9]' AS screening, 'x' AS category, 'old' AS note, 'lost' AS extra FROM {customer} WHERE c_nationkey < 10"
#: Meanings of categories as they were entered over time; the first one of each holds.
CATEGORIES = "SELECT event_type AS old_value, CAST(event_id % 4 + 2 AS STRING) AS new_value, event_id AS entered FROM {events} WHERE event_type IN ('click', 'view')"


@query(f"""
WITH t AS ({plain(GENERAL_TARGET)}), d AS (SELECT old_value, new_value FROM ({plain(CATEGORIES)}) QUALIFY row_number() OVER (PARTITION BY old_value ORDER BY entered) = 1),
s AS (SELECT CAST(exam AS BIGINT) AS exam, '[' || CASE WHEN exam = '6' THEN '20' ELSE exam END || ',20]' AS screening, new_value AS category,
  nullif(concat_ws(' ', {sql_blank('finding')}, {sql_blank('remark')}), '') AS note
  FROM (SELECT *, row_number() OVER (PARTITION BY exam ORDER BY row_id) AS rn FROM ({plain(GENERAL_ROWS)})) LEFT JOIN d ON old_value = category WHERE rn = 1)
SELECT t.id, t.exam, coalesce(s.screening, t.screening) AS screening, CASE WHEN s.exam IS NULL THEN t.category ELSE s.category END AS category,
  CASE WHEN s.exam IS NULL THEN t.note ELSE s.note END AS note, CASE WHEN s.exam IS NULL THEN t.extra END AS extra FROM t LEFT JOIN s USING (exam)
UNION ALL SELECT (SELECT max(id) FROM t) + row_number() OVER (ORDER BY exam), *, NULL FROM s WHERE exam NOT IN (SELECT exam FROM t)""")
def load_exam_general(t: Tables):
    dictionary = distinct_on(t.derive(CATEGORIES), ["old_value"], [col("entered")], ["old_value", "new_value"])
    spec = TableSpec(
        "exam_general", "row_id", ["exam"], ["row_id"],
        [
            FieldSpec("exam", "exam", integer, "invalid_key"),
            FieldSpec("screening", "screening", lambda x: c.remap_code_list(x, {6: 20})),
            FieldSpec("category", "category"), FieldSpec("note", "note"),
        ],
        mode="replace", transform=lambda df: shape.dictionary_remap(df, "category", dictionary),
    )
    staging = t.derive(GENERAL_ROWS).withColumn("note", c.concat_nonblank(col("finding"), col("remark")))
    return loads.run_load(spec, staging, t.derive(GENERAL_TARGET)).rows.drop("merge_action")


RECOMMENDED = """SELECT o_orderkey AS exam, CASE WHEN o_orderstatus = 'F' THEN '[{{"side": 1}}]' WHEN o_orderstatus = 'O' THEN '[1]' ELSE '["{{free text}}"]' END AS advice FROM {orders}"""


# Elements of a list in one row; longer lists go on in further parts. Small here, so that lists have several.
ADVICE_ITEMS, FINDING_ITEMS = 3, 2


@query(f"""
WITH l AS (SELECT l_orderkey, list({{'line': l_linenumber, 'place': CASE l_returnflag WHEN 'A' THEN 'LEFT' ELSE upper(l_returnflag || 'x') END}}
  ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS a FROM lineitem GROUP BY 1),
p AS (SELECT l_orderkey, a, unnest(range(0, (len(a) + {ADVICE_ITEMS} - 1) // {ADVICE_ITEMS})) AS part FROM l)
SELECT o_orderkey AS exam, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE coalesce(part, 0) END AS part, CASE WHEN o_orderstatus = 'F' THEN '[{{"side": 1}}]'
  WHEN a IS NULL THEN CASE o_orderstatus WHEN 'O' THEN '[1]' ELSE '["{{free text}}"]' END ELSE to_json(a[{ADVICE_ITEMS} * part + 1:{ADVICE_ITEMS} * (part + 1)]) END AS advice
FROM orders LEFT JOIN p ON l_orderkey = o_orderkey AND (o_orderstatus <> 'F' OR part = 0)""")
def load_recommendations(t: Tables):
    places = t.lineitem.select(F.lower(F.concat(col("l_returnflag"), F.lit("x"))).alias("old_value")).distinct().withColumn(
        "new_value", F.when(col("old_value") == "ax", "LEFT")
    ).filter("new_value is not null")
    lines = t.lineitem.withColumns(
        {"line": col("l_linenumber"), "place": F.lower(F.concat(col("l_returnflag"), F.lit("x")))}
    )
    lines = shape.dictionary_remap(lines, "place", places, "upper", fold=True)
    order = [col(n) for n in ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")]
    grouped = document.group_to_struct_array(lines, ["l_orderkey"], order, ["line", "place"], "advice", ADVICE_ITEMS)
    lists = grouped.select(col("l_orderkey").alias("exam"), "part", F.to_json("advice").alias("advice"))
    target = t.derive(RECOMMENDED).withColumn("part", F.lit(0))
    return merge.array_parts_unless_object(target, lists, "exam", "advice").drop("merge_action")


# --- image sync, procedures, imaging, findings ------------------------------------------------

#: Some persons were made from a reference only, and some keys are known as an older key of another person.
KEYED_PEOPLE = """
SELECT c_custkey AS id, CAST(c_custkey AS STRING) AS pid, CAST(c_custkey + 2 AS STRING) AS older_pid, c_custkey % 7 = 0 AS inferred
FROM {customer} WHERE c_custkey % 5 NOT IN (0, 3)
"""
SQL_KEYED = f"""SELECT pid, id FROM (SELECT pid, id, inferred, 0 AS r FROM ({plain(KEYED_PEOPLE)}) UNION ALL SELECT older_pid, id, inferred, 1 FROM ({plain(KEYED_PEOPLE)}))
  QUALIFY row_number() OVER (PARTITION BY pid ORDER BY inferred, r, id) = 1"""
SYNC_ROWS = """
SELECT CASE WHEN event_type = 'error' THEN ' ' ELSE CAST(event_id AS STRING) END AS accession, CAST(user_id AS STRING) AS exam, CAST(ts AS STRING) AS synced,
  event_type AS modality, CASE WHEN event_id % 10 = 0 THEN '' ELSE CAST(user_id AS STRING) END AS person FROM {events}
"""
SYNC_TARGET = """
SELECT event_id + 1 AS id, CAST(event_id AS STRING) AS accession, CAST(NULL AS BIGINT) AS exam, 'old' AS modality, CAST(NULL AS BIGINT) AS patient, 'none' AS fingerprint
FROM {events} WHERE event_type = 'view'
"""


@query(f"""
WITH t AS ({plain(SYNC_TARGET)}), p AS ({SQL_KEYED}),
r AS (SELECT *, CASE WHEN event_type = 'error' THEN sha256(CAST(user_id AS VARCHAR) || chr(30) || CAST(ts AS VARCHAR) || chr(30) || event_type) END AS d FROM events),
n AS (SELECT CASE WHEN d IS NULL THEN CAST(event_id AS VARCHAR) ELSE '__blank__' || left(sha256(d || chr(30) || 'ord:' || row_number() OVER (PARTITION BY d ORDER BY event_id)), 40) END AS accession, * FROM r),
s AS (SELECT accession, (SELECT c_custkey FROM customer WHERE c_custkey = user_id) AS exam, event_type AS modality, p.id AS patient,
  sha256('A:' || accession || '|P:' || CASE WHEN event_id % 10 = 0 THEN '~' ELSE CAST(user_id AS VARCHAR) END || '|S:' || CAST(ts AS VARCHAR) || '|M:' || event_type) AS fingerprint
  FROM n LEFT JOIN p ON p.pid = CAST(user_id AS VARCHAR) AND event_id % 10 <> 0)
SELECT t.id, t.accession, coalesce(s.exam, t.exam) AS exam, coalesce(s.modality, t.modality) AS modality, coalesce(s.patient, t.patient) AS patient,
  coalesce(s.fingerprint, t.fingerprint) AS fingerprint FROM t LEFT JOIN s USING (accession)
UNION ALL SELECT (SELECT max(id) FROM t) + row_number() OVER (ORDER BY accession), accession, exam, modality, patient, fingerprint FROM s WHERE accession NOT IN (SELECT accession FROM t)""")
def load_image_sync(t: Tables):
    staging = k.synthetic_key(t.derive(SYNC_ROWS), "accession", ["exam", "synced", "modality"], "__blank__")
    staging = staging.withColumn(
        "fingerprint", k.row_fingerprint({"A": col("accession"), "P": col("person")}, {"S": col("synced"), "M": col("modality")})
    )
    exams = t.customer.select(col("c_custkey").cast("string").alias("old_id"), col("c_custkey").alias("id"))
    spec = TableSpec(
        "image_sync", "accession", ["accession"], ["synced", "modality"],
        [FieldSpec("accession", "accession"), FieldSpec("modality", "modality"), FieldSpec("fingerprint", "fingerprint")],
        [
            RelationSpec("exam", "exam", exams, ["old_id"]),
            RelationSpec("patient", "person", t.derive(KEYED_PEOPLE), ["pid", "older_pid"], placeholder=lambda: col("inferred")),
        ],
        mode="replace",
    )
    return loads.run_load(spec, staging, t.derive(SYNC_TARGET)).rows.drop("merge_action")


PROCEDURES = """
SELECT concat(CAST(l_orderkey AS STRING), '_', CAST(l_linenumber AS STRING)) AS old_key, CAST(l_orderkey AS STRING) AS exam,
  md5(CAST(l_orderkey AS STRING)) AS token, l_returnflag AS flag, l_partkey, l_suppkey, l_extendedprice FROM {lineitem}
"""


SQL_PROCEDURES = """
SELECT l_orderkey || '_' || l_linenumber AS old_key, o_orderkey AS exam, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F') THEN '3' ELSE '1' END AS state,
  l_returnflag = 'A' AS is_repeat FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem)
LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') ON o_orderkey = l_orderkey WHERE rn = 1"""


def procedure_load(t: Tables, mode: str = "if_changed"):
    exams = t.orders.filter("o_orderstatus <> 'P'").select(col("o_orderkey").cast("string").alias("old_id"), col("o_orderkey").alias("id"))
    signed = t.lineitem.filter("l_linestatus = 'F'")
    spec = TableSpec(
        "procedures", "old_key", ["old_key"], ["l_partkey", "l_suppkey", "l_extendedprice"],
        [
            FieldSpec("old_key", "old_key"), FieldSpec("token", "token", c.guard_uuid),
            FieldSpec("is_repeat", "flag", lambda x: F.coalesce(c.null_if_blank(x) == "A", F.lit(False))),
        ],
        [RelationSpec("exam", "exam", exams, ["old_id"])], mode=mode,
        transform=lambda df: shape.signed_state(df, signed, "exam", "l_orderkey", "3", "1"),
    )
    return loads.run_load(spec, t.derive(PROCEDURES), t.derive(PROCEDURE_TARGET))


@query(SQL_PROCEDURES)
def load_procedures(t: Tables):
    return procedure_load(t).shaped.select("old_key", "exam", "state", "is_repeat")


# Loaded before: lines that were finished, some without their exam, none with the repeat mark; and some that the source has not.
PROCEDURE_TARGET = """
SELECT l_orderkey * 1000 + l_linenumber AS id, concat(CAST(l_orderkey AS STRING), '_', CAST(l_linenumber AS STRING)) AS old_key,
  CASE WHEN min(l_returnflag) <> 'R' THEN l_orderkey END AS exam, '9' AS state, CAST(NULL AS BOOLEAN) AS is_repeat
FROM {lineitem} WHERE l_linestatus = 'F' GROUP BY l_orderkey, l_linenumber
UNION ALL SELECT 900000000 + o_orderkey, concat('old_', CAST(o_orderkey AS STRING)), o_orderkey, '2', true FROM {orders} WHERE o_orderstatus = 'P'
"""


@query(f"""
WITH t AS ({plain(PROCEDURE_TARGET)}), s AS ({SQL_PROCEDURES})
SELECT t.id, t.old_key, coalesce(t.exam, s.exam) AS exam, t.state, coalesce(t.is_repeat, s.is_repeat) AS is_repeat, CASE WHEN s.old_key IS NULL THEN 'kept' ELSE 'filled' END AS merge_action
FROM t LEFT JOIN s USING (old_key)
UNION ALL SELECT (SELECT max(id) FROM t) + row_number() OVER (ORDER BY old_key), old_key, exam, state, is_repeat, 'inserted' FROM s WHERE old_key NOT IN (SELECT old_key FROM t)""")
def load_procedures_filled(t: Tables):
    # What the target has wins; its empty columns take the source's values.
    return procedure_load(t, "fill_null").rows


@query(f"""
WITH t AS ({plain(PROCEDURE_TARGET)}), s AS ({SQL_PROCEDURES})
SELECT *, 'kept' AS merge_action FROM t WHERE old_key NOT IN (SELECT old_key FROM s)
UNION ALL SELECT (SELECT max(id) FROM t) + row_number() OVER (ORDER BY old_key), old_key, exam, state, is_repeat,
  CASE WHEN old_key IN (SELECT old_key FROM t) THEN 'replaced' ELSE 'inserted' END FROM s""")
def load_procedures_replaced(t: Tables):
    # Rows of a reloaded key are deleted and written anew: their ids are not kept.
    return procedure_load(t, "replace_new").rows


@query("""
SELECT l_orderkey || '_' || l_linenumber AS record_id, 'exam' AS field, 'exam_not_resolved' AS reason, CAST(l_orderkey AS VARCHAR) AS source_raw
FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def load_procedure_issues(t: Tables):
    return procedure_load(t).issues


IMAGING_TARGET = "SELECT o_orderkey + 4 AS id, o_orderkey AS exam, '[]' AS codes, '0' AS mass, 'none' AS mass_des, '' AS mass_number, '1' AS state FROM {orders} WHERE o_orderstatus = 'F'"


@query(f"""
WITH t AS ({plain(IMAGING_TARGET)}), n AS (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
s AS (SELECT o_orderkey AS exam, '[' || o_custkey || ']' AS codes, CASE coalesce(n, 0) WHEN 0 THEN '1' WHEN 1 THEN '2' ELSE '3' END AS mass,
  CASE coalesce(n, 0) WHEN 0 THEN 'none returned' WHEN 1 THEN 'one returned' ELSE 'some returned' END AS mass_des, CASE WHEN n > 1 THEN CAST(n AS VARCHAR) ELSE '' END AS mass_number,
  CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F') THEN '3' ELSE '1' END AS state FROM orders LEFT JOIN n ON l_orderkey = o_orderkey)
SELECT t.id, s.* FROM t JOIN s USING (exam)
UNION ALL SELECT (SELECT max(id) FROM t) + row_number() OVER (ORDER BY exam), * FROM s WHERE exam NOT IN (SELECT exam FROM t)""")
def load_imaging(t: Tables):
    masses = {"mass": (t.lineitem.filter("l_returnflag = 'R'"), "l_orderkey")}
    labels = {"mass": ("none returned", "one returned", "some returned")}
    signed = t.lineitem.filter("l_linestatus = 'F'")

    def finish(df):
        counted = profile.child_count_summary(df, "exam", masses, labels)
        return shape.signed_state(counted, signed, "exam", "l_orderkey", "3", "1")

    spec = TableSpec(
        "imaging", "o_orderkey", ["exam"], ["o_custkey"],
        [FieldSpec("exam", "o_orderkey", integer), FieldSpec("codes", "o_custkey", lambda x: c.to_json_array(x.cast("string")))],
        mode="replace", transform=finish,
    )
    return loads.run_load(spec, t.orders, t.derive(IMAGING_TARGET)).rows.drop("merge_action")


FINDING_TARGET = """
SELECT min(l_partkey) + 11 AS id, l_orderkey AS exam, CAST(l_linenumber AS BIGINT) AS child, 'old' AS shape, CAST(NULL AS BIGINT) AS parent
FROM {lineitem} WHERE l_linestatus = 'F' GROUP BY l_orderkey, l_linenumber
"""
FINDING_PARENTS = """
SELECT o_orderkey + 4 AS id, CAST(o_orderkey AS STRING) AS old_id FROM {orders} WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_orderkey + 900, concat(' ', CAST(o_orderkey AS STRING)) FROM {orders} WHERE o_orderpriority = '1-URGENT'
"""
SQL_PARENTS = f"SELECT CAST(trim(old_id) AS BIGINT) AS exam, min(id) AS parent FROM ({plain(FINDING_PARENTS)}) GROUP BY 1"


def finding_load(t: Tables):
    # An exam may have several parent rows: the lowest id is taken.
    spec = TableSpec(
        "findings", "l_orderkey", ["exam", "child"], ["l_partkey", "l_suppkey", "l_extendedprice"],
        [FieldSpec("exam", "l_orderkey", integer), FieldSpec("child", "l_linenumber", integer), FieldSpec("shape", "l_returnflag")],
        [RelationSpec("parent", "l_orderkey", t.derive(FINDING_PARENTS), ["old_id"])], mode="replace",
    )
    return loads.run_load(spec, t.lineitem, t.derive(FINDING_TARGET))


@query(f"""
WITH t AS ({plain(FINDING_TARGET)}), p AS ({SQL_PARENTS}), s AS (SELECT l_orderkey AS exam, CAST(l_linenumber AS BIGINT) AS child, l_returnflag AS shape, parent FROM
  (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) LEFT JOIN p ON exam = l_orderkey WHERE rn = 1)
SELECT t.id, exam, child, s.shape, s.parent FROM t JOIN s USING (exam, child)
UNION ALL SELECT (SELECT max(id) FROM t) + row_number() OVER (ORDER BY exam, child), * FROM s WHERE (exam, child) NOT IN (SELECT (exam, child) FROM t)""")
def load_findings(t: Tables):
    return finding_load(t).rows.drop("merge_action")


@query(f"""
SELECT CAST(l_orderkey AS VARCHAR) AS record_id, 'parent' AS field, 'parent_not_resolved' AS reason, CAST(l_orderkey AS VARCHAR) AS source_raw
FROM lineitem WHERE l_orderkey NOT IN (SELECT exam FROM ({SQL_PARENTS}))""")
def load_finding_issues(t: Tables):
    return finding_load(t).issues


# --- pathology, special cases, income ---------------------------------------------------------

PATHO_TARGET = """
SELECT o_orderkey + 2 AS id, CAST(o_custkey AS STRING) AS old_pid, o_orderkey AS surgical, CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE o_custkey END AS patient,
  CAST(NULL AS BIGINT) AS exam, 'P' AS code FROM {orders} WHERE year(o_orderdate) < 1999
"""
PATHO_ROWS = """
SELECT o_orderkey AS row_id, CAST(o_custkey AS STRING) AS old_pid, CASE WHEN o_orderkey % 101 = 0 THEN 'x1' ELSE CAST(o_orderkey AS STRING) END AS surgical,
  CAST(o_orderkey * 2 AS STRING) AS exam, o_orderstatus AS code FROM {orders}
"""
SQL_PATHO = f"""SELECT old_pid, try_cast(surgical AS BIGINT) AS surgical, k.id AS patient, o.o_orderkey AS exam, code FROM ({plain(PATHO_ROWS)})
  LEFT JOIN ({KNOWN}) k ON CAST(k.id AS VARCHAR) = old_pid LEFT JOIN orders o ON CAST(o.o_orderkey AS VARCHAR) = exam WHERE try_cast(surgical AS BIGINT) IS NOT NULL"""


def pathology(t: Tables, mode: str, policies=None):
    people = t.derive(KNOWN_CUSTOMERS).select(col("id").cast("string").alias("old_id"), "id")
    exams = t.orders.select(col("o_orderkey").cast("string").alias("old_id"), col("o_orderkey").alias("id"))
    spec = TableSpec(
        "pathology", "row_id", ["old_pid", "surgical"], ["row_id"],
        [
            FieldSpec("old_pid", "old_pid", c.int_or_text_id), FieldSpec("surgical", "surgical", integer, "key_not_mappable"),
            FieldSpec("code", "code"),
        ],
        [RelationSpec("patient", "old_pid", people, ["old_id"]), RelationSpec("exam", "exam", exams, ["old_id"])],
        mode=mode, policies=policies or {},
    )
    return loads.run_load(spec, t.derive(PATHO_ROWS), t.derive(PATHO_TARGET))


@query(f"""
WITH t AS ({plain(PATHO_TARGET)}), s AS ({SQL_PATHO})
SELECT t.id, t.old_pid, t.surgical, coalesce(s.patient, t.patient) AS patient, coalesce(s.exam, t.exam) AS exam, coalesce(s.code, t.code) AS code FROM t LEFT JOIN s USING (old_pid, surgical)
UNION ALL SELECT (SELECT max(id) FROM t) + row_number() OVER (ORDER BY old_pid, surgical), * FROM s WHERE surgical NOT IN (SELECT surgical FROM t)""")
def load_pathology(t: Tables):
    return pathology(t, "prefer_source").rows.drop("merge_action")


CASES = """
SELECT concat(CAST(l_orderkey AS STRING), '/', CAST(l_linenumber AS STRING), '/', CAST(l_partkey AS STRING)) AS row_id, CAST(l_suppkey AS STRING) AS old_pid,
  CASE WHEN l_orderkey % 97 = 0 THEN 'n/a' ELSE CAST(l_orderkey * 10 + l_linenumber AS STRING) END AS sequence, l_returnflag AS point,
  concat(l_linestatus, repeat('.', l_linenumber * 3)) AS detail, l_partkey AS read_at FROM {lineitem}
"""
CASE_TARGET = """
SELECT min(l_partkey) * 3 AS id, CAST(l_suppkey AS STRING) AS old_pid, l_orderkey * 10 + l_linenumber AS sequence, CAST(NULL AS BIGINT) AS patient, 'Q' AS point,
  CAST(NULL AS STRING) AS point_text, 'old' AS detail FROM {lineitem} WHERE l_linestatus = 'F' GROUP BY l_suppkey, l_orderkey, l_linenumber
"""
DETAIL_LENGTH = 12
SQL_CASES = f"""SELECT old_pid, try_cast(sequence AS BIGINT) AS sequence, k.id AS patient, point, CASE point WHEN 'A' THEN 'first' WHEN 'R' THEN 'last' END AS point_text, left(detail, {DETAIL_LENGTH}) AS detail
  FROM (SELECT *, row_number() OVER (PARTITION BY old_pid, sequence ORDER BY read_at, detail, point) AS rn FROM ({plain(CASES)}) WHERE sequence <> 'n/a') LEFT JOIN ({KNOWN}) k ON CAST(k.id AS VARCHAR) = old_pid WHERE rn = 1"""


def special_cases(t: Tables):
    people = t.derive(KNOWN_CUSTOMERS).select(col("id").cast("string").alias("old_id"), "id")
    points = t.lineitem.select(col("l_returnflag").alias("old_value")).distinct().withColumn(
        "new_value", F.when(col("old_value") == "A", "first").when(col("old_value") == "R", "last")
    )
    text = lambda df: shape.dictionary_remap(df.withColumn("point_text", col("point")), "point_text", points.filter("new_value is not null"))
    spec = TableSpec(
        "special_cases", "row_id", ["old_pid", "sequence"], ["read_at", "detail", "point"],
        [
            FieldSpec("old_pid", "old_pid", c.int_or_text_id), FieldSpec("sequence", "sequence", integer, "key_not_mappable"),
            FieldSpec("point", "point"), FieldSpec("detail", "detail", lambda x: c.clamp_text(x, DETAIL_LENGTH)[0]),
        ],
        [RelationSpec("patient", "old_pid", people, ["old_id"])], mode="prefer_source", transform=text,
    )
    return loads.run_load(spec, t.derive(CASES), t.derive(CASE_TARGET))


@query(f"""
WITH t AS ({plain(CASE_TARGET)}), s AS ({SQL_CASES})
SELECT t.id, t.old_pid, t.sequence, coalesce(s.patient, t.patient) AS patient, coalesce(s.point, t.point) AS point, coalesce(s.point_text, t.point_text) AS point_text, coalesce(s.detail, t.detail) AS detail
FROM t LEFT JOIN s USING (old_pid, sequence)
UNION ALL SELECT (SELECT max(id) FROM t) + row_number() OVER (ORDER BY old_pid, sequence), * FROM s WHERE (old_pid, sequence) NOT IN (SELECT (old_pid, sequence) FROM t)""")
def load_special_cases(t: Tables):
    return special_cases(t).rows.drop("merge_action")


@query(f"""
SELECT reason, count(*)::BIGINT AS records FROM (
  SELECT 'key_not_mappable' AS reason FROM ({plain(CASES)}) WHERE sequence = 'n/a'
  UNION ALL SELECT 'patient_not_resolved' FROM ({plain(CASES)}) WHERE old_pid NOT IN (SELECT CAST(id AS VARCHAR) FROM ({KNOWN}))
  UNION ALL SELECT 'detail_truncated' FROM ({plain(CASES)}) WHERE length(detail) > {DETAIL_LENGTH}
  UNION ALL SELECT 'duplicate_key' FROM ({plain(CASES)}) WHERE sequence <> 'n/a' GROUP BY old_pid, sequence HAVING count(*) > 1) GROUP BY 1""")
def special_case_issues(t: Tables):
    # Lost keys and relations of the load, texts cut, and keys read more than once.
    raw = t.derive(CASES)
    cut = raw.filter(c.clamp_text(col("detail"), DETAIL_LENGTH)[1]).select(F.lit("detail_truncated").alias("reason"))
    keyed = raw.filter(integer(col("sequence")).isNotNull())
    twice = duplicate_keys(keyed, ["old_pid", "sequence"]).select(F.lit("duplicate_key").alias("reason"))
    found = special_cases(t).issues.select("reason").unionByName(cut).unionByName(twice)
    return found.groupBy("reason").agg(F.count(F.lit(1)).alias("records"))


SPELLED = """
SELECT o_orderkey AS row_id, CASE o_orderpriority WHEN '1-URGENT' THEN lower(c_name) WHEN '2-HIGH' THEN concat('  ', upper(c_name), ' ') WHEN '3-MEDIUM' THEN 'NULL'
  WHEN '4-NOT SPECIFIED' THEN concat(c_name, '?') ELSE c_name END AS owner, o_orderstatus AS state FROM {orders} JOIN {customer} ON c_custkey = o_custkey
"""


@query(f"""
SELECT row_id AS id, CASE WHEN owner NOT LIKE '%?' AND owner <> 'NULL' THEN CAST(regexp_extract(owner, '[0-9]+') AS BIGINT) END AS owner,
  CASE WHEN owner LIKE '%?' THEN 'owner_not_resolved' END AS reason FROM ({plain(SPELLED)})""")
def load_issues(t: Tables):
    # Keys that differ from their parents in case and white space, and a sentinel: what a row resolves to, beside its issue.
    parents = t.customer.select(F.concat(F.lit(" "), col("c_name")).alias("name"), col("c_custkey").alias("id"))
    spec = TableSpec(
        "owners", "row_id", ["id"], ["row_id"], [FieldSpec("id", "row_id", lambda x: x.cast("bigint")), FieldSpec("state", "state")],
        [RelationSpec("owner", "owner", parents, ["name"], sentinels=["NULL"])],
    )
    result = loads.run_load(spec, t.derive(SPELLED), t.spark.createDataFrame([], "id bigint, owner bigint, state string"))
    issues = result.issues.select(col("record_id").cast("bigint").alias("id"), "reason")
    return result.shaped.join(issues, "id", "left").select("id", "owner", "reason")


@query(f"""
SELECT 'patient' AS relation, count(*)::BIGINT AS with_key, count(patient)::BIGINT AS resolved FROM ({SQL_PATHO})
UNION ALL SELECT 'issue:' || reason, count(*)::BIGINT, NULL FROM (
  SELECT 'key_not_mappable' AS reason FROM ({plain(PATHO_ROWS)}) WHERE surgical = 'x1'
  UNION ALL SELECT 'patient_not_resolved' FROM ({plain(PATHO_ROWS)}) WHERE old_pid NOT IN (SELECT CAST(id AS VARCHAR) FROM ({KNOWN}))
  UNION ALL SELECT 'exam_not_resolved' FROM ({plain(PATHO_ROWS)}) WHERE CAST(exam AS BIGINT) NOT IN (SELECT o_orderkey FROM orders)) GROUP BY 1""")
def load_quality_report(t: Tables):
    result = pathology(t, "if_changed")
    rates = profile.resolution_rate(result.shaped, {"patient": ("old_pid", "patient")})
    issues = result.issues.groupBy("reason").agg(F.count(F.lit(1)).alias("with_key"))
    return rates.unionByName(
        issues.select(F.concat(F.lit("issue:"), col("reason")).alias("relation"), "with_key"), allowMissingColumns=True
    )


INCOME_MAIN = """
SELECT o_orderkey AS old_id, o_custkey AS payer, concat(' ', CAST(o_totalprice AS STRING)) AS receipt, CASE WHEN o_orderstatus = 'P' THEN 'NULL' ELSE o_orderstatus END AS kind,
  CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' THEN 'soon' ELSE CAST(o_orderdate AS STRING) END AS paid FROM {orders} WHERE o_orderpriority <> '5-LOW'
"""
INCOME_OLD = """
SELECT o_orderkey - 500 AS old_id, o_custkey AS payer, CAST(o_totalprice AS STRING) AS receipt, o_orderstatus AS kind, CAST(o_orderdate AS STRING) AS paid
FROM {orders} WHERE o_orderstatus <> 'P' OR o_orderpriority = '5-LOW'
"""
INCOME_TARGET = """
SELECT o_orderkey AS id, concat('main:', CAST(o_orderkey AS STRING)) AS old_key, CAST(NULL AS BIGINT) AS party, o_orderdate AS paid_at,
  CAST(o_totalprice AS DECIMAL(19,4)) AS receipt, o_orderstatus AS kind, 'chosen' AS purpose FROM {orders} WHERE o_orderpriority = '1-URGENT'
"""
SQL_INCOME = f"""SELECT 'main:' || old_id AS old_key, payer, paid, receipt, nullif(kind, 'NULL') AS kind FROM ({plain(INCOME_MAIN)})
  UNION ALL SELECT 'old:' || old_id, payer, paid, receipt, kind FROM ({plain(INCOME_OLD)}) WHERE old_id + 500 NOT IN (SELECT old_id FROM ({plain(INCOME_MAIN)}))"""
#: Clocks of the source's times.
INCOME_ZONE = "Asia/Bangkok"


def income_load(t: Tables):
    rows = drop_archived_copies(t.derive(INCOME_MAIN), t.derive(INCOME_OLD), "old_id", 500).withColumn(
        "old_key", k.composite_key(F.when(col("source_rank") == 0, "old").otherwise("main"), col("old_id"), sep=":")
    )
    spec = TableSpec(
        "income", "old_key", ["old_key"], ["source_rank", "old_id"],
        [
            FieldSpec("old_key", "old_key"),
            FieldSpec("receipt", "receipt", lambda x: c.to_real_lenient(x, money=True), "numeric_parse_failed"),
            FieldSpec("kind", "kind", lambda x: c.null_if_blank(x, ["NULL"])),
            FieldSpec("paid_at", "paid", lambda x: c.wall_clock_to_instant(x.try_cast("timestamp_ntz"), INCOME_ZONE), "timestamp_parse_failed"),
        ],
        [RelationSpec("party", "payer", t.derive(KEYED_PEOPLE), ["pid", "older_pid"], placeholder=lambda: col("inferred"))],
        mode="policy", transform=lambda df: df.withColumn("purpose", F.lit("service")),
        policies={"purpose": merge.if_condition(col("_s_kind") == "F")},
    )
    return loads.run_load(spec, rows, t.derive(INCOME_TARGET))


@query(f"""
WITH t AS ({plain(INCOME_TARGET)}), p AS ({SQL_KEYED}),
s AS (SELECT old_key, p.id AS party, try_cast(paid AS TIMESTAMP) - INTERVAL 7 HOUR AS paid_at, CAST(trim(receipt) AS DECIMAL(19,4)) AS receipt, kind
  FROM ({SQL_INCOME}) LEFT JOIN p ON p.pid = CAST(payer AS VARCHAR))
SELECT t.id, t.old_key, s.party, s.paid_at, t.receipt, s.kind, CASE WHEN s.kind = 'F' THEN 'service' ELSE t.purpose END AS purpose FROM t JOIN s USING (old_key)
UNION ALL SELECT (SELECT max(id) FROM t) + row_number() OVER (ORDER BY old_key), *, 'service' FROM s WHERE old_key NOT IN (SELECT old_key FROM t)""")
def load_income(t: Tables):
    return income_load(t).rows.drop("merge_action")


@query(f"""
SELECT old_key AS record_id, 'paid_at' AS field, 'timestamp_parse_failed' AS reason, paid AS source_raw FROM ({SQL_INCOME}) WHERE paid = 'soon'
UNION ALL SELECT old_key, 'party', 'party_not_resolved', CAST(payer AS VARCHAR) FROM ({SQL_INCOME}) WHERE CAST(payer AS VARCHAR) NOT IN (SELECT pid FROM ({SQL_KEYED}))""")
def load_income_issues(t: Tables):
    return income_load(t).issues


# --- derivations over the target --------------------------------------------------------------


@query(f"""
WITH se AS (SELECT l_orderkey AS exam_id, max(l_shipdate) AS exam_at, any_value(o_custkey) AS party, any_value(o_orderkey + 1) AS appointment,
  list({{'finding_id': l_partkey}} ORDER BY l_partkey) AS found FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1 HAVING bool_or(l_returnflag = 'R')),
picked AS (SELECT a.o_orderkey AS id, (SELECT exam_id FROM se WHERE se.party = a.o_custkey AND se.exam_at < date_trunc('day', a.o_orderdate) AND se.appointment IS DISTINCT FROM a.o_orderkey
  ORDER BY se.exam_at DESC, se.exam_id DESC LIMIT 1) AS exam FROM orders a),
parts AS (SELECT exam_id, found, unnest(range(0, (len(found) + {FINDING_ITEMS} - 1) // {FINDING_ITEMS})) AS part FROM se)
SELECT id, coalesce(part, 0) AS part, to_json(found[{FINDING_ITEMS} * part + 1:{FINDING_ITEMS} * (part + 1)]) AS payload FROM picked LEFT JOIN parts ON exam_id = exam""")
def prior_result_enrichment(t: Tables):
    appointments = t.orders.select(
        col("o_orderkey").alias("id"), col("o_custkey").alias("party"), col("o_orderdate").alias("at"), F.lit(None).cast("string").alias("payload")
    )
    exams = t.orders.select(col("o_orderkey").alias("exam_id"), col("o_custkey").alias("party"), (col("o_orderkey") + 1).alias("appointment"))
    findings = t.lineitem.select(
        col("l_orderkey").alias("exam_id"), col("l_shipdate").alias("found_at"), col("l_partkey").alias("finding_id"), "l_returnflag"
    )
    filled = loads.enrich_with_prior_result(appointments, exams, findings, col("l_returnflag") == "R", FINDING_ITEMS)
    return filled.select("id", "part", "payload")


@query("""
WITH target AS (SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
  AND o_orderkey NOT IN (SELECT user_id FROM events)),
h AS (SELECT o.o_orderkey, max(CASE WHEN p.o_orderpriority = '1-URGENT' THEN p.o_orderdate END) AS u, max(CASE WHEN p.o_orderpriority = '5-LOW' THEN p.o_orderdate END) AS l
  FROM target o JOIN orders p ON p.o_custkey = o.o_custkey AND CAST(p.o_orderdate AS DATE) <= CAST(o.o_orderdate AS DATE) GROUP BY 1)
SELECT o_orderkey, 0 AS part, to_json({'o_orderkey': o_orderkey, 'o_orderstatus': o_orderstatus, 'history': concat_ws(chr(10), CASE WHEN u IS NOT NULL THEN 'Urgent dated ' || strftime(u, '%d/%m/') || (year(u) + 543) END,
  CASE WHEN l IS NOT NULL THEN 'Low dated ' || strftime(l, '%d/%m/') || (year(l) + 543) END), 'lines': (SELECT list({'l_linenumber': l_linenumber, 'l_partkey': l_partkey} ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice)
    FROM lineitem WHERE l_orderkey = o_orderkey)}) AS document FROM h JOIN orders USING (o_orderkey)""")
def report_history(t: Tables):
    # Orders with a returned line and no stored report, each with its history up to that day.
    general = t.orders.select("o_orderkey", col("o_orderkey").alias("general_id"))
    flags = document.eligible_targets(
        t.orders, "o_orderkey", [(t.lineitem.filter("l_returnflag = 'R'"), "l_orderkey")], general, "o_orderkey", "general_id", t.events, "user_id"
    )
    targets = t.orders.join(flags.filter("is_target").select("o_orderkey"), "o_orderkey", "left_semi")
    marks = {"urgent": "1-URGENT", "low": "5-LOW"}
    history = t.orders.select(
        "o_custkey", "o_orderdate", *[F.when(col("o_orderpriority") == v, col("o_orderdate")).alias(n) for n, v in marks.items()]
    )
    probes = targets.select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"))
    dated = document.max_per_column(probes, history, "o_custkey", "day", "o_orderdate", list(marks))
    lines = document.history_lines([("Urgent dated", col("urgent")), ("Low dated", col("low"))])
    parents = dated.withColumn("history", lines)
    children = [
        document.ChildCollection(
            "lines", t.lineitem, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], ["l_linenumber", "l_partkey"]
        )
    ]
    return document.build_snapshot_doc(parents, "o_orderkey", children, ["o_orderkey", "o_orderstatus", "history"])
