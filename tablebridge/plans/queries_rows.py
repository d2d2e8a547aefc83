"""Sources, cleansing and keys: SURVEY sections A and B."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge.functions import clean as c
from tablebridge.functions import keys as k
from tablebridge.operators import shape
from tablebridge.plans.inputs import (
    PEOPLE,
    RAW_ORDERS,
    sql_blank,
    sql_strip,
)
from tablebridge.plans.registry import Tables, plain, query
from tablebridge.session import new_run_folder
from tablebridge.sources import scan, sinks

RAW = plain(RAW_ORDERS)
col = F.col


# --- A: sources and row selection -------------------------------------------------------------


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
  trim(o_orderstatus) AS o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') AS o_orderdate, trim(o_orderpriority) AS o_orderpriority
FROM orders""")
def scan_text(t: Tables):
    return scan.scan_text(t.spark, scan.SourceSpec("parquet", t.path("orders")))


@query("""
SELECT event_id, ts, user_id, value FROM events
WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'""")
def filtered_scan(t: Tables):
    low, high = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-05", "2024-01-20"))
    rows = scan.filtered_scan(t.events, col("event_type") == "purchase", "ts", low, high)
    return rows.select("event_id", "ts", "user_id", "value")


@query(f"""
SELECT order_key, cust_key FROM ({RAW})
WHERE try_cast({sql_blank('order_key')} AS BIGINT) BETWEEN 1000 AND 9000""")
def key_range(t: Tables):
    return scan.key_range(t.derive(RAW_ORDERS), "order_key", 1000, 9000).select("order_key", "cust_key")


@query("""
SELECT * FROM (SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_index
  FROM orders) WHERE row_index BETWEEN 1001 AND 11000""")
def row_index_range(t: Tables):
    from tablebridge.operators.page import row_index_range as ranked

    return ranked(t.orders.select("o_orderkey", "o_orderdate"), [col("o_orderdate"), col("o_orderkey")], 1001, 11000)


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE l_returnflag = 'R')""")
def explicit_ids(t: Tables):
    ids = t.lineitem.filter("l_returnflag = 'R'").select("l_orderkey", "l_linenumber")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return scan.explicit_ids(rows, ids, ["l_orderkey", "l_linenumber"])


@query(f"""
SELECT count(*)::BIGINT AS total, count({sql_blank('order_key')})::BIGINT AS with_key,
  (count(*) - count({sql_blank('order_key')}))::BIGINT AS without_key FROM ({RAW})""")
def source_count(t: Tables):
    return scan.source_count(t.derive(RAW_ORDERS), "order_key")


@query("""
SELECT 's' || s_suppkey AS item, s_name AS label, NULL::BIGINT AS row_count FROM supplier
UNION ALL SELECT 'manifest', NULL, count(*) FROM supplier""")
def export_table(t: Tables):
    path = new_run_folder(t.spark, "export")
    sinks.export_table(t.supplier, path)
    rows = t.spark.read.schema(t.supplier.schema).json(f"{path}/rows").select(
        F.concat(F.lit("s"), col("s_suppkey").cast("string")).alias("item"),
        col("s_name").alias("label"), F.lit(None).cast("bigint").alias("row_count"),
    )
    manifest = t.spark.read.schema("row_count bigint").json(f"{path}/manifest")
    return rows.unionByName(
        manifest.select(F.lit("manifest").alias("item"), F.lit(None).cast("string").alias("label"), "row_count")
    )


@query("""
SELECT table_name, n AS source_rows, n AS target_rows, n <> n AS mismatch, note FROM (
  SELECT 'nation' AS table_name, count(*) AS n, 'copied' AS note FROM nation
  UNION ALL SELECT 'supplier', count(*), 'copied' FROM supplier
  UNION ALL SELECT 'part', count(*), 'copied' FROM part
  UNION ALL SELECT 'archive', NULL, 'skipped: no such table')""")
def copy_tables(t: Tables):
    return sinks.copy_tables(
        t.spark, t.folder, new_run_folder(t.spark, "copy"), ["nation", "supplier", "part", "archive"]
    )


@query(f"""
SELECT {sql_blank('order_key')} AS key, CAST(row_id AS VARCHAR) AS send FROM ({RAW})
WHERE {sql_blank('order_key')} IS NOT NULL""")
def key_snapshot(t: Tables):
    return sinks.key_snapshot(
        t.derive(RAW_ORDERS), col("order_key"), col("row_id"), new_run_folder(t.spark, "snapshot")
    )


@query(f"SELECT row_id, order_key, priority FROM ({RAW})")
def json_report_sink(t: Tables):
    path = new_run_folder(t.spark, "report")
    rows = t.derive(RAW_ORDERS).select("row_id", "order_key", "priority")
    sinks.json_report_sink(rows, path)
    return t.spark.read.schema(rows.schema).json(path)


@query("""
WITH b AS (SELECT count(*) AS n, max(event_id) AS m FROM events WHERE ts < TIMESTAMP '2024-01-20'),
s AS (SELECT count(*) AS n, max(event_id) AS m FROM events),
h AS (SELECT count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-20' AND event_type <> 'signup')
SELECT s.n AS source_rows, s.m AS source_max, h.n AS target_rows, 
  'catch_up' AS mode, CASE WHEN h.n < b.n THEN 'target_lost_rows' WHEN s.n > b.n AND s.m = b.m THEN 'rows_behind_cursor' ELSE 'rows_added' END AS reason FROM s, b, h""")
def source_fingerprint(t: Tables):
    before = t.events.filter(col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    stored = before.agg(F.count(F.lit(1)), F.max("event_id")).first()
    held = before.filter("event_type <> 'signup'")
    return scan.source_fingerprint(t.events, held, "event_id", (stored[0], stored[1]))


# --- B: cleansing -----------------------------------------------------------------------------


@query(f"""
SELECT row_id, {sql_blank('order_key')} AS order_key,
  regexp_replace(lower({sql_blank('order_key')}), '^0+([0-9])', '\\1') AS folded FROM ({RAW})""")
def norm_key(t: Tables):
    return t.derive(RAW_ORDERS).select(
        "row_id", c.norm_key(col("order_key")).alias("order_key"), c.match_key(col("order_key")).alias("folded")
    )


@query(f"""
SELECT doc_id, line_no, CASE WHEN upper({sql_strip('line')}) IN ('', 'NULL') THEN NULL ELSE {sql_strip('line')} END AS line
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
        unnest(range(len(string_split(text, chr(10))))) AS line_no FROM documents)""")
def null_if_blank(t: Tables):
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.select(
        "doc_id", col("line_no").cast("bigint").alias("line_no"),
        c.null_if_blank(col("line"), ["null"]).alias("line"),
    )


@query(f"""
SELECT doc_id, left({sql_blank('text')}, 255) AS text, coalesce(length({sql_blank('text')}) > 255, false) AS is_cut
FROM documents""")
def clamp_text(t: Tables):
    text, cut = c.clamp_text(col("text"), 255)
    return t.documents.select("doc_id", text.alias("text"), cut.alias("is_cut"))


@query(f"""
SELECT row_id, CASE WHEN regexp_matches({sql_strip('order_key')}, '^-?[0-9]+$')
    THEN CAST({sql_strip('order_key')} AS BIGINT) END AS order_no,
  CASE WHEN regexp_matches({sql_strip('total_price')}, '^[0-9]{{1,9}}$')
    THEN CAST({sql_strip('total_price')} AS BIGINT) END AS whole_price FROM ({RAW})""")
def to_int_strict(t: Tables):
    return t.derive(RAW_ORDERS).select(
        "row_id",
        c.to_int_strict(col("order_key")).alias("order_no"),
        c.to_int_strict(col("total_price"), 9, signed=False).alias("whole_price"),
    )


SQL_REAL = """CASE WHEN regexp_matches(n, '^-?[0-9]+,[0-9]+$') THEN replace(n, ',', '.')
     WHEN regexp_matches(n, '^-?[0-9]+\\.$') THEN left(n, length(n) - 1) ELSE n END"""
SQL_NUMBER = "regexp_replace(regexp_replace(regexp_replace(total_price, '\\s+', '', 'g'), '^\\+', ''), '([0-9])[+-]$', '\\1')"
SQL_PRICE = f"""try_cast(CASE WHEN regexp_matches({SQL_REAL}, '^-?[0-9]+(\\.[0-9]+)?$') THEN {SQL_REAL} END AS DOUBLE)"""


@query(f"""
SELECT row_id, {SQL_PRICE} AS price, try_cast(CASE WHEN regexp_matches(m, '^-?[0-9]+(\\.[0-9]+)?$') THEN m END AS DECIMAL(19,4)) AS money
FROM (SELECT row_id, {SQL_NUMBER} AS n, replace({sql_strip('total_price')}, ',', '') AS m FROM ({RAW}))""")
def to_real_lenient(t: Tables):
    return t.derive(RAW_ORDERS).select(
        "row_id",
        c.to_real_lenient(col("total_price")).alias("price"),
        c.to_real_lenient(col("total_price"), money=True).alias("money"),
    )


@query(f"""
SELECT row_id, CASE is_done WHEN 'Y' THEN true END AS js,
  CASE is_done WHEN 'Y' THEN true WHEN 'No' THEN false END AS sql,
  coalesce(CASE is_done WHEN 'Y' THEN true END, false) AS or_false FROM ({RAW})""")
def to_bool(t: Tables):
    done = col("is_done")
    return t.derive(RAW_ORDERS).select(
        "row_id", c.to_bool(done).alias("js"), c.to_bool(done, "sql").alias("sql"),
        c.to_bool(done, default=False).alias("or_false"),
    )


@query(f"""
SELECT row_id, CASE WHEN v = 'Y' THEN 1 WHEN v IN ('P', 'No', '') THEN NULL ELSE CAST(v AS BIGINT) END AS flag
FROM (SELECT row_id, CASE WHEN is_done = 'P' THEN {sql_strip('order_key')} ELSE is_done END AS v FROM ({RAW}))""")
def to_int_flag(t: Tables):
    value = F.when(col("is_done") == "P", col("order_key")).otherwise(col("is_done"))
    return t.derive(RAW_ORDERS).select("row_id", c.to_int_flag(value).alias("flag"))


def sql_era(threshold: int, time: bool = True, after_t: bool = True) -> str:
    """Checking SQL for the era rule."""
    year = "CAST(left(order_date, 4) AS INTEGER)"
    shifted = f"CASE WHEN {year} >= {threshold} THEN {year} - 543 ELSE {year} END"
    rest = "ltrim(substr(order_date, 11), ' T')" if after_t else "ltrim(substr(order_date, 11), ' ')"
    clock = f"CASE WHEN regexp_matches({rest}, '^[0-9]{{2}}.[0-9]{{2}}.[0-9]{{2}}') THEN left({rest}, 8) ELSE '00:00:00' END"
    clock = clock if time else "'00:00:00'"
    stamp = f"lpad(CAST({shifted} AS VARCHAR), 4, '0') || substr(order_date, 5, 6) || ' ' || {clock}"
    return f"CASE WHEN regexp_matches(order_date, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN try_cast({stamp} AS TIMESTAMP) END"


@query(f"""
SELECT row_id, {sql_era(2200)} AS at_2200, {sql_era(2400)} AS at_2400,
  {sql_era(2400, after_t=False)} AS exam_style, {sql_era(2400, time=False)} AS day_only FROM ({RAW})""")
def be_to_timestamp(t: Tables):
    d = col("order_date")
    return t.derive(RAW_ORDERS).select(
        "row_id",
        c.be_to_timestamp(d, 2200).alias("at_2200"),
        c.be_to_timestamp(d, 2400).alias("at_2400"),
        c.be_to_timestamp(d, 2400, time_after_t=False).alias("exam_style"),
        c.be_to_timestamp(d, 2400, keep_time=False).alias("day_only"),
    )


@query(f"""
SELECT row_id, CASE WHEN regexp_matches(order_date, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')
  THEN try_cast(left(order_date, 10) AS DATE) END AS order_day FROM ({RAW})""")
def parse_iso_date(t: Tables):
    return t.derive(RAW_ORDERS).select("row_id", c.parse_iso_date(col("order_date")).alias("order_day"))


@query(f"""
SELECT row_id, CASE WHEN regexp_matches(v, '^[0-9]+$') THEN CASE WHEN v IN ('0', '1') THEN NULL ELSE CAST(v AS BIGINT) END
  ELSE CAST(epoch({sql_era(2400, after_t=False).replace('order_date', 'v')}) AS BIGINT) END AS epoch_s
FROM (SELECT row_id, CASE WHEN is_done = 'P' THEN cust_key ELSE order_date END AS v FROM ({RAW}))""")
def to_epoch(t: Tables):
    value = F.when(col("is_done") == "P", col("cust_key")).otherwise(col("order_date"))
    return t.derive(RAW_ORDERS).select("row_id", c.to_epoch(value).alias("epoch_s"))


@query("""
SELECT event_id, strftime(ts, '%H:%M') AS clock,
  lpad(CAST(hour(ts) AS VARCHAR), 2, '0') || ':' || lpad(CAST(minute(ts) AS VARCHAR), 2, '0') AS label FROM events""")
def clock_slot(t: Tables):
    loose = F.concat(F.hour("ts").cast("string"), F.lit(":"), F.minute("ts").cast("string"), F.lit(" "))
    return t.events.select(
        "event_id", c.clock_slot(col("ts")).alias("clock"), c.slot_label(loose).alias("label")
    )


@query("""
SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') AS digits, c_mktsegment AS segment FROM customer""")
def digits_or_text(t: Tables):
    return t.customer.select(
        "c_custkey", c.digits_or_text(col("c_name")).alias("digits"), c.digits_or_text(col("c_mktsegment")).alias("segment")
    )


@query("""
SELECT p_partkey, CASE WHEN p_size > 25 THEN '08' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') 
    ELSE '08' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') END AS biz,
  CASE WHEN p_size > 25 THEN '02' || lpad(CAST(p_size AS VARCHAR), 7, '0')
    ELSE '02-' || lpad(CAST(p_size AS VARCHAR), 7, '0') END AS home,
  '08' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') || ',' || '02' || lpad(CAST(p_size AS VARCHAR), 7, '0') AS numbers
FROM part""")
def split_phones(t: Tables):
    mobile = F.concat(F.lit("08"), F.lpad(col("p_partkey").cast("string"), 8, "0"))
    land = F.concat(F.lit("02-"), F.lpad(col("p_size").cast("string"), 7, "0"))
    mixed = col("p_size") > 25
    rows = t.part.select(
        "p_partkey",
        F.when(mixed, F.concat(land, F.lit(" / "), mobile)).otherwise(mobile).alias("raw_biz"),
        F.when(~mixed, land).alias("raw_home"),
        F.concat(F.lit("+66"), F.substring(mobile, 2, 9), F.lit(";"), land).alias("raw_all"),
    )
    biz, home = c.split_phones(col("raw_biz"), col("raw_home"))
    return rows.select(
        "p_partkey", biz.alias("biz"), home.alias("home"),
        F.array_join(c.phone_digit_set(col("raw_all")), ",").alias("numbers"),
    )


@query("""
SELECT p_partkey, p_name || ' ' || p_brand AS full_name, regexp_matches(p_name, '[a-z]') AS is_searchable FROM part""")
def clean_person_name(t: Tables):
    loose = F.concat(F.lit("﻿ "), col("p_name"), F.lit("  \t"), col("p_brand"), F.lit("  "))
    name = c.clean_person_name(loose)
    return t.part.select("p_partkey", name.alias("full_name"), c.is_searchable_name(name).alias("is_searchable"))


SQL_UUID = """substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12)"""


@query(f"""
SELECT c_custkey, CASE WHEN substr(h, 13, 1) IN ('1','2','3','4','5') AND substr(h, 17, 1) IN ('8','9','a','b')
  THEN {SQL_UUID} END AS uuid FROM (SELECT c_custkey, md5(c_name) AS h FROM customer)""")
def guard_uuid(t: Tables):
    h = F.md5("c_name")
    text = F.concat_ws("-", *[F.substring(h, p, n) for p, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return t.customer.select("c_custkey", c.guard_uuid(F.upper(text)).alias("uuid"))


@query("""
SELECT p_partkey, CASE WHEN p_size > 40 THEN NULL WHEN p_size > 20 THEN '[' || p_size || ']' ELSE '["' || p_name || '"]' END AS js,
  CASE WHEN p_size > 40 THEN '[]' WHEN p_size > 20 THEN '[' || p_size || ']' ELSE '["' || p_name || '"]' END AS js_or_empty FROM part""")
def to_json_array(t: Tables):
    raw = F.when(col("p_size") > 40, " ").when(col("p_size") > 20, col("p_size").cast("string")).otherwise(col("p_name"))
    return t.part.select(
        "p_partkey", c.to_json_array(raw).alias("js"), c.to_json_array(raw, null_as_empty=True).alias("js_or_empty")
    )


@query("""
SELECT event_id, CASE event_type
    WHEN 'click' THEN '[' || CASE WHEN u = 6 THEN 20 ELSE u END || ',1]'
    WHEN 'view' THEN '[' || CASE WHEN u = 6 THEN 20 ELSE u END || ',20]'
    WHEN 'error' THEN '[]' ELSE '["' || event_type || ' ' || u || '"]' END AS codes
FROM (SELECT event_id, event_type, user_id AS u FROM events)""")
def remap_code_list(t: Tables):
    u = col("user_id").cast("string")
    raw = (
        F.when(col("event_type") == "click", F.concat(u, F.lit("|1")))
        .when(col("event_type") == "view", F.concat(F.lit('["'), u, F.lit('","6"]')))
        .when(col("event_type") == "error", F.lit("  "))
        .otherwise(F.concat_ws(" ", "event_type", u))
    )
    return t.events.select("event_id", c.remap_code_list(raw, {6: 20}).alias("codes"))


@query("""
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'now' WHEN '2-HIGH' THEN 'soon' END AS or_null,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'now' WHEN '2-HIGH' THEN 'soon' ELSE o_orderpriority END AS or_keep,
  CASE o_orderstatus WHEN 'F' THEN 'finished' ELSE upper(lower(o_orderstatus)) END AS or_upper FROM orders""")
def dictionary_remap(t: Tables):
    # The dictionary comes from the values in use; only two priorities have a translation.
    words = F.when(col("old_value") == "1-URGENT", "now").when(col("old_value") == "2-HIGH", "soon")
    table = t.orders.select(col("o_orderpriority").alias("old_value")).distinct().withColumn("new_value", words)
    table = table.filter("new_value is not null")
    states = t.orders.select(col("o_orderstatus").alias("old_value")).distinct().withColumn(
        "new_value", F.when(col("old_value") == "F", "finished")
    ).filter("new_value is not null")
    rows = t.orders.select(
        "o_orderkey", col("o_orderpriority").alias("or_null"), col("o_orderpriority").alias("or_keep"),
        F.lower("o_orderstatus").alias("or_upper"),
    )
    rows = shape.dictionary_remap(rows, "or_null", table)
    rows = shape.dictionary_remap(rows, "or_keep", table, "keep")
    return shape.dictionary_remap(rows, "or_upper", states, "upper", fold=True)


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'no show' WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'completed'
  ELSE 'waiting' END AS status FROM orders""")
def derive_status(t: Tables):
    labels = {"no_show": "no show", "completed": "completed", "default": "waiting"}
    as_of = F.lit("1999-01-01").cast("timestamp_ntz")
    return t.orders.select(
        "o_orderkey", c.derive_status(col("o_orderdate"), col("o_orderstatus") == "P", as_of, labels).alias("status")
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F')
  THEN '3' ELSE '1' END AS state FROM orders""")
def signed_state(t: Tables):
    signed = t.lineitem.filter("l_returnflag = 'R' and l_linestatus = 'F'")
    return shape.signed_state(t.orders.select("o_orderkey"), signed, "o_orderkey", "l_orderkey", "3", "1")


ORDER_SCHEMA = T.StructType(
    [
        T.StructField("order_key", T.LongType()),
        T.StructField("ordered_at", T.TimestampNTZType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("is_done", T.BooleanType()),
        T.StructField("priority", T.StringType(), True, {"max_len": 6, "not_null_default": ""}),
        T.StructField("kind", T.StringType()),
        T.StructField("branch", T.IntegerType()),
    ]
)


@query(f"""
SELECT try_cast({sql_blank('order_key')} AS BIGINT) AS order_key, {sql_era(2400)} AS ordered_at, {SQL_PRICE} AS total,
  CASE is_done WHEN 'Y' THEN true WHEN 'No' THEN false END AS is_done, coalesce(left(priority, 6), '') AS priority,
  'order' AS kind, NULL::INTEGER AS branch FROM (SELECT *, {SQL_NUMBER} AS n FROM ({RAW}))""")
def align_to_schema(t: Tables):
    return shape.align_to_schema(
        t.derive(RAW_ORDERS), ORDER_SCHEMA, {"kind": F.lit("order")},
        {"ordered_at": "order_date", "total": "total_price"},
    )


@query("""
SELECT p_partkey, nullif(concat_ws(' ', nullif(CASE WHEN p_size > 25 THEN p_brand ELSE ' ' END, ' '),
  CASE WHEN p_size > 10 THEN p_type END), '') AS label FROM part""")
def concat_nonblank(t: Tables):
    brand = F.when(col("p_size") > 25, col("p_brand")).otherwise(" ")
    return t.part.select("p_partkey", c.concat_nonblank(brand, F.when(col("p_size") > 10, col("p_type"))).alias("label"))


@query(f"""
SELECT row_id, {sql_blank('order_key')} || '|' || cust_key AS pair_key FROM ({RAW})""")
def composite_key(t: Tables):
    return t.derive(RAW_ORDERS).select(
        "row_id", k.composite_key(col("order_key"), col("cust_key"), sep="|").alias("pair_key")
    )


@query("""
WITH r AS (SELECT CASE WHEN event_type = 'error' THEN '' ELSE CAST(event_id AS VARCHAR) END AS accession,
    CAST(user_id AS VARCHAR) AS person, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events),
d AS (SELECT *, CASE WHEN accession = '' THEN sha256(person || chr(30) || day) END AS digest FROM r)
SELECT person, day, CASE WHEN accession <> '' THEN accession ELSE '__blank__' || left(sha256(digest || chr(30) || 'ord:' ||
  CAST(row_number() OVER (PARTITION BY digest) AS VARCHAR)), 40) END AS accession FROM d""")
def synthetic_key(t: Tables):
    rows = t.events.select(
        F.when(col("event_type") == "error", "").otherwise(col("event_id").cast("string")).alias("accession"),
        col("user_id").cast("string").alias("person"), F.to_date("ts").cast("string").alias("day"),
    )
    return k.synthetic_key(rows, "accession", ["person", "day"], "__blank__")


@query("""
SELECT o_orderkey, sha256('K:' || o_orderkey || '|C:' || CASE WHEN o_orderpriority = '5-LOW' THEN '~' ELSE CAST(o_custkey AS VARCHAR) END
  || '|S:' || CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderstatus END) AS fingerprint FROM orders""")
def row_fingerprint(t: Tables):
    known = col("o_orderpriority") != "5-LOW"
    prints = k.row_fingerprint(
        {"K": col("o_orderkey"), "C": F.when(known, col("o_custkey"))}, {"S": F.when(known, col("o_orderstatus"))}
    )
    return t.orders.select("o_orderkey", prints.alias("fingerprint"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '0' ELSE '1' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') || '_' END
  || CASE WHEN o_orderpriority = '5-LOW' THEN '1x' || o_orderkey ELSE '0' || lpad(CAST(o_orderkey AS VARCHAR), 20, '0') END AS sort_key
FROM orders""")
def sort_key_text(t: Tables):
    ident = F.when(col("o_orderpriority") == "5-LOW", F.concat(F.lit("x"), col("o_orderkey").cast("string"))).otherwise(
        col("o_orderkey").cast("string")
    )
    ts = F.when(col("o_orderstatus") != "P", col("o_orderdate"))
    return t.orders.select("o_orderkey", k.sort_key_text(ts, ident).alias("sort_key"))


@query("""
SELECT event_id, ts - INTERVAL 7 HOUR AS instant, isodow(ts) IN (6, 7) AS is_weekend FROM events""")
def wall_clock_to_instant(t: Tables):
    return t.events.select(
        "event_id", c.wall_clock_to_instant(col("ts"), "Asia/Bangkok").alias("instant"), c.is_weekend(col("ts")).alias("is_weekend")
    )


@query(f"""
SELECT row_id, coalesce(CAST(try_cast({sql_blank('order_key')} AS BIGINT) AS VARCHAR), {sql_blank('order_key')}) AS order_id,
  coalesce(CAST(try_cast('000' || cust_key AS BIGINT) AS VARCHAR), cust_key) AS cust_id FROM ({RAW})""")
def int_or_text_id(t: Tables):
    padded = F.concat(F.lit(" 000"), col("cust_key"))
    return t.derive(RAW_ORDERS).select(
        "row_id", c.int_or_text_id(col("order_key")).alias("order_id"), c.int_or_text_id(padded).alias("cust_id")
    )


@query(f"""
SELECT id, pid, first_name = 'INFERRED' AS is_fake, first_name = 'INFERRED' AND starts_with(last_name, 'PID ') AS is_generated
FROM ({plain(PEOPLE)})""")
def is_placeholder(t: Tables):
    first, last = col("first_name"), col("last_name")
    return t.derive(PEOPLE).select(
        "id", "pid", c.is_placeholder(first, "INFERRED").alias("is_fake"),
        c.is_placeholder(first, "INFERRED", last, "PID ").alias("is_generated"),
    )


