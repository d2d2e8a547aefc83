"""Catch-up of child tables and logs: SURVEY section M."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablebridge.operators import catchup
from tablebridge.operators.catchup import CatchUpSpec
from tablebridge.plans.registry import Tables, plain, query

col = F.col

# Children of exams, asked for by exam and told apart by number; a number may be given twice.
CHILD_ROWS = """
SELECT CAST(l_orderkey AS STRING) AS exam, l_linenumber AS child, l_partkey AS part, l_quantity AS amount, l_returnflag AS flag
FROM {lineitem}
"""
# What the source still has: it has dropped the lines shipped in its last years.
CHILD_SOURCE = CHILD_ROWS + "WHERE year(l_shipdate) < 2000"
# The target missed the returned lines: some exams lack all of their children, others a part.
CHILD_TARGET = """
SELECT l_orderkey * 10000000 + l_partkey * 10 + l_linenumber AS id, CAST(l_orderkey AS STRING) AS exam, l_linenumber AS child, l_partkey AS part,
  CAST(NULL AS DOUBLE) AS amount, 'old' AS flag FROM {lineitem} WHERE l_returnflag <> 'R'
"""


def sql_units(multiset: bool, partial: str = "replace") -> str:
    """Common tables of the checking SQL: plan of units, rows that come in, rows that give way."""
    need = "count(*)" if multiset else "1"
    first = "" if multiset else "WHERE k = 1"
    return f"""
WITH src AS ({plain(CHILD_SOURCE)}), snap AS ({plain(CHILD_ROWS)}), t AS ({plain(CHILD_TARGET)}),
need AS (SELECT exam, child, {need} AS n FROM snap GROUP BY 1, 2), have AS (SELECT exam, child, count(*) AS h FROM t GROUP BY 1, 2),
short AS (SELECT exam, sum(greatest(n - coalesce(h, 0), 0))::BIGINT AS missing_rows FROM need LEFT JOIN have USING (exam, child) GROUP BY exam),
units AS (SELECT exam, missing_rows, coalesce(held, 0) AS held_rows,
  CASE WHEN exam NOT IN (SELECT exam FROM src) THEN 'not_found' WHEN held > 0 THEN '{partial}' ELSE 'send' END AS action
  FROM short LEFT JOIN (SELECT exam, count(*) AS held FROM t GROUP BY exam) USING (exam) WHERE missing_rows > 0),
due AS (SELECT exam FROM units WHERE action IN ('send', 'replace')),
incoming AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY exam, child ORDER BY part, amount, flag) AS k FROM src WHERE exam IN (FROM due)) {first}),
held AS (SELECT exam, child, id, row_number() OVER (PARTITION BY exam, child ORDER BY id) AS k FROM t WHERE exam IN (FROM due)),
paired AS (SELECT id, exam, child, part, amount, flag, k FROM incoming LEFT JOIN held USING (exam, child, k))"""


SQL_ROWS = """
SELECT *, 'kept' AS merge_action FROM t WHERE exam NOT IN (FROM due)
UNION ALL SELECT id, exam, child, part, amount, flag, 'replaced' FROM paired WHERE id IS NOT NULL
UNION ALL SELECT (SELECT max(id) FROM t) + row_number() OVER (ORDER BY exam, child, k), exam, child, part, amount, flag, 'inserted' FROM paired WHERE id IS NULL"""
SQL_PLAN = """
SELECT exam, missing_rows, held_rows, coalesce(w, 0) AS written_rows, CASE action WHEN 'send' THEN 'loaded' WHEN 'replace' THEN 'replaced' ELSE action END AS action
FROM units LEFT JOIN (SELECT exam, count(*) AS w FROM paired GROUP BY exam) USING (exam)"""


def _units(t: Tables, multiset: bool, replace_partial: bool = True):
    spec = CatchUpSpec("exam", ["child"], multiset, replace_partial)
    order = [col("part"), col("amount"), col("flag")]
    return catchup.catch_up_units(t.derive(CHILD_SOURCE), t.derive(CHILD_ROWS), t.derive(CHILD_TARGET), spec, "id", order)


@query(sql_units(False) + SQL_ROWS)
def catch_up_children(t: Tables):
    return _units(t, False)[0]


@query(sql_units(False) + SQL_PLAN)
def catch_up_children_plan(t: Tables):
    return _units(t, False)[1]


@query(sql_units(False, "partial") + SQL_PLAN)
def catch_up_children_partial(t: Tables):
    return _units(t, False, replace_partial=False)[1]


@query(sql_units(True) + SQL_ROWS)
def catch_up_repeated_children(t: Tables):
    return _units(t, True)[0]


# A log with many rows of one user and kind. The target has no purchases and no cheap signups; the source has let go of the smallest values.
LOG_ROWS = "SELECT event_id, user_id, event_type, ts, value FROM {events}"
LOG_SOURCE = LOG_ROWS + " WHERE value >= 3 OR event_type <> 'purchase'"
LOG_TARGET = LOG_ROWS + " WHERE event_type <> 'purchase' AND (event_type <> 'signup' OR value > 20)"
SQL_LOG = f"""
WITH src AS ({plain(LOG_SOURCE)}), snap AS ({plain(LOG_ROWS)}), t AS ({plain(LOG_TARGET)}),
short AS (SELECT user_id, event_type, n, coalesce(h, 0) AS h FROM (SELECT user_id, event_type, count(*) AS n FROM snap GROUP BY 1, 2)
  LEFT JOIN (SELECT user_id, event_type, count(*) AS h FROM t GROUP BY 1, 2) USING (user_id, event_type) WHERE n > coalesce(h, 0)),
late AS (SELECT src.* FROM src JOIN short USING (user_id, event_type)
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) BETWEEN h + 1 AND n)"""


def _log(t: Tables):
    order = [col("ts"), col("event_id")]
    return catchup.catch_up_rows(t.derive(LOG_SOURCE), t.derive(LOG_ROWS), t.derive(LOG_TARGET), ["user_id", "event_type"], order)


@query(SQL_LOG + " SELECT *, 'kept' AS merge_action FROM t UNION ALL SELECT *, 'appended' FROM late")
def catch_up_log(t: Tables):
    return _log(t)[0]


@query(SQL_LOG + """
SELECT user_id, event_type, n - h AS missing_rows, h AS held_rows, coalesce(w, 0) AS written_rows,
  CASE WHEN coalesce(w, 0) < n - h THEN 'not_found' WHEN h > 0 THEN 'partial' ELSE 'loaded' END AS action
FROM short LEFT JOIN (SELECT user_id, event_type, count(*) AS w FROM late GROUP BY 1, 2) USING (user_id, event_type)""")
def catch_up_log_plan(t: Tables):
    return _log(t)[1]
