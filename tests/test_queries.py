"""All registered queries: same rows as their SQL, and plans fit for large inputs."""

import importlib.util
import pathlib
import re

import duckdb
import pytest

from tablebridge.plans import catalog
from tablebridge.plans.registry import TABLES

ROOT = pathlib.Path(__file__).resolve().parent.parent
_spec = importlib.util.spec_from_file_location("check_oracle", ROOT / "tools" / "check_oracle.py")
check_oracle = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(check_oracle)


@pytest.fixture(scope="module")
def db(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, db, folder, name):
    df = catalog.QUERIES[name](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython", plan)
    mine = check_oracle.rows_of(df.columns, df.collect())
    assert name in catalog.ORACLES
    cur = db.execute(catalog.ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert mine == check_oracle.rows_of(columns, cur.fetchall())


def test_filters_and_columns_reach_the_scan(spark, folder):
    plan = catalog.QUERIES["filtered_scan"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,purchase)" in plan and "GreaterThanOrEqual(ts" in plan
    assert re.search(r"ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>", plan)


def test_top_n_groups_are_limited_before_the_shuffle(spark, folder):
    plan = catalog.QUERIES["asof_before_day"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_a_report_of_a_load_starts_no_job_before_it_is_asked_for(spark, folder):
    spark.sparkContext.setJobGroup("lazy", "lazy")
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup("lazy"))
    reads = 0
    original = type(spark.read).parquet

    def counted(self, *paths, **options):
        nonlocal reads
        reads += 1
        return original(self, *paths, **options)

    type(spark.read).parquet = counted
    try:
        catalog.QUERIES["load_quality_report"](spark, folder)
    finally:
        type(spark.read).parquet = original
        spark.sparkContext.setJobGroup(None, None)
    # A read looks at the schema of a file in one job.
    assert len(tracker.getJobIdsForGroup("lazy")) - before <= reads
