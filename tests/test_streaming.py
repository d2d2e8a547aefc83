"""Incremental loads: position, replays and late rows."""

from pyspark.sql import functions as F

from tablebridge.operators.merge import MergeSpec, merge_if_changed
from tablebridge.session import new_run_folder
from tablebridge.streaming import incremental, progress

SCHEMA = "k bigint, v string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_append_advances_and_ignores_replays(spark):
    home = new_run_folder(spark, "test")
    df = lambda data: spark.createDataFrame(data, SCHEMA)
    table = incremental.BatchFolders(spark, f"{home}/table", df([]).schema)

    def run():
        stream = incremental.read_arrivals(spark, f"{home}/in", df([]).schema)
        incremental.incremental_append(stream, table, ["k"], [F.col("v")], f"{home}/pos")

    df([(1, "a"), (2, "b"), (2, "a")]).write.parquet(f"{home}/in")
    run()
    assert rows(table.read_all()) == [(1, "a"), (2, "a")]
    df([(2, "z"), (3, "c")]).write.mode("append").parquet(f"{home}/in")
    run()
    run()
    assert rows(table.read_all()) == [(1, "a"), (2, "a"), (3, "c")]
    # The same batch again, as after a lost commit, writes the same rows.
    before = rows(table.read_all())
    batch, number = df([(2, "z"), (3, "c")]), table.complete()[-1]
    held = table.read_all(before=number).select("k")
    table.write(batch.join(held, "k", "left_anti"), number)
    assert rows(table.read_all()) == before


def test_merge_versions(spark):
    home = new_run_folder(spark, "test")
    df = lambda data: spark.createDataFrame(data, SCHEMA)
    table = incremental.VersionedBuckets(spark, f"{home}/table", df([]).schema, ["k"], buckets=4)
    merge = lambda t, s: merge_if_changed(t, s, MergeSpec(["k"]))
    for data in ([(1, "a"), (2, "b")], [(2, "c"), (4, "d"), (4, "c")]):
        df(data).write.mode("append").parquet(f"{home}/in")
        incremental.incremental_load(incremental.read_arrivals(spark, f"{home}/in", df([]).schema), table, merge, f"{home}/pos", [F.col("v")])
    assert rows(table.current()) == [(1, "a"), (2, "c"), (4, "d")]
    # The second batch wrote only the buckets of its keys.
    first, second = table.complete()
    written = lambda n: spark.read.parquet(table.folder(n))
    assert {r.bucket for r in written(second).collect()} == set(table.touched(df([(2, ""), (4, "")])))
    assert rows(table.current(before=second)) == rows(written(first).select("k", "v"))


def test_catch_up_in_two_runs(spark):
    source = spark.createDataFrame([(i, f"v{i}") for i in range(6)], SCHEMA)
    snapshot = source.filter("k < 5").select(F.col("k").cast("string").alias("key"), F.col("k").cast("string").alias("send"))
    target = source.filter("k = 0")
    loaded, plan = incremental.catch_up_late(source, snapshot, target, MergeSpec(["k"]), "k", max_ids=3)
    assert rows(plan.groupBy("action").count()) == [("loaded", 3), ("postponed", 1)]
    again, plan = incremental.catch_up_late(source, snapshot, loaded.drop("merge_action"), MergeSpec(["k"]), "k", max_ids=3)
    assert rows(again.select("k", "v")) == [(i, f"v{i}") for i in range(5)]
    assert rows(plan.groupBy("action").count()) == [("loaded", 1)]
    gone = snapshot.unionByName(spark.createDataFrame([("99", "99")], snapshot.schema))
    _, plan = incremental.catch_up_late(source, gone, target, MergeSpec(["k"]), "k", max_ids=2)
    assert rows(plan.groupBy("action").count()) == [("loaded", 2), ("not_found", 1), ("postponed", 2)]


def test_progress_tells_behind_from_ahead(spark):
    home = new_run_folder(spark, "test")
    df = lambda data: spark.createDataFrame(data, SCHEMA)
    table = incremental.BatchFolders(spark, f"{home}/table", df([]).schema)
    df([(1, "a"), (2, "b")]).write.parquet(f"{home}/in")
    incremental.incremental_append(incremental.read_arrivals(spark, f"{home}/in", df([]).schema), table, ["k"], [F.col("v")], f"{home}/pos")
    inbox = lambda: spark.read.schema(df([]).schema).parquet(f"{home}/in")
    checked = lambda target: {r.check_name: (r.source_value, r.target_value, r.is_ok, r.reason) for r in progress.parity_progress(inbox(), target, f"{home}/pos", "k").collect()}
    assert {r[3] for r in checked(table.read_all()).values()} == {"equal"}
    found = checked(table.read_all().unionByName(df([(9, "z")])))
    assert found["keys"] == ("2", "3", False, "ahead") and found["highest_key"] == ("2", "9", False, "ahead") and found["rows"][3] == "equal"
    df([(3, "c")]).write.mode("append").parquet(f"{home}/in")
    found = checked(table.read_all().filter("k < 2"))
    assert found["rows"] == ("3", "2", False, "behind") and found["highest_key"] == ("2", "1", False, "behind") and found["batches"] == ("1", "1", True, "equal")
