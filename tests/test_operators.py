"""Invariants and skew paths of the operators, against brute force where it is small enough."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tablebridge.functions.clean import is_placeholder
from tablebridge.operators import compare, dedup, document, ids, jsonrefs, merge, page, quality, resolve, sets, shape, skew
from tablebridge.operators.merge import ACTION, MergeSpec
from tablebridge.plans.catalog import QUERIES

col = F.col
SPEC = MergeSpec(["k"], "id")


def data(df):
    return sorted(tuple(r) for r in df.collect())


def target(spark):
    return spark.createDataFrame([(1, 10, 5, None), (2, 20, None, "x"), (3, 30, 7, "y")], "id bigint, k bigint, a bigint, b string")


def source(spark):
    return spark.createDataFrame([(20, 2, None), (30, 7, "y"), (50, 9, "n"), (40, 8, "m"), (None, 1, "q")], "k bigint, a bigint, b string")


def test_merge_modes(spark):
    t, s = target(spark), source(spark)
    assert data(merge.merge_if_changed(t, s, SPEC).select("id", "k", "a", ACTION)) == [
        (1, 10, 5, "kept"), (2, 20, 2, "updated"), (3, 30, 7, "unchanged"), (4, 40, 8, "inserted"), (5, 50, 9, "inserted"),
    ]
    assert data(merge.fill_null_only(t, s, SPEC).filter("k = 20").select("a", "b", ACTION)) == [(2, "x", "filled")]
    assert data(merge.prefer_source_keep_target(t, s, SPEC).filter("k = 20").select("a", "b")) == [(2, "x")]
    assert data(merge.merge_overwrite(t, s, SPEC).filter("k = 20").select("a", "b")) == [(2, None)]
    assert data(merge.merge_insert_only(t, s, SPEC).filter("id <= 3").drop(ACTION).select("id", "k")) == [(1, 10), (2, 20), (3, 30)]


def test_merges_are_idempotent(spark):
    t, s = target(spark), source(spark)
    for mode in (merge.merge_insert_only, merge.merge_overwrite, merge.merge_if_changed, merge.fill_null_only, merge.replace_keep_id):
        once = mode(t, s, SPEC).drop(ACTION)
        twice = mode(once, s, SPEC).drop(ACTION)
        assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect())), mode.__name__


def test_replace_keeps_id_and_clears_other_columns(spark):
    t = target(spark).withColumn("extra", F.lit("e"))
    rows = merge.replace_keep_id(t, source(spark), SPEC)
    assert data(rows.filter("k = 20").select("id", "extra")) == [(2, None)]
    assert data(rows.filter("k = 10").select("id", "extra")) == [(1, "e")]
    kept = merge.replace_keep_id(t, source(spark), MergeSpec(["k"], "id", keep=["extra"]))
    assert data(kept.filter("k = 20").select("extra")) == [("e",)]


def test_policies(spark):
    spec = MergeSpec(["k"], "id", policies={"a": merge.only_if_null, "b": merge.only_if("y")})
    rows = merge.column_policy_merge(target(spark), source(spark).withColumn("b", F.lit("new")), spec)
    assert data(rows.filter("k = 30").select("a", "b")) == [(7, "new")]
    assert data(rows.filter("k = 20").select("a", "b")) == [(2, "x")]


def test_assign_ids_empty_target_starts_at_one(spark):
    fresh = spark.createDataFrame([("b",), ("a",), ("c",)], "name string")
    empty = spark.createDataFrame([], "id bigint, name string")
    assert data(ids.assign_ids(fresh, [col("name")], empty).select("id", "name")) == [(1, "a"), (2, "b"), (3, "c")]


def test_hot_group_ranks_equal_window_ranks(spark):
    rng = random.Random(3)
    rows = [(0 if rng.random() < 0.4 else rng.randrange(1, 60), rng.randrange(1000), i) for i in range(3000)]
    rows += [(None, 5, 100000 + i) for i in range(400)]
    df = spark.createDataFrame(rows, "k bigint, o bigint, u bigint")
    order = [col("o"), col("u")]
    calm = df.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy(*order)).cast("bigint"))
    busy = skew.rank_in_group(df, ["k"], order, "r")
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, calm.collect()), key=key) == sorted(map(tuple, busy.collect()), key=key)


def test_ranks_of_small_keys_take_one_shuffle_and_large_keys_the_same_ranks(spark, monkeypatch):
    rows = [(k, i % 7, i) for k in (None, 1, 2, 3) for i in range(3 if k == 2 else 40)]
    df = spark.createDataFrame(rows, "k int, v int, i int").repartition(5, "i")
    small = skew.rank_in_group(df, ["k"], [col("v").desc(), col("i")], "r")
    plan = small._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" in plan
    monkeypatch.setattr(skew, "HOT_ROWS", 10)
    large = skew.rank_in_group(df, ["k"], [col("v").desc(), col("i")], "r")
    want = [(k, v, i, n) for x in (None, 1, 2, 3) for n, (k, v, i) in enumerate(sorted((r for r in rows if r[0] == x), key=lambda r: (-r[1], r[2])), 1)]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert small.dtypes == large.dtypes
    for found in (small, large):
        assert sorted(map(tuple, found.collect()), key=key) == sorted(want, key=key)


def test_parts_hold_every_item(spark):
    df = spark.createDataFrame([(1, i) for i in range(25)] + [(2, 1)], "k int, v int")
    parts = document.group_to_struct_array(df, ["k"], [col("v")], ["v"], "items", max_items=10)
    sizes = data(parts.select("k", "part", F.size("items")))
    assert sizes == [(1, 0, 10), (1, 1, 10), (1, 2, 5), (2, 0, 1)]
    child = document.ChildCollection("items", df, "k", ["v"], ["v"])
    parent = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    docs = document.build_snapshot_doc(parent, "k", [child, document.ChildCollection("more", df.filter("k = 2"), "k", ["v"], ["v"])], ["k"], max_items=10)
    assert data(docs.select("k", "part")) == [(1, 0), (1, 1), (1, 2), (2, 0), (3, 0)]
    assert data(docs.filter("k = 3").select("document")) == [('{"k":3,"items":[],"more":[]}',)]


def test_pages_cover_the_table_with_ties_and_nulls(spark):
    rows = [(None if i % 7 == 0 else i // 5, i % 3, i) for i in range(100)]
    df = spark.createDataFrame(rows, "a bigint, b bigint, c bigint")
    order, cursor, seen = ["a", "b", "c"], None, []
    while True:
        rows_of_page = page.keyset_page(df, order, cursor, 13).collect()
        if not rows_of_page:
            break
        seen += [tuple(r) for r in rows_of_page]
        cursor = rows_of_page[-1].asDict()
    assert seen == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def test_positions_and_tie_audit(spark):
    df = spark.createDataFrame([(i // 10, i) for i in range(200)], "a bigint, b bigint")
    got = data(page.row_index_range(df.repartition(5), [col("a"), col("b")], 11, 15).select("b", "row_index"))
    assert got == [(10, 11), (11, 12), (12, 13), (13, 14), (14, 15)]
    skipped = page.boundary_tie_audit(df, ["a"], ["a", "b"], 15).select("b")
    rows = [r for i in range(200) for r in [(i + 1, i // 10, i)]]
    edges = {(p, a) for p, a, _ in rows if p % 15 == 0}
    assert data(skipped) == sorted((b,) for p, a, b in rows if any(a == ea and p > ep for ep, ea in edges))


def test_lookup_preferred_order(spark):
    parents = spark.createDataFrame(
        [(1, "AB", "old1", "FAKE"), (2, "ab", "old2", "real"), (3, "Ab", "zz", "real"), (4, "q", "AB", "real"), (5, "only", "x", "FAKE"), (6, "other", "ONLY", "real")],
        "id bigint, pid string, old string, first string",
    )
    asked = spark.createDataFrame([("Ab",), ("AB",), ("aB",), ("only",), ("ZZ",), ("none",), (" ",), (None,)], "p string")
    out = resolve.lookup_preferred(asked, parents, col("p"), ["pid", "old"], "id", is_placeholder(col("first"), "FAKE"))
    assert {r.p: r.parent_id for r in out.collect()} == {
        "Ab": 3, "AB": 2, "aB": 2, "only": 6, "ZZ": 3, "none": None, " ": None, None: None,
    }


def test_asof_matches_brute_force(spark):
    rng = random.Random(11)
    start = dt.datetime(2024, 1, 1)
    moment = lambda: start + dt.timedelta(hours=rng.randrange(24 * 12))
    cands = [(1 if rng.random() < 0.4 else rng.randrange(6), moment(), i, rng.choice([None, 0, 1, 2, 3])) for i in range(400)]
    rows = [(i, 1 if rng.random() < 0.4 else rng.randrange(7), moment(), rng.randrange(4)) for i in range(300)] + [(999, None, start, 1)]
    c = spark.createDataFrame(cands, "party bigint, cts timestamp_ntz, cid bigint, owner bigint")
    r = spark.createDataFrame(rows, "rid bigint, party bigint, ts timestamp_ntz, own bigint")
    for own in (None, ("own", "owner")):
        got = {x.rid: x.asof_id for x in resolve.asof_before_day(r, c, "party", "ts", "cts", "cid", own).collect()}
        for rid, party, at, mine in rows:
            day = at.replace(hour=0)
            fit = [(t, i) for p, t, i, o in cands if p == party and t < day and not (own and o == mine)]
            assert got[rid] == (max(fit)[1] if fit else None), (own, rid)


def test_top_n_history_matches_brute_force(spark):
    rng = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    hist = [(rng.randrange(4), start + dt.timedelta(hours=rng.randrange(200)), i, rng.choice([None, i])) for i in range(150)]
    probes = [(i, rng.randrange(5), (start + dt.timedelta(hours=rng.randrange(220))).date()) for i in range(80)]
    h = spark.createDataFrame(hist, "party bigint, ts timestamp_ntz, hid bigint, v bigint")
    p = spark.createDataFrame(probes, "pid bigint, party bigint, day date")
    got = document.top_n_history(p, h, "party", "day", "ts", "hid", 3, lambda x: x["v"].isNotNull(), ["hid", "v"])
    found = {r.pid: r.history_hid for r in got.collect()}
    for pid, party, day in probes:
        newest = sorted(((t, i, v) for q, t, i, v in hist if q == party and t.date() <= day), reverse=True)[:3]
        want = next((i for _, i, v in newest if v is not None), newest[0][1] if newest else None)
        assert found[pid] == want


def test_match_by_name_phone(spark):
    people = spark.createDataFrame(
        [(1, "Ann", "Lee", "0812345678"), (2, "Ann", "Lee", "0899999999 / 0812345670"), (3, "Bob", "Ray", None), (4, "Ann", "Lee", "0899999999"), (5, "-", "Lee", "1")],
        "pid bigint, first_name string, last_name string, phone string",
    )
    asked = spark.createDataFrame(
        [(1, " Ann ", "Lee", "+66812345678"), (2, "Ann", "Lee", "0899999999"), (3, "Bob", "Ray", "x"), (4, "-", "Lee", "1"), (5, "Cy", "No", "1"), (6, "Ann", "Lee", None), (7, "Ann", "Lee", "0812345670")],
        "rid bigint, first_name string, last_name string, phone string",
    )
    out = {r.rid: (r.pid, r.is_ambiguous) for r in resolve.match_by_name_phone(asked, "rid", people, "pid").collect()}
    assert out == {1: (1, False), 2: (None, True), 3: (3, False), 4: (None, False), 5: (None, False), 6: (None, True), 7: (2, False)}


def test_pair_renamed_claims_and_reasons(spark):
    people = "pid string, old_db_id string, id bigint, first_name string, last_name string, birth_date string, national_id string"
    old = spark.createDataFrame(
        [("T1", "T1", 1, "A", "B", "d1", None), ("T2", "T2", 2, "C", "D", "d2", "n"), ("T3", "T3", 3, "E", "F", "d3", None), ("T4", "T4", 4, "G", "H", "d4", None)], people
    )
    new = spark.createDataFrame(
        [("N1", "A", "X", "d1", None), ("N2", "C", "D", "d2", "m"), ("N3", "E", "F", "d3", None), ("N3b", "E", "F", "d3", None), ("N4", "G", "H", "d4", None), ("N5", None, "H", "d4", None)],
        "pid string, first_name string, last_name string, birth_date string, national_id string",
    )
    log = spark.createDataFrame([("T1", "N1"), ("t4", "n4")], "old_pid string, new_pid string")
    live = spark.createDataFrame([("T4",)], "pid string")
    none = spark.createDataFrame([], "pid string")
    out = {r.new_pid: (r.row_id, r.route, r.reason, r.old_pid_alive) for r in resolve.pair_renamed(new, old, log, live, none).collect()}
    assert out == {
        "N1": (1, "log", None, False), "N2": (2, "identity", "national_id_differs", False),
        "N3": (None, "identity", "identity_not_unique", None), "N3b": (None, "identity", "identity_not_unique", None),
        "N4": (4, "log", None, True),
    }
    both = spark.createDataFrame([("T1", "N1"), ("T1", "N9")], "old_pid string, new_pid string")
    twice = spark.createDataFrame([("N1", "A", "X", "d1", None), ("N9", "Z", "B", "d1", None)], new.schema)
    assert {r.reason for r in resolve.pair_renamed(twice, old, both, live, none).collect()} == {"claimed_by_several"}


def test_entities_without_key_stay_apart(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "a"), (4, None), (5, "b")], "rid bigint, key string")
    known = spark.createDataFrame([("b", 7)], "match_key string, eid bigint")
    out, created = resolve.find_or_create_entity(rows, col("key"), "rid", known, "eid")
    ids_by_row = {r.rid: r.eid for r in out.collect()}
    assert ids_by_row[1] == ids_by_row[3] and ids_by_row[5] == 7
    assert len({ids_by_row[i] for i in (1, 2, 4, 5)}) == 4 and created.count() == 3


def test_dedup(spark):
    df = spark.createDataFrame([("a ", 2), ("﻿a", 1), (" ", 0), ("A", 5)], "k string, o int")
    assert data(dedup.first_by_key(df, col("k"), [col("o")])) == [("A", 5), ("﻿a", 1)]
    votes = spark.createDataFrame([(1, "x"), (1, None), (2, "x"), (2, "y"), (3, None)], "k int, v string")
    assert {r.k: (r.v, r.is_ambiguous) for r in dedup.unanimous_or_null(votes, ["k"], "v").collect()} == {
        1: ("x", False), 2: (None, True), 3: (None, False),
    }


def test_compare_with_itself_has_no_diff_and_pairs_copies(spark):
    df = spark.createDataFrame([("1", "a", "5"), ("1", "b", None), ("2", "c", "7.0")], "k string, a string, n string")
    other = spark.createDataFrame([(1, "a", 5.0), (1, "b", None), (2, "c", 7.0)], "k int, a string, n double")
    spec = compare.CompareSpec("k", "k", ["a", "n"], ["a"])
    assert data(compare.compare_summary(compare.compare_by_key(df, df, spec))) == [("match", 3)]
    assert data(compare.compare_summary(compare.compare_by_key(df, other, spec))) == [("match", 3)]
    gone = compare.compare_by_key(df, df.filter("a = 'b'"), spec)
    assert data(gone.select("key", "k", "status")) == [("1", 1, "field_mismatch"), ("1", 2, "missing_right"), ("2", 1, "missing_right")]


def test_compare_waives_swapped_phones(spark):
    a = spark.createDataFrame([(1, "1", "02 / 08"), (2, "5", "6")], "k int, h string, b string")
    b = spark.createDataFrame([(1, "02", "08"), (2, "6", "7")], "k int, h string, b string")
    waive = (["h", "b"], compare.pair_multiset_equal(col("_l_h"), col("_l_b"), col("_r_h"), col("_r_b")))
    diff = compare.compare_by_key(a, b, compare.CompareSpec("k", "k", ["h", "b"], ["h"], [waive]))
    assert {r.key: r.status for r in diff.collect()} == {"1": "match", "2": "field_mismatch"}


def test_canonical_values(spark):
    df = spark.createDataFrame([("007", "n:7"), ("7.0", "n:7"), ("7.50", "f:7.5"), (" x ", "t: x "), ("  ", None), ("1e2", "n:100")], "v string, want string")
    assert df.filter(~compare.canonical_value(col("v")).eqNullSafe(col("want"))).count() == 0


def test_multiset_missing_reports_partial(spark):
    s = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "1"), ("c", "2"), ("d", "x")], "k string, send string")
    t = spark.createDataFrame([("a", "1")], "k string, send string")
    out = sets.multiset_missing(s, t, "k", "send", col("send").rlike("^[0-9]+$"))
    assert data(out) == [("a", "1", 1, "partial"), ("b", "1", 1, "partial"), ("c", "2", 1, "send"), ("d", "x", 1, "unsendable")]


def test_every_row_is_good_or_quarantined(spark):
    df = spark.createDataFrame([("1", "x"), ("z", "y"), (None, "q")], "n string, m string")
    rules = [quality.FieldRule("n", "n", col("n").try_cast("int"), "integer_parse_failed", required=True)]
    good, bad = quality.quarantine_bad_rows(df, rules)
    assert good.count() + bad.count() == 3 and data(bad.select("n", "failed_fields")) == [("z", "n")]


def test_repair_ids_of_wide_ranges_are_all_there(spark):
    log = spark.createDataFrame(
        [(1, "failed", 1, 9, [5]), (2, "failed", 10, 12, [77]), (2, "ok", 50, 60, [61]), (2, "failed", 100, 25_900, None), (2, "failed", None, None, None)],
        "run_id int, status string, first_id bigint, last_id bigint, ids array<bigint>",
    )
    issues = spark.createDataFrame([("11",), ("x",), (" ",)], "record_id string")
    got = {r.source_id for r in quality.repair_ids(log, issues).collect()}
    assert got == {"10", "11", "12", "77", "x"} | {str(i) for i in range(100, 25_901)}


def test_role_paths_at_any_depth(spark):
    df = spark.createDataFrame([(1, '{"role": "a", "x": {"user_role": [1, {"roles": null}], "roller": 1}}'), (4, '{"a":{"b":{"c":{"d":{"e":[{"f":{"role":7}}]}}}}}'), (2, "not json"), (3, "[]")], "i int, js string")
    assert data(jsonrefs.walk_json_paths(df, "i", "js").select("i", "path")) == [(1, "role"), (1, "x.user_role"), (1, "x.user_role[1].roles"), (4, "a.b.c.d.e[0].f.role")]


def test_json_fingerprint_ignores_key_order(spark):
    df = spark.createDataFrame([(1, '{"b": 1, "a": 2}', "t1"), (2, '{"a":2,"b":1}', "t2")], "i int, js string, at string")
    prints = jsonrefs.canonical_json_fingerprint(df, "i", drop=["i", "at"], json_columns=["js"])
    assert prints.select("fingerprint").distinct().count() == 1


def test_refs_skip_templates(spark):
    refs = spark.createDataFrame([("a",), ("{{x}}",), ("b",)], "ref string")
    known = spark.createDataFrame([("a",)], "name string")
    assert data(jsonrefs.missing_refs(refs, known, "ref", "name")) == [("b",)]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_tasks_of_a_ranking_grow_with_its_rows(spark, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 100, raising=False)
    df = spark.createDataFrame([(i % 300 if i % 9 else None, i) for i in range(1000)], "k int, v int")
    ranked = skew.rank_in_group(df, ["k"], [col("v")], "r")
    assert ranked.rdd.getNumPartitions() == 10
    calm = df.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy("v")).cast("bigint"))
    assert sorted(map(str, ranked.collect())) == sorted(map(str, calm.collect()))


def test_lists_in_parts_are_gathered_once(spark):
    held = spark.createDataFrame([(1, 0, '["a"]'), (2, 0, '[{"b": 1}]'), (3, 0, "[1]"), (None, 0, "[2]")], "k int, part int, items string")
    rows = spark.createDataFrame([(k, i) for k in (1, 2, None) for i in range(3)], "k int, v int")
    lists = document.group_to_struct_array(rows, ["k"], [col("v")], ["v"], "items", 2).withColumn("items", F.to_json("items"))
    merged = merge.array_parts_unless_object(held, lists, "k", "items")
    assert "Window" not in plan_of(merged)
    assert sorted(map(str, map(tuple, merged.collect()))) == sorted(map(str, [
        (1, 0, '[{"v":0},{"v":1}]', "updated"), (1, 1, '[{"v":2}]', "updated"), (2, 0, '[{"b": 1}]', "kept"), (3, 0, "[1]", "kept"), (None, 0, "[2]", "kept"),
    ]))


def test_codes_are_reduced_before_rows_are_remapped(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, " ")], "i int, code string")
    codes = spark.createDataFrame([("a", "z"), ("a", "y"), ("c", "x")], "old_value string, new_value string")
    found = shape.dictionary_remap(rows, "code", codes, "upper")
    assert "Aggregate" not in plan_of(found)
    assert data(found.select("i", F.coalesce("code", F.lit("-")))) == [(1, "y"), (2, "B"), (3, "-"), (4, "-")]


def test_replaced_lines_are_dealt_by_order(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 5, raising=False)
    lines = [(o, n, 10 * o + n, o, 5.0 if n == 1 else 30.0, float(n)) for o in range(1, 21) for n in (1, 2)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(o, "F" if o % 2 else "O") for o in range(1, 21)], "o_orderkey bigint, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    out = QUERIES["replace_children"](spark, str(tmp_path))
    assert "RepartitionByExpression [l_orderkey" in plan_of(out)
    found = [tuple(r) for r in out.select("kind", "line_id", "l_orderkey", "part").collect()]
    assert {r for r in found if r[0] == "line" and r[2] % 2 == 0} == {("line", o * 10 + n, o, 10 * o + n) for o in range(2, 21, 2) for n in (1, 2)}
    assert {r for r in found if r[0] == "line" and r[2] % 2} == {("line", 202 + i, o, 10 * o + 2) for i, o in enumerate(range(1, 21, 2), 1)}
    assert {r for r in found if r[0] == "pointer"} == {("pointer", 202 + i, o, None) for i, o in enumerate(range(1, 21, 2), 1)}


def test_documents_run_the_plan_of_their_parents_once(spark):
    parents = spark.createDataFrame([([1, 2],)], "ks array<int>").select(F.explode("ks").alias("k"))
    kids = spark.createDataFrame([(1, i) for i in range(3)], "k int, v int")
    docs = document.build_snapshot_doc(parents, "k", [document.ChildCollection(n, kids, "k", ["v"], ["v"]) for n in ("a", "b")], ["k"], max_items=2)
    assert "Generate" not in plan_of(docs)
    assert data(docs) == [
        (1, 0, '{"k":1,"a":[{"v":0},{"v":1}],"b":[{"v":0},{"v":1}]}'), (1, 1, '{"k":1,"a":[{"v":2}],"b":[{"v":2}]}'), (2, 0, '{"k":2,"a":[],"b":[]}'),
    ]
