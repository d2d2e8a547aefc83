"""Flow graphs: cycles end, ways are followed inside a flow only."""

from tablebridge.operators import jsonrefs


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_issues_of_flows(spark):
    flows = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "flow_id int, first_op int")
    ops = spark.createDataFrame(
        [
            (10, 1, "trigger", '{"flow": "2"}', 11, None), (11, 1, "trigger", '{"flow": ["9", "{{x}}", "2"]}', 10, 99),
            (12, 1, "log", '{"flow": "9"}', 12, None), (20, 2, "trigger", "not json", 11, None), (30, 3, "log", None, None, None),
        ],
        "op_id int, flow_id int, op_type string, options string, resolve int, reject int",
    )
    assert rows(jsonrefs.flow_graph_issues(flows, ops)) == sorted([
        (1, 11, "trigger_missing", "9"), (1, 11, "next_missing", "99"), (2, 20, "next_elsewhere", "11"),
        (1, 12, "unreachable", None), (3, 30, "unreachable", None),
    ], key=str)
    assert rows(jsonrefs.flow_graph_issues(flows.limit(0), ops.limit(0))) == []


def test_walk_goes_below_one_pass(spark):
    deep = '{"role": 0}'
    for i in range(12):
        deep = f'{{"k{i}": [{deep}, {i}]}}' if i % 2 else f'{{"role": {i}, "x": {deep}}}'
    found = dict(rows(jsonrefs.walk_json_paths(spark.createDataFrame([(1, deep), (2, "no"), (3, None), (4, "[]")], "id int, j string"), "id", "j").select("path", "value")))
    assert len(found) == 7 and found["k11[0].role"] == "10" and found["k11[0].x.k9[0].x.k7[0].x.k5[0].x.k3[0].x.k1[0].x.role"] == "0"
