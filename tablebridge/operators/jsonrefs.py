"""References and fingerprints in JSON configuration rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebridge.session import cut_lineage

# Reference shapes searched in configuration text.
URL_SHAPE = r"https?://[^\s'\"\\]+"
UUID_IN_TEXT = r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
ENV_SHAPE = r"(?i)(?:\{\{\s*\$?env\.|\$env\.|process\.env\.|\$env\[['\"])([A-Za-z_][A-Za-z0-9_]*)"
ROLE_KEY_SHAPE = r"(?i)(^|_)role$|^roles$"


def extract_refs(
    df: DataFrame,
    row_id: str,
    text: str,
    patterns: Mapping[str, tuple[str, int]],
    paths: Mapping[str, str] | None = None,
) -> DataFrame:
    """References of each kind in a text column, one row per hit with its row id.

    `patterns` maps a kind to (regular expression, group) searched in the whole text; `paths` maps
    a kind to a JSON path. The text is parsed once for all paths; a list gives one reference per element.
    """

    def tagged(kind: str) -> Callable[[Column], Column]:
        return lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("ref"))

    hits = [
        F.transform(F.regexp_extract_all(F.col(text), F.lit(shape), group), tagged(kind))
        for kind, (shape, group) in patterns.items()
    ]
    def at(parsed: Column) -> Column:
        found = []
        for kind, path in (paths or {}).items():
            node = F.try_variant_get(parsed, path, "variant")
            is_list = F.coalesce(F.schema_of_variant(node).startswith("ARRAY"), F.lit(False))
            one = F.array(F.try_variant_get(node, "$", "string"))
            found.append(F.transform(F.when(is_list, F.try_variant_get(node, "$", "array<string>")).otherwise(one), tagged(kind)))
        return F.concat(*found)

    if paths:
        hits.append(F.flatten(F.transform(F.array(F.try_parse_json(text)), at)))
    return (
        df.select(row_id, F.explode(F.concat(*hits)).alias("h"))
        .select(row_id, "h.kind", "h.ref")
        .filter("ref is not null and ref <> ''")
    )


# Levels of a JSON text that one pass unfolds.
LEVELS = 5


def _members(node: Column) -> Column:
    """Name, step and node of each member of an object or element of an array; none of a leaf."""
    fields = F.map_entries(F.try_variant_get(node, "$", "map<string,variant>"))
    member = lambda name, step, value: F.struct(name.alias("name"), step.alias("step"), value.alias("node"))
    named = F.transform(fields, lambda e: member(e["key"], F.concat(F.lit("."), e["key"]), e["value"]))
    nameless = F.lit(None).cast("string")
    listed = F.transform(
        F.try_variant_get(node, "$", "array<variant>"),
        lambda x, i: member(nameless, F.concat(F.lit("["), i.cast("string"), F.lit("]")), x),
    )
    return F.coalesce(named, listed, F.array().cast("array<struct<name:string,step:string,node:variant>>"))


def _unfolded(node: Column, key_shape: str, levels: int) -> Column:
    """Matching members down to so many levels, and the containers of the last one, with their paths."""

    def each(m: Column) -> Column:
        hit = F.coalesce(m["name"].rlike(key_shape), F.lit(False))
        more = F.coalesce(F.schema_of_variant(m["node"]).rlike("^(OBJECT|ARRAY)"), F.lit(False)) if levels == 1 else F.lit(False)
        own = F.array(F.struct(m["step"].alias("path"), m["node"].alias("node"), hit.alias("hit"), more.alias("more")))
        own = F.filter(own, lambda x: x["hit"] | x["more"])
        if levels == 1:
            return own
        deeper = lambda x: F.struct(F.concat(m["step"], x["path"]).alias("path"), x["node"].alias("node"), x["hit"].alias("hit"), x["more"].alias("more"))
        return F.concat(own, F.transform(_unfolded(m["node"], key_shape, levels - 1), deeper))

    return F.flatten(F.transform(_members(node), each))


def walk_json_paths(df: DataFrame, row_id: str, json: str, key_shape: str = ROLE_KEY_SHAPE) -> DataFrame:
    """(path, value) of every key whose name matches, at any depth.

    A pass unfolds LEVELS levels of each text inside one expression and stages what matches and the containers
    that go deeper; leaves are not stored. The walk ends at a pass without such containers.
    """
    level = df.select(F.col(row_id), F.lit("").alias("path"), F.try_parse_json(json).alias("node"))
    found = None
    while True:
        inner = level.select(row_id, "path", F.explode(_unfolded(F.col("node"), key_shape, LEVELS)).alias("m"))
        level = cut_lineage(inner.select(row_id, F.concat("path", "m.path").alias("path"), "m.node", "m.hit", "m.more"))
        hits = level.filter("hit").select(row_id, F.regexp_replace("path", "^[.]", "").alias("path"), F.to_json("node").alias("value"))
        found = hits if found is None else found.unionByName(hits)
        level = level.filter("more").select(row_id, "path", "node")
        if level.isEmpty():
            return found


def missing_refs(refs: DataFrame, present: DataFrame, ref: str, name: str) -> DataFrame:
    """Referenced names that do not exist; templated names are skipped."""
    wanted = refs.filter(~F.col(ref).startswith("{{"))
    return wanted.join(present.select(F.col(name).alias(ref)), ref, "left_anti")


def canonical_json_fingerprint(
    df: DataFrame, id_col: str, drop: Sequence[str] = (), json_columns: Sequence[str] = ()
) -> DataFrame:
    """Id, key-sorted JSON of the row without volatile columns, and its digest.

    JSON columns pass through a variant, which writes object keys in order.
    """

    def field(c: str) -> Column:
        return (F.to_json(F.try_parse_json(c)) if c in json_columns else F.col(c)).alias(c)

    names = sorted(c for c in df.columns if c not in drop)
    payload = F.to_json(F.struct(*[field(c) for c in names]), {"ignoreNullFields": "false"})
    return df.select(id_col, payload.alias("payload")).withColumn("fingerprint", F.sha2("payload", 256))


def operation_refs(
    ops: DataFrame, op_type: str, options: str, rules: Sequence[tuple[str, str, str]], context: Sequence[str]
) -> DataFrame:
    """References that depend on the kind of operation, one row each with its context columns: (context, kind, ref).

    A rule is (beginning of the type, JSON path, kind). Options are parsed once; a list gives one row per
    element; templated and empty references are left out.
    """

    def tagged(kind: str) -> Callable[[Column], Column]:
        return lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("ref"))

    def at(parsed: Column) -> Column:
        found = []
        for prefix, path, kind in rules:
            node = F.when(F.col(op_type).startswith(prefix), F.try_variant_get(parsed, path, "variant"))
            listed = F.try_variant_get(node, "$", "array<string>")
            one = F.array(F.try_variant_get(node, "$", "string"))
            found.append(F.transform(F.coalesce(listed, one), tagged(kind)))
        return F.concat(*found)

    hits = F.flatten(F.transform(F.array(F.try_parse_json(options)), at))
    return ops.select(*context, F.explode(hits).alias("h")).select(*context, "h.kind", "h.ref").filter("ref <> '' and not ref like '{{%'")


def reachable(starts: DataFrame, edges: DataFrame) -> DataFrame:
    """(node) of every node that `edges` (a, b) lead to from `starts` (node), these included.

    Breadth first: a round follows the edges of the nodes found last and keeps what is new, so cycles end
    and a round costs its own nodes. There are as many rounds as the longest way has steps.
    """
    edges = cut_lineage(edges.filter("a is not null and b is not null").distinct())
    found = last = cut_lineage(starts.filter("node is not null").distinct())
    while True:
        ahead = last.join(edges, F.col("node") == F.col("a")).select(F.col("b").alias("node")).distinct()
        last = cut_lineage(ahead.join(found, "node", "left_anti"))
        if last.isEmpty():
            return found
        found = found.unionByName(last)


def flow_graph_issues(flows: DataFrame, ops: DataFrame, trigger: str = "trigger") -> DataFrame:
    """(flow_id, op_id, issue, detail) of a set of automation flows.

    `flows`: flow_id, first_op. `ops`: op_id, flow_id, op_type, options (JSON), resolve, reject. Issues:
    `trigger_missing` (an operation starts a flow that does not exist), `next_missing` (the operation after
    a success or failure does not exist), `next_elsewhere` (it belongs to another flow), `unreachable` (no way
    leads to it from its flow's first operation).
    """
    issue = lambda df, name, detail: df.select("flow_id", "op_id", F.lit(name).alias("issue"), detail.cast("string").alias("detail"))
    refs = operation_refs(ops, "op_type", "options", [(trigger, "$.flow", "flow")], ["flow_id", "op_id"])
    lost = refs.join(flows.select(F.col("flow_id").cast("string").alias("ref")).distinct(), "ref", "left_anti")
    steps = ops.select("flow_id", "op_id", F.explode(F.array("resolve", "reject")).alias("next")).filter("next is not null")
    known = ops.select(F.col("op_id").alias("next"), F.col("flow_id").alias("_there"))
    placed = cut_lineage(steps.join(known, "next", "left"))
    inside = placed.filter("_there = flow_id")
    way = reachable(flows.select(F.col("first_op").alias("node")), inside.select(F.col("op_id").alias("a"), F.col("next").alias("b")))
    return (
        issue(lost, "trigger_missing", F.col("ref"))
        .unionByName(issue(placed.filter("_there is null"), "next_missing", F.col("next")))
        .unionByName(issue(placed.filter("_there <> flow_id"), "next_elsewhere", F.col("next")))
        .unionByName(issue(ops.join(way.withColumnRenamed("node", "op_id"), "op_id", "left_anti"), "unreachable", F.lit(None)))
    )
