"""Write modes as pure functions (target, source, spec) -> new target.

Every function returns the new target rows with a `merge_action` column. The source must be unique
on its keys (see `dedup`). The target is joined from the left, so a small source is broadcast by
the optimizer and a large target is not shuffled; the keys that are new are found by reading the
target's key columns only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebridge.operators.dedup import distinct_on
from tablebridge.operators.ids import assign_ids
from tablebridge.operators.skew import left_lookup, spread
from tablebridge.session import cut_lineage

ACTION = "merge_action"
SOURCE = "_s_"


@dataclass(frozen=True)
class MergeSpec:
    """Keys, optional surrogate id, and the columns a merge may write (default: all shared)."""

    keys: Sequence[str]
    id_col: str | None = None
    columns: Sequence[str] | None = None
    policies: Mapping[str, Callable[[Column, Column], Column]] = field(default_factory=dict)
    keep: Sequence[str] = ()

    def written(self, target: DataFrame, source: DataFrame) -> list[str]:
        fixed = {*self.keys, self.id_col}
        names = self.columns or [c for c in target.columns if c in source.columns]
        return [c for c in names if c not in fixed]


def _beside(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows with the source row of their key, its columns prefixed."""
    tagged = source.select(
        *[F.col(k) for k in keys],
        *[F.col(c).alias(SOURCE + c) for c in source.columns if c not in keys],
        F.lit(True).alias("_hit"),
    )
    joined = left_lookup(target, tagged, keys)
    return joined.withColumn("_hit", F.coalesce("_hit", F.lit(False)))


def _new_rows(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """Source rows to insert, shaped like the target, with ids behind the highest one."""
    keys = list(spec.keys)
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    # The semi join keeps this side no larger than the source.
    seen = target.select(*keys).join(source.select(*keys), keys, "left_semi")
    fresh = source.filter(has_key).join(seen, keys, "left_anti")
    if spec.id_col:
        fresh = assign_ids(fresh.drop(spec.id_col), [F.col(k) for k in keys], target, spec.id_col)
    types = {f.name: f.dataType for f in target.schema.fields}
    columns = [
        F.col(c).cast(t).alias(c) if c in fresh.columns else F.lit(None).cast(t).alias(c)
        for c, t in types.items()
    ]
    return fresh.select(*columns).withColumn(ACTION, F.lit("inserted"))


def _write(
    target: DataFrame,
    source: DataFrame,
    spec: MergeSpec,
    value: Callable[[str, Column, Column], Column],
    when: Column | None = None,
    insert: bool = True,
    changed_action: str = "updated",
) -> DataFrame:
    """Write `value(column, old, new)` into matched rows; rows whose values stay are unchanged."""
    columns = spec.written(target, source)
    beside = _beside(target, source, spec.keys)
    apply = F.col("_hit") if when is None else F.col("_hit") & F.coalesce(when, F.lit(False))
    fresh = {
        c: value(c, F.col(c), F.col(SOURCE + c)).cast(target.schema[c].dataType) for c in columns
    }
    same = F.struct(*[F.col(c) for c in columns]).eqNullSafe(F.struct(*[fresh[c].alias(c) for c in columns]))
    action = (
        F.when(~F.col("_hit"), "kept").when(apply & ~same, changed_action).otherwise("unchanged")
    )
    out = beside.select(
        *[
            F.when(apply, fresh[c]).otherwise(F.col(c)).alias(c) if c in fresh else F.col(c)
            for c in target.columns
        ],
        action.alias(ACTION),
    )
    return out.unionByName(_new_rows(target, source, spec)) if insert else out


def merge_insert_only(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """Add rows with new keys; nothing that exists is touched."""
    return target.withColumn(ACTION, F.lit("kept")).unionByName(_new_rows(target, source, spec))


def merge_overwrite(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """Matched rows take all source values and count as updated; new keys are inserted."""
    columns = spec.written(target, source)
    beside = _beside(target, source, spec.keys)
    out = beside.select(
        *[
            F.when(F.col("_hit"), F.col(SOURCE + c).cast(target.schema[c].dataType)).otherwise(F.col(c)).alias(c)
            if c in columns
            else F.col(c)
            for c in target.columns
        ],
        F.when(F.col("_hit"), "updated").otherwise("kept").alias(ACTION),
    )
    return out.unionByName(_new_rows(target, source, spec))


def merge_if_changed(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """Update a matched row only if a value differs (null equals null); insert new keys."""
    return _write(target, source, spec, lambda c, old, new: new)


def fill_null_only(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """Existing values win; nulls take the source value. New keys are inserted."""
    return _write(
        target, source, spec, lambda c, old, new: F.coalesce(old, new), changed_action="filled"
    )


def prefer_source_keep_target(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """Source values win; a null in the source does not erase what exists."""
    return _write(target, source, spec, lambda c, old, new: F.coalesce(new, old))


def overwrite(old: Column, new: Column) -> Column:
    return new


def never(old: Column, new: Column) -> Column:
    return old


def only_if_null(old: Column, new: Column) -> Column:
    return F.coalesce(old, new)


def only_if(default: object) -> Callable[[Column, Column], Column]:
    """Policy: write while the target still holds its default."""
    return lambda old, new: F.when(old.eqNullSafe(F.lit(default)), new).otherwise(old)


def if_condition(condition: Column) -> Callable[[Column, Column], Column]:
    """Policy: write where a condition over the target row (or `_s_` source columns) holds."""
    return lambda old, new: F.when(condition, new).otherwise(old)


def column_policy_merge(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """Every column follows its own policy (default: overwrite)."""
    return _write(
        target, source, spec, lambda c, old, new: spec.policies.get(c, overwrite)(old, new)
    )


def upgrade_placeholder(
    target: DataFrame, source: DataFrame, spec: MergeSpec, placeholder: Column
) -> DataFrame:
    """Insert new keys; of the existing rows only placeholders take the source values."""
    return _write(
        target, source, spec, lambda c, old, new: new, when=placeholder, changed_action="upgraded"
    )


def replace_keep_id(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """Replace the rows of each source key, reusing their id and the `keep` columns.

    Unlike an overwrite, columns the source does not deliver end up null in replaced rows.
    """
    columns = spec.written(target, source)
    kept = {*spec.keys, spec.id_col, *spec.keep}
    beside = _beside(target, source, spec.keys)

    def replaced(c: str) -> Column:
        if c in kept:
            return F.col(c)
        new = F.col(SOURCE + c) if c in columns else F.lit(None)
        return F.when(F.col("_hit"), new.cast(target.schema[c].dataType)).otherwise(F.col(c)).alias(c)

    out = beside.select(
        *[replaced(c) for c in target.columns],
        F.when(F.col("_hit"), "replaced").otherwise("kept").alias(ACTION),
    )
    return out.unionByName(_new_rows(target, source, spec))


def replace_new_id(target: DataFrame, source: DataFrame, spec: MergeSpec) -> DataFrame:
    """Replace the rows of each source key by rows with new ids, as a delete and an insert would."""
    keys = list(spec.keys)
    incoming = source.select(*keys).distinct()
    kept = target.join(incoming, keys, "left_anti").select(*target.columns, F.lit("kept").alias(ACTION))
    known = target.select(*keys).join(incoming, keys, "left_semi").distinct().withColumn("_known", F.lit(True))
    # Ids go on behind all of the old ones, those of replaced rows included.
    nobody = target.select(*[F.lit(None).cast(t).alias(c) if c in keys else F.col(c) for c, t in target.dtypes])
    fresh = left_lookup(_new_rows(nobody, source, spec), known, keys)
    action = F.when(F.col("_known"), "replaced").otherwise("inserted")
    return kept.unionByName(fresh.select(*target.columns, action.alias(ACTION)))


def holds_objects(column: str) -> Column:
    """Whether the first element of a JSON array is an object; a text that begins with a brace is none."""
    first = F.try_variant_get(F.try_parse_json(column), "$[0]", "variant")
    return F.coalesce(F.schema_of_variant(first).startswith("OBJECT"), F.lit(False))


def array_overwrite_unless_object(
    target: DataFrame, source: DataFrame, spec: MergeSpec, column: str
) -> DataFrame:
    """Replace a JSON array unless its first element already is an object."""
    return _write(target, source, spec, lambda c, old, new: new, when=~holds_objects(column), insert=False)


def array_parts_unless_object(
    target: DataFrame, source: DataFrame, key: str, column: str, part: str = "part"
) -> DataFrame:
    """The same for arrays stored in parts, one row per (key, part): all parts of a key or none are replaced.

    The source is read twice, so it is written once: gathering its lists again would take their memory again.
    """
    source = cut_lineage(source)
    source = spread(source, [key], source.count())
    state = target.groupBy(key).agg(F.max(holds_objects(column)).alias("_object"))
    fresh = source.join(state.filter(~F.col("_object")).select(key), key, "left_semi")
    kept = target.join(fresh.select(key).distinct(), key, "left_anti").withColumn(ACTION, F.lit("kept"))
    return kept.unionByName(fresh.select(*target.columns).withColumn(ACTION, F.lit("updated")))


def exists_complete(
    target: DataFrame, child: DataFrame, key: str, child_key: str, status: str, default: str, completed: str
) -> DataFrame:
    """Set a default status to completed where a child exists."""
    present = child.select(F.col(child_key).alias(key)).filter(F.col(key).isNotNull()).distinct()
    joined = left_lookup(target, present.withColumn("_present", F.lit(True)), [key], sparse=True)
    turns = F.coalesce(F.col("_present"), F.lit(False)) & (F.col(status) == default)
    return (
        joined.withColumn(ACTION, F.when(turns, "updated").otherwise("kept"))
        .withColumn(status, F.when(turns, F.lit(completed)).otherwise(F.col(status)))
        .drop("_present")
    )


def replace_children(
    children: DataFrame,
    parents: DataFrame,
    fresh: DataFrame,
    parent_key: str,
    payload: Sequence[str],
    child_id: str,
) -> tuple[DataFrame, DataFrame]:
    """(children with those of the given parents replaced, back-pointer per parent).

    Of the new children only rows with some payload are kept. `parents` holds the updated keys.
    """
    has_payload = F.lit(False)
    for c in payload:
        has_payload = has_payload | F.col(c).isNotNull()
    kept = children.join(parents.select(parent_key).distinct(), parent_key, "left_anti")
    added = fresh.join(parents.select(parent_key), parent_key, "left_semi").filter(has_payload)
    added = assign_ids(
        added.drop(child_id), [F.col(parent_key), *[F.col(c) for c in payload]], children, child_id
    )
    pointers = parents.select(parent_key).distinct().join(
        added.groupBy(parent_key).agg(F.min(child_id).alias("child_pointer")), parent_key, "left"
    )
    return kept.unionByName(added.select(*children.columns)), pointers


def append_log(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Append every row, equal ones included."""
    return target.unionByName(rows, allowMissingColumns=True)


def last_wins_attribute(
    parent: DataFrame, rows: DataFrame, key: str, value: str, order: Sequence[Column], column: str
) -> DataFrame:
    """The last row by order sets one attribute of its parent; other parents keep theirs."""
    last = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order)).alias("_last")
    )
    joined = left_lookup(parent, last, [key])
    return joined.withColumn(
        column, F.when(F.col("_last").isNotNull(), F.col("_last.v")).otherwise(F.col(column))
    ).drop("_last")


def latest_child_to_parent(
    parent: DataFrame, child: DataFrame, key: str, order: Sequence[Column], fills: Mapping[str, str]
) -> DataFrame:
    """Copy columns of the child that sorts first (say, highest id) to its parent."""
    top = distinct_on(child.filter(F.col(key).isNotNull()), [key], order)
    chosen = top.select(F.col(key), *[F.col(src).alias(f"_c_{dst}") for dst, src in fills.items()])
    joined = left_lookup(parent, chosen.withColumn("_hit", F.lit(True)), [key])
    for dst in fills:
        joined = joined.withColumn(dst, F.when(F.col("_hit"), F.col(f"_c_{dst}")).otherwise(F.col(dst)))
    return joined.select(*parent.columns)


def backfill_from_lookup(
    df: DataFrame, lookup: DataFrame, key: str, lookup_key: str, value: str, column: str
) -> DataFrame:
    """Fill a null column from a lookup; only positive keys are looked up."""
    found = lookup.groupBy(F.col(lookup_key).alias("_key")).agg(F.min(value).alias("_value"))
    marked = df.withColumn("_key", F.when(F.col(column).isNull() & (F.col(key) > 0), F.col(key)))
    return (
        left_lookup(marked, found, ["_key"], sparse=True)
        .withColumn(column, F.coalesce(F.col(column), F.col("_value")))
        .drop("_key", "_value")
    )


def create_companion(
    parent: DataFrame,
    companion: DataFrame,
    parent_id: str,
    fk: str,
    id_col: str,
    attributes: Mapping[str, Column],
) -> tuple[DataFrame, DataFrame]:
    """(parents with the id of their companion, companions made for parents that lack one)."""
    lacking = parent.join(companion.select(F.col(fk).alias(parent_id)), parent_id, "left_anti")
    made = assign_ids(
        lacking.select(F.col(parent_id).alias(fk), *[c.alias(n) for n, c in attributes.items()]),
        [F.col(fk)], companion, id_col,
    )
    links = (
        companion.select(fk, id_col).unionByName(made.select(fk, id_col))
        .groupBy(F.col(fk).alias(parent_id)).agg(F.min(id_col).alias(id_col))
    )
    return left_lookup(parent, links, [parent_id]), made


def derive_if_null(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Fill empty columns by rule. All rules read the row as it was before."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), rule.cast(df.schema[c].dataType)) for c, rule in rules.items()}
    )


def merge_metrics(merged: DataFrame, source: DataFrame | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per action. With the source as it was read, also `skipped`, its rows without a full key,
    and `duplicate`, its rows beyond the first of their key."""
    actions = merged.groupBy(ACTION).agg(F.count(F.lit(1)).alias("rows"))
    if source is None:
        return actions
    full = F.lit(True)
    for k in keys:
        full = full & F.col(k).isNotNull()
    per_key = source.withColumn("_full", full).groupBy("_full", *[F.when(full, F.col(k)).alias(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    name = F.when(F.col("_full"), "duplicate").otherwise("skipped")
    beyond = F.when(F.col("_full"), F.col("_n") - 1).otherwise(F.col("_n"))
    read = per_key.groupBy(name.alias(ACTION)).agg(F.sum(beyond).alias("rows")).filter("rows > 0")
    return actions.unionByName(read)
