"""Catch-up of tables whose rows are asked for by unit: child tables with composite keys, and logs with equal rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebridge.operators.dedup import distinct_on
from tablebridge.operators.ids import assign_ids
from tablebridge.operators.skew import rank_in_group
from tablebridge.session import cut_lineage

ACTION = "merge_action"


@dataclass(frozen=True)
class CatchUpSpec:
    """`unit` is what the source can be asked for, `keys` tell a unit's rows apart.

    With `multiset` rows of one key count as often as they occur. A unit of which the target holds a part
    is `partial`: with `replace_partial` it is replaced as one, else it is reported only.
    """

    unit: str
    keys: Sequence[str]
    multiset: bool = False
    replace_partial: bool = True

    @property
    def row_key(self) -> list[str]:
        return [self.unit, *self.keys]


def shortages(snapshot: DataFrame, target: DataFrame, spec: CatchUpSpec) -> DataFrame:
    """(unit, keys, need, have) of all rows of the snapshot and the target, in one aggregate of both.

    Rows without a unit or a key part take no part.
    """
    sides = [
        df.select(*spec.row_key, F.lit(need).cast("bigint").alias("_need"), F.lit(1 - need).cast("bigint").alias("_have")).dropna()
        for df, need in ((snapshot, 1), (target, 0))
    ]
    counted = sides[0].unionByName(sides[1]).groupBy(*spec.row_key).agg(F.sum("_need").alias("need"), F.sum("_have").alias("have"))
    return counted if spec.multiset else counted.withColumn("need", F.least("need", F.lit(1)))


def unit_plan(
    snapshot: DataFrame, target: DataFrame, source: DataFrame, spec: CatchUpSpec, sendable: Column | None = None,
    max_units: int | None = None,
) -> DataFrame:
    """(unit, missing_rows, held_rows, action) of each unit the target lacks rows of.

    Actions: `send` (no row held), `replace` or `partial` (some held), `unsendable` (the id can't be put
    into a request), `not_found` (the source no longer has the unit), `postponed` (beyond the lowest
    `max_units` of those that would be loaded). The units short of rows are written once, as they are read twice.
    """
    short = cut_lineage(
        shortages(snapshot, target, spec)
        .groupBy(spec.unit)
        .agg(F.sum(F.greatest(F.col("need") - F.col("have"), F.lit(0))).alias("missing_rows"), F.sum("have").alias("held_rows"))
        .filter("missing_rows > 0")
    )
    there = source.select(spec.unit).join(short.select(spec.unit), spec.unit, "left_semi").distinct().withColumn("_there", F.lit(True))
    started = F.lit("replace" if spec.replace_partial else "partial")
    action = (
        F.when(~(sendable if sendable is not None else F.lit(True)), "unsendable")
        .when(F.col("_there").isNull(), "not_found")
        .when(F.col("held_rows") > 0, started)
        .otherwise("send")
    )
    plan = short.join(there, spec.unit, "left").select(spec.unit, "missing_rows", "held_rows", action.alias("action"))
    if max_units is None:
        return plan
    plan = cut_lineage(plan)
    due = plan.filter(F.col("action").isin("send", "replace"))
    taken = due.select(spec.unit).orderBy(F.col(spec.unit).try_cast("bigint"), spec.unit).limit(max_units).withColumn("_taken", F.lit(True))
    late = F.col("action").isin("send", "replace") & F.col("_taken").isNull()
    return plan.join(taken, spec.unit, "left").select(
        spec.unit, "missing_rows", "held_rows", F.when(late, "postponed").otherwise(F.col("action")).alias("action")
    )


def catch_up_units(
    source: DataFrame,
    snapshot: DataFrame,
    target: DataFrame,
    spec: CatchUpSpec,
    id_col: str,
    order: Sequence[Column],
    sendable: Column | None = None,
    max_units: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(target with the units it missed, plan with outcomes).

    A unit that is due is written as one: its rows in the target give way to the source's rows. Equal keys
    are settled by ordinal: the k-th row of a key takes the id of the k-th held row of that key (by id), the
    others get ids behind the highest one, and held rows beyond the source's are gone. Without `multiset`
    the first row of a key in `order` counts, so nothing is ranked. Only rows of due units are ranked; the rest of the target is
    read once and never shuffled by its keys.
    """
    plan = cut_lineage(unit_plan(snapshot, target, source, spec, sendable, max_units))
    due = plan.filter(F.col("action").isin("send", "replace")).select(spec.unit)
    incoming = source.join(due, spec.unit, "left_semi").dropna(subset=spec.row_key)
    held = target.join(due, spec.unit, "left_semi").select(*spec.row_key, id_col)
    at = list(spec.row_key)
    if spec.multiset:
        at.append("_ordinal")
        incoming = rank_in_group(incoming, spec.row_key, order, "_ordinal", even=False)
        held = rank_in_group(held, spec.row_key, [F.col(id_col)], "_ordinal", even=False)
    else:
        incoming = distinct_on(incoming, spec.row_key, order)
        # As a struct, so that an id that is null comes first, as in an ordering.
        held = held.groupBy(*spec.row_key).agg(F.min(F.struct(id_col)).alias("_held")).select(*spec.row_key, f"_held.{id_col}")
    # The ids are taken from the held rows; an id column of the source has no say.
    paired = cut_lineage(incoming.drop(id_col).join(held, at, "left"))
    types = {f.name: f.dataType for f in target.schema.fields}
    shaped = lambda df, what: df.select(
        *[F.col(c).cast(t).alias(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in types.items()], F.lit(what).alias(ACTION)
    )
    fresh = paired.filter(F.col(id_col).isNull()).drop(id_col)
    made = assign_ids(fresh, [F.col(c) for c in at], target, id_col)
    kept = target.join(due, spec.unit, "left_anti").select(*target.columns, F.lit("kept").alias(ACTION))
    rows = kept.unionByName(shaped(paired.filter(F.col(id_col).isNotNull()), "replaced")).unionByName(shaped(made, "inserted"))
    written = paired.groupBy(spec.unit).agg(F.count(F.lit(1)).alias("written_rows"))
    outcome = F.when(F.col("action") == "send", "loaded").when(F.col("action") == "replace", "replaced").otherwise(F.col("action"))
    report = plan.join(written, spec.unit, "left").select(
        spec.unit, "missing_rows", "held_rows", F.coalesce("written_rows", F.lit(0)).alias("written_rows"), outcome.alias("action")
    )
    return rows, report


def catch_up_rows(
    source: DataFrame, snapshot: DataFrame, target: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> tuple[DataFrame, DataFrame]:
    """(log with the rows it missed, plan per key): for logs that only grow and hold equal rows.

    Of a key that the source holds k times and the target j times, the rows k - j last in `order` are
    appended; nothing that the target holds is touched. Actions: `loaded` (none held before), `partial`
    (some held, the rest appended), `not_found` (fewer rows in the source by now than the snapshot asked for).
    """
    spec = CatchUpSpec(keys[0], keys[1:], multiset=True)
    short = cut_lineage(shortages(snapshot, target, spec).filter("need > have"))
    ranked = rank_in_group(source.join(short.select(*keys), list(keys), "left_semi"), list(keys), order, "_ordinal")
    late = cut_lineage(ranked.join(short, list(keys)).filter("_ordinal > have and _ordinal <= need"))
    rows = target.withColumn(ACTION, F.lit("kept")).unionByName(late.select(*target.columns).withColumn(ACTION, F.lit("appended")))
    written = late.groupBy(*keys).agg(F.count(F.lit(1)).alias("written_rows"))
    plan = short.join(written, list(keys), "left").withColumn("written_rows", F.coalesce("written_rows", F.lit(0)))
    missing = F.col("need") - F.col("have")
    action = F.when(F.col("written_rows") < missing, "not_found").when(F.col("have") > 0, "partial").otherwise("loaded")
    return rows, plan.select(*keys, missing.alias("missing_rows"), F.col("have").alias("held_rows"), "written_rows", action.alias("action"))
