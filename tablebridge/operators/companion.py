"""Companion rows: one per parent, each pointing at the other."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebridge.operators.ids import assign_ids
from tablebridge.operators.merge import ACTION
from tablebridge.operators.skew import left_lookup
from tablebridge.session import cut_lineage


@dataclass(frozen=True)
class CompanionSpec:
    """Names and rules. `link` is the parent's column, `back` the companion's.

    `dates` gives the candidates for the companion's date over the parent's columns, by origin, the first known one
    holds. `place` is the location over the parent's columns; one that its master lacks becomes null and an issue.
    `values` are further columns of a new companion.
    """

    parent_id: str
    link: str
    companion_id: str
    back: str
    dates: Mapping[str, Column]
    place: Column
    date_column: str = "date_created"
    place_column: str = "location"
    values: Mapping[str, Column] = field(default_factory=dict)


class Companions:
    """Companions of parents, on demand: `parent_rows`, `companion_rows` (with the action and the date's origin), `issues`.

    - A parent with a link keeps it; the companion points back at it, at the lowest parent if several share it.
    - A parent without a link takes the companion that points at it and that no parent links to: a run that was lost
      between its writes leaves such a one, so a rerun makes none twice. Else a companion is made.
    - A companion without a date gets its parent's; a date in place stays.
    - Companions of nobody stay as they are.

    Parents without an id take no part and stay as they are.
    """

    def __init__(self, parents: DataFrame, companions: DataFrame, places: DataFrame, place_id: str, spec: CompanionSpec) -> None:
        self.parents, self.companions, self.places, self.place_id, self.spec = parents, companions, places, place_id, spec

    @cached_property
    def _asked(self) -> DataFrame:
        """A row per parent: its companion if it has one, and what a new one would hold."""
        s = self.spec
        origin = F.coalesce(*[F.when(c.isNotNull(), name) for name, c in s.dates.items()])
        asked = self.parents.filter(F.col(s.parent_id).isNotNull()).select(
            F.col(s.parent_id).alias("_parent"), F.col(s.link).alias("_link"), F.coalesce(*s.dates.values()).alias("_date"),
            origin.alias("_origin"), s.place.alias("_place"), *[c.alias(f"_v_{n}") for n, c in s.values.items()],
        )
        linked = self.parents.select(F.col(s.link).alias(s.companion_id)).filter(F.col(s.companion_id).isNotNull())
        free = self.companions.filter(F.col(s.back).isNotNull()).join(linked, s.companion_id, "left_anti")
        pointing = free.groupBy(F.col(s.back).alias("_parent")).agg(F.min(s.companion_id).alias("_free"))
        found = left_lookup(asked, pointing, ["_parent"])
        return cut_lineage(found.withColumn("_link", F.coalesce("_link", "_free")).drop("_free"))

    @cached_property
    def _made(self) -> DataFrame:
        known = self.places.select(F.col(self.place_id).alias("_place")).distinct().withColumn("_known", F.lit(True))
        placed = left_lookup(self._asked.filter("_link is null"), known, ["_place"], sparse=True)
        return assign_ids(placed, [F.col("_parent")], self.companions, self.spec.companion_id)

    @cached_property
    def made(self) -> DataFrame:
        s = self.spec
        place = F.when(F.col("_known"), F.col("_place"))
        return self._made.select(
            s.companion_id, F.col("_parent").alias(s.back), F.col("_date").alias(s.date_column), place.alias(s.place_column),
            *[F.col(f"_v_{n}").alias(n) for n in s.values], F.col("_origin").alias("date_origin"),
        )

    @cached_property
    def companion_rows(self) -> DataFrame:
        s = self.spec
        owners = self._asked.filter("_link is not null").groupBy(F.col("_link").alias(s.companion_id)).agg(
            F.min(F.struct("_parent", "_date", "_origin")).alias("_owner")
        )
        owner = F.col("_owner._parent")
        moved = owner.isNotNull() & ~F.col(s.back).eqNullSafe(owner)
        dated = F.col(s.date_column).isNull() & F.col("_owner._date").isNotNull()
        changed = {
            s.back: F.coalesce(owner, F.col(s.back)),
            s.date_column: F.coalesce(F.col(s.date_column), F.col("_owner._date")),
        }
        old = left_lookup(self.companions, owners, [s.companion_id]).select(
            *[changed.get(c, F.col(c)).alias(c) for c in self.companions.columns], F.when(dated, F.col("_owner._origin")).alias("date_origin"),
            F.when(moved, "relinked").when(dated, "dated").otherwise("kept").alias(ACTION),
        )
        return old.unionByName(self.made.withColumn(ACTION, F.lit("made")), allowMissingColumns=True)

    @cached_property
    def parent_rows(self) -> DataFrame:
        s = self.spec
        links = self._asked.filter("_link is not null").select(F.col("_parent").alias(s.parent_id), F.col("_link").alias("_to")).unionByName(
            self.made.select(F.col(s.back).alias(s.parent_id), F.col(s.companion_id).alias("_to"))
        )
        out = left_lookup(self.parents, links, [s.parent_id])
        return out.select(*[F.coalesce("_to", c).alias(c) if c == s.link else F.col(c) for c in self.parents.columns])

    @cached_property
    def issues(self) -> DataFrame:
        lost = self._made.filter("_place is not null and _known is null")
        return lost.select(
            F.col("_parent").cast("string").alias("record_id"), F.lit(self.spec.place_column).alias("field"),
            F.lit(f"{self.spec.place_column}_not_resolved").alias("reason"), F.col("_place").cast("string").alias("source_raw"),
        )
