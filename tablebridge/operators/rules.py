"""Rules that fill empty columns, in the order in which they need each other."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebridge.functions.clean import strip


@dataclass(frozen=True)
class Rule:
    """How an empty `column` is filled: the columns that `value` reads, and texts that count as empty besides blank ones."""

    column: str
    value: Column
    reads: Sequence[str] = ()
    empty: Sequence[str] = ()


def in_levels(rules: Sequence[Rule]) -> list[list[Rule]]:
    """Rules by level: each reads only what earlier levels have filled. A cycle, or two rules for a column, is an error."""
    by_column = {r.column: r for r in rules}
    if len(by_column) < len(rules):
        raise ValueError("a column has two rules")
    sorter = TopologicalSorter({r.column: {c for c in r.reads if c in by_column and c != r.column} for r in rules})
    try:
        sorter.prepare()
    except CycleError as e:
        raise ValueError(f"rules read each other: {' -> '.join(e.args[1])}") from e
    levels = []
    while sorter.is_active():
        ready = sorter.get_ready()
        levels.append([by_column[c] for c in sorted(ready)])
        sorter.done(*ready)
    return levels


def derive_by_rules(df: DataFrame, rules: Sequence[Rule], where: Column | None = None) -> DataFrame:
    """Fill the empty columns of the rows `where` holds (all, if not given); a rule reads what other rules have filled.

    Rules for columns that the table lacks, or that read such columns, are left out: tables differ between releases.
    Values in place are never changed, except that text which counts as empty becomes the rule's value or null.
    All rules of a level are one projection, so the optimizer collapses the levels into one pass.
    """
    asked = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    usable = [r for r in rules if {r.column, *r.reads} <= set(df.columns)]
    for level in in_levels(usable):
        filled = {}
        for r in level:
            kind, held = df.schema[r.column].dataType, F.col(r.column)
            if kind.simpleString() == "string":
                held = F.when(~strip(held).isin("", *r.empty), held)
            filled[r.column] = F.when(asked, F.coalesce(held, r.value.cast(kind))).otherwise(F.col(r.column))
        df = df.withColumns(filled)
    return df
