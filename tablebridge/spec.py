"""What a table load is made of. Specs hold names and rules only; they never touch data."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

from tablebridge.functions.clean import null_if_blank
from tablebridge.operators.resolve import ParentTemplate


@dataclass(frozen=True)
class FieldSpec:
    """One target column: its staging column, how it is cleansed, and the reason if text is lost."""

    name: str
    source: str
    clean: Callable[[Column], Column] = null_if_blank
    reason: str | None = None
    required: bool = False


@dataclass(frozen=True)
class RelationSpec:
    """A reference column: the legacy key in staging and the parent it resolves in.

    With `placeholder` (a predicate over the parent) the preferred lookup over several parent keys
    is used, else the lowest id of the first key. With `ensure`, parents that staging rows ask for
    and that do not exist are made by that template before rows are resolved.
    """

    name: str
    source: str
    parent: DataFrame
    parent_keys: Sequence[str]
    id_col: str = "id"
    placeholder: Callable[[], Column] | None = None
    sentinels: Sequence[str] = ()
    ensure: ParentTemplate | None = None


@dataclass(frozen=True)
class TableSpec:
    """A table load: keys (after cleansing), order for duplicates, fields, relations, write mode."""

    name: str
    record_id: str
    keys: Sequence[str]
    order: Sequence[str]
    fields: Sequence[FieldSpec]
    relations: Sequence[RelationSpec] = ()
    mode: str = "if_changed"
    id_col: str | None = "id"
    policies: Mapping[str, Callable[[Column, Column], Column]] = field(default_factory=dict)
    keep: Sequence[str] = ()
    transform: Callable[[DataFrame], DataFrame] | None = None
    post_load: Callable[[DataFrame], DataFrame] | None = None
