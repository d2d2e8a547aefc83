"""Nested documents from parents and children."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablebridge.operators.merge_flags import changed
from tablebridge.operators.skew import left_lookup, rank_in_group
from tablebridge.session import cut_lineage

# Elements per array. A group above it continues in further parts, so no row grows without bound.
MAX_ITEMS = 10_000


def group_to_struct_array(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    fields: Sequence[str],
    out: str = "items",
    max_items: int = MAX_ITEMS,
) -> DataFrame:
    """Ordered array of structs per key, numbered parts of at most `max_items` elements."""
    ranked = rank_in_group(df, keys, order, "_rank")
    part = F.floor((F.col("_rank") - 1) / max_items).cast("int")
    gathered = ranked.withColumn("part", part).groupBy(*keys, "part").agg(
        F.sort_array(F.collect_list(F.struct("_rank", *fields))).alias("_list")
    )
    return gathered.select(
        *keys,
        "part",
        F.transform("_list", lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias(out),
    )


@dataclass(frozen=True)
class ChildCollection:
    """A child table of a document: where it hangs, its order and the fields it shows."""

    name: str
    rows: DataFrame
    fk: str
    order: Sequence[str]
    fields: Sequence[str]

    def of(self, parents: DataFrame) -> DataFrame:
        """The children of some parents (a column named like `fk`), with the columns a document needs."""
        needed = dict.fromkeys([self.fk, *self.order, *self.fields])
        return self.rows.select(*needed).join(parents, self.fk, "left_semi")

    def parts(self, parents: DataFrame, max_items: int) -> DataFrame:
        """(fk, part, the array of the children) of some parents."""
        return group_to_struct_array(
            self.of(parents), [self.fk], [F.col(c) for c in self.order], self.fields, self.name, max_items
        )


@dataclass(frozen=True)
class NestedCollection(ChildCollection):
    """A collection whose elements, known by the unique column `key`, hold a collection of their own.

    Both levels are cut by one ordering of the innermost rows, in which an element without any counts as one. So a part
    holds at most `max_items` of these over all of its elements together, an element whose rows continue in the next part
    is there again with the rest of them, and no row grows with a parent or with an element. Rows without a key take no part.
    """

    key: str = "id"
    inner: ChildCollection | None = None

    def of(self, parents: DataFrame) -> DataFrame:
        needed = dict.fromkeys([self.fk, self.key, *self.order, *self.fields])
        return self.rows.select(*needed).filter(F.col(self.key).isNotNull()).join(parents, self.fk, "left_semi")

    def parts(self, parents: DataFrame, max_items: int) -> DataFrame:
        outer = self.of(parents)
        below = self.inner.of(outer.select(F.col(self.key).alias(self.inner.fk)))
        leaves = below.select(
            F.col(self.inner.fk).alias(self.key), F.struct(*self.inner.order).alias("_order"), F.struct(*self.inner.fields).alias("_leaf")
        )
        # Either side of an inner join may be split if an element has very many rows, unlike those of an outer join.
        held, bare = outer.join(leaves, self.key), outer.join(leaves.select(self.key), self.key, "left_anti")
        every = held.unionByName(bare, allowMissingColumns=True)
        ranked = rank_in_group(every, [self.fk], [*[F.col(c) for c in self.order], F.col(self.key), F.col("_order")], "_rank")
        rows = ranked.withColumn("part", F.floor((F.col("_rank") - 1) / max_items).cast("int"))
        element = {f"_e_{f}": F.col(f) for f in self.fields}
        per_element = rows.groupBy(self.fk, "part", self.key).agg(
            F.min("_rank").alias("_at"), *[F.first(c).alias(n) for n, c in element.items()],
            F.sort_array(F.collect_list(F.when(F.col("_leaf").isNotNull(), F.struct("_rank", "_leaf")))).alias("_leaves"),
        )
        inner = F.transform("_leaves", lambda x: x["_leaf"]).alias(self.inner.name)
        fields = [F.col(n).alias(n[3:]) for n in element]
        gathered = per_element.groupBy(self.fk, "part").agg(F.sort_array(F.collect_list(F.struct("_at", F.struct(*fields, inner).alias("_element")))).alias("_list"))
        return gathered.select(self.fk, "part", F.transform("_list", lambda x: x["_element"]).alias(self.name))


def nest_child(parent_rows: DataFrame, parent_key: str, child: ChildCollection) -> DataFrame:
    """Parent rows with their children as JSON text (for a collection inside a collection)."""
    lists = group_to_struct_array(
        child.of(parent_rows.select(F.col(parent_key).alias(child.fk))), [child.fk],
        [F.col(c) for c in child.order], child.fields, child.name,
    )
    texts = lists.select(F.col(child.fk).alias(parent_key), "part", child.name)
    return parent_rows.join(texts, parent_key, "left")


def build_snapshot_doc(
    parent: DataFrame,
    key: str,
    children: Sequence[ChildCollection],
    fields: Sequence[str],
    eligible: Column | None = None,
    max_items: int = MAX_ITEMS,
) -> DataFrame:
    """One JSON document per parent: its fields and one array per child table.

    Children of the chosen parents are aggregated on their own before they meet the parent. A parent whose children
    exceed `max_items` gets further numbered parts instead of a cut or an endless row. Parents may come from a long plan,
    which every collection would run again, so they are written once.
    """
    chosen = parent if eligible is None else parent.filter(eligible)
    doc = cut_lineage(chosen.select(F.col(key).alias("_doc"), F.struct(*fields).alias("_head")))
    lists = []
    for child in children:
        grouped = child.parts(doc.select(F.col("_doc").alias(child.fk)), max_items)
        lists.append(grouped.withColumnRenamed(child.fk, "_doc"))
    kids = lists[0]
    for grouped in lists[1:]:
        kids = kids.join(grouped, ["_doc", "part"], "full_outer")
    # Children that exist fill part 0 first, so a parent without any is the only one to lack it.
    out = doc.join(kids, "_doc", "left").withColumn("part", F.coalesce("part", F.lit(0)))
    arrays = []
    for child, grouped in zip(children, lists, strict=True):
        empty = F.array().cast(grouped.schema[child.name].dataType)
        arrays.append(F.coalesce(F.col(child.name), empty).alias(child.name))
    body = F.struct(*[F.col(f"_head.{f}").alias(f) for f in fields], *arrays)
    return out.select(F.col("_doc").alias(key), "part", F.to_json(body).alias("document"))


def max_per_column(
    probes: DataFrame, history: DataFrame, party: str, day: str, history_ts: str, columns: Sequence[str]
) -> DataFrame:
    """Per probe (party, day): the highest value of each column up to the end of that day.

    History is reduced to one row per party and day first; the running maximum then covers days.
    """
    daily = (
        history.filter(F.col(party).isNotNull() & F.col(history_ts).isNotNull())
        .groupBy(F.col(party).alias("_party"), F.to_date(history_ts).alias("_day"))
        .agg(*[F.max(c).alias(c) for c in columns])
    )
    asked = probes.select(F.col(party).alias("_party"), F.col(day).cast("date").alias("_day")).filter(
        "_party is not null and _day is not null"
    ).distinct()
    upto = W.partitionBy("_party").orderBy("_day").rowsBetween(W.unboundedPreceding, 0)
    line = asked.join(daily, ["_party", "_day"], "full_outer").select(
        "_party", "_day", *[F.max(c).over(upto).alias(c) for c in columns]
    )
    marked = probes.withColumn("_party", F.col(party)).withColumn("_day", F.col(day).cast("date"))
    return left_lookup(marked, line, ["_party", "_day"], sparse=True).drop("_party", "_day")


def be_date_text(c: Column) -> Column:
    """dd/MM/yyyy in the Buddhist era."""
    return F.concat(F.date_format(c, "dd/MM/"), (F.year(c) + 543).cast("string"))


def history_lines(lines: Sequence[tuple[str, Column]], sep: str = "\n") -> Column:
    """Ordered text lines `label date` for the dates that are set."""
    parts = [F.when(c.isNotNull(), F.concat(F.lit(label + " "), be_date_text(c))) for label, c in lines]
    return F.array_join(F.filter(F.array(*parts), lambda x: x.isNotNull()), sep)


def eligible_targets(
    parent: DataFrame, key: str, reports: Sequence[tuple[DataFrame, str]], general: DataFrame,
    general_fk: str, general_id: str, history: DataFrame, history_fk: str,
) -> DataFrame:
    """Per parent: has a report, lowest general row, and whether one of those has a history."""
    ids = None
    for rows, fk in reports:
        part = rows.select(F.col(fk).alias(key)).filter(F.col(key).isNotNull())
        ids = part if ids is None else ids.unionByName(part)
    reported = ids.distinct().withColumn("_report", F.lit(True))
    kept = history.select(F.col(history_fk).alias(general_id)).distinct().withColumn("_kept", F.lit(True))
    rows = general.filter(F.col(general_fk).isNotNull()).select(F.col(general_fk).alias(key), general_id)
    per_parent = left_lookup(rows, kept, [general_id], sparse=True).groupBy(key).agg(
        F.min(general_id).alias("general_id"), F.max("_kept").alias("_kept")
    )
    flagged = left_lookup(left_lookup(parent, reported, [key]), per_parent, [key])
    has_report = F.coalesce("_report", F.lit(False))
    has_history = F.coalesce("_kept", F.lit(False))
    return flagged.select(
        key,
        has_report.alias("has_report"),
        "general_id",
        has_history.alias("has_history"),
        (has_report & F.col("general_id").isNotNull() & ~has_history).alias("is_target"),
    )


def signed_at(*times: Column, fallback: Column) -> Column:
    """The latest known time, else the fallback."""
    latest = F.greatest(*times) if len(times) > 1 else times[0]
    return F.coalesce(latest, fallback)


def denormalise_to_parent(
    parent: DataFrame, picked: str, payload: DataFrame, payload_key: str, columns: Sequence[str], part: str | None = None
) -> DataFrame:
    """Copy payload columns of the picked row to the parent and mark the rows that change.

    The payload is one row per key, built once however many parents pick it. With `part` it is one
    row per key and part, and so is the result; a parent that picks nothing has part 0.
    """
    number = [F.col(part)] if part else []
    looked = payload.select(F.col(payload_key).alias(picked), *[F.col(c).alias(f"_p_{c}") for c in columns], *number)
    joined = left_lookup(parent, looked.withColumn("_hit", F.lit(True)), [picked], sparse=True)
    hit = F.coalesce("_hit", F.lit(False))
    differs = changed([F.col(c) for c in columns], [F.col(f"_p_{c}") for c in columns])
    out = joined.withColumn("is_updated", hit & differs)
    for c in columns:
        out = out.withColumn(c, F.when(hit, F.col(f"_p_{c}")).otherwise(F.col(c)))
    return out.select(*parent.columns, *[F.coalesce(c, F.lit(0)).alias(part) for c in number], "is_updated")


def nested_sample(
    parent: DataFrame, key: str, ids: DataFrame, children: Sequence[ChildCollection], fields: Sequence[str]
) -> DataFrame:
    """Documents of the listed parents only."""
    wanted = ids.select(key).distinct()
    fewer = [
        ChildCollection(
            c.name, c.rows.join(wanted.withColumnRenamed(key, c.fk), c.fk, "left_semi"), c.fk, c.order, c.fields
        )
        for c in children
    ]
    return build_snapshot_doc(parent.join(wanted, key, "left_semi"), key, fewer, fields)


def top_n_history(
    probes: DataFrame, history: DataFrame, party: str, day: str, history_ts: str, history_id: str,
    n: int, has_value: Callable[[Column], Column], fields: Sequence[str],
) -> DataFrame:
    """Of the newest `n` history rows up to the end of the probe's day: the newest one with a
    value, else the newest.

    Each party and day first keeps its newest `n` rows; the ranking window stops at `n`, so Spark
    limits groups before the shuffle. The frame then spans `n` rows.
    """
    newest = [F.col("_ts").desc(), F.col("_id").desc()]
    rows = history.filter(F.col(party).isNotNull() & F.col(history_ts).isNotNull()).select(
        F.col(party).alias("_party"), F.to_date(history_ts).alias("_day"),
        F.col(history_ts).alias("_ts"), F.col(history_id).alias("_id"), F.struct(*fields).alias("_row"),
    )
    rank = F.row_number().over(W.partitionBy("_party", "_day").orderBy(*newest))
    kept = rows.withColumn("_rank", rank).filter(F.col("_rank") <= n)
    frame = W.partitionBy("_party").orderBy("_ts", "_id").rowsBetween(-(n - 1), 0)
    seen = kept.withColumn("_seen", F.reverse(F.collect_list("_row").over(frame)))
    daily = seen.filter("_rank = 1").select("_party", "_day", "_seen")
    asked = probes.select(F.col(party).alias("_party"), F.col(day).cast("date").alias("_day")).filter(
        "_party is not null and _day is not null"
    ).distinct()
    upto = W.partitionBy("_party").orderBy("_day").rowsBetween(W.unboundedPreceding, 0)
    line = asked.join(daily, ["_party", "_day"], "full_outer").select(
        "_party", "_day", F.last("_seen", ignorenulls=True).over(upto).alias("_seen")
    )
    marked = probes.withColumn("_party", F.col(party)).withColumn("_day", F.col(day).cast("date"))
    found = left_lookup(marked, line, ["_party", "_day"], sparse=True)
    chosen = F.coalesce(F.get(F.filter("_seen", has_value), F.lit(0)), F.get("_seen", F.lit(0)))
    return found.withColumn("_pick", chosen).select(
        *probes.columns, *[F.col(f"_pick.{f}").alias(f"history_{f}") for f in fields]
    )
