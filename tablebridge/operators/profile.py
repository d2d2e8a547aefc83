"""Counts and profiles of tables and loads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebridge.functions.clean import null_if_blank
from tablebridge.operators.document import MAX_ITEMS, group_to_struct_array
from tablebridge.operators.skew import left_lookup


def _count_if(condition: Column) -> Column:
    return F.count_if(condition).cast("bigint")


def child_count_summary(
    parent: DataFrame, key: str, children: Mapping[str, tuple[DataFrame, str]],
    labels: Mapping[str, tuple[str, str, str]],
) -> DataFrame:
    """Per parent and child table: code 1 none, 2 single, 3 multiple, its label, and the number
    as text when above one (else empty)."""
    out = parent
    for name, (rows, fk) in children.items():
        counts = rows.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias(key)).agg(F.count(F.lit(1)).alias("_n"))
        n = F.coalesce("_n", F.lit(0))
        none, single, multiple = labels[name]
        out = (
            left_lookup(out, counts, [key], sparse=True)
            .withColumn(name, F.when(n == 0, "1").when(n == 1, "2").otherwise("3"))
            .withColumn(f"{name}_des", F.when(n == 0, none).when(n == 1, single).otherwise(multiple))
            .withColumn(f"{name}_number", F.when(n > 1, n.cast("string")).otherwise(""))
            .drop("_n")
        )
    return out


def group_having_any(df: DataFrame, keys: Sequence[str], flag: Column, ts: str) -> DataFrame:
    """Groups with at least one flagged row: latest time and number of rows. Row ids of a group
    come from `group_to_struct_array`, whose arrays are bounded."""
    return (
        df.groupBy(*keys)
        .agg(F.max(ts).alias("latest"), F.count(F.lit(1)).alias("members"), F.bool_or(flag).alias("_any"))
        .filter("_any")
        .drop("_any")
    )


def group_ids_having_any(
    df: DataFrame, keys: Sequence[str], flag: Column, ts: str, id_col: str, max_items: int = MAX_ITEMS
) -> DataFrame:
    """Groups with at least one flagged row: per part their ordered ids, and in every part the latest time and the
    number of rows of the whole group. Groups with a null key count like others; rows without an id are counted, not listed.

    A group's rows are only ranked once it is known to be wanted, and are listed in parts of at most `max_items`.
    """
    wanted = df.groupBy(*keys).agg(
        F.max(ts).alias("latest"), F.count(F.lit(1)).alias("members"), F.bool_or(flag).alias("_any")
    ).filter("_any").drop("_any")
    renamed = wanted.select(*[F.col(k).alias(f"_w_{k}") for k in keys], "latest", "members")
    same = [F.col(k).eqNullSafe(F.col(f"_w_{k}")) for k in keys]
    rows = df.select(*dict.fromkeys([*keys, id_col])).filter(F.col(id_col).isNotNull()).join(renamed.select(*[f"_w_{k}" for k in keys]), same, "left_semi")
    lists = group_to_struct_array(rows, keys, [F.col(id_col)], [id_col], "_ids", max_items)
    parts = lists.select(*keys, "part", F.transform("_ids", lambda x: x[id_col]).alias("ids"))
    out = renamed.join(parts, same, "left")
    empty = F.array().cast(parts.schema["ids"].dataType)
    return out.select(
        *[F.col(f"_w_{k}").alias(k) for k in keys], F.coalesce("part", F.lit(0)).alias("part"), F.coalesce("ids", empty).alias("ids"), "latest", "members"
    )


def filtered_counts(df: DataFrame, conditions: Mapping[str, Column], distinct: Mapping[str, str] | None = None) -> DataFrame:
    aggregates = [_count_if(c).alias(n) for n, c in conditions.items()]
    aggregates += [F.count_distinct(c).alias(n) for n, c in (distinct or {}).items()]
    return df.agg(F.count(F.lit(1)).alias("total"), *aggregates)


def resolution_rate(df: DataFrame, relations: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Per relation: rows with a legacy key and rows whose reference is resolved."""
    pairs = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("relation"),
                    null_if_blank(F.col(key)).isNotNull().alias("_asked"),
                    F.col(fk).isNotNull().alias("_found"),
                )
                for name, (key, fk) in relations.items()
            ]
        )
    )
    return df.select(pairs.alias("r")).groupBy("r.relation").agg(
        _count_if(F.col("r._asked")).alias("with_key"),
        _count_if(F.col("r._asked") & F.col("r._found")).alias("resolved"),
    )


def issue_summary(issues: DataFrame) -> DataFrame:
    return issues.groupBy("field", "reason").agg(F.count(F.lit(1)).alias("issues"))


def value_profile(df: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """Long form of (value, price) column pairs: rows and price range per column and value."""
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(v).alias("column_name"),
                    null_if_blank(F.col(v).cast("string")).alias("value"),
                    F.col(p).cast("double").alias("price"),
                )
                for v, p in pairs.items()
            ]
        )
    )
    return df.select(rows.alias("r")).groupBy("r.column_name", "r.value").agg(
        F.count(F.lit(1)).alias("n"), F.min("r.price").alias("min_price"), F.max("r.price").alias("max_price")
    )


def group_compare_profile(df: DataFrame, keys: Sequence[str], a: str, b: str) -> DataFrame:
    """Per group, how column a relates to column b."""
    x, y = F.col(a), F.col(b)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        _count_if(x.isNull()).alias("a_null"),
        _count_if(x == y).alias("a_eq_b"),
        _count_if(x < y).alias("a_lt_b"),
        _count_if(x > y).alias("a_gt_b"),
        _count_if(x == 0).alias("a_zero"),
        F.avg(x).alias("avg_a"),
        F.avg(y).alias("avg_b"),
    )


def sum_check(head: DataFrame, key: str, total: str, lines: DataFrame, fk: str, amount: Column, n: int) -> DataFrame:
    """Heads whose lines do not add up to the total, the `n` largest gaps first."""
    sums = lines.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias(key)).agg(
        F.sum(amount.cast("decimal(19,4)")).alias("line_sum")
    )
    checked = head.select(key, F.col(total).cast("decimal(19,4)").alias("head_total")).join(sums, key)
    gap = (F.col("line_sum") - F.col("head_total")).alias("gap")
    return checked.select("*", gap).filter("gap <> 0").orderBy(F.abs("gap").desc(), F.col(key)).limit(n)


def code_label_freq(df: DataFrame, code: str, label: str) -> DataFrame:
    return df.groupBy(F.col(code).cast("string").alias("code"), F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )


def code_child_mismatch(
    parent: DataFrame, key: str, code: Column, child: DataFrame, fk: str
) -> DataFrame:
    """How a stored none/single/multiple code fits the child rows, and orphans on both sides."""
    counts = child.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias(key)).agg(F.count(F.lit(1)).alias("_n"))
    both = parent.select(key, code.alias("_code")).join(counts, key, "full_outer")
    n = F.coalesce("_n", F.lit(0))
    fits = F.when(n == 0, "1").when(n == 1, "2").otherwise("3") == F.col("_code")
    case = (
        F.when(F.col("_code").isNull(), "children_without_parent")
        .when(fits, "code_fits")
        .when(n == 0, "code_without_children")
        .otherwise("code_differs")
    )
    return both.groupBy(case.alias("finding")).agg(F.count(F.lit(1)).alias("n"))


def load_outcome(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct source keys, those found in the target, those not found, and the lowest such key."""
    wanted = source.select(*keys).filter(F.col(keys[0]).isNotNull()).distinct()
    there = target.select(*keys).distinct().withColumn("_there", F.lit(True))
    missing = F.col("_there").isNull()
    return wanted.join(there, list(keys), "left").agg(
        F.count(F.lit(1)).alias("source_keys"),
        _count_if(~missing).alias("matched"),
        _count_if(missing).alias("failed"),
        F.min(F.when(missing, F.col(keys[0]))).alias("first_failed"),
    )


def category_counter(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col(column))
