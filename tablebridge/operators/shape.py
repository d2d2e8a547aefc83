"""Shaping whole tables: value maps, flags from other tables, target schemas."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge.functions.clean import (
    be_to_timestamp,
    guard_uuid,
    null_if_blank,
    parse_iso_date,
    to_bool,
    to_int_strict,
    to_real_lenient,
)
from tablebridge.operators.skew import left_lookup
from tablebridge.session import cut_lineage


def dictionary_remap(
    df: DataFrame, column: str, mapping: DataFrame, on_miss: str = "null", fold: bool = False
) -> DataFrame:
    """Replace codes through a table (old_value, new_value); `on_miss` is null, keep or upper.

    The table is reduced to a row per code and written first: a few codes with a known size are broadcast, instead of
    shuffling all rows by a key of a few values.
    """
    text = null_if_blank(F.col(column))
    key = F.lower(text) if fold else text
    table_key = F.lower("old_value") if fold else F.col("old_value")
    table = cut_lineage(mapping.groupBy(table_key.alias("_code")).agg(F.min("new_value").alias("_mapped")))
    miss = {"null": F.lit(None).cast("string"), "keep": text, "upper": F.upper(text)}[on_miss]
    return (
        left_lookup(df.withColumn("_code", key), table, ["_code"], sparse=True)
        .withColumn(column, F.coalesce("_mapped", miss))
        .drop("_code", "_mapped")
    )


def signed_state(
    df: DataFrame, signed: DataFrame, key: str, signed_key: str, yes: str, no: str | None, out: str = "state"
) -> DataFrame:
    """State from membership in the set of signed reports."""
    keys = signed.select(F.col(signed_key).alias(key)).filter(F.col(key).isNotNull()).distinct()
    # A lookup straight from an aggregate could not be split by the adaptive skew join.
    flagged = left_lookup(df, keys.withColumn("_signed", F.lit(True)), [key], sparse=True)
    return flagged.withColumn(out, F.when(F.col("_signed"), yes).otherwise(F.lit(no))).drop("_signed")


def cast_guarded(c: Column, data_type: T.DataType, max_len: int | None = None, era_threshold: int = 2400) -> Column:
    """Text as a target type; what does not fit becomes null, too long text is cut."""
    if isinstance(data_type, T.StringType):
        text = null_if_blank(c)
        return F.substring(text, 1, max_len) if max_len else text
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return to_int_strict(c).try_cast(data_type)
    if isinstance(data_type, T.DecimalType):
        return to_real_lenient(c, money=True).try_cast(data_type)
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return to_real_lenient(c).cast(data_type)
    if isinstance(data_type, T.BooleanType):
        return to_bool(c, "sql")
    if isinstance(data_type, T.DateType):
        return parse_iso_date(c)
    if isinstance(data_type, T.TimestampNTZType):
        return be_to_timestamp(c, era_threshold)
    raise TypeError(f"no guarded cast to {data_type.simpleString()}")


def align_to_schema(
    df: DataFrame,
    target: T.StructType,
    computed: Mapping[str, Column] | None = None,
    sources: Mapping[str, str] | None = None,
    era_threshold: int = 2400,
) -> DataFrame:
    """Shape a text table like a target schema.

    Each target column takes its computed expression, else its (possibly renamed) source column
    cast by the target type, else null. Field metadata: `max_len` cuts text, `format` = uuid guards
    it, `not_null_default` replaces null.
    """
    computed, sources = computed or {}, sources or {}
    present = {c.lower(): c for c in df.columns}
    columns = []
    for field in target.fields:
        source = present.get(sources.get(field.name, field.name).lower())
        if field.name in computed:
            value = computed[field.name].try_cast(field.dataType)
        elif source is None:
            value = F.lit(None).cast(field.dataType)
        elif field.metadata.get("format") == "uuid":
            value = guard_uuid(F.col(source))
        else:
            value = cast_guarded(F.col(source), field.dataType, field.metadata.get("max_len"), era_threshold)
        if "not_null_default" in field.metadata:
            value = F.coalesce(value, F.lit(field.metadata["not_null_default"]))
        columns.append(value.alias(field.name))
    return df.select(*columns)
