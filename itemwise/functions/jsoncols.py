"""JSON text columns parsed with ``from_json``, one parse for each value.

Without options Catalyst splits a struct read into one parse for each field;
naming the (default) mode keeps the struct whole, so its fields share it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemwise.operators.columns import col

# The 13 keys of the item description object.
LLM_KEYS = [
    "category_first", "category_second", "brand_real", "brand_quality",
    "audience", "subj_scenario", "obj_scenario", "time_scenario",
    "dep_scenario", "feature", "category", "scenario", "brand",
]

# The 11 fields of a category statistics object and their types.
STAT_FIELDS = [
    ("raw_max", "double"), ("raw_min", "double"), ("raw_count", "bigint"),
    ("max_", "double"), ("mean_", "double"), ("mid_", "double"),
    ("min_", "double"), ("count_", "bigint"), ("group_by", "string"),
    ("unit", "string"), ("update_time", "string"),
]

_CORRUPT = "__corrupt"
SHARED = {"mode": "PERMISSIVE"}


def _string_struct(fields: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType()) for f in fields])


def parse_object(c: Column, fields: Sequence[str]) -> Column:
    """Parse a JSON object; every field is read as text.  Malformed text,
    non-objects and null all give a struct of nulls; a missing key gives a
    null field.  Numbers come back as their JSON text (``1`` -> ``'1'``)."""
    return F.from_json(c, _string_struct(fields), SHARED)


def extract_flat(df: DataFrame, column: str, keys: Sequence[str] = LLM_KEYS) -> DataFrame:
    """Append one text column per key of a flat JSON object column."""
    parsed = parse_object(col(column), keys)
    return df.select("*", *[parsed.getField(k).alias(k) for k in keys])


def extract_nested(df: DataFrame, column: str, outer_key: str,
                   fields: Sequence[tuple[str, str]] = STAT_FIELDS,
                   prefix: str | None = None) -> DataFrame:
    """Append ``<prefix>_<field>`` columns taken from ``{outer_key: {...}}``.

    Fields are read as text then cast with ``try_cast``, so a number written
    as a string still converts and a bad value becomes null instead of failing
    the row.  The outer key is case-sensitive; a missing one gives nulls.
    """
    prefix = prefix if prefix is not None else column
    names = [f for f, _ in fields]
    schema = T.StructType([T.StructField(outer_key, _string_struct(names))])
    inner = F.from_json(col(column), schema, SHARED).getField(outer_key)
    outs = []
    for f, typ in fields:
        v = inner.getField(f)
        outs.append((v if typ == "string" else v.try_cast(typ)).alias(f"{prefix}_{f}"))
    return df.select("*", *outs)


def corrupt_count(df: DataFrame, column: str, fields: Sequence[str] = ("_",)) -> DataFrame:
    """Number of non-null values that are not parsable JSON objects."""
    schema = _string_struct(list(fields) + [_CORRUPT])
    parsed = F.from_json(col(column), schema, {"columnNameOfCorruptRecord": _CORRUPT})
    return df.agg(F.count_if(parsed.getField(_CORRUPT).isNotNull()).alias("n_corrupt"),
                  F.count(col(column)).alias("n_values"))
