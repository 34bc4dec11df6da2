"""Helpers over VARIANT values parsed from raw JSON.

A key that is absent gives SQL NULL; a JSON ``null`` gives a non-NULL variant
for which ``is_variant_null`` is true.  The reference distinguishes the two
(``dict.get`` default versus an explicit ``None``), so the helpers here keep
that distinction explicit.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse(text: Column) -> Column:
    """Raw JSON text → VARIANT (NULL for malformed text, including duplicate keys)."""
    return F.try_parse_json(text)


def field(v: Column, path: str) -> Column:
    """Sub-variant at ``path`` ($.a.b); SQL NULL when any key on the way is missing."""
    return F.try_variant_get(v, path, "variant")


def missing(v: Column) -> Column:
    return v.isNull()


def json_null(v: Column) -> Column:
    return v.isNotNull() & F.is_variant_null(v)


def present(v: Column) -> Column:
    """Key present with a non-null value."""
    return v.isNotNull() & ~F.is_variant_null(v)


def as_array(v: Column) -> Column:
    """array<variant> when ``v`` is a JSON array, else NULL."""
    return F.try_variant_get(v, "$", "array<variant>")


def as_object(v: Column) -> Column:
    """map<string,variant> when ``v`` is a JSON object, else NULL."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def is_array(v: Column) -> Column:
    return as_array(v).isNotNull()


def is_object(v: Column) -> Column:
    # Casting to an empty struct succeeds for any object and copies nothing.
    return F.try_variant_get(v, "$", "struct<>").isNotNull()


def scalar_kind(v: Column) -> Column:
    """Type name of a scalar variant: STRING, BIGINT, DOUBLE, DECIMAL(p,s), BOOLEAN, VOID."""
    return F.schema_of_variant(v)


def is_string(v: Column) -> Column:
    return scalar_kind(v) == F.lit("STRING")


def is_number(v: Column) -> Column:
    k = scalar_kind(v)
    return (k.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")
            | k.startswith("DECIMAL") | (k == F.lit("BOOLEAN")))


def as_string(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def as_double(v: Column) -> Column:
    return F.try_variant_get(v, "$", "double")


def as_long(v: Column) -> Column:
    """Integer value the way ``int(x)`` reads it: numbers truncate, integral text parses."""
    return F.try_variant_get(v, "$", "bigint")


def py_truthy(v: Column) -> Column:
    """Python truthiness of a JSON value (missing and null are false)."""
    arr = as_array(v)
    kind = scalar_kind(v)
    return (F.when(v.isNull() | F.is_variant_null(v), F.lit(False))
            .when(arr.isNotNull(), F.size(arr) > 0)
            .when(is_object(v), F.size(as_object(v)) > 0)
            .when(kind == "STRING", F.length(as_string(v)) > 0)
            .otherwise(F.coalesce(as_double(v) != 0, F.lit(False))))
