"""Readers of JSON whose values are not always of the kind that they should be, by Spark's variant type.

``v`` is a variant column from ``as_object``, ``path`` a JSON path such as ``$.scores.depth``.
A value of another kind is NULL or the default, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_object(raw: Column) -> Column:
    """A variant from the text of a JSON object; NULL for anything else."""
    v = F.try_parse_json(raw)
    return F.when(F.schema_of_variant(v).startswith("OBJECT"), v)


def value(v: Column, path: str) -> Column:
    """What stands there as a variant; NULL if nothing or a JSON null does."""
    out = F.try_variant_get(v, path, "variant")
    return F.when(~F.is_variant_null(out), out)


def kind(v: Column, path: str) -> Column:
    """STRING, BIGINT, DOUBLE, BOOLEAN, ARRAY, OBJECT and so on; NULL if there is nothing."""
    return F.regexp_extract(F.schema_of_variant(value(v, path)), r"^\w+", 0)


def as_text(v: Column, path: str, default: str | None = None) -> Column:
    """A string, or a scalar as one; the default for NULL, and instead of the empty string."""
    out = F.nullif(F.try_variant_get(v, path, "string"), F.lit(""))
    return F.coalesce(out, F.lit(default)) if default is not None else out


def as_int(v: Column, path: str, default: int | None = None) -> Column:
    """A whole number, cut towards zero; numbers in quotes count, with no fraction."""
    said = F.try_variant_get(v, path, "string")
    number = F.when(kind(v, path) == "STRING", F.trim(said).try_cast("bigint")).when(~kind(v, path).isin("ARRAY", "OBJECT"), F.try_variant_get(v, path, "bigint"))
    return F.coalesce(number, F.lit(default).cast("bigint")) if default is not None else number


def as_float(v: Column, path: str) -> Column:
    said = F.try_variant_get(v, path, "string")
    return F.when(kind(v, path) == "STRING", F.trim(said).try_cast("double")).otherwise(F.try_variant_get(v, path, "double"))


def as_flag(v: Column, path: str) -> Column:
    """Whether there is anything but false, zero, an empty string, list or object."""
    empty = F.to_json(value(v, path)).isin("false", '""', "[]", "{}")
    number = kind(v, path).isin("BIGINT", "DOUBLE", "DECIMAL")
    return F.coalesce(F.when(number, F.try_variant_get(v, path, "double") != 0).otherwise(~empty), F.lit(False))


def as_strings(v: Column, path: str) -> Column:
    """An array of strings without NULLs; a scalar is an array of one, NULL the empty array."""
    several = F.transform(F.try_variant_get(v, path, "array<variant>"), _said)
    one = F.array(_said(value(v, path)))
    return F.array_compact(F.when(kind(v, path) == "ARRAY", several).when(value(v, path).isNotNull(), one).otherwise(F.array().cast("array<string>")))


def _said(x: Column) -> Column:
    scalar = ~F.coalesce(F.schema_of_variant(x).rlike("^(ARRAY|OBJECT)"), F.lit(False))
    return F.when(scalar, F.try_variant_get(x, "$", "string")).otherwise(F.to_json(x))


def as_vector(v: Column, path: str) -> Column:
    """An array of doubles; NULL unless it is a list of nothing but numbers."""
    items = F.try_variant_get(v, path, "array<variant>")
    numbers = F.transform(items, lambda x: F.try_variant_get(x, "$", "double"))
    plain = F.forall(items, lambda x: F.coalesce(F.schema_of_variant(x).rlike("^(BIGINT|DOUBLE|DECIMAL)"), F.lit(False)))
    return F.when((kind(v, path) == "ARRAY") & plain, numbers)


def as_json_list(v: Column, path: str) -> Column:
    """The list as JSON, ``[]`` for what is empty."""
    return F.when(as_flag(v, path), F.to_json(value(v, path))).otherwise("[]")


def sorted_json(v: Column) -> Column:
    """The JSON text with the keys of all objects, nested ones too, in order: variants keep them so."""
    return F.to_json(v)
