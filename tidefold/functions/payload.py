"""Fields of change records, and the types of their values.

A record names its columns and values in parallel arrays without types.  A value is in one of three states that are
kept apart everywhere: a value, an explicit null, or absent (the column is not named).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PAYLOAD = "kind string, schema string, `table` string, columnnames array<string>, columnvalues array<string>, oldkeys struct<keynames:array<string>,keyvalues:array<string>>"

#: Source types and what they become here.
TYPES = {
    "bool": "boolean",
    "int2": "smallint",
    "int4": "int",
    "int8": "bigint",
    "float4": "float",
    "float8": "double",
    "numeric": "decimal(38,18)",
    "bytea": "binary",
    "date": "date",
    "timestamp": "timestamp_ntz",
    "timestamptz": "timestamp",
    "pg_lsn": "bigint",
}


def spark_type(source: str) -> str:
    """The Spark type of a source type; ``numeric(p,s)`` keeps its digits, unknown types stay text."""
    base, _, digits = source.strip().lower().partition("(")
    if source.endswith("[]"):
        return "array<string>"
    if base == "numeric" and digits:
        return f"decimal({digits}"
    return TYPES.get(base, "string")


def parsed(payload: Column) -> Column:
    return F.from_json(payload, PAYLOAD)


def zip_map(names: Column, values: Column) -> Column:
    """A map from names to values; explicit nulls stay."""
    return F.when(names.isNotNull() & values.isNotNull(), F.map_from_arrays(names, values))


def present(names: Column, column: str) -> Column:
    return F.coalesce(F.array_contains(names, column), F.lit(False))


def value_at(names: Column, values: Column, column: str, source_type: str = "text") -> Column:
    """The column's value in its type (null if explicit null or absent); a value that does not fit raises."""
    raw = F.when(present(names, column), F.element_at(values, F.array_position(names, F.lit(column)).cast("int")))
    return cast_text(raw, source_type)


def cast_text(raw: Column, source_type: str) -> Column:
    kind = spark_type(source_type)
    if source_type.endswith("[]"):
        return array_literal(raw)
    if kind == "binary":
        return F.unhex(F.regexp_replace(raw, r"^\\x", ""))
    if source_type == "pg_lsn":
        from .lsn import parse_lsn

        return parse_lsn(raw)
    return raw if kind == "string" else raw.cast(kind)


def array_literal(text: Column) -> Column:
    """``{a,"b, c",NULL}`` to an array: quoted elements may hold commas and escapes, unquoted NULL is null."""
    inner = F.regexp_extract(text, r"^\s*[{](.*)[}]\s*$", 1)
    items = F.regexp_extract_all(inner, F.lit(r'\s*("(?:[^"\\]|\\.)*"|[^,"]+)\s*'), F.lit(1))
    unquoted = lambda x: F.regexp_replace(F.substring(x, F.lit(2), F.length(x) - 2), r"\\(.)", "$1")
    element = lambda x: F.when(x.startswith('"'), unquoted(x)).when(F.upper(F.trim(x)) == "NULL", None).otherwise(F.trim(x))
    return F.when(text.rlike(r"^\s*[{].*[}]\s*$"), F.transform(items, element))


def ordered_key(keynames: Column, keyvalues: Column, key_columns: list[str]) -> Column:
    """Key values in the order of the table's key columns; null where a key is not given."""
    return F.array(*(F.try_element_at(F.map_from_arrays(keynames, keyvalues), F.lit(k)) for k in key_columns))
