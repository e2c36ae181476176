"""Schema federation names, identifier quoting and routing hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def federated_schema(schema: Column, database: Column, keep_schema: bool = False) -> Column:
    """``database_schema``, or the schema itself where schemas are kept."""
    return schema if keep_schema else F.concat_ws("_", database, schema)


def quoted(name: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"'))


def quoted_if_needed(name: Column) -> Column:
    return F.when(name.rlike("^[a-z_][a-z0-9_]*$"), name).otherwise(quoted(name))


def qualified(*parts: Column) -> Column:
    """Quoted parts joined by dots; null parts are left out."""
    return F.concat_ws(".", *(quoted(p) for p in parts))


def route(workers: int, *parts: Column) -> Column:
    """A worker number: the first 32 bits of an MD5 over the parts, without separators, modulo the workers."""
    return (F.conv(F.substring(F.md5(F.concat(*parts)), 1, 8), 16, 10).cast("bigint") % workers).cast("int")


def search_path(path: Column, database: Column, keep_schema: bool = False) -> Column:
    """Each schema of a search path federated, without the user's own; ``public`` ends the path."""
    items = F.filter(F.transform(F.split(path, ","), lambda x: F.trim(x)), lambda x: (x != '"$user"') & (x != "$user"))
    named = items if keep_schema else F.transform(items, lambda x: F.concat_ws("_", database, x))
    return F.array_join(F.array_append(named, F.lit("public")), ", ")
