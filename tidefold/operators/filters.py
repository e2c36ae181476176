"""Predicates of the replay."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def slot_allowed(database: Column, slot: Column, slots: dict[str, str]) -> Column:
    """True for databases without a restriction, and for the named slot of the others; a null slot is not it."""
    if not slots:
        return F.lit(True)
    pairs = reduce(lambda a, b: a | b, ((database == d) & F.coalesce(slot == s, F.lit(False)) for d, s in slots.items()))
    return ~database.isin(list(slots)) | pairs


def temporary_table(table: Column) -> Column:
    """Tables that a rewrite makes for a moment."""
    return table.startswith("pg_temp")


def table_excluded(schema: Column, table: Column, patterns: list[str]) -> Column:
    """``schema.table`` patterns, ``*`` for any name."""
    if not patterns:
        return F.lit(False)
    regex = ["^" + "[.]".join("[^.]*" if p == "*" else f"\\Q{p}\\E" for p in x.split(".", 1)) + "$" for x in patterns]
    return F.concat_ws(".", schema, table).rlike("|".join(regex))


def is_ddl_event(schema: Column, table: Column) -> Column:
    return (schema == "public") & (table == "sql_ddl_statements")


def stop_requested(query: Column) -> Column:
    """A comment that tells the replay to stop."""
    return query.rlike(r"(?is)^\s*comment\s.*'KILL_ME'")


def first_window(rows: DataFrame, at: str, seconds: int = 30) -> DataFrame:
    """Rows less than ``seconds`` after the earliest one."""
    start = rows.agg(F.min(at).alias("_start"))
    return rows.crossJoin(F.broadcast(start)).where(F.col(at) < F.col("_start") + F.make_dt_interval(secs=F.lit(seconds))).drop("_start")


def key_changed(old: Column, new: Column) -> Column:
    """Whether an update changes its key: maps by column; a key column that the update does not name is unchanged."""
    return F.exists(F.map_keys(old), lambda k: F.map_contains_key(new, k) & ~F.element_at(old, k).eqNullSafe(F.element_at(new, k)))


def without_objects(objects: DataFrame, ignored_schemas: list[str], owned: DataFrame) -> DataFrame:
    """Objects (schema, name) outside the ignored schemas and not owned by an extension."""
    kept = objects.where(~F.col("schema").isin(ignored_schemas)) if ignored_schemas else objects
    return kept.join(owned.select("schema", "name").distinct(), ["schema", "name"], "left_anti")


def missing_schemas(mapped: DataFrame, created: DataFrame) -> DataFrame:
    """Schemas that a map leads to and nobody creates."""
    return mapped.select("schema").subtract(created.select("schema"))
