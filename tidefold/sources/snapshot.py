"""Snapshot scans: a pinned base version with its log position, read whole or in parts."""

from __future__ import annotations

import json
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import store


def create_slot(spark: SparkSession, root: str, slot: str, lsn: int, tables: dict[str, str], temporary: bool = False) -> dict:
    """Write the snapshot's manifest: which directory each table has at ``lsn``."""
    manifest = {"slot": slot, "consistent_point": lsn, "temporary": temporary, "created": int(time.time()), "tables": tables}
    store.write_text(spark, f"{root}/slots/{slot}.json", json.dumps(manifest, sort_keys=True))
    return manifest


def drop_slot(spark: SparkSession, root: str, slot: str) -> None:
    store.delete(spark, f"{root}/slots/{slot}.json")


def read_snapshot(spark: SparkSession, root: str, slot: str, table: str) -> DataFrame:
    """The table as the slot's manifest pins it."""
    manifest = json.loads(store.read_text(spark, f"{root}/slots/{slot}.json"))
    return spark.read.parquet(manifest["tables"][table])


def part(key: Column, parts: int) -> Column:
    """The part of a parallel copy that a row belongs to: every row is in exactly one."""
    return F.pmod(key, F.lit(parts)).cast("int")


def jdbc_predicates(key: str, parts: int) -> list[str]:
    """Disjoint predicates that cover all rows, for ``spark.read.jdbc(predicates=...)``."""
    return [f"mod({key}, {parts}) = {i}" + (f" OR {key} IS NULL" if i == 0 else "") for i in range(parts)]


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, parts: int, properties: dict) -> DataFrame:
    """A live table in ``parts`` parallel scans; needs the database's driver on the class path."""
    return spark.read.jdbc(url, table, predicates=jdbc_predicates(key, parts), properties=properties)
