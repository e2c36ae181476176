"""Repair of a stopped replay: the record it stopped at, and its replacement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .filters import first_window, is_ddl_event, slot_allowed


def next_failed(spool: DataFrame, slots: dict[str, str] | None = None, seconds: int = 30) -> DataFrame:
    """The first DDL record of the spool's first ``seconds``, where a replay stops; a top-1, not a sort."""
    rows = spool.where(slot_allowed(F.col("database"), F.col("source_slotname"), slots or {}))
    early = first_window(rows, "insert_timestamp", seconds)
    schema, table = F.get_json_object("payload", "$.schema"), F.get_json_object("payload", "$.table")
    return early.where(is_ddl_event(schema, table)).orderBy("insert_timestamp", "lsn_start").limit(1)


def resolve(spool: DataFrame, record: dict, execute: Callable[[str], None], statement: str) -> DataFrame:
    """Run ``statement`` in place of the record and return the spool without it.

    Nothing is run if the record is no longer the one that was shown.
    """
    same = spool.where((F.col("database") == record["database"]) & (F.col("lsn_start") == record["lsn_start"]))
    now = same.select("payload").first()
    if now is None or now["payload"] != record["payload"]:
        raise RuntimeError("the record has changed meanwhile")
    execute(statement)
    return spool.where(~((F.col("database") == record["database"]) & (F.col("lsn_start") == record["lsn_start"])))
