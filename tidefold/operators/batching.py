"""Batches, barriers and routing of a replay."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import route
from .running import running_sum


def by_key(changes: DataFrame, workers: int, keys: list[str], *names: str) -> DataFrame:
    """The worker of each change of a table with one unique index at most: by names and key values."""
    return changes.withColumn("worker", route(workers, *(F.col(n) for n in names), F.concat_ws("-", *(F.col(k).cast("string") for k in keys))))


def by_table(changes: DataFrame, workers: int, *names: str) -> DataFrame:
    """The worker of each change of a table with several unique indexes: one for the whole table."""
    return changes.withColumn("worker", route(workers, *(F.col(n) for n in names)))


def greedy_batches(rows: DataFrame, group: str, order: str, epoch: str, seconds: float = 30) -> DataFrame:
    """``rows`` with ``batch``: a batch ends before the first row more than ``seconds`` after its own first row.

    Each row depends on the one before, so a group is one ordered stream; it is read in order with three numbers of
    state and never gathered.
    """
    schema = rows.schema.add("batch", "integer")
    at_group, at_epoch = rows.columns.index(group), rows.columns.index(epoch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = anchor = number = None
        for b in batches:
            out = []
            for g, t in zip(b.column(at_group).to_pylist(), b.column(at_epoch).to_pylist(), strict=True):
                if number is None or g != now:
                    now, anchor, number = g, t, 0
                elif t - anchor > seconds:
                    anchor, number = t, number + 1
                out.append(number)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int32())], names=schema.names)

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, group).sortWithinPartitions(group, order).mapInArrow(run, schema)


def ddl_epochs(rows: DataFrame, group: str, order: str, is_ddl: str) -> DataFrame:
    """``rows`` with ``epoch``: how many DDL events came before, so that each batch has one schema."""
    return running_sum(rows, [group], order, F.col(is_ddl), "epoch", own=False)


def replay_statistics(changes: DataFrame, *groups: str) -> DataFrame:
    """Changes, those with a key, and their percentage."""
    keyed = F.col("kind").isin("update", "delete")
    return changes.groupBy(*groups).agg(F.count("*").alias("updated"), F.count_if(keyed).alias("updated_by_key"), F.round(100 * F.avg(keyed.cast("double")), 2).alias("percent_by_key"))
