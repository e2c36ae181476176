"""The replayer: new spool files are folded into the federated tables, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.federate import TableSpec, Warehouse, replay_batch
from .receiver import SPOOL


def spool_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(SPOOL).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def replay_stream(spool: DataFrame, warehouse: Warehouse, specs: list[TableSpec], checkpoint: str, *, once: bool = True, archive: str | None = None, **options):
    """Apply each micro-batch; the batch number in the manifest makes a repeated batch harmless.

    ``archive``: where applied spool rows are kept, if at all.
    """

    def apply_batch(batch: DataFrame, number: int) -> None:
        rows = batch.select("database", F.col("seq").alias("lsn_start"), "xid", "payload", F.col("slot").alias("source_slotname")).persist()
        try:
            replay_batch(warehouse, rows, specs, number, **options)
            if archive:
                rows.write.mode("overwrite").parquet(f"{archive}/batch={number}")
        finally:
            rows.unpersist()

    writer = spool.writeStream.foreachBatch(apply_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="15 seconds")).start()


def progress_report(warehouse: Warehouse) -> dict:
    """Position of each slot and number of the last batch."""
    now = warehouse.manifest()
    return {"batch": now["batch"], "progress": now["progress"]}
