"""The spool: whole transactions appended in batches, each batch visible at once together with its progress."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store

SCHEMA = "insert_timestamp timestamp, database string, lsn_start bigint, xid bigint, payload string, xid_timestamp timestamp, source_slotname string"


class Spool:
    """A folder of batches and a manifest that names the batches there are and each slot's position."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def manifest(self) -> dict:
        text = store.read_text(self.spark, f"{self.root}/manifest.json")
        return json.loads(text) if text else {"batches": [], "progress": {}}

    def _write(self, manifest: dict) -> None:
        store.write_text(self.spark, f"{self.root}/manifest.json", json.dumps(manifest, sort_keys=True))

    def bootstrap(self) -> None:
        """Make the spool if it is not there."""
        if not store.exists(self.spark, f"{self.root}/manifest.json"):
            self._write({"batches": [], "progress": {}})

    def append(self, rows: DataFrame, batch: str) -> bool:
        """Add whole transactions and advance their slots; false if the batch is there already."""
        now = self.manifest()
        if batch in now["batches"]:
            return False
        path = f"{self.root}/data/batch={batch}"
        # sorted inside the files, so that a scan in order merges runs
        rows.select(*(f.split()[0] for f in SCHEMA.split(", "))).sortWithinPartitions("insert_timestamp", "lsn_start").write.mode("overwrite").partitionBy("database").parquet(path)
        last = {r[0]: r[1] for r in self._read([batch]).where("source_slotname IS NOT NULL").groupBy("source_slotname").agg(F.max("lsn_start")).collect()}
        self._write({"batches": [*now["batches"], batch], "progress": self._advanced(now["progress"], last)})
        return True

    @staticmethod
    def _advanced(old: dict, new: dict) -> dict:
        return old | {s: max(n, old.get(s, 0)) for s, n in new.items()}

    def keepalive(self, slot: str, lsn: int) -> None:
        """Advance an idle slot without data; never back."""
        now = self.manifest()
        self._write(now | {"progress": self._advanced(now["progress"], {slot: lsn})})

    def last_flushed(self, slot: str) -> int:
        return self.manifest()["progress"].get(slot, 0)

    def _read(self, batches: list[str]) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], SCHEMA)
        paths = [f"{self.root}/data/batch={b}" for b in batches]  # one scan, however many batches there are
        found = self.spark.read.schema(SCHEMA).option("basePath", f"{self.root}/data").parquet(*paths)
        return found.select(*(f.split()[0] for f in SCHEMA.split(", ")))

    def read(self, database: str | None = None) -> DataFrame:
        """All rows; a database's only from its partitions."""
        df = self._read(self.manifest()["batches"])
        return df if database is None else df.where(F.col("database") == database)

    def ordered(self) -> DataFrame:
        """All rows in the order of replay, ties of several databases broken by database."""
        return self.read().orderBy("insert_timestamp", "lsn_start", "database")

    def clean(self, batches: list[str], archive: str | None = None) -> None:
        """Take applied batches out; with ``archive`` their rows are kept there first."""
        now = self.manifest()
        gone = [b for b in batches if b in now["batches"]]
        if archive:
            for b in gone:
                self._read([b]).write.mode("overwrite").parquet(f"{archive}/{b}")
        self._write(now | {"batches": [b for b in now["batches"] if b not in gone]})
        for b in gone:
            store.delete(self.spark, f"{self.root}/data/batch={b}")
