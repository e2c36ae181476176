"""The receiver: a stream of chunks becomes whole transactions in the spool."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

CHUNK = "slot string, database string, seq bigint, chunk string"
SPOOL = "slot string, database string, seq bigint, xid bigint, committed string, payload string"
_FIRST = re.compile(r'^\{"xid":([0-9]+),"timestamp":"([^"]+)"')
_REGULAR = re.compile(r"^,?(\{.*\})$", re.S)


def chunk_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Chunk files (JSON lines) as they arrive; the number of files bounds a micro-batch."""
    return spark.readStream.schema(CHUNK).option("maxFilesPerTrigger", files_per_trigger).json(path)


def _assemble(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One slot: chunks in order; an open transaction waits in the state, and nothing of it is visible."""
    last, xid, committed, held = state.get if state.exists else (-1, None, None, [])
    held = list(held or [])
    out = []
    rows = pd.concat(list(batches)).sort_values("seq", kind="stable")
    for database, seq, chunk in zip(rows["database"], rows["seq"], rows["chunk"], strict=True):
        if seq <= last:
            continue  # sent again after a restart
        last = int(seq)
        if m := _REGULAR.match(chunk):
            if xid is None:
                raise ValueError(f"change outside of a transaction: {chunk[:80]}")
            held.append((database, last, m[1]))
        elif m := _FIRST.match(chunk):
            xid, committed, held = int(m[1]), m[2], []
        elif chunk == "]}":
            out += [(key[0], d, s, xid, committed, p) for d, s, p in held]
            xid, committed, held = None, None, []
        else:
            raise ValueError(f"unknown chunk: {chunk[:80]}")
    state.update((last, xid, committed, held))
    yield pd.DataFrame(out, columns=["slot", "database", "seq", "xid", "committed", "payload"])


def assemble_stream(chunks: DataFrame) -> DataFrame:
    """Changes of whole transactions, each once, in a stateful step by slot."""
    state = "last bigint, xid bigint, committed string, held array<struct<database:string,seq:bigint,payload:string>>"
    return chunks.groupBy("slot").applyInPandasWithState(_assemble, SPOOL, state, "append", GroupStateTimeout.NoTimeout)


def spool_writer(rows: DataFrame, path: str, checkpoint: str, once: bool = True):
    """Append to the spool; the file sink's log makes each micro-batch visible as a whole."""
    writer = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="5 seconds")).start()
