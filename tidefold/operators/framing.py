"""Chunks of a change stream: classification, headers, and assembly into whole transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .running import running_sum

#: The forms of a chunk.
FIRST = r'^[{]("xid":[0-9]+,"timestamp":"[^"]+")'
REGULAR = r"^,?([{].*[}])$"
LAST = "]}"


def chunk_kind(chunk: Column, strict: bool = True) -> Column:
    """``regular``, ``first`` or ``last``, tried in this order; anything else raises, or is null if not strict."""
    kind = F.when(chunk.rlike(REGULAR), "regular").when(chunk.rlike(FIRST), "first").when(chunk == LAST, "last")
    return kind.otherwise(F.raise_error(F.concat(F.lit("unknown chunk: "), F.coalesce(chunk, F.lit("null"))))) if strict else kind


def header(chunk: Column) -> tuple[Column, Column]:
    """Transaction id and commit time of a first chunk; any offset from UTC is understood."""
    xid = F.regexp_extract(chunk, r'^[{]"xid":([0-9]+)', 1)
    text = F.regexp_extract(chunk, r'^[{]"xid":[0-9]+,"timestamp":"([^"]+)"', 1)
    first = chunk.rlike(FIRST)
    return F.when(first, xid.cast("bigint")), F.when(first, F.to_timestamp(F.regexp_replace(text, r"([+-][0-9]{2})$", "$1:00")))


def payload(chunk: Column) -> Column:
    """A regular chunk without its leading comma."""
    return F.when(chunk.rlike(REGULAR), F.regexp_replace(chunk, "^,", ""))


def assemble(chunks: DataFrame) -> DataFrame:
    """Changes of whole transactions from (slot, seq, chunk): slot, txn, seq, xid, committed, n, payload.

    A transaction whose last chunk has not come is left out.  A slot is one ordered stream of any length: transactions are
    numbered by running sums of blocks, and what is known of each one is aggregated and joined to its changes.
    """
    kinds = chunks.withColumn("kind", chunk_kind(F.col("chunk")))
    numbered = running_sum(kinds, ["slot"], "seq", F.col("kind") == "first", "txn")
    xid, committed = header(F.col("chunk"))
    whole = numbered.groupBy("slot", "txn").agg(F.max(xid).alias("xid"), F.max(committed).alias("committed"), F.max(F.col("kind") == "last").alias("complete"), F.count_if(F.col("kind") == "regular").alias("n")).where("complete")
    changes = numbered.where("kind = 'regular'").join(whole, ["slot", "txn"])
    return changes.select("slot", "txn", "seq", "xid", "committed", "n", payload(F.col("chunk")).alias("payload"))


def copy_data(message: Column) -> dict[str, Column]:
    """Fields of a copy-data message: kind (``data`` or ``keepalive``), start and end positions, the source's clock in
    microseconds since 2000, the chunk, and whether an answer is asked for.

    Data: ``w``, three int64 in network order, the chunk.  Keepalive: ``k``, end and clock, one byte.
    """
    from ..functions.lsn import int64_from_network

    first = F.decode(F.substring(message, 1, 1), "us-ascii")
    data, alive = first == "w", first == "k"
    number = lambda at: int64_from_network(F.substring(message, at, 8))
    return {
        "kind": F.when(data, "data").when(alive, "keepalive").otherwise(F.raise_error(F.concat(F.lit("unknown message: "), first))),
        "start_lsn": F.when(data, number(2)),
        "end_lsn": F.when(data, number(10)).otherwise(number(2)),
        "clock": F.when(data, number(18)).otherwise(number(10)),
        "chunk": F.when(data, F.decode(F.substring(message, 26, 2147483647), "utf-8")),
        "reply": F.when(alive, F.hex(F.substring(message, 18, 1)) != "00"),
    }


def transactions(chunks: DataFrame) -> DataFrame:
    """Slot, xid, commit time and number of changes of each whole transaction."""
    return assemble(chunks).groupBy("slot", "txn", "xid", "committed").agg(F.count("*").alias("n_changes")).drop("txn")


def progress(rows: DataFrame, slot: str = "slot", lsn: str = "lsn") -> DataFrame:
    """The last position of each slot."""
    return rows.groupBy(slot).agg(F.max(lsn).alias("flushed_lsn"))


def resume(rows: DataFrame, done: DataFrame, slot: str = "slot", lsn: str = "lsn") -> DataFrame:
    """Rows after each slot's last position, without repetitions; a slot without progress begins at 0."""
    where = F.broadcast(done.select(F.col(slot), F.col("flushed_lsn")))  # one row for each slot
    return rows.join(where, slot, "left").where(F.col(lsn) > F.coalesce("flushed_lsn", F.lit(0))).drop("flushed_lsn").dropDuplicates([slot, lsn])
