"""A deterministic change log over the ``events`` table, its payloads and its chunk stream.

Each event changes the row of its user in one of three databases: an insert for the first event or the first after a
delete, a delete for an error, an update otherwise.  Updates of ``view`` events do not carry ``props``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Changes of one transaction: so many event numbers in a row.
XACT = 8


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def change_log(source: DataFrame) -> DataFrame:
    """database, slot, lsn, xid, ts, kind, user_id, event_type, value, props, has_props."""
    before = F.lag("event_type").over(Window.partitionBy("user_id").orderBy("event_id"))
    log = source.withColumn("prev", before)
    error, fresh = F.col("event_type") == "error", F.col("prev").isNull() | (F.col("prev") == "error")
    kind = F.when(error & ~fresh, "delete").when(error, "noop").when(fresh, "insert").otherwise("update")
    log = log.withColumn("kind", kind).where("kind <> 'noop'")
    number = F.col("user_id") % 3
    return log.select(
        F.concat(F.lit("db"), number).alias("database"),
        F.concat(F.lit("slot"), number).alias("slot"),
        F.col("event_id").alias("lsn"),
        F.floor(F.col("event_id") / XACT).cast("bigint").alias("xid"),
        "ts",
        "kind",
        "user_id",
        "event_type",
        "value",
        "props",
        ((F.col("kind") == "insert") | ((F.col("kind") == "update") & (F.col("event_type") != "view"))).alias("has_props"),
    )


def payloads(log: DataFrame) -> DataFrame:
    """The spool: insert_timestamp, database, lsn_start, xid, payload, xid_timestamp, source_slotname."""
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    names = F.when(F.col("has_props"), '["user_id","event_type","value","props"]').otherwise('["user_id","event_type","value"]')
    common = F.concat(F.lit("["), F.col("user_id").cast("string"), F.lit(","), q(F.col("event_type")), F.lit(","), F.col("value").cast("string"))
    props = F.coalesce(F.concat(F.lit(',"'), F.replace("props", F.lit('"'), F.lit('\\"')), F.lit('"')), F.lit(",null"))
    values = F.concat(common, F.when(F.col("has_props"), props).otherwise(""), F.lit("]"))
    keys = F.concat(F.lit('"oldkeys":{"keynames":["user_id"],"keyvalues":['), F.col("user_id").cast("string"), F.lit("]}"))
    head = F.concat(F.lit('{"kind":"'), F.col("kind"), F.lit('","schema":"public","table":"users",'))
    columns = F.concat(F.lit('"columnnames":'), names, F.lit(',"columnvalues":'), values)
    body = F.when(F.col("kind") == "delete", keys).when(F.col("kind") == "insert", columns).otherwise(F.concat(columns, F.lit(","), keys))
    return log.select(
        F.col("ts").cast("timestamp").alias("insert_timestamp"),
        "database",
        F.col("lsn").alias("lsn_start"),
        "xid",
        F.concat(head, body, F.lit("}")).alias("payload"),
        F.col("ts").cast("timestamp").alias("xid_timestamp"),
        F.col("slot").alias("source_slotname"),
    )


def chunks(spool: DataFrame) -> DataFrame:
    """The chunk stream slot, seq, chunk: a first chunk, the payloads and a last chunk for each transaction.

    The transaction with the largest xid of each slot has no last chunk yet.
    """
    xact = spool.groupBy("source_slotname", "xid").agg(F.min("lsn_start").alias("first"), F.max("lsn_start").alias("last"), F.min("xid_timestamp").alias("at"))
    newest = F.max("xid").over(Window.partitionBy("source_slotname"))
    xact = xact.withColumn("open", F.col("xid") == newest)
    head = F.concat(F.lit('{"xid":'), F.col("xid"), F.lit(',"timestamp":"'), F.date_format("at", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit('+00","change":['))
    first = xact.select(F.col("source_slotname").alias("slot"), (F.col("first") * 3 - 1).alias("seq"), head.alias("chunk"))
    last = xact.where("not open").select(F.col("source_slotname").alias("slot"), (F.col("last") * 3 + 1).alias("seq"), F.lit("]}").alias("chunk"))
    inner = spool.join(xact.select("source_slotname", "xid", "first"), ["source_slotname", "xid"])
    comma = F.when(F.col("lsn_start") == F.col("first"), "").otherwise(",")
    middle = inner.select(F.col("source_slotname").alias("slot"), (F.col("lsn_start") * 3).alias("seq"), F.concat(comma, F.col("payload")).alias("chunk"))
    return first.unionAll(middle).unionAll(last)
