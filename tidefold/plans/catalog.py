"""All queries of the federation engine, each with the SQL that gives the same rows, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lsn, names, payload
from ..operators import advisor, batching, ddl, filters, fold, framing
from ..sources import changelog, snapshot
from . import store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: The change log of sources.changelog in SQL.
LOG = """
WITH k AS (SELECT event_id, ts, user_id, event_type, value, props,
                  lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS prev FROM events),
l AS (SELECT *, CASE WHEN event_type = 'error' AND prev IS NOT NULL AND prev <> 'error' THEN 'delete'
                     WHEN event_type = 'error' THEN 'noop'
                     WHEN prev IS NULL OR prev = 'error' THEN 'insert' ELSE 'update' END AS kind FROM k),
log AS (SELECT 'db' || (user_id % 3) AS database, 'slot' || (user_id % 3) AS slot, event_id AS lsn, event_id // 8 AS xid,
               ts, kind, user_id, event_type, value, props,
               (kind = 'insert' OR (kind = 'update' AND event_type <> 'view')) AS has_props
        FROM l WHERE kind <> 'noop')
"""


def query(sql: str | None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def log_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.change_log(changelog.events(spark, sf_dir))


def literal(value) -> str:
    """A value in SQL that both engines read."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, list):
        return "[" + ", ".join(map(literal, value)) + "]"
    return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def values(rows: list[tuple], columns: str) -> str:
    return f"(SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(literal, r)) + ')' for r in rows)}) AS v({columns}))"


def frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def carried() -> dict:
    changed = F.col("kind") != "delete"
    return {"event_type": changed, "value": changed, "props": F.col("has_props")}


@query(LOG + """, r AS (SELECT *, row_number() OVER (PARTITION BY database, user_id ORDER BY lsn DESC) AS rn,
    last_value(CASE WHEN has_props THEN props END IGNORE NULLS) OVER (PARTITION BY database, user_id ORDER BY lsn
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS p FROM log)
SELECT database, user_id, event_type, value, p AS props FROM r WHERE rn = 1 AND kind <> 'delete'""")
def fold_latest(spark, sf_dir):
    """Current state of all keys from the whole change log."""
    return fold.fold(log_of(spark, sf_dir), ["database", "user_id"], carried())


@query(LOG + "SELECT database, kind, count(*) AS n FROM log GROUP BY ALL")
def fold_counts_by_table(spark, sf_dir):
    return log_of(spark, sf_dir).groupBy("database", "kind").agg(F.count("*").alias("n"))


@query(LOG + """, r AS (SELECT *, row_number() OVER (PARTITION BY database, user_id ORDER BY lsn DESC) AS rn,
    last_value(CASE WHEN has_props THEN props END IGNORE NULLS) OVER (PARTITION BY database, user_id ORDER BY lsn
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS p FROM log)
SELECT database || '_public' AS federated_schema, user_id, event_type, value, p AS props FROM r WHERE rn = 1 AND kind <> 'delete'""")
def fold_json_spool(spark, sf_dir):
    """The same state from the JSON records of the spool, through the typed payload functions."""
    from . import federate

    spool = changelog.payloads(log_of(spark, sf_dir))
    rows = federate.accepted(spool)
    types = {"user_id": "int8", "event_type": "text", "value": "float8", "props": "text"}
    n, v = F.col("r.columnnames"), F.col("r.columnvalues")
    old = payload.zip_map(F.col("r.oldkeys.keynames"), F.col("r.oldkeys.keyvalues"))
    typed = rows.select(names.federated_schema(F.col("r.schema"), F.col("database")).alias("federated_schema"), F.col("lsn_start").alias("lsn"), F.col("r.kind").alias("kind"), F.coalesce(F.try_element_at(old, F.lit("user_id")).cast("bigint"), payload.value_at(n, v, "user_id", "int8")).alias("user_id"), *(payload.value_at(n, v, c, t).alias(c) for c, t in types.items() if c != "user_id"), *(payload.present(n, c).alias(f"_in_{c}") for c in types))
    return fold.fold(typed, ["federated_schema", "user_id"], {c: F.col(f"_in_{c}") for c in types if c != "user_id"})


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 2 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 10 = 1 THEN o_totalprice + 100 ELSE o_totalprice END AS o_totalprice, o_orderpriority
FROM orders WHERE o_orderkey % 10 <> 0
UNION ALL SELECT o_orderkey + 100000000, 'N', o_totalprice, NULL FROM orders WHERE o_orderkey % 10 = 3""")
def fold_orders_base_plus_changes(spark, sf_dir):
    """A snapshot of orders and changes to it: deletes, partial updates, explicit nulls, inserts."""
    base = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    part = F.col("o_orderkey") % 10
    picked = base.where(part <= 3).withColumn("part", part)
    kind = F.when(F.col("part") == 0, "delete").when(F.col("part") == 3, "insert").otherwise("update")
    changes = picked.select(
        F.when(F.col("part") == 3, F.col("o_orderkey") + 100_000_000).otherwise(F.col("o_orderkey")).alias("o_orderkey"),
        F.when(F.col("part") == 3, "N").alias("o_orderstatus"),
        F.when(F.col("part") == 1, F.col("o_totalprice") + 100).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.lit(None).cast("string").alias("o_orderpriority"),
        kind.alias("kind"),
        F.col("o_orderkey").alias("lsn"),
        "part",
    )
    has = {"o_orderstatus": F.col("part") == 2, "o_totalprice": F.col("part") == 1, "o_orderpriority": F.lit(False)}
    return fold.apply_changes(base, changes, ["o_orderkey"], has)


@query(LOG + """, m AS (SELECT *, sum(CASE WHEN kind = 'update' AND event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY lsn) AS moves,
    row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC) AS rn,
    last_value(CASE WHEN has_props THEN props END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY lsn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS p FROM log)
SELECT user_id * 100000 + moves AS key, event_type, value, p AS props FROM m WHERE rn = 1 AND kind <> 'delete'""")
def fold_key_changes(spark, sf_dir):
    """Updates that change the key, in chains, with columns that they do not carry."""
    moved = (F.col("kind") == "update") & (F.col("event_type") == "signup")
    from pyspark.sql import Window

    moves = F.sum(moved.cast("bigint")).over(Window.partitionBy("user_id").orderBy("lsn").rowsBetween(Window.unboundedPreceding, 0))
    log = log_of(spark, sf_dir).withColumn("new_key", F.col("user_id") * 100_000 + moves).withColumn("old_key", F.col("new_key") - moved.cast("bigint"))
    return fold.fold_key_changes(log, "old_key", "new_key", carried())


@query("""SELECT * FROM (VALUES (1, 'y', NULL), (2, NULL, 'b'), (4, 'z', NULL)) AS v(id, a, b)""")
def null_or_absent(spark, sf_dir):
    """An explicit null overwrites, an absent column stays, a re-inserted row has nothing of the old one."""
    rows = [("insert", 1, 1, ["id", "a", "b"], ["1", "x", "b"]), ("update", 2, 1, ["id", "a", "b"], ["1", "y", None]), ("insert", 3, 2, ["id", "a", "b"], ["2", "x", "b"]), ("update", 4, 2, ["id", "a"], ["2", None]), ("insert", 5, 3, ["id", "a", "b"], ["3", "x", "b"]), ("delete", 6, 3, None, None), ("insert", 7, 4, ["id", "a", "b"], ["4", "x", "old"]), ("delete", 8, 4, None, None), ("insert", 9, 4, ["id", "a", "b"], ["4", "z", None])]
    changes = frame(spark, rows, "kind string, lsn bigint, id int, n array<string>, v array<string>")
    n, v = F.col("n"), F.col("v")
    typed = changes.select("kind", "lsn", "id", *(payload.value_at(n, v, c).alias(c) for c in "ab"), *(payload.present(n, c).alias(f"_{c}") for c in "ab"))
    return fold.fold(typed, ["id"], {c: F.col(f"_{c}") for c in "ab"})


@query("""WITH e AS (SELECT event_id AS lsn, user_id, CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END AS kind FROM events),
b AS (SELECT *, lag(kind) OVER (PARTITION BY user_id ORDER BY lsn) AS before FROM e),
c AS (SELECT *, before IS NOT NULL AND before <> 'delete' AS live FROM b)
SELECT lsn, user_id, kind, CASE WHEN kind = 'insert' THEN 'insert of a live key' ELSE 'change of a missing key' END AS reason
FROM c WHERE (kind = 'insert' AND live) OR (kind <> 'insert' AND NOT live)""")
def apply_violations(spark, sf_dir):
    kind = F.when(F.col("event_type") == "signup", "insert").when(F.col("event_type") == "error", "delete").otherwise("update")
    changes = changelog.events(spark, sf_dir).select(F.col("event_id").alias("lsn"), "user_id", kind.alias("kind"))
    return fold.violations(changes, ["user_id"])


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL HAVING count(*) > 1")
def key_duplicates(spark, sf_dir):
    return fold.duplicate_keys(changelog.events(spark, sf_dir).select("user_id", "event_type"), ["user_id", "event_type"])


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')")
def reference_orphans(spark, sf_dir):
    parent = read(spark, sf_dir, "orders").where("o_orderstatus <> 'F'").select("o_orderkey")
    return fold.orphans(read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), parent, ["l_orderkey"], ["o_orderkey"])


@query(LOG + """, t AS (SELECT slot, xid, count(*) AS n_changes, epoch_us(min(ts)) AS committed_us FROM log GROUP BY ALL)
SELECT slot, xid, n_changes, committed_us FROM t WHERE xid < (SELECT max(xid) FROM t AS u WHERE u.slot = t.slot)""")
def txn_assembly(spark, sf_dir):
    """Chunks to whole transactions; the unfinished ones at the end are left out."""
    chunks = changelog.chunks(changelog.payloads(log_of(spark, sf_dir)))
    return framing.transactions(chunks).select("slot", "xid", "n_changes", F.unix_micros("committed").alias("committed_us"))


@query(LOG + """, t AS (SELECT slot, count(DISTINCT xid) AS x, count(*) AS c FROM log GROUP BY slot)
SELECT slot, 'first' AS kind, x AS n FROM t UNION ALL SELECT slot, 'regular', c FROM t UNION ALL SELECT slot, 'last', x - 1 FROM t WHERE x > 1""")
def chunk_counts(spark, sf_dir):
    chunks = changelog.chunks(changelog.payloads(log_of(spark, sf_dir)))
    return chunks.groupBy("slot", framing.chunk_kind(F.col("chunk")).alias("kind")).agg(F.count("*").alias("n"))


@query(LOG + "SELECT lsn, database, kind, user_id, event_type FROM log WHERE xid < (SELECT max(xid) FROM log AS u WHERE u.slot = log.slot)")
def framing_round_trip(spark, sf_dir):
    """Every change of a whole transaction comes out of the chunks as it went in."""
    spool = changelog.payloads(log_of(spark, sf_dir))
    found = framing.assemble(changelog.chunks(spool)).withColumn("r", payload.parsed(F.col("payload")))
    old = payload.zip_map(F.col("r.oldkeys.keynames"), F.col("r.oldkeys.keyvalues"))
    n, v = F.col("r.columnnames"), F.col("r.columnvalues")
    user = F.coalesce(payload.value_at(n, v, "user_id", "int8"), F.try_element_at(old, F.lit("user_id")).cast("bigint"))
    kept = F.coalesce(payload.value_at(n, v, "event_type"), F.lit("error"))
    return found.select((F.col("seq") / 3).cast("bigint").alias("lsn"), F.replace("slot", F.lit("slot"), F.lit("db")).alias("database"), F.col("r.kind").alias("kind"), user.alias("user_id"), kept.alias("event_type"))


CHUNKS = ["{hello", "hello}there", "hello}", "]}", '{"xid":1234,"timestamp":"1234.123", "changes": [', '{"xid":1234,"other": "blah", "timestamp": "1234.123"', '{"timestamp": "1234.123"', '{"kind":"insert"}', ',{"kind":"delete"}', ""]


@query(f"""SELECT chunk, CASE WHEN regexp_matches(chunk, '^,?[{{].*[}}]$') THEN 'regular' WHEN regexp_matches(chunk, '^[{{]"xid":[0-9]+,"timestamp":"[^"]+"') THEN 'first' WHEN chunk = ']}}' THEN 'last' END AS kind
FROM {values([(c,) for c in CHUNKS], "chunk")}""")
def chunk_classify(spark, sf_dir):
    return frame(spark, [(c,) for c in CHUNKS], "chunk string").select("chunk", framing.chunk_kind(F.col("chunk"), strict=False).alias("kind"))


HEADERS = [(1, '{"xid":7,"timestamp":"2021-03-04 05:06:07.12+02","change":['), (2, '{"xid":4294967295,"timestamp":"2021-12-31 23:59:59.000001+00","change":['), (3, '{"xid":8,"timestamp":"2021-03-04 05:06:07-05:30"')]


@query(f"""SELECT id, CAST(regexp_extract(chunk, '"xid":([0-9]+)', 1) AS BIGINT) AS xid, epoch_us(CAST(regexp_extract(chunk, '"timestamp":"([^"]+)"', 1) AS TIMESTAMPTZ)) AS committed_us FROM {values(HEADERS, "id, chunk")}""")
def header_extract(spark, sf_dir):
    xid, at = framing.header(F.col("chunk"))
    return frame(spark, HEADERS, "id int, chunk string").select("id", xid.alias("xid"), F.unix_micros(at).alias("committed_us"))


@query("SELECT event_id, event_id * 4294967311 AS lsn, upper(to_hex((event_id * 4294967311) >> 32)) || '/' || upper(to_hex((event_id * 4294967311) & 4294967295)) AS text FROM events")
def lsn_codec(spark, sf_dir):
    position = F.col("event_id") * 4294967311
    rows = changelog.events(spark, sf_dir).select("event_id", lsn.format_lsn(position).alias("text"))
    return rows.select("event_id", lsn.parse_lsn(F.col("text")).alias("lsn"), "text")


@query("SELECT event_id, event_id * 1000003 AS value, lpad(upper(to_hex(event_id * 1000003)), 16, '0') AS wire FROM events")
def int64_codec(spark, sf_dir):
    wire = changelog.events(spark, sf_dir).select("event_id", lsn.int64_to_network(F.col("event_id") * 1000003).alias("b"))
    return wire.select("event_id", lsn.int64_from_network(F.col("b")).alias("value"), F.hex("b").alias("wire"))


@query("""SELECT event_id, CASE WHEN event_type = 'view' THEN 'keepalive' ELSE 'data' END AS kind, CASE WHEN event_type <> 'view' THEN event_id * 16 END AS start_lsn,
  event_id * 16 + 8 AS end_lsn, event_id * 1000 AS clock, CASE WHEN event_type <> 'view' THEN props END AS chunk, CASE WHEN event_type = 'view' THEN event_id % 2 = 1 END AS reply FROM events""")
def copy_data_messages(spark, sf_dir):
    """Binary messages of the replication protocol, written and decoded."""
    n = lambda c: lsn.int64_to_network(c)
    at = F.col("event_id")
    data = F.concat(F.encode(F.lit("w"), "utf-8"), n(at * 16), n(at * 16 + 8), n(at * 1000), F.encode("props", "utf-8"))
    alive = F.concat(F.encode(F.lit("k"), "utf-8"), n(at * 16 + 8), n(at * 1000), F.unhex(F.concat(F.lit("0"), (at % 2).cast("string"))))
    messages = changelog.events(spark, sf_dir).select("event_id", F.when(F.col("event_type") == "view", alive).otherwise(data).alias("m"))
    return messages.select("event_id", *(c.alias(k) for k, c in framing.copy_data(F.col("m")).items()))


@query("SELECT event_id, epoch_us(ts) - 946684800000000 AS micros, epoch_us(ts) / 1000000 AS seconds FROM events")
def source_clock(spark, sf_dir):
    return changelog.events(spark, sf_dir).select("event_id", lsn.source_micros(F.col("ts")).alias("micros"), lsn.epoch_seconds(F.col("ts")).alias("seconds"))


@query(LOG + "SELECT database, CAST(CAST('0x' || substr(md5(database || 'public' || 'users' || user_id), 1, 8) AS BIGINT) % 4 AS INTEGER) AS worker, count(*) AS n FROM log GROUP BY ALL")
def dispatch_by_key(spark, sf_dir):
    log = log_of(spark, sf_dir).withColumns({"schema": F.lit("public"), "table": F.lit("users")})
    return batching.by_key(log, 4, ["user_id"], "database", "schema", "table").groupBy("database", "worker").agg(F.count("*").alias("n"))


@query(LOG + "SELECT database, CAST(CAST('0x' || substr(md5(database || 'public' || 'users'), 1, 8) AS BIGINT) % 4 AS INTEGER) AS worker, count(*) AS n FROM log GROUP BY ALL")
def dispatch_by_table(spark, sf_dir):
    log = log_of(spark, sf_dir).withColumns({"schema": F.lit("public"), "table": F.lit("users")})
    return batching.by_table(log, 4, "database", "schema", "table").groupBy("database", "worker").agg(F.count("*").alias("n"))


@query(LOG.replace("WITH k", "WITH RECURSIVE k") + """, a AS (
  SELECT database, min(ts) AS anchor, 0 AS batch FROM log GROUP BY database
  UNION ALL
  SELECT a.database, (SELECT min(l.ts) FROM log AS l WHERE l.database = a.database AND epoch_us(l.ts) - epoch_us(a.anchor) > 7200000000) AS anchor, a.batch + 1
  FROM a WHERE EXISTS (SELECT 1 FROM log AS l WHERE l.database = a.database AND epoch_us(l.ts) - epoch_us(a.anchor) > 7200000000))
SELECT l.database, a.batch, count(*) AS n, min(l.lsn) AS first_lsn FROM log AS l ASOF JOIN a ON l.database = a.database AND l.ts >= a.anchor GROUP BY ALL""")
def greedy_batches(spark, sf_dir):
    """Commit points by time: each batch is anchored at its first change."""
    rows = log_of(spark, sf_dir).select("database", "lsn", F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"))
    found = batching.greedy_batches(rows, "database", "lsn", "micros", 7200 * 1_000_000)
    return found.groupBy("database", "batch").agg(F.count("*").alias("n"), F.min("lsn").alias("first_lsn"))


@query(LOG + """, e AS (SELECT database, coalesce(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY database ORDER BY lsn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS epoch FROM log)
SELECT database, CAST(epoch AS BIGINT) AS epoch, count(*) AS n FROM e GROUP BY ALL""")
def ddl_epochs(spark, sf_dir):
    log = log_of(spark, sf_dir).withColumn("is_ddl", F.col("event_type") == "signup")
    return batching.ddl_epochs(log, "database", "lsn", "is_ddl").groupBy("database", "epoch").agg(F.count("*").alias("n"))


@query(LOG + "SELECT database, count(*) AS updated, count(*) FILTER (WHERE kind IN ('update', 'delete')) AS updated_by_key, round(100 * avg(CASE WHEN kind IN ('update', 'delete') THEN 1.0 ELSE 0.0 END), 2) AS percent_by_key FROM log GROUP BY ALL")
def replay_stats(spark, sf_dir):
    return batching.replay_statistics(log_of(spark, sf_dir), "database")


@query(LOG + """, s AS (SELECT database, CASE WHEN user_id % 5 = 0 THEN NULL ELSE slot END AS slot FROM log)
SELECT database, count(*) AS n FROM s WHERE database NOT IN ('db0', 'db1') OR (database = 'db0' AND slot = 'slot0') OR (database = 'db1' AND slot = 'other') GROUP BY ALL""")
def slot_filter(spark, sf_dir):
    log = log_of(spark, sf_dir).withColumn("slot", F.when(F.col("user_id") % 5 != 0, F.col("slot")))
    return log.where(filters.slot_allowed(F.col("database"), F.col("slot"), {"db0": "slot0", "db1": "other"})).groupBy("database").agg(F.count("*").alias("n"))


@query(LOG + "SELECT database, count(*) AS n FROM log WHERE user_id % 7 <> 0 GROUP BY ALL")
def temp_table_filter(spark, sf_dir):
    log = log_of(spark, sf_dir).withColumn("table", F.when(F.col("user_id") % 7 == 0, F.concat(F.lit("pg_temp_"), "user_id")).otherwise("users"))
    return log.where(~filters.temporary_table(F.col("table"))).groupBy("database").agg(F.count("*").alias("n"))


@query(LOG + "SELECT user_id % 4 AS part, count(*) AS n FROM log WHERE NOT (user_id % 4 = 0 OR (user_id % 4 = 1 AND event_type = 'click')) GROUP BY ALL")
def table_filter(spark, sf_dir):
    schema = F.when(F.col("user_id") % 4 == 0, "bi").when(F.col("user_id") % 4 == 1, "public").otherwise("bi2")
    log = log_of(spark, sf_dir)
    return log.where(~filters.table_excluded(schema, F.col("event_type"), ["bi.*", "public.click"])).groupBy((F.col("user_id") % 4).alias("part")).agg(F.count("*").alias("n"))


@query(LOG + "SELECT lsn, event_type = 'signup' AS changed FROM log WHERE kind = 'update'")
def key_change_flag(spark, sf_dir):
    """Old and new key by column; an update that does not name its key (a view) does not change it."""
    old = F.create_map(F.lit("id"), F.col("user_id"))
    new = F.when(F.col("event_type") == "view", F.create_map().cast("map<string,bigint>")).when(F.col("event_type") == "signup", F.create_map(F.lit("id"), F.col("user_id") + 1)).otherwise(old)
    return log_of(spark, sf_dir).where("kind = 'update'").select("lsn", filters.key_changed(old, new).alias("changed"))


@query(LOG + "SELECT CASE WHEN xid % 3 = 0 THEN 'archived' ELSE 'spool' END AS place, database, count(*) AS n, sum(lsn) AS positions FROM log GROUP BY ALL")
def archive_split(spark, sf_dir):
    spool = log_of(spark, sf_dir).select("database", "lsn", "xid")
    left, done = fold.archive(spool, spool.where("xid % 3 = 0"), ["database", "lsn"])
    both = left.withColumn("place", F.lit("spool")).unionByName(done.withColumn("place", F.lit("archived")))
    return both.groupBy("place", "database").agg(F.count("*").alias("n"), F.sum("lsn").alias("positions"))


@query(LOG + "SELECT database, lsn AS lsn_start, event_type FROM log WHERE event_type = 'signup' AND ts < (SELECT min(ts) FROM log) + INTERVAL 1 DAY ORDER BY ts, lsn LIMIT 1")
def next_to_repair(spark, sf_dir):
    from ..operators.repair import next_failed

    table = F.when(F.col("event_type") == "signup", "sql_ddl_statements").otherwise("users")
    spool = log_of(spark, sf_dir).select("database", F.col("slot").alias("source_slotname"), F.col("lsn").alias("lsn_start"), F.col("ts").cast("timestamp").alias("insert_timestamp"), "event_type", F.to_json(F.struct(F.lit("public").alias("schema"), table.alias("table"))).alias("payload"))
    return next_failed(spool, seconds=86_400).select("database", "lsn_start", "event_type")


@query(LOG + """, d AS (SELECT slot, max(lsn) // 2 AS done FROM log WHERE slot <> 'slot2' GROUP BY slot)
SELECT log.slot, count(*) AS n, min(lsn) AS first_lsn FROM log LEFT JOIN d ON log.slot = d.slot WHERE lsn > coalesce(done, 0) GROUP BY ALL""")
def resume_filter(spark, sf_dir):
    """Rows after each slot's progress, though all were sent twice."""
    log = log_of(spark, sf_dir).select("slot", "lsn")
    done = framing.progress(log.where("slot <> 'slot2'")).withColumn("flushed_lsn", F.floor(F.col("flushed_lsn") / 2).cast("bigint"))
    return framing.resume(log.unionAll(log), done).groupBy("slot").agg(F.count("*").alias("n"), F.min("lsn").alias("first_lsn"))


@query(LOG + "SELECT slot, max(lsn) AS flushed_lsn FROM log GROUP BY ALL")
def slot_progress(spark, sf_dir):
    return framing.progress(log_of(spark, sf_dir).select("slot", "lsn"))


DDL = [
    ("db0", "CREATE TEMP TABLE t (a int)"), ("db0", "create temporary table t (a int)"), ("db0", " CREATE EXTENSION hstore"), ("db1", "ALTER TABLE public.t DISABLE TRIGGER ALL;"),
    ("db1", "ALTER TABLE public.t ADD CHECK (a > 0)"), ("db1", "ALTER TABLE t ADD CONSTRAINT c CHECK (a > 0)"), ("db1", "alter table t enable row level security"), ("db1", "ALTER TABLE t VALIDATE CONSTRAINT c"),
    ("db1", "ALTER TABLE public.t OWNER TO me"), ("db2", "CREATE OR REPLACE FUNCTION f() RETURNS int AS $$ SELECT 1 $$ LANGUAGE sql"), ("db2", "CREATE OR REPLACE VIEW public.v AS SELECT 1"), ("db2", "create view v as select 1"),
    ("db2", "COMMENT ON TABLE t IS 'x'"), ("db0", "CREATE TABLE public.t (a int)"), ("db0", "create table if not exists public.t (a int)"), ("db0", "ALTER TABLE public.t SET SCHEMA other"), ("db0", "DROP TABLE public.t"),
    ("db0", "CREATE TYPE public.mood AS ENUM ('a', 'b')"), ("db0", "ALTER SEQUENCE public.s RESTART"), ("db0", "ALTER TABLE t DROP CONSTRAINT c"), ("db0", "ALTER TABLE public.t DROP CONSTRAINT IF EXISTS c"),
    ("db0", "CREATE INDEX i ON t (a)"), ("db0", "TRUNCATE t"), ("db0", "GRANT SELECT ON t TO me"), ("db0", "ALTER TABLE public.t ADD COLUMN checked int"), ("db1", "CREATE TABLE t (a int)"),
]
DDL_SQL = values(DDL, "database, current_query")
RULE_SQL = "CASE " + " ".join(f"WHEN regexp_matches(current_query, '{p}', 'is') THEN '{n}'" for n, p, _ in ddl.RULES) + " ELSE 'unknown' END"
ACTION_SQL = "CASE rule " + " ".join(f"WHEN '{n}' THEN '{a}'" for n, _, a in ddl.RULES) + " ELSE 'quarantine' END"
#: The one statement per rule of DDL that is moved, in SQL.
NAME_SQL = r"(^\s*(?:create|alter|drop)\s+(?:or\s+replace\s+)?(?:table|view|type|sequence)\s+(?:if\s+(?:not\s+)?exists\s+)?(?:only\s+)?)([^\s.(]+)[.](\S+)"


@query(f"SELECT *, {ACTION_SQL} AS action FROM (SELECT database, current_query, {RULE_SQL} AS rule FROM {DDL_SQL})")
def ddl_classify(spark, sf_dir):
    return ddl.classify(ddl.statements(spark, DDL), unknown="quarantine").select("database", "current_query", "rule", "action")


@query(f"""SELECT database, current_query, CASE WHEN regexp_matches(s, 'drop\\s+constraint\\s+if\\s+exists', 'i') THEN s
  ELSE regexp_replace(s, '^(\\s*alter\\s+table.*?drop\\s+constraint\\s+)', '\\1IF EXISTS ', 'i') END AS fixed_ddl FROM (
  SELECT *, regexp_replace(regexp_replace(current_query, '{NAME_SQL}', '\\1' || database || '_\\2.\\3', 'i'), '(set\\s+schema\\s+)([^\\s;]+)', '\\1' || database || '_\\2', 'i') AS s
  FROM (SELECT *, {RULE_SQL} AS rule FROM {DDL_SQL}) WHERE rule IN ('view', 'table', 'type', 'sequence'))""")
def ddl_rewrite(spark, sf_dir):
    return ddl.classify(ddl.statements(spark, DDL), unknown="quarantine").where("action = 'rewrite'").select("database", "current_query", "fixed_ddl")


PATHS = [("db0", '"$user", public'), ("db1", "a,b , c"), ("db2", "public")]


@query("""SELECT * FROM (VALUES ('db0', 'db0_public, public'), ('db1', 'db1_a, db1_b, db1_c, public'), ('db2', 'db2_public, public')) AS v(database, path)""")
def search_path_rewrite(spark, sf_dir):
    return frame(spark, PATHS, "database string, path string").select("database", names.search_path(F.col("path"), F.col("database")).alias("path"))


STATEMENTS = [
    ("CREATE SCHEMA app;", "schema", "app", "pre"), ("CREATE EXTENSION IF NOT EXISTS hstore;", "extension", "hstore", "pre"), ("CREATE TYPE app.mood AS ENUM ('x');", "type", "app.mood", "pre"),
    ("CREATE FUNCTION app.f(a int) RETURNS int LANGUAGE sql AS 'select 1';", "function", "app.f", "pre"), ("CREATE TABLE app.t (a int);", "table", "app.t", "pre"), ("CREATE VIEW app.v AS SELECT 1;", "view", "app.v", "pre"),
    ("CREATE SEQUENCE app.s;", "sequence", "app.s", "pre"), ("CREATE UNIQUE INDEX i ON app.t (a);", "index", "i", "post"), ("CREATE INDEX j ON app.t (a);", "index", "j", "post"), ("CREATE TRIGGER g AFTER INSERT ON app.t EXECUTE FUNCTION f();", "trigger", "g", "skip"),
    ("CREATE EVENT TRIGGER e ON ddl_command_end EXECUTE FUNCTION f();", "event_trigger", "e", "skip"), ("CREATE POLICY p ON app.t;", "policy", "p", "skip"), ("GRANT SELECT ON app.t TO me;", None, None, "skip"), ("COMMENT ON TABLE app.t IS 'x';", None, None, "skip"),
    ("SET search_path = '';", None, None, "pre"), ("ALTER TABLE app.t OWNER TO me;", None, None, "skip"), ("ALTER TABLE app.t ENABLE ROW LEVEL SECURITY;", None, None, "skip"), ("ALTER TABLE ONLY app.t REPLICA IDENTITY FULL;", None, None, "skip"),
    ("ALTER TABLE ONLY app.t ADD CONSTRAINT k PRIMARY KEY (a);", None, None, "post"), ("ALTER TABLE ONLY app.t ADD CONSTRAINT c CHECK (a > 0);", None, None, "post"), ("ALTER TABLE app.t CLUSTER ON i;", None, None, "post"), ("ALTER INDEX i ATTACH PARTITION j;", None, None, "skip"),
    ("ALTER TABLE app.t ADD COLUMN b int;", None, None, "pre"), ("SELECT 1;", None, None, "pre"),
]


@query(f"SELECT statement, kind, name FROM {values(STATEMENTS, 'statement, kind, name, route')}")
def object_creation(spark, sf_dir):
    kind, name = advisor.object_created(F.col("statement"))
    return frame(spark, [(s[0],) for s in STATEMENTS], "statement string").select("statement", kind.alias("kind"), name.alias("name"))


@query(f"SELECT kind, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names FROM {values(STATEMENTS, 'statement, kind, name, route')} WHERE kind IS NOT NULL GROUP BY kind")
def objects_by_type(spark, sf_dir):
    found = object_creation(spark, sf_dir).where("kind IS NOT NULL")
    return found.groupBy("kind").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("name")), ",").alias("names"))


@query(f"SELECT statement, route FROM {values(STATEMENTS, 'statement, kind, name, route')}")
def restore_routing(spark, sf_dir):
    return frame(spark, [(s[0],) for s in STATEMENTS], "statement string").select("statement", advisor.routing(F.col("statement")).alias("route"))


POST = [("CREATE UNIQUE INDEX i ON t (a);", True), ("CREATE INDEX j ON t (a);", False), ("ALTER TABLE t ADD CONSTRAINT k PRIMARY KEY (a);", True), ("ALTER TABLE t ADD CONSTRAINT u UNIQUE (a, b);", True), ("ALTER TABLE t ADD CONSTRAINT f FOREIGN KEY (a) REFERENCES s (b);", True), ("ALTER TABLE t ADD CONSTRAINT c CHECK (a > 0);", False), ("ALTER TABLE t ADD CONSTRAINT x EXCLUDE USING gist (a WITH =);", False), ("ALTER TABLE t CLUSTER ON i;", False), ("ALTER TABLE t ADD CONSTRAINT c CHECK (a > 0), ADD COLUMN b int;", True)]


@query(f"SELECT statement, kept FROM {values(POST, 'statement, kept')}")
def post_data_filter(spark, sf_dir):
    return frame(spark, [(s,) for s, _ in POST], "statement string").select("statement", advisor.post_data_kept(F.col("statement")).alias("kept"))


CONSTRAINTS = [("f1", "t", "f", [1]), ("f2", "t", "f", [2, 3]), ("f3", "t", "f", [3, 2]), ("f4", "u", "f", [1]), ("f5", "u", "f", [2, 1]), ("p1", "t", "p", [4]), ("f6", "u", "f", [3])]
INDEXES = [("i1", "t", [3, 2], 2, True, True), ("i2", "t", [4, 1], 2, True, False), ("i3", "u", [1, 2], 1, False, True), ("i4", "u", [3, 1, 2], 3, False, False), ("i5", "u", [2], 1, True, True)]
COLUMNS = [("t", 1, "a"), ("t", 2, "b"), ("t", 3, "Odd Name"), ("t", 4, "d"), ("u", 1, "a"), ("u", 2, "b"), ("u", 3, "c")]
CATALOG_SQL = f"WITH c AS {values(CONSTRAINTS, 'conname, conrelid, contype, conkey')}, i AS {values(INDEXES, 'indexrelid, indrelid, indkey, indnkeyatts, indisunique, indisvalid')}, a AS {values(COLUMNS, 'attrelid, attnum, attname')}"


def catalog_frames(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (frame(spark, CONSTRAINTS, "conname string, conrelid string, contype string, conkey array<int>"), frame(spark, INDEXES, "indexrelid string, indrelid string, indkey array<int>, indnkeyatts int, indisunique boolean, indisvalid boolean"), frame(spark, COLUMNS, "attrelid string, attnum int, attname string"))


@query(CATALOG_SQL + """, bare AS (SELECT * FROM c WHERE contype = 'f' AND NOT EXISTS (SELECT 1 FROM i WHERE indrelid = conrelid
    AND list_has_all(indkey[1:least(len(conkey), indnkeyatts)], conkey) AND list_has_all(conkey, indkey[1:least(len(conkey), indnkeyatts)]))),
e AS (SELECT conname, conrelid, unnest(conkey) AS attnum, generate_subscripts(conkey, 1) AS place FROM bare)
SELECT conrelid, conname, 'CREATE INDEX ON ' || conrelid || '(' || string_agg(CASE WHEN regexp_matches(attname, '^[a-z_][a-z0-9_]*$') THEN attname ELSE '"' || attname || '"' END, ',' ORDER BY place) || ')' AS statement
FROM e JOIN a ON conrelid = attrelid AND e.attnum = a.attnum GROUP BY conrelid, conname""")
def missing_fk_index(spark, sf_dir):
    return advisor.missing_fk_indexes(*catalog_frames(spark))


@query(CATALOG_SQL + "SELECT indexrelid, 'DROP INDEX CONCURRENTLY ' || indexrelid AS statement FROM i WHERE NOT indisvalid AND indexrelid <> 'i4'")
def invalid_index(spark, sf_dir):
    return advisor.invalid_indexes(catalog_frames(spark)[1], frame(spark, [("i4",)], "relation string"))


@query(CATALOG_SQL + "SELECT indrelid, count(*) FILTER (WHERE indisunique) AS n_unique, count(*) FILTER (WHERE indisunique) > 1 AS several FROM i GROUP BY indrelid")
def unique_indexes(spark, sf_dir):
    return advisor.has_several_unique(catalog_frames(spark)[1])


@query("""SELECT * FROM (VALUES ('app', 't'), ('app', 'u')) AS v("schema", name)""")
def extension_objects(spark, sf_dir):
    """Objects of no ignored schema and no extension; an object may be owned twice."""
    objects = frame(spark, [("app", "t"), ("app", "u"), ("app", "ext_f"), ("audit", "log")], "schema string, name string")
    owned = frame(spark, [("app", "ext_f"), ("app", "ext_f")], "schema string, name string")
    return filters.without_objects(objects, ["audit"], owned)


@query(LOG + """SELECT DISTINCT database || '_public' AS "schema" FROM log WHERE database <> 'db0'""")
def missing_schemas(spark, sf_dir):
    mapped = log_of(spark, sf_dir).select(names.federated_schema(F.lit("public"), F.col("database")).alias("schema"))
    return filters.missing_schemas(mapped, frame(spark, [("db0_public",), ("other",)], "schema string"))


@query("SELECT CAST(o_orderkey % 8 AS INTEGER) AS part, count(*) AS n, sum(o_orderkey) AS keys FROM orders GROUP BY ALL")
def partitioned_scan(spark, sf_dir):
    return read(spark, sf_dir, "orders").groupBy(snapshot.part(F.col("o_orderkey"), 8).alias("part")).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@query("""WITH c AS (SELECT 'db' || (c_nationkey % 3) || '_sales' AS federated_schema, c_custkey, c_mktsegment FROM customer)
SELECT federated_schema, c_mktsegment, count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers, round(sum(o_totalprice), 2) AS revenue FROM c JOIN orders ON o_custkey = c_custkey GROUP BY ALL""")
def federated_join(spark, sf_dir):
    """Customers of several sources joined with the orders of another one."""
    customers = read(spark, sf_dir, "customer").select(names.federated_schema(F.lit("sales"), F.concat(F.lit("db"), F.col("c_nationkey") % 3)).alias("federated_schema"), "c_custkey", "c_mktsegment")
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    return customers.join(orders, F.col("o_custkey") == F.col("c_custkey")).groupBy("federated_schema", "c_mktsegment").agg(F.count("*").alias("n_orders"), F.countDistinct("o_custkey").alias("n_customers"), F.round(F.sum("o_totalprice"), 2).alias("revenue"))


@query("""SELECT 42 AS i, CAST(-7 AS BIGINT) AS b, true AS t, CAST('1.50' AS DECIMAL(10,2)) AS n, 'x y' AS s, '0AFF' AS h, DATE '2020-02-29' AS d, 1583020800000000 AS at_us, 4294967296 AS p""")
def typed_values(spark, sf_dir):
    """Values of a record in their source types."""
    record = '{"columnnames":["i","b","t","n","s","h","d","at","p"],"columnvalues":[42,-7,true,1.50,"x y","\\\\x0aff","2020-02-29","2020-03-01 02:00:00+02","1/0"]}'
    kinds = {"i": "int4", "b": "int8", "t": "bool", "n": "numeric(10,2)", "s": "text", "h": "bytea", "d": "date", "at": "timestamptz", "p": "pg_lsn"}
    r = frame(spark, [(record,)], "payload string").select(payload.parsed(F.col("payload")).alias("r"))
    typed = r.select(*(payload.value_at(F.col("r.columnnames"), F.col("r.columnvalues"), c, t).alias(c) for c, t in kinds.items()))
    return typed.select("i", "b", "t", "n", "s", F.hex("h").alias("h"), "d", F.unix_micros("at").alias("at_us"), "p")


ARRAYS = [("{a,b}", "a|b"), ('{"a, b",NULL,c}', "a, b|?|c"), ("{}", ""), ('{"say \\"x\\""}', 'say "x"'), ("none", None)]


@query(f"SELECT literal, parsed FROM {values(ARRAYS, 'literal, parsed')}")
def array_literals(spark, sf_dir):
    return frame(spark, [(a,) for a, _ in ARRAYS], "literal string").select("literal", F.array_join(payload.array_literal(F.col("literal")), "|", "?").alias("parsed"))


@query("""SELECT r_name, '"' || r_name || '"."x""y"' AS qualified, CASE WHEN regexp_matches(r_name, '^[a-z_][a-z0-9_]*$') THEN r_name ELSE '"' || r_name || '"' END AS quoted FROM region""")
def identifier_quoting(spark, sf_dir):
    return read(spark, sf_dir, "region").select("r_name", names.qualified(F.col("r_name"), F.lit('x"y')).alias("qualified"), names.quoted_if_needed(F.col("r_name")).alias("quoted"))


@query("SELECT * FROM (VALUES (1, true), (2, false), (3, false)) AS v(id, stop)")
def stop_request(spark, sf_dir):
    rows = [(1, "COMMENT ON TABLE t IS 'KILL_ME'"), (2, "COMMENT ON TABLE t IS 'x'"), (3, "SELECT 'KILL_ME'")]
    return frame(spark, rows, "id int, q string").select("id", filters.stop_requested(F.col("q")).alias("stop"))


SCRIPT = """-- dump
CREATE TABLE app.t (a text DEFAULT 'x;y'); /* a /* nested; */ comment; */
CREATE FUNCTION app.f() RETURNS int LANGUAGE sql AS $body$ SELECT count(*)::int FROM app.t; $body$;
\\connect x
ALTER SEQUENCE app.s OWNED BY app.t.a; SELECT nextval('app.s'::regclass); COMMENT ON TABLE app."T;2" IS 'it''s';
"""
MOVED = [
    (0, "-- dump\nCREATE TABLE db0_app.t (a text DEFAULT 'x;y');"),
    (1, "/* a /* nested; */ comment; */\nCREATE FUNCTION db0_app.f() RETURNS int LANGUAGE sql AS $body$ SELECT count(*)::int FROM db0_app.t; $body$;"),
    (2, "ALTER SEQUENCE db0_app.s OWNED BY db0_app.t.a;"),
    (3, "SELECT nextval('db0_app.s'::regclass);"),
    (4, "COMMENT ON TABLE db0_app.\"T;2\" IS 'it''s';"),
]


@query(f"SELECT position, statement FROM {values(MOVED, 'position, statement')}")
def script_translate(spark, sf_dir):
    """A dump split into statements, its schema moved."""
    from ..operators.sqltext import Script

    script = Script.from_text(SCRIPT).translate({"app": "db0_app"})
    return frame(spark, list(enumerate(script.statements)), "position int, statement string")


USERS = {"user_id": "int8", "event_type": "text", "value": "float8", "props": "text"}
#: Where the statements of the replay queries stand in the log.
FENCE = 500


def user_specs() -> list:
    from .federate import TableSpec

    return [TableSpec(f"db{i}", "public", "users", ("user_id",), dict(USERS)) for i in range(3)]


def sequenced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.payloads(log_of(spark, sf_dir)).withColumn("seq", F.lit(0).cast("bigint"))


def ddl_rows(spark: SparkSession, databases: list[str], statement: str, seq: int) -> DataFrame:
    """Spool rows with a statement behind the change at FENCE, in its transaction."""
    import json

    record = json.dumps({"kind": "insert", "schema": "public", "table": "sql_ddl_statements", "columnnames": ["current_query", "search_path"], "columnvalues": [statement, '"$user", public']})
    rows = frame(spark, [(d, FENCE, FENCE // changelog.XACT, record, d.replace("db", "slot"), seq) for d in databases], "database string, lsn_start bigint, xid bigint, payload string, source_slotname string, seq bigint")
    return rows.withColumns({"insert_timestamp": F.lit(None).cast("timestamp"), "xid_timestamp": F.lit(None).cast("timestamp")})


def federated_users(warehouse) -> DataFrame:
    out = None
    for i in range(3):
        found = warehouse.read(f"db{i}_public.users")
        found = found.select(F.lit(f"db{i}").alias("database"), *found.columns)
        out = found if out is None else out.unionByName(found)
    return out


LATEST = """, r AS (SELECT *, row_number() OVER (PARTITION BY database, user_id ORDER BY lsn DESC) AS rn,
    last_value(CASE WHEN has_props THEN props END IGNORE NULLS) OVER (PARTITION BY database, user_id ORDER BY lsn
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS p FROM log)
"""


@query(LOG + LATEST + f"SELECT database, user_id, event_type, p AS props, CASE WHEN lsn > {FENCE} THEN value END AS value FROM r WHERE rn = 1 AND kind <> 'delete'")
def replay_ddl_fence(spark, sf_dir):
    """A column dropped and added again inside the log: what it held before is gone, and later changes fill it."""
    from .federate import Warehouse, replay_batch

    spool = sequenced(spark, sf_dir)
    databases = ["db0", "db1", "db2"]
    spool = spool.unionByName(ddl_rows(spark, databases, "ALTER TABLE users DROP COLUMN value", 1)).unionByName(ddl_rows(spark, databases, "ALTER TABLE public.users ADD COLUMN value double precision", 2))
    warehouse = Warehouse(spark, store.scratch(spark, "fence"), buckets=4)
    replay_batch(warehouse, spool, user_specs(), 0)
    return federated_users(warehouse)


@query(LOG + LATEST + "SELECT database, user_id, event_type, value, p AS props FROM r WHERE rn = 1 AND kind <> 'delete'")
def replay_same_position(spark, sf_dir):
    """Sixteen changes share a position and follow one another by their sequence; all are sent twice, in two batches."""
    from .federate import Warehouse, replay_batch

    spool = sequenced(spark, sf_dir).withColumn("seq", F.col("lsn_start")).withColumn("lsn_start", F.floor(F.col("lsn_start") / 16).cast("bigint"))
    warehouse = Warehouse(spark, store.scratch(spark, "positions"), buckets=4)
    replay_batch(warehouse, spool.where("lsn_start <= 40").unionAll(spool.where("lsn_start <= 20")), user_specs(), 0)
    replay_batch(warehouse, spool.where("lsn_start > 25"), user_specs(), 1)
    return federated_users(warehouse)


@query(LOG + f""", s AS (SELECT min(lsn) AS first FROM log WHERE database = 'db1' AND xid = {FENCE // changelog.XACT}),
kept AS (SELECT * FROM log WHERE database <> 'db1' OR lsn < (SELECT least(coalesce(first, {FENCE}), {FENCE}) FROM s)),
q AS (SELECT *, row_number() OVER (PARTITION BY database, user_id ORDER BY lsn DESC) AS rn FROM kept)
SELECT database, max(lsn) AS progress, count(*) FILTER (WHERE rn = 1 AND kind <> 'delete') AS live FROM q GROUP BY database""")
def replay_stop(spark, sf_dir):
    """An unknown statement in one database stops it before its transaction; the others go on, and all is committed."""
    from .federate import ReplayStopped, Warehouse, replay_batch

    spool = sequenced(spark, sf_dir).unionByName(ddl_rows(spark, ["db1"], "TRUNCATE users", 1))
    warehouse = Warehouse(spark, store.scratch(spark, "stop"), buckets=4)
    try:
        replay_batch(warehouse, spool, user_specs(), 0)
        raise AssertionError("the replay went on")
    except ReplayStopped:
        pass
    progress = warehouse.manifest()["progress"]
    rows = frame(spark, [(s.replace("slot", "db"), n) for s, n in progress.items()], "database string, progress bigint")
    return rows.join(federated_users(warehouse).groupBy("database").agg(F.count("*").alias("live")), "database", "left").select("database", "progress", F.coalesce("live", F.lit(0)).alias("live"))


@query(LOG + "SELECT database, count(*) AS n, min(lsn) AS first_lsn, max(lsn) AS last_lsn, max(lsn) + CASE WHEN database = 'db2' THEN 10 ELSE 0 END AS flushed FROM log GROUP BY database")
def spool_append(spark, sf_dir):
    """Batches appended to the spool, one of them twice; keepalives advance an idle slot, and never turn it back."""
    from .spool import Spool

    rows = changelog.payloads(log_of(spark, sf_dir))
    spool = Spool(spark, store.scratch(spark, "spool"))
    spool.bootstrap()
    for batch, part in (("a", "xid % 2 = 0"), ("a", "xid % 2 = 0"), ("b", "xid % 2 = 1")):
        spool.append(rows.where(part), batch)
    spool.keepalive("slot2", spool.last_flushed("slot2") + 10)
    spool.keepalive("slot1", 1)
    flushed = frame(spark, [(s.replace("slot", "db"), n) for s, n in spool.manifest()["progress"].items()], "database string, flushed bigint")
    return spool.ordered().groupBy("database").agg(F.count("*").alias("n"), F.min("lsn_start").alias("first_lsn"), F.max("lsn_start").alias("last_lsn")).join(flushed, "database")


@query("""SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 4 = 0 THEN 'new' ELSE c_mktsegment END AS c_mktsegment, 900 AS progress FROM customer WHERE c_custkey % 5 <> 1""")
def backup_then_changes(spark, sf_dir):
    """A snapshot copied with its slot's position, then changes of which only those after that position count."""
    from . import federate

    base = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    spec = federate.TableSpec("db0", "sales", "customer", ("c_custkey",), {"c_custkey": "int8", "c_name": "text", "c_nationkey": "int8", "c_mktsegment": "text"})
    root = store.scratch(spark, "backup")
    base.write.parquet(f"{root}/pinned")
    snapshot.create_slot(spark, root, "slot0", 700, {"customer": f"{root}/pinned"})
    warehouse = federate.Warehouse(spark, f"{root}/tables", buckets=4)
    violations = federate.base_backup(warehouse, {"customer": snapshot.read_snapshot(spark, root, "slot0", "customer")}, [spec], "slot0", 700)
    assert violations == {"key of customer": 0}
    key = F.col("c_custkey").cast("string")
    old = F.concat(F.lit('"oldkeys":{"keynames":["c_custkey"],"keyvalues":['), key, F.lit("]}}"))
    update = F.concat(F.lit('{"kind":"update","schema":"sales","table":"customer","columnnames":["c_mktsegment"],"columnvalues":["new"],'), old)
    delete = F.concat(F.lit('{"kind":"delete","schema":"sales","table":"customer",'), old)
    row = lambda lsn, p: (F.lit("db0").alias("database"), F.lit(lsn).cast("bigint").alias("lsn_start"), F.lit(1).cast("bigint").alias("xid"), p.alias("payload"), F.lit("slot0").alias("source_slotname"))
    changes = base.where("c_custkey % 4 = 0").select(*row(800, update)).unionAll(base.where("c_custkey % 5 = 1").select(*row(900, delete))).unionAll(base.where("c_custkey % 3 = 0").select(*row(600, delete)))
    federate.replay_batch(warehouse, changes, [spec], 1)
    return warehouse.read("db0_sales.customer").withColumn("progress", F.lit(warehouse.manifest()["progress"]["slot0"]))


@query("""SELECT n_nationkey AS id, 'COMMENT ON COLUMN db' || (n_nationkey % 3) || '_app."' || n_name || '".c IS ''app.t; ' || n_name || ''';' AS statement FROM nation
UNION ALL SELECT 100 + n_nationkey, 'GRANT SELECT ON db' || (n_nationkey % 3) || '_app.t' || n_nationkey || ', other.u TO "' || n_name || '";' FROM nation
UNION ALL SELECT 200 + n_nationkey, 'SELECT app.id, db' || (n_nationkey % 3) || '_app.f(app.id) FROM db' || (n_nationkey % 3) || '_app.t JOIN x.app ON app.id = t.id;' FROM nation""")
def statements_moved(spark, sf_dir):
    """A file of statements made from a table: split, checked and moved to each row's federated schema."""
    from ..operators.sqltext import Remapper
    from ..sources.sqlfiles import read_statements

    comment = F.concat(F.lit("COMMENT ON COLUMN app.\""), "n_name", F.lit("\".c IS 'app.t; "), "n_name", F.lit("';"))
    grant = F.concat(F.lit("GRANT SELECT ON app.t"), F.col("n_nationkey").cast("string"), F.lit(', other.u TO "'), "n_name", F.lit('";'))
    select = F.lit("SELECT app.id, app.f(app.id) FROM app.t JOIN x.app ON app.id = t.id;")
    rows = read(spark, sf_dir, "nation")
    path = store.scratch(spark, "statements")
    ids = None
    for n, text in enumerate((comment, grant, select)):
        part = rows.select((F.col("n_nationkey") + 100 * n).cast("bigint").alias("id"), F.concat(F.lit("/* "), (F.col("n_nationkey") + 100 * n).cast("string"), F.lit(" */ "), text).alias("value"))
        ids = part if ids is None else ids.unionAll(part)
    ids.orderBy("id").select("value").write.text(path)
    found = read_statements(spark, path).where("error IS NULL")
    number = F.regexp_extract("statement", "[0-9]+", 0).cast("bigint")
    move = F.udf(lambda text, d: Remapper({"app": f"{d}_app"}).statement(text), "string")
    moved = found.select(number.alias("id"), F.regexp_replace("statement", r"^/\* [0-9]+ \*/ ", "").alias("s"))
    return moved.select("id", move("s", F.concat(F.lit("db"), (F.col("id") % 100) % 3)).alias("statement"))
