"""Configuration, snapshots, repair and the driver's entry module."""

import json

import pytest
from pyspark.sql import functions as F

from tidefold.operators import ddl, repair
from tidefold.sources import config, snapshot


def test_replay_config(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"connection_string": "x", "db_options": {"a": {"source_slotname": "s"}, "b": {}}}))
    c = config.replay_config(str(path))
    assert c.nb_threads == 4 and c.slots == {"a": "s"}
    path.write_text("{}")
    with pytest.raises(ValueError, match="connection_string"):
        config.replay_config(str(path))
    assert config.backup_config(str(path)).ignored_schemas == ()


def test_snapshot_is_pinned(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "v0"))
    snapshot.create_slot(spark, str(tmp_path), "s", 7, {"t": str(tmp_path / "v0")})
    assert snapshot.read_snapshot(spark, str(tmp_path), "s", "t").count() == 3
    assert snapshot.create_slot(spark, str(tmp_path), "s", 8, {})["consistent_point"] == 8  # replaced as a whole
    snapshot.drop_slot(spark, str(tmp_path), "s")
    parts = snapshot.jdbc_predicates("id", 3)
    rows = spark.range(-5, 20).selectExpr("id")
    assert sum(rows.where(f"pmod(id, 3) = {i}").count() for i in range(3)) == 25 and len(parts) == 3


def test_repair(spark):
    rows = [("db0", 1, "2024-01-01 00:00:00", '{"schema":"public","table":"t"}', "s"), ("db0", 2, "2024-01-01 00:00:10", '{"schema":"public","table":"sql_ddl_statements"}', "s")]
    spool = spark.createDataFrame(rows, "database string, lsn_start bigint, at string, payload string, source_slotname string").withColumn("insert_timestamp", F.to_timestamp("at"))
    record = repair.next_failed(spool).first().asDict()
    assert record["lsn_start"] == 2
    ran = []
    assert repair.resolve(spool, record, ran.append, "SELECT 1").count() == 1 and ran == ["SELECT 1"]
    with pytest.raises(RuntimeError):
        repair.resolve(spool, record | {"payload": "other"}, ran.append, "SELECT 2")
    assert ran == ["SELECT 1"]


def test_unknown_ddl_stops_by_default(spark):
    events = ddl.statements(spark, [("db0", "TRUNCATE t")])
    with pytest.raises(Exception, match="unknown DDL"):
        ddl.classify(events).collect()
    assert ddl.classify(events, unknown="quarantine").first()["action"] == "quarantine"
    kept = ddl.classify(ddl.statements(spark, [("db0", "CREATE TABLE s.t (a int)")]), keep_schema=True).first()
    assert kept["fixed_ddl"] == "CREATE TABLE s.t (a int)"


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_spool(spark, tmp_path):
    from tidefold.plans.spool import SCHEMA, Spool

    spool = Spool(spark, str(tmp_path / "spool"))
    spool.bootstrap()
    assert spool.read().count() == 0
    rows = [(None, f"db{i % 2}", i, i // 3, "{}", None, f"slot{i % 2}") for i in range(9)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("insert_timestamp", F.timestamp_seconds(F.lit(7)))
    assert spool.append(frame.where("lsn_start < 6"), "a") and spool.append(frame.where("lsn_start >= 6"), "b")
    assert not spool.append(frame, "a")  # tried again
    assert [r["lsn_start"] for r in spool.ordered().collect()] == list(range(9)) and spool.read("db1").count() == 4
    assert (spool.last_flushed("slot0"), spool.last_flushed("slot1"), spool.last_flushed("new")) == (8, 7, 0)
    spool.keepalive("slot1", 20)
    spool.keepalive("slot1", 3)
    assert spool.last_flushed("slot1") == 20
    spool.clean(["a"], str(tmp_path / "archive"))
    assert spool.read().count() == 3 and spark.read.parquet(str(tmp_path / "archive/a")).count() == 6


def test_restore(spark):
    from tidefold.plans.restore import restore_schema

    ran = []

    def execute(s):
        if "bad" in s:
            raise ValueError("no")
        ran.append(s)

    statements = ["CREATE SCHEMA a;", "CREATE TABLE a.t (x int);", "CREATE TABLE a.gone (x int);", "CREATE VIEW a.bad AS SELECT 1;", "GRANT SELECT ON a.t TO me;", "ALTER TABLE a.t ADD CONSTRAINT f FOREIGN KEY (x) REFERENCES a.u (x);", "ALTER TABLE a.u ADD CONSTRAINT k PRIMARY KEY (x);", "CREATE INDEX i ON a.t (x);"]
    out = restore_schema(spark, statements, execute, blacklist={("table", "a.gone")}, failable={("view", "a.bad")})
    assert ran == out.executed == statements[:2] and out.failed == [(statements[3], "no")]
    assert out.post == [statements[6], statements[5]] and set(out.skipped) == {statements[2], statements[4], statements[7]}
    with pytest.raises(ValueError, match="no"):
        restore_schema(spark, ["CREATE VIEW a.bad AS SELECT 1;"], execute)
