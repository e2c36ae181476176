"""The set-based fold against a row-by-row interpreter, over random change logs."""

import random

import pytest
from pyspark.sql import functions as F

from tidefold.operators import fold
from tidefold.plans.federate import TableSpec, Warehouse, base_backup, replay_batch

SCHEMA = "database string, lsn_start bigint, xid bigint, payload string, source_slotname string"
SPEC = TableSpec("db0", "public", "t", ("id",), {"id": "int8", "a": "text", "b": "int4"})


def record(kind, key=None, **columns):
    import json

    out = {"kind": kind, "schema": "public", "table": "t"}
    if kind != "delete":
        out |= {"columnnames": list(columns), "columnvalues": list(columns.values())}
    if kind != "insert":
        out["oldkeys"] = {"keynames": ["id"], "keyvalues": [key]}
    return json.dumps(out)


def random_log(seed, n, moves=True):
    """Records and the state after them."""
    r, state, rows = random.Random(seed), {}, []
    for lsn in range(1, n + 1):
        free = [k for k in range(12) if k not in state]
        what = r.choice(["insert", "update", "update", "delete"] + ["move"] * moves)
        if what == "insert" and free:
            k = r.choice(free)
            state[k] = {"a": r.choice([None, "x", "y"]), "b": r.choice([None, 1, 2])}
            rows.append((lsn, record("insert", id=k, **state[k])))
        elif state and what in ("update", "move"):
            k = r.choice(list(state))
            to = r.choice(free) if what == "move" and free else k
            some = {c: v for c, v in {"a": r.choice([None, "u", "v"]), "b": r.choice([None, 7, 8])}.items() if r.random() < 0.5}
            state[to] = state.pop(k) | some
            rows.append((lsn, record("update", k, **({"id": to} if to != k or r.random() < 0.5 else {}), **some)))
        elif state and what == "delete":
            k = r.choice(list(state))
            del state[k]
            rows.append((lsn, record("delete", k)))
    return rows, {(k, v["a"], v["b"]) for k, v in state.items()}


def spool(spark, rows):
    return spark.createDataFrame([("db0", lsn, lsn, p, "slot0") for lsn, p in rows], SCHEMA)


def state_of(warehouse):
    return {tuple(r) for r in warehouse.read("db0_public.t").collect()}


@pytest.mark.parametrize(("seed", "moves"), [(1, False), (2, True), (3, True)])
def test_fold_equals_interpreter_however_batches_are_cut(spark, tmp_path, seed, moves):
    rows, expected = random_log(seed, 70, moves)
    one = Warehouse(spark, str(tmp_path / "one"))
    assert replay_batch(one, spool(spark, rows), [SPEC], 0)
    assert state_of(one) == expected
    several = Warehouse(spark, str(tmp_path / "several"))
    for i, a in enumerate(range(0, len(rows), 30)):
        assert replay_batch(several, spool(spark, rows[max(0, a - 5) : a + 30]), [SPEC], i)  # rows sent again do no harm
    assert state_of(several) == expected
    assert not replay_batch(several, spool(spark, rows), [SPEC], 0)  # a batch is applied once
    assert several.manifest()["progress"] == {"slot0": rows[-1][0]}


def test_base_backup_then_changes(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    base = spark.createDataFrame([(1, "x", 1), (2, "y", None)], "id bigint, a string, b int")
    assert base_backup(w, {"t": base}, [SPEC], "slot0", 100) == {"key of t": 0}
    rows = [(99, record("delete", 1)), (101, record("update", 1, a=None)), (102, record("delete", 2)), (103, record("insert", id=3, a="n", b=5))]
    replay_batch(w, spool(spark, rows), [SPEC], 1)
    assert state_of(w) == {(1, None, 1), (3, "n", 5)}
    w.register()
    assert spark.sql("SELECT count(*) FROM db0_public__t").first()[0] == 2
    w.vacuum()
    assert state_of(w) == {(1, None, 1), (3, "n", 5)}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "id bigint, a string, kind string, lsn bigint")
    assert fold.fold(none, ["id"], {"a": F.lit(True)}).collect() == []
    assert fold.violations(none, ["id"]).collect() == []
    assert fold.fold_key_changes(none.withColumn("to", F.col("id")), "id", "to", {"a": F.lit(True)}).collect() == []


def test_unknown_operation_is_an_error(spark):
    rows = spark.createDataFrame([(1, "truncate", 1)], "id bigint, kind string, lsn bigint")
    with pytest.raises(Exception, match="unknown operation"):
        fold.violations(rows, ["id"]).collect()


def ddl_record(query, path="public"):
    import json

    return json.dumps({"kind": "insert", "schema": "public", "table": "sql_ddl_statements", "columnnames": ["id", "current_query", "search_path", "command_tags"], "columnvalues": [1, query, path, "{}"]})


def test_ddl_in_a_batch(spark, tmp_path):
    """Changes before a statement are applied to the old columns, those after it to the new ones, in one commit."""
    from tidefold.plans.federate import ReplayStopped

    w = Warehouse(spark, str(tmp_path / "w"))
    replay_batch(w, spool(spark, [(1, record("insert", id=1, a="x", b=1)), (2, record("insert", id=2, a="y", b=2))]), [SPEC], 0)
    rows = [
        (3, record("update", 1, a="z")),
        (4, ddl_record("ALTER TABLE public.t ADD COLUMN c bigint, DROP COLUMN b")),
        (5, record("insert", id=3, a="n", c=7)),
        (6, ddl_record("COMMENT ON TABLE t IS 'x'")),
        (7, ddl_record("ALTER TABLE t RENAME COLUMN a TO name")),
        (8, record("update", 2, name="w", c=5)),
        (9, ddl_record("CREATE TABLE public.u (k int PRIMARY KEY, v numeric(6,2) NOT NULL DEFAULT 0, CHECK (v > 0))")),
        (10, record("insert", k=1, v="2.50").replace('"table": "t"', '"table": "u"')),
    ]
    assert replay_batch(w, spool(spark, rows), [SPEC], 1)
    assert w.read("db0_public.t").columns == ["id", "name", "c"] and state_of(w) == {(1, "z", None), (2, "w", 5), (3, "n", 7)}
    assert [(r["k"], float(r["v"])) for r in w.read("db0_public.u").collect()] == [(1, 2.5)]
    more = [(11, ddl_record("ALTER TABLE u RENAME TO v")), (12, record("delete", 1)), (13, ddl_record("TRUNCATE t")), (14, record("delete", 2))]
    with pytest.raises(ReplayStopped, match="TRUNCATE"):
        replay_batch(w, spool(spark, more), [SPEC], 2)
    assert state_of(w) == {(2, "w", 5), (3, "n", 7)} and w.manifest()["progress"] == {"slot0": 12} and w.read("db0_public.u") is None
    assert replay_batch(w, spool(spark, more), [SPEC], 2, resolved=[("db0", 13)])  # tried again after the repair
    assert state_of(w) == {(3, "n", 7)} and w.manifest()["quarantine"][0]["statement"] == "TRUNCATE t" and w.read("db0_public.v").count() == 1
    kill = [(15, ddl_record("COMMENT ON TABLE t IS 'KILL_ME'")), (16, record("delete", 3))]
    with pytest.raises(ReplayStopped, match="stop requested"):
        replay_batch(w, spool(spark, kill), [SPEC], 3)
    assert state_of(w) == {(3, "n", 7)}
    assert replay_batch(w, spool(spark, [(17, ddl_record("DROP TABLE v, t"))]), [SPEC], 3) and w.read("db0_public.t") is None
    w.vacuum()


def test_the_whole_transaction_of_a_stop_waits(spark, tmp_path):
    from tidefold.plans.federate import ReplayStopped

    w = Warehouse(spark, str(tmp_path / "w"))
    rows = [("db0", 1, 1, record("insert", id=1, a="x", b=1), "slot0"), ("db0", 2, 2, record("insert", id=2, a="x", b=1), "slot0"), ("db0", 3, 2, ddl_record("VACUUM t"), "slot0")]
    with pytest.raises(ReplayStopped):
        replay_batch(w, spark.createDataFrame(rows, SCHEMA), [SPEC], 0)
    assert state_of(w) == {(1, "x", 1)} and w.manifest()["progress"] == {"slot0": 1}
    assert replay_batch(w, spark.createDataFrame(rows, SCHEMA), [SPEC], 0, unknown="quarantine") and len(state_of(w)) == 2


def test_a_slot_without_progress_begins_before_all_positions(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    rows = [(-1, record("insert", id=1, a="x", b=1)), (0, record("insert", id=2, a="y", b=2)), (1, record("insert", id=3, a="z", b=3))]
    assert replay_batch(w, spool(spark, rows[:1]), [SPEC], 0) and w.manifest()["progress"] == {"slot0": -1}
    assert replay_batch(w, spool(spark, [*rows[:2], (0, record("update", 1, a="n"))]), [SPEC], 1) and w.manifest()["progress"] == {"slot0": 0}
    assert replay_batch(w, spool(spark, [(0, record("delete", 1)), *rows[2:]]), [SPEC], 2)  # what is sent again is passed over
    assert state_of(w) == {(1, "n", 1), (2, "y", 2), (3, "z", 3)}


def test_replay_stop_applies_the_change_at_position_0(spark, tmp_path):
    """A user of db1 whose only change is at position 0."""
    import duckdb

    from tidefold.plans import catalog

    user, kind = "CASE id WHEN 0 THEN 1 ELSE 2 + id % 8 END AS user_id", "CASE id WHEN 0 THEN 'signup' ELSE 'click' END AS event_type"
    rows = spark.range(0, 700).selectExpr("id AS event_id", "timestamp_ntz '2024-01-01 00:00:00' AS ts", user, kind, "id / 2 AS value", "'{}' AS props")
    rows.write.parquet(str(tmp_path / "events.parquet"))
    found = {tuple(r) for r in catalog.replay_stop(spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    assert found == set(con.execute(catalog.ORACLE["replay_stop"]).fetchall())
    assert {r[0]: r[2] for r in found}["db1"] == 3  # users 1, 4 and 7


def test_changes_of_one_position(spark, tmp_path):
    """A position may have many changes: they follow one another by their sequence; equal rows are sent again."""
    w = Warehouse(spark, str(tmp_path / "w"))
    rows = [("db0", 5, 1, record("insert", id=1, a="x", b=1), "slot0", 0), ("db0", 5, 1, record("insert", id=2, a="y", b=2), "slot0", 1), ("db0", 5, 1, record("update", 1, a="z"), "slot0", 2)]
    replay_batch(w, spark.createDataFrame(rows + rows[1:2], SCHEMA + ", seq bigint"), [SPEC], 0)
    assert state_of(w) == {(1, "z", 1), (2, "y", 2)}


def test_unknown_kinds_and_refused_changes(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    with pytest.raises(Exception, match="unknown operation: truncate"):
        replay_batch(w, spool(spark, [(1, record("truncate", 1))]), [SPEC], 0)
    rows = [(1, record("insert", id=1, a="x", b=1)), (2, record("update", 1, id=2)), (3, record("update", 1, a="y"))]
    with pytest.raises(ValueError, match="change of a missing key"):
        replay_batch(w, spool(spark, rows), [SPEC], 0, strict=True)
    assert replay_batch(w, spool(spark, rows[:2]), [SPEC], 0, strict=True)
    with pytest.raises(ValueError, match="insert of a live key"):
        replay_batch(w, spool(spark, [(4, record("insert", id=2, a="x", b=1))]), [SPEC], 1, strict=True)
    assert state_of(w) == {(2, "x", 1)}


def test_only_touched_buckets_are_written(spark, tmp_path):
    import os

    w = Warehouse(spark, str(tmp_path / "w"), buckets=8)
    other = TableSpec("db0", "public", "o", ("id",), SPEC.types)
    replay_batch(w, spool(spark, [(i, record("insert", id=i, a="x", b=i)) for i in range(1, 60)]), [SPEC, other], 0)
    files = {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(tmp_path / "w") for f in names if f.endswith(".parquet")}
    before = w.manifest()["tables"]
    replay_batch(w, spool(spark, [(100, record("update", 7, a="new"))]), [SPEC, other], 1)
    after = w.manifest()["tables"]
    changed = [b for b in after["db0_public.t"]["files"] if after["db0_public.t"]["files"][b] != before["db0_public.t"]["files"][b]]
    assert len(changed) == 1 and after["db0_public.o"] == before["db0_public.o"]
    assert all(os.stat(f).st_mtime_ns == t for f, t in files.items())
    w.vacuum()
    assert w.read("db0_public.t").count() == 59 and w.read("db0_public.t").where("a = 'new'").count() == 1
    assert sum(not os.path.exists(f) for f in files) > 0


@pytest.mark.parametrize(("statement", "wanted"), [
    ('CREATE TABLE "public".t (a int REFERENCES public.d (x))', "CREATE TABLE db1_public.t (a int REFERENCES db1_public.d (x))"),
    ("DROP TABLE public.a, public.b", "DROP TABLE db1_public.a, db1_public.b"),
    ("ALTER TABLE public.t SET SCHEMA other", "ALTER TABLE db1_public.t SET SCHEMA db1_other"),
    ("ALTER TABLE public.t DROP CONSTRAINT c", "ALTER TABLE db1_public.t DROP CONSTRAINT IF EXISTS c"),
    ("CREATE VIEW public.v AS SELECT public.t.a, t.b FROM public.t", "CREATE VIEW db1_public.v AS SELECT db1_public.t.a, t.b FROM db1_public.t"),
    ("CREATE TABLE public.t (a pg_catalog.int4)", "CREATE TABLE db1_public.t (a pg_catalog.int4)"),
])
def test_ddl_is_moved(statement, wanted):
    from tidefold.operators import ddl

    assert ddl.fixed(statement, "db1") == wanted


def test_ddl_operations():
    from tidefold.operators.ddl import first_schema, operations

    assert operations('CREATE TABLE IF NOT EXISTS t ("A b" character varying(10)[], n double precision DEFAULT (1 + 2), d timestamp with time zone, CONSTRAINT k PRIMARY KEY (n, "A b"));', "s") == [("create", "s.t", ["n", "A b"], {"A b": "character varying[]", "n": "float8", "d": "timestamptz"})]
    assert operations("ALTER TABLE ONLY s.t ALTER COLUMN a TYPE bigint USING a::bigint, ALTER b SET DEFAULT 1, ADD CONSTRAINT k PRIMARY KEY (a), DROP CONSTRAINT c") == [("retype", "s.t", "a", "int8"), ("key", "s.t", ["a"])]
    assert operations("ALTER TABLE t SET SCHEMA z") == [("rename", "public.t", None, "z.t")] and operations("CREATE VIEW v AS SELECT 1") == []
    assert (first_schema('"$user", app'), first_schema(None)) == ("app", "public")
