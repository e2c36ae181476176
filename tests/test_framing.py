"""Chunks, their order, and the streaming receiver and replayer."""

import json

import pytest
from pyspark.sql import functions as F

from tidefold.operators import framing
from tidefold.plans.federate import TableSpec, Warehouse
from tidefold.streaming import receiver, replayer

CASES = [("{hello", None), ("hello}there", None), ("hello}", None), ("]}", "last"), ('{"xid":1234,"timestamp":"1234.123", "changes": [', "first"), ('{"xid":1234,"other": "blah", "timestamp": "1234.123"', None), ('{"timestamp": "1234.123"', None), (',{"a":1}', "regular"), ('{"a":1}', "regular")]


def test_kinds(spark):
    rows = spark.createDataFrame([(c,) for c, _ in CASES], "chunk string")
    found = {r[0]: r[1] for r in rows.select("chunk", framing.chunk_kind(F.col("chunk"), strict=False)).collect()}
    assert found == dict(CASES)
    with pytest.raises(Exception, match="unknown chunk"):
        rows.select(framing.chunk_kind(F.col("chunk"))).collect()


def test_header_payload_has_33_bytes(spark):
    text = CASES[4][0]
    found = spark.createDataFrame([(text,)], "chunk string").select(F.regexp_extract("chunk", framing.FIRST, 1)).first()[0]
    assert found == '"xid":1234,"timestamp":"1234.123"' and len(found) == 33


def chunk_rows(txns, slot="slot0", finish=True, start=0):
    rows, seq = [], start
    for i, (xid, changes) in enumerate(txns):
        rows.append((slot, "db0", seq, f'{{"xid":{xid},"timestamp":"2024-01-01 00:00:0{i}+00","change":['))
        for j, c in enumerate(changes):
            seq += 1
            rows.append((slot, "db0", seq, ("," if j else "") + c))
        seq += 1
        if finish or i + 1 < len(txns):
            rows.append((slot, "db0", seq, "]}"))
        seq += 1
    return rows


def insert(i):
    return json.dumps({"kind": "insert", "schema": "public", "table": "t", "columnnames": ["id", "a"], "columnvalues": [i, f"v{i}"]})


def test_open_transactions_stay_invisible(spark):
    rows = chunk_rows([(1, [insert(1), insert(2)]), (2, [insert(3)])], finish=False)
    found = framing.assemble(spark.createDataFrame(rows, receiver.CHUNK)).collect()
    assert sorted(json.loads(r["payload"])["columnvalues"][0] for r in found) == [1, 2]
    assert {r["n"] for r in found} == {2}


def test_running_sums(spark):
    from tidefold.operators.running import running_sum

    rows = [(g, i * (1 + g), (i * 7) % 3 if i % 5 else None) for g in range(3) for i in range(50)]
    df = spark.createDataFrame(rows, "g int, o bigint, v int")
    for block_rows in (1, 7, 1000):
        for own in (True, False):
            found = {(r["g"], r["o"]): r["s"] for r in running_sum(df, ["g"], "o", F.col("v"), "s", own=own, block_rows=block_rows).collect()}
            assert found == {(g, o): sum(w or 0 for h, p, w in rows if h == g and (p < o or own and p == o)) for g, o, _ in rows}
    assert running_sum(df.limit(0), ["g"], "o", F.col("v"), "s").collect() == []


def write_chunks(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("".join(json.dumps(dict(zip(("slot", "database", "seq", "chunk"), r, strict=True))) + "\n" for r in rows))


def test_stream_from_chunks_to_table(spark, tmp_path):
    inbox, spool = tmp_path / "in", tmp_path / "spool"
    rows = chunk_rows([(1, [insert(1), insert(2)]), (2, [insert(3)])])
    write_chunks(inbox, "a.json", rows[:6])  # the second transaction is still open
    warehouse = Warehouse(spark, str(tmp_path / "tables"))
    spec = TableSpec("db0", "public", "t", ("id",), {"id": "int8", "a": "text"})

    def step():
        received = receiver.assemble_stream(receiver.chunk_stream(spark, str(inbox), 1))
        receiver.spool_writer(received, str(spool), str(tmp_path / "c1")).awaitTermination(120)
        stream = replayer.spool_stream(spark, str(spool))
        replayer.replay_stream(stream, warehouse, [spec], str(tmp_path / "c2"), archive=str(tmp_path / "archive")).awaitTermination(120)
        return sorted(r["id"] for r in warehouse.read("db0_public.t").collect())

    assert step() == [1, 2]
    write_chunks(inbox, "b.json", rows[4:])  # the source sends some chunks again
    assert step() == [1, 2, 3]
    assert replayer.progress_report(warehouse)["progress"]["slot0"] == 5
