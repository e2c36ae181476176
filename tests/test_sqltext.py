"""Statements and names."""

import pytest

from tidefold.operators.ddl import SchemaRegistry
from tidefold.operators.sqltext import Remapper, Script, Splitter, scan, split


def test_pieces():
    s = Splitter()
    counts = []
    for piece in ("SELECT col1 FROM ", "table1; SELECT col2 ", "FROM table2;"):
        s.feed(piece)
        counts.append(len(s.take()))
    assert counts == [0, 1, 1]


SCRIPT = "-- a; b\nSELECT 'x;''y', \"q;\" /* c; /* d; */ e; */ FROM t; \\connect x;\nDO $x$ BEGIN; $y$; END $x$; SELECT $$;$$ ;; last"


def test_everything_that_hides_an_end():
    found, rest = split(SCRIPT)
    assert len(found) == 3 and rest == "last" and "\\connect" not in "".join(found)
    assert "".join(t.text for t in scan(SCRIPT)) == SCRIPT


QUOTES = "SELECT 'a\\'; SELECT 'b'; SELECT e'c\\'; d' ; SELECT $a$ ; $b$ ; $a$, $1; /* ; ** /* ; */ ; */ SELECT \"x\"\"; y\" - 1;"


def test_pieces_of_any_length_give_the_same():
    for text in (SCRIPT, QUOTES):
        for n in (1, 2, 3, 7):
            s = Splitter()
            for a in range(0, len(text), n):
                s.feed(text[a : a + n])
            assert (s.take(), s.rest()) == split(text)


def test_quotes():
    found, rest = split(QUOTES)
    assert found[:3] == ["SELECT 'a\\';", "SELECT 'b';", "SELECT e'c\\'; d';"] and len(found) == 5 and rest == ""


def test_long_statements_are_read_once():
    import time

    began = time.time()
    for lines in (["CREATE TABLE t (", *(f"  c{i} int," for i in range(10_000)), "  z int);"], ["CREATE FUNCTION f() RETURNS int AS $x$", *(f"  -- {i};" for i in range(10_000)), "$x$;"], ["SELECT '", *["; it''s"] * 10_000, "';"], ["/*", *["* /* */ ;"] * 10_000, "*/ SELECT 1;"]):
        s = Splitter()
        for line in lines:
            s.feed(line + "\n")
        assert len(s.take()) == 1 and s.rest() == ""
    assert time.time() - began < 4


def test_statements_are_checked():
    from tidefold.operators.sqltext import check

    assert [check(x) for x in ("SELECT (1);", "CREATE TABLE t (a int[]);", "(SELECT 1);")] == [None] * 3
    assert [check(x) is None for x in ("SELECT (1;", "SELECT 1);", "SELECT 'a;", "= 1;", "SELECT (1];")] == [False] * 5


@pytest.mark.parametrize(("before", "after"), [
    ("SELECT * FROM schema1.table1", "SELECT * FROM schema2.table1"),
    ('CREATE TABLE "schema1"."T" (a schema1.kind)', 'CREATE TABLE schema2."T" (a schema2.kind)'),
    ("ALTER SEQUENCE schema1.s OWNED BY schema1.t.c", "ALTER SEQUENCE schema2.s OWNED BY schema2.t.c"),
    ("SELECT 'schema1.t'::regclass, 'schema1.t'", "SELECT 'schema2.t'::regclass, 'schema1.t'"),
    ("CREATE TRIGGER g BEFORE INSERT ON schema1.t EXECUTE FUNCTION schema1.f()", "CREATE TRIGGER g BEFORE INSERT ON schema2.t EXECUTE FUNCTION schema2.f()"),
    ("GRANT USAGE ON SCHEMA schema1 TO me", "GRANT USAGE ON SCHEMA schema2 TO me"),
    ("CREATE SCHEMA IF NOT EXISTS schema1", "CREATE SCHEMA IF NOT EXISTS schema2"),
    ("CREATE FUNCTION schema1.f() RETURNS int LANGUAGE sql AS $$SELECT a FROM schema1.t$$", "CREATE FUNCTION schema2.f() RETURNS int LANGUAGE sql AS $$SELECT a FROM schema2.t$$"),
    ("CREATE FUNCTION schema1.f() RETURNS int LANGUAGE plpgsql AS $$schema1.t$$", "CREATE FUNCTION schema2.f() RETURNS int LANGUAGE plpgsql AS $$schema1.t$$"),
    ("COMMENT ON COLUMN schema1.t.c IS 'schema1.t'", "COMMENT ON COLUMN schema2.t.c IS 'schema1.t'"),
    ("SELECT strip.t.a FROM strip.t, other.t", "SELECT t.a FROM t, other.t"),
    ("SELECT keep FROM schema1.ignored", "SELECT keep FROM schema1.ignored"),
    ("SELECT a FROM b.t", "SELECT a FROM schema1.t"),
    ("SET search_path = schema1.t", "SET search_path = schema1.t"),
    ("CREATE TYPE schema1.mood AS ENUM ('schema1.x')", "CREATE TYPE schema2.mood AS ENUM ('schema1.x')"),
    ("GRANT EXECUTE ON FUNCTION schema1.f(schema1.kind) TO me", "GRANT EXECUTE ON FUNCTION schema2.f(schema2.kind) TO me"),
    ("GRANT SELECT ON schema1.t, schema1.u TO me", "GRANT SELECT ON schema2.t, schema2.u TO me"),
    ("CREATE TRIGGER g AFTER UPDATE ON schema1.t WHEN (schema1.f(old.a) = new.b) EXECUTE PROCEDURE schema1.g()", "CREATE TRIGGER g AFTER UPDATE ON schema2.t WHEN (schema2.f(old.a) = new.b) EXECUTE PROCEDURE schema2.g()"),
    ("ALTER FUNCTION schema1.f(int) OWNER TO me", "ALTER FUNCTION schema2.f(int) OWNER TO me"),
    ("ALTER TYPE schema1.mood ADD VALUE 'x'", "ALTER TYPE schema2.mood ADD VALUE 'x'"),
    ("ALTER SCHEMA schema1 OWNER TO me", "ALTER SCHEMA schema2 OWNER TO me"),
    ("COMMENT ON SCHEMA schema1 IS 'x'", "COMMENT ON SCHEMA schema2 IS 'x'"),
    ("COMMENT ON FUNCTION schema1.f() IS 'x'", "COMMENT ON FUNCTION schema2.f() IS 'x'"),
    ("CREATE EVENT TRIGGER e ON ddl_command_end EXECUTE FUNCTION schema1.f()", "CREATE EVENT TRIGGER e ON ddl_command_end EXECUTE FUNCTION schema2.f()"),
    ("CREATE FUNCTION f(a schema1.kind, b int) RETURNS SETOF schema1.t LANGUAGE c AS 'x'", "CREATE FUNCTION f(a schema2.kind, b int) RETURNS SETOF schema2.t LANGUAGE c AS 'x'"),
    ("SELECT schema1.f(a)::schema1.kind, CAST(b AS schema1.kind) FROM t", "SELECT schema2.f(a)::schema2.kind, CAST(b AS schema2.kind) FROM t"),
    ("SELECT schema1.id, max(schema1.n) FROM public.schema1 WHERE schema1.a = 1 AND schema1.b IN (schema1.c) GROUP BY schema1.id", "SELECT schema1.id, max(schema1.n) FROM public.schema1 WHERE schema1.a = 1 AND schema1.b IN (schema1.c) GROUP BY schema1.id"),
    ("SELECT schema1.id FROM other.users schema1 JOIN schema1.t ON schema1.id = t.id, schema1.u", "SELECT schema1.id FROM other.users schema1 JOIN schema2.t ON schema1.id = t.id, schema1.u"),
    ("SELECT 1 FROM schema1.a x, schema1.b AS y WHERE x.i = y.i", "SELECT 1 FROM schema2.a x, schema2.b AS y WHERE x.i = y.i"),
    ("SELECT 1 FROM schema1 . t, schema1/* x */.u", "SELECT 1 FROM schema2.t, schema2.u"),
    ("CREATE TABLE schema1.t (a int DEFAULT schema1.f(), b schema1.kind REFERENCES schema1.u (b), CHECK (schema1.g(a) > 0))", "CREATE TABLE schema2.t (a int DEFAULT schema2.f(), b schema2.kind REFERENCES schema2.u (b), CHECK (schema2.g(a) > 0))"),
    ("DROP TABLE schema1.a, schema1.b CASCADE", "DROP TABLE schema2.a, schema2.b CASCADE"),
    ("ALTER TABLE schema1.t ADD COLUMN c schema1.kind, ALTER COLUMN d TYPE schema1.kind", "ALTER TABLE schema2.t ADD COLUMN c schema2.kind, ALTER COLUMN d TYPE schema2.kind"),
    ("CREATE CAST (schema1.a AS schema1.b) WITH FUNCTION schema1.f(schema1.a)", "CREATE CAST (schema2.a AS schema2.b) WITH FUNCTION schema2.f(schema2.a)"),
    ("INSERT INTO schema1.t (a) SELECT schema1.a FROM x schema1", "INSERT INTO schema2.t (a) SELECT schema1.a FROM x schema1"),
])
def test_names(before, after):
    mapper = Remapper({"schema1": "schema2", "strip": None, "b": "schema1"}, frozenset({"schema1.ignored"}))
    assert mapper.statement(before) == after


def test_default_schema_and_selection():
    assert Remapper({}, default="d").statement("CREATE TABLE IF NOT EXISTS t (a int)") == "CREATE TABLE IF NOT EXISTS d.t (a int)"
    assert Remapper({"a": "b"}, only=frozenset({"a.t"})).statement("SELECT 1 FROM a.t, a.u") == "SELECT 1 FROM b.t, a.u"


def test_script(tmp_path):
    path = tmp_path / "dump.sql"
    path.write_text("SET default_table_access_method = heap;\nCREATE TABLE a.t (x int) USING heap; -- note\nSELECT 1;")
    script = Script.load(str(path)).without_access_methods()
    assert script.statements[0] == "CREATE TABLE a.t (x int);"
    assert script.comments() == [(1, "-- note")]
    two = Script.from_text("SELECT a, -- one\n  b; -- two\n")
    assert two.comments_on_line(0, 7) == ["-- one"] and two.comments_on_line(0, 19) == []
    assert "b.t" in str(script.translate({"a": "b"})) and "a.t" in str(script)


def test_statement_files(spark, tmp_path):
    from tidefold.sources.sqlfiles import read_statements

    (tmp_path / "a.sql").write_text("SELECT 1; SELECT 2")
    found = [(r["position"], r["statement"], r["error"]) for r in read_statements(spark, str(tmp_path)).orderBy("position").collect()]
    assert found == [(0, "SELECT 1;", None), (1, "SELECT 2", "no end of statement")]


def test_registry(spark):
    r = SchemaRegistry({"t": {"id": "int", "a": "string"}}, {"t": ["id"]})
    r = r.apply("add", "t", "b", "double").apply("rename_column", "t", "a", "c").apply("retype", "t", "id", "bigint").apply("rename", "t", value="u")
    stored = spark.createDataFrame([(1, "x")], "id int, c string")
    assert r.conform(stored, "u").dtypes == [("id", "bigint"), ("c", "string"), ("b", "double")] and r.epoch == 4
    assert r.apply("drop", "missing").tables == r.tables
