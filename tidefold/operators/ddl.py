"""DDL events: which are ignored, rewritten to the federated schemas, or unknown.

The rules are a table in order; the first that matches decides.  A rule's action is ``ignore`` or ``rewrite``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.payload import spark_type
from .sqltext import Remapper, scan, unquote

#: Fixed value: checksums of statements that are never replayed.
IGNORED_MD5 = ("c84a77b8caf1d8bc02f2a21b2e13d0da",)

#: Rule, pattern (any case), action.
RULES = (
    ("temporary_table", r"^\s*create\s+temp(orary)?\s+table", "ignore"),
    ("extension", r"^\s*(create|alter|drop)\s+extension", "ignore"),
    ("trigger", r"^\s*alter\s+table\s+\S+\s+(disable|enable)\s+trigger", "ignore"),
    ("row_level_security", r"^\s*alter\s+table\s+\S+\s+(disable|enable)\s+row\s+level\s+security", "ignore"),
    ("check_constraint", r"^\s*alter\s+table\s+\S.*\badd\b.*\bcheck\b", "ignore"),
    ("validate_constraint", r"^\s*alter\s+table\s+\S.*\bvalidate\s+constraint", "ignore"),
    ("owner", r"^\s*alter\s+table\s+\S.*\bowner\s+to", "ignore"),
    ("function", r"^\s*(create|alter|drop)(\s+or\s+replace)?\s+function\s", "ignore"),
    ("view", r"^\s*(create|alter|drop)\s+(or\s+replace\s+)?view", "rewrite"),
    ("comment", r"^\s*comment\s+on", "ignore"),
    ("table", r"^\s*(create|alter|drop)\s+table", "rewrite"),
    ("type", r"^\s*(create|alter|drop)\s+type", "rewrite"),
    ("sequence", r"^\s*(create|alter|drop)\s+sequence", "rewrite"),
)

_DROPPED = re.compile(r"(\s*alter\s+table\b.*?\bdrop\s+constraint\s+)(?!if\s+exists)", re.I | re.S)
#: Schemas that are the same in every database.
SYSTEM = frozenset({"pg_catalog", "information_schema"})


class _Federated(Mapping):
    """Every schema of a database by its federated name."""

    def __init__(self, database: str):
        self.database = database

    def __contains__(self, schema: object) -> bool:
        return schema not in SYSTEM

    def __getitem__(self, schema: str) -> str:
        if schema in SYSTEM:
            raise KeyError(schema)
        return f"{self.database}_{schema}"

    def __iter__(self):
        return iter(())

    def __len__(self) -> int:
        return 0


def fixed(statement: str, database: str, keep_schema: bool = False) -> str:
    """The statement with all its schemas federated, and constraints dropped only if they exist."""
    text = statement if keep_schema else Remapper(_Federated(database)).statement(statement)
    return _DROPPED.sub(r"\1IF EXISTS ", text, count=1)


def decide(statement: str) -> tuple[str, str]:
    """Rule and action of one statement: as rule() and action() say."""
    if hashlib.md5(statement.encode()).hexdigest() in IGNORED_MD5:
        return "checksum", "ignore"
    return next(((name, what) for name, pattern, what in RULES if re.match(pattern, statement, re.I | re.S)), ("unknown", "fatal"))


def rule(ddl: Column) -> Column:
    """The name of the first rule that matches: ``checksum``, one of RULES, or ``unknown``."""
    found = F.when(F.md5(ddl.cast("binary")).isin(*IGNORED_MD5), "checksum")
    for name, pattern, _ in RULES:
        found = found.when(ddl.rlike(f"(?is){pattern}"), name)
    return found.otherwise("unknown")


def action(rule_name: Column) -> Column:
    out = F.when(rule_name == "checksum", "ignore")
    for name, _, what in RULES:
        out = out.when(rule_name == name, what)
    return out.otherwise("fatal")


def rewritten(ddl: Column, database: Column, keep_schema: bool = False) -> Column:
    """The statement as fixed() makes it; null if it is ignored.  Statements are few, so they go through Python."""
    move = F.udf(lambda text, d: fixed(text, d, keep_schema), "string")
    return F.when(action(rule(ddl)) == "rewrite", move(ddl, database))


def classify(events: DataFrame, ddl: str = "current_query", database: str = "database", keep_schema: bool = False, unknown: str = "fail") -> DataFrame:
    """``events`` with rule, action and fixed_ddl; an unknown statement raises, or is ``quarantine`` if asked."""
    out = events.withColumn("rule", rule(F.col(ddl)))
    what = action(F.col("rule"))
    if unknown == "fail":
        what = F.when(what == "fatal", F.raise_error(F.concat(F.lit("unknown DDL: "), F.col(ddl)))).otherwise(what)
    elif unknown == "quarantine":
        what = F.when(what == "fatal", "quarantine").otherwise(what)
    else:
        raise ValueError(f"unknown = {unknown!r}")
    return out.withColumn("action", what).withColumn("fixed_ddl", rewritten(F.col(ddl), F.col(database), keep_schema))


@dataclass
class SchemaRegistry:
    """Column types and keys of tables by DDL epoch; what DDL means for stored tables."""

    tables: dict[str, dict[str, str]]
    keys: dict[str, list[str]]
    epoch: int = 0

    def apply(self, operation: str, table: str, column: str | None = None, value: str | None = None) -> SchemaRegistry:
        """The registry after a change: create, drop, add, drop_column, rename_column, retype, rename."""
        tables = {t: dict(c) for t, c in self.tables.items()}
        keys = dict(self.keys)
        if operation == "create":
            tables.setdefault(table, dict(value or {}))
            keys.setdefault(table, list(column or []))
        elif operation == "drop":
            tables.pop(table, None)  # a table that is missing already is no error
            keys.pop(table, None)
        elif operation in ("add", "retype"):
            tables[table][column] = value
        elif operation == "drop_column":
            tables[table].pop(column, None)
        elif operation == "rename_column":
            tables[table] = {value if c == column else c: t for c, t in tables[table].items()}
            keys[table] = [value if c == column else c for c in keys.get(table, [])]
        elif operation == "key":
            keys[table] = list(column)
        elif operation == "rename":
            tables[value] = tables.pop(table)
            if table in keys:
                keys[value] = keys.pop(table)
        else:
            raise ValueError(f"unknown operation {operation!r}")
        return SchemaRegistry(tables, keys, self.epoch + 1)

    def conformed(self, df: DataFrame, table: str, operation: str, column: str | None = None, value: str | None = None) -> DataFrame:
        """Stored rows as they were before ``operation``, which made this registry, in the present columns."""
        if operation == "rename_column":
            df = df.withColumnRenamed(column, value)
        kinds = {c: spark_type(t) for c, t in self.tables[table].items()}
        return df.select(*((F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in kinds.items()))

    def conform(self, df: DataFrame, table: str) -> DataFrame:
        """The stored rows in the table's present columns: new ones are null, dropped ones go, types are cast."""
        have = set(df.columns)
        return df.select(*((F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in self.tables[table].items()))


#: Names of types in statements, and what they are called in catalogs.
TYPE_NAMES = {
    "smallint": "int2", "integer": "int4", "int": "int4", "bigint": "int8", "serial": "int4", "bigserial": "int8", "boolean": "bool", "real": "float4",
    "double precision": "float8", "decimal": "numeric", "timestamp with time zone": "timestamptz", "timestamp without time zone": "timestamp",
}
#: Words that end a column's type.
_AFTER_TYPE = frozenset("not null default primary references unique check constraint collate generated using".split())


def first_schema(path: str | None) -> str:
    """The schema in which a statement's plain names are: the first of the search path but the user's own."""
    found = [x.strip().strip('"') for x in (path or "").split(",")]
    return next((x for x in found if x and x != "$user"), "public")


class _Words:
    """The tokens of a statement, one after the other."""

    def __init__(self, text: str):
        self.tokens = [t for t in scan(text) if t.kind not in ("space", "line_comment", "block_comment", "end")]
        self.at = 0

    def peek(self, n: int = 0) -> str:
        i = self.at + n
        return self.tokens[i].text.lower() if i < len(self.tokens) else ""

    def skip(self, *words: str) -> bool:
        """Whether these words come next; they are passed if so."""
        if all(self.peek(i) == w for i, w in enumerate(words)):
            self.at += len(words)
            return True
        return False

    def take(self) -> str:
        self.at += 1
        return self.tokens[self.at - 1].text if self.at <= len(self.tokens) else ""

    def name(self, schema: str) -> str:
        """A table's name with its schema."""
        parts = [unquote(self.take())]
        while self.skip("."):
            parts.append(unquote(self.take()))
        return ".".join(parts if len(parts) > 1 else [schema, *parts])

    def type(self) -> str:
        """A type up to what can follow it: its catalog name with its digits."""
        words, digits = [], ""
        while self.peek() not in ("", ",", ")") and self.peek() not in _AFTER_TYPE:
            if self.peek() == "(":
                digits = self.bracket()
            else:
                words.append(self.take().lower())
        text = " ".join(words)
        array = text.endswith("[ ]") or text.endswith("]")
        base = re.sub(r"\s*\[.*", "", text)
        base = TYPE_NAMES.get(base, base)
        return base + "[]" if array else base + (digits if base == "numeric" else "")

    def bracket(self) -> str:
        """A bracket with all that is in it."""
        out, depth = [], 0
        while True:
            t = self.take()
            depth += (t == "(") - (t == ")")
            out.append(t)
            if depth == 0 or not t:
                return "".join(out)

    def rest(self) -> None:
        """Passes all up to the next comma, or the end of the bracket around."""
        while self.peek() not in ("", ",", ")"):
            if self.peek() == "(":
                self.bracket()
            else:
                self.at += 1


def _columns(text: str) -> list[str]:
    return [unquote(t.text) for t in scan(text) if t.kind in ("word", "quoted")]


def _constraint(w: _Words) -> list[str] | None:
    """The key columns if a table's constraint is its key; passes the constraint."""
    if w.skip("constraint"):
        w.take()
    found = _columns(w.bracket()) if w.skip("primary", "key") and w.peek() == "(" else None
    w.rest()
    return found


def operations(statement: str, schema: str = "public") -> list[tuple]:
    """What a rewritten statement means for stored tables, as arguments of SchemaRegistry.apply.

    Views, types and sequences mean nothing to them, nor do constraints other than keys, defaults and nullability.  A
    table made from a query is an error, as its columns are not in the statement.
    """
    w = _Words(statement)
    if w.skip("create", "table"):
        w.skip("if", "not", "exists")
        table = w.name(schema)
        if w.peek() != "(":
            raise ValueError(f"no columns in {statement[:200]!r}")
        w.take()
        types, keys = {}, []
        while w.peek() not in (")", ""):
            if w.peek() in ("primary", "constraint", "unique", "check", "foreign", "exclude", "like"):
                keys = _constraint(w) or keys
            else:
                column = unquote(w.take())
                types[column] = w.type()
                while w.peek() not in ("", ",", ")"):
                    if w.skip("primary", "key"):
                        keys = [column]
                    elif w.peek() == "(":
                        w.bracket()
                    else:
                        w.at += 1
            w.skip(",")
        return [("create", table, keys, types)]
    if w.skip("drop", "table"):
        w.skip("if", "exists")
        out = [("drop", w.name(schema))]
        while w.skip(","):
            out.append(("drop", w.name(schema)))
        return out
    if not w.skip("alter", "table"):
        return []
    w.skip("if", "exists")
    w.skip("only")
    table, out = w.name(schema), []
    while w.peek():
        if w.skip("rename", "to"):
            out.append(("rename", table, None, f"{table.split('.', 1)[0]}.{unquote(w.take())}"))
        elif w.skip("set", "schema"):
            out.append(("rename", table, None, f"{unquote(w.take())}.{table.split('.', 1)[1]}"))
        elif w.skip("rename", "constraint"):
            w.rest()
        elif w.skip("rename"):
            w.skip("column")
            old = unquote(w.take())
            w.skip("to")
            out.append(("rename_column", table, old, unquote(w.take())))
        elif w.skip("add"):
            if w.peek() in ("primary", "constraint", "unique", "check", "foreign", "exclude"):
                if keys := _constraint(w):
                    out.append(("key", table, keys))
            else:
                w.skip("column")
                w.skip("if", "not", "exists")
                column = unquote(w.take())
                out.append(("add", table, column, w.type()))
                w.rest()
        elif w.skip("drop", "constraint") or w.peek() == "":
            w.rest()
        elif w.skip("drop"):
            w.skip("column")
            w.skip("if", "exists")
            out.append(("drop_column", table, unquote(w.take())))
            w.rest()
        elif w.skip("alter"):
            w.skip("column")
            column = unquote(w.take())
            if w.skip("type") or w.skip("set", "data", "type"):
                out.append(("retype", table, column, w.type()))
            w.rest()
        else:
            w.rest()
        if not w.skip(","):
            break
    return out


def statements(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    """DDL events (database, current_query) from literal rows."""
    return spark.createDataFrame(rows, "database string, current_query string")
