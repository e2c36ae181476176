"""Federated tables: hash buckets of files under one manifest, and the plans that write them.

A commit writes new files of the buckets that changed beside the old ones and then replaces the manifest, which names the
files of every bucket, the progress of every slot, the source tables' columns and the number of the batch: all tables of
a batch appear at once, and a batch that is tried again is seen to be done.  Tables and buckets without a change are
neither read nor written.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import payload
from ..operators import ddl, fold
from ..operators.filters import is_ddl_event, slot_allowed, table_excluded, temporary_table
from . import store


def federated_name(database: str, schema: str, keep_schema: bool = False) -> str:
    return schema if keep_schema else f"{database}_{schema}"


@dataclass(frozen=True)
class TableSpec:
    """A source table: key columns and source types of all columns."""

    database: str
    schema: str
    name: str
    keys: tuple[str, ...]
    types: dict[str, str]

    def target(self, keep_schema: bool = False) -> str:
        return f"{federated_name(self.database, self.schema, keep_schema)}.{self.name}"


def spark_types(types: dict[str, str]) -> dict[str, str]:
    return {c: payload.spark_type(t) for c, t in types.items()}


def bucket_of(keys: Iterable[Column], buckets: int) -> Column:
    """The bucket of a row: by the text of its key, which does not depend on the key's type."""
    return F.pmod(F.xxhash64(*(F.coalesce(k.cast("string"), F.lit("")) for k in keys)), F.lit(buckets)).cast("int")


@dataclass
class Change:
    """New content of a table: rows of the buckets that are replaced (None: of all)."""

    rows: DataFrame
    keys: tuple[str, ...]
    types: dict[str, str]
    buckets: set[int] | None = None


class Warehouse:
    """The federated tables below ``root``; a new table has ``buckets`` buckets."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def manifest(self) -> dict:
        text = store.read_text(self.spark, f"{self.root}/manifest.json")
        return json.loads(text) if text else {"tables": {}, "progress": {}, "batch": -1, "schemas": {}, "quarantine": [], "garbage": []}

    def read(self, table: str, buckets: Iterable[int] | None = None, types: dict[str, str] | None = None) -> DataFrame | None:
        """A table's rows, or those of some buckets, in its columns; columns that a file does not have are null."""
        entry = self.manifest()["tables"].get(table)
        if entry is None:
            return None
        schema = ", ".join(f"`{c}` {t}" for c, t in spark_types(types or entry["types"]).items())
        paths = [f"{self.root}/{p}" for b, p in entry["files"].items() if buckets is None or int(b) in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def register(self) -> None:
        """A view for each table, named schema__table, for cross-source SQL."""
        for table in self.manifest()["tables"]:
            self.read(table).createOrReplaceTempView(table.replace(".", "__"))

    def commit(self, changes: dict[str, Change], progress: dict[str, int], batch: int, *, renamed: dict[str, str] | None = None, dropped: Iterable[str] = (), part: bool = False, **more) -> bool:
        """Write the changed buckets and then the manifest; false if the batch was committed before.

        ``renamed`` and ``dropped`` tables come first.  ``part``: only a part of the batch is done, so its number is
        not kept, and the rest comes with the next attempt, after the progress of this one.
        """
        old = self.manifest()
        if batch <= old["batch"]:
            return False
        tables, garbage = dict(old["tables"]), list(old["garbage"])
        for a, b in (renamed or {}).items():
            tables[b] = tables.pop(a)
        for table in dropped:
            garbage += tables.pop(table, {"files": {}})["files"].values()
        for table, change in changes.items():
            entry = tables.get(table) or {"buckets": self.buckets, "files": {}, "version": -1, "place": table.replace(".", "/", 1)}
            version = entry["version"] + 1
            where = f"{entry['place']}/v={version}"
            replaced = set(range(entry["buckets"])) if change.buckets is None else change.buckets
            kinds = spark_types(change.types)
            rows = change.rows.select(*(F.col(f"`{c}`").cast(t).alias(c) for c, t in kinds.items())).withColumn("_bucket", bucket_of((F.col(f"`{k}`") for k in change.keys), entry["buckets"]))
            rows.repartition(max(1, len(replaced)), "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.root}/{where}")
            files = {int(b): p for b, p in entry["files"].items()}
            garbage += [p for b, p in files.items() if b in replaced]
            files = {b: p for b, p in files.items() if b not in replaced}
            files |= {b: f"{where}/_bucket={b}" for b in replaced if store.exists(self.spark, f"{self.root}/{where}/_bucket={b}")}
            tables[table] = entry | {"files": {str(b): files[b] for b in sorted(files)}, "version": version, "types": change.types, "keys": list(change.keys)}
        done = old["progress"] | {s: max(n, old["progress"].get(s, n)) for s, n in progress.items()}
        new = old | more | {"tables": tables, "progress": done, "batch": old["batch"] if part else batch, "garbage": garbage}
        store.write_text(self.spark, f"{self.root}/manifest.json", json.dumps(new))
        return True

    def vacuum(self) -> None:
        """Delete files that newer ones have replaced."""
        now = self.manifest()
        for path in now["garbage"]:
            store.delete(self.spark, f"{self.root}/{path}")
        store.write_text(self.spark, f"{self.root}/manifest.json", json.dumps(now | {"garbage": []}))


Hook = Callable[[DataFrame], DataFrame]


def parsed(spool: DataFrame, slots: dict[str, str] | None = None) -> DataFrame:
    """Spool rows of allowed slots with their parsed record ``r``."""
    return spool.where(slot_allowed(F.col("database"), F.col("source_slotname"), slots or {})).withColumn("r", payload.parsed(F.col("payload")))


def accepted(spool: DataFrame, slots: dict[str, str] | None = None, excluded: list[str] | None = None, hook: Hook | None = None) -> DataFrame:
    """Spool rows to be applied, with their parsed record ``r``; ``hook`` may change or drop rows."""
    return _changes(parsed(spool, slots), excluded, hook)


def _changes(rows: DataFrame, excluded: list[str] | None, hook: Hook | None) -> DataFrame:
    rows = rows.where(~temporary_table(F.col("r.table")) & ~is_ddl_event(F.col("r.schema"), F.col("r.table")) & ~table_excluded(F.col("r.schema"), F.col("r.table"), excluded or []))
    return hook(rows) if hook else rows


def position(rows: DataFrame) -> Column:
    """The order of changes: by position, and by ``seq`` inside one position if there is such a column."""
    return F.struct(F.col("lsn_start").alias("lsn"), (F.col("seq").cast("bigint") if "seq" in rows.columns else F.lit(0).cast("bigint")).alias("seq"))


def known_kind(kind: Column) -> Column:
    """The kind of a change; any other than the three raises."""
    return F.when(kind.isin("insert", "update", "delete"), kind).otherwise(F.raise_error(F.concat(F.lit("unknown operation: "), F.coalesce(kind, F.lit("none")))))


def table_changes(rows: DataFrame, spec: TableSpec) -> tuple[DataFrame, dict[str, Column]]:
    """The changes of one table, typed: kind, lsn, the key before (``_old``), the columns and whether they are carried."""
    mine = rows.where((F.col("database") == spec.database) & (F.col("r.schema") == spec.schema) & (F.col("r.table") == spec.name))
    names, values = F.col("r.columnnames"), F.col("r.columnvalues")
    old = payload.zip_map(F.col("r.oldkeys.keynames"), F.col("r.oldkeys.keyvalues"))
    columns = {c: payload.value_at(names, values, c, t) for c, t in spec.types.items()}
    out = mine.select(
        position(mine).alias("lsn"),
        known_kind(F.col("r.kind")).alias("kind"),
        *(F.when(F.col("r.kind") == "insert", columns[k]).otherwise(payload.cast_text(F.try_element_at(old, F.lit(k)), spec.types[k])).alias(f"_old_{k}") for k in spec.keys),
        *(v.alias(c) for c, v in columns.items()),
        *(payload.present(names, c).alias(f"_in_{c}") for c in spec.types),
    )
    # an update that does not name a key column keeps it
    out = out.withColumns({k: F.when(F.col(f"_in_{k}"), F.col(k)).otherwise(F.col(f"_old_{k}")) for k in spec.keys})
    return out, {c: F.col(f"_in_{c}") for c in spec.types if c not in spec.keys}


def _moved(spec: TableSpec) -> Column:
    """Whether a change is an update that changes its key."""
    out = F.lit(False)
    for k in spec.keys:
        out = out | ~F.col(f"_old_{k}").eqNullSafe(F.col(k))
    return (F.col("kind") == "update") & out


def _with_base(base: DataFrame | None, changes: DataFrame, spec: TableSpec) -> DataFrame:
    """The changes, and the base's rows as inserts before all of them."""
    if base is None:
        return changes
    before = F.struct(F.lit(-(2**63)).cast("bigint").alias("lsn"), F.lit(0).cast("bigint").alias("seq"))
    first = base.select(before.alias("lsn"), F.lit("insert").alias("kind"), *(F.col(k).alias(f"_old_{k}") for k in spec.keys), *spec.types, *(F.lit(True).alias(f"_in_{c}") for c in spec.types))
    return first.unionByName(changes)


def refused(base: DataFrame | None, rows: DataFrame, spec: TableSpec) -> DataFrame:
    """The changes that a row-by-row replay would refuse, as each of them has to meet exactly one row: an update or
    delete of a missing key, an insert or a change of key onto a present one."""
    changes = _with_base(base, table_changes(rows, spec)[0], spec).withColumn("_moved", _moved(spec))
    keys = [F.col(k) for k in spec.keys]
    old = [F.col(f"_old_{k}").alias(k) for k in spec.keys]
    at = lambda n: F.struct("lsn", F.lit(n).alias("step")).alias("lsn")  # noqa: E731  the old key goes first
    left = changes.where("_moved").select(*old, at(0), F.lit("delete").alias("kind"))
    came = changes.where("_moved").select(*keys, at(1), F.lit("insert").alias("kind"))
    gone = changes.where("kind = 'delete'").select(*old, at(0), "kind")
    rest = changes.where("NOT _moved AND kind <> 'delete'").select(*keys, at(0), "kind")
    return fold.violations(left.unionAll(came).unionAll(gone).unionAll(rest), list(spec.keys))


def apply(base: DataFrame | None, rows: DataFrame, spec: TableSpec, moved: bool | None = None) -> DataFrame:
    """The table after the changes in ``rows``; changes of keys take the way that follows them."""
    changes, carried = table_changes(rows, spec)
    if moved is None:
        moved = not changes.where(_moved(spec)).isEmpty()
    changes = _with_base(base, changes, spec)
    if not moved:
        return fold.fold(changes, list(spec.keys), carried).select(*spec.types)
    pair = lambda p: F.struct(*(F.col(p + k).alias(k) for k in spec.keys))
    keyed = changes.withColumns({"_from_key": pair("_old_"), "_to_key": pair("")})
    out = fold.fold_key_changes(keyed, "_from_key", "_to_key", carried)
    return out.select(*(F.col(f"key.{c}").alias(c) if c in spec.keys else F.col(c) for c in spec.types))


class ReplayStopped(RuntimeError):
    """The replay cannot go on: an unknown statement, or a request to stop.  What came before it is committed."""

    def __init__(self, reason: str, database: str, lsn: int, statement: str):
        super().__init__(f"{reason} in {database} at {lsn}: {statement[:200]}")
        self.reason, self.database, self.lsn, self.statement = reason, database, lsn, statement


STOP = re.compile(r"\s*comment\s.*'KILL_ME'", re.I | re.S)


@dataclass
class _Run:
    """A batch on its way: what is known of each database's tables, and the new content of tables so far."""

    warehouse: Warehouse
    keep_schema: bool
    registries: dict[str, ddl.SchemaRegistry]
    changes: dict[str, Change] = field(default_factory=dict)
    renamed: dict[str, str] = field(default_factory=dict)
    dropped: list[str] = field(default_factory=list)
    quarantine: list[dict] = field(default_factory=list)

    def spec(self, database: str, table: str) -> TableSpec:
        schema, name = table.split(".", 1)
        registry = self.registries[database]
        return TableSpec(database, schema, name, tuple(registry.keys.get(table, ())), dict(registry.tables[table]))

    def stored(self, target: str) -> str:
        """The name under which the manifest still has a table."""
        return next((a for a, b in self.renamed.items() if b == target), target)

    def base(self, spec: TableSpec, buckets: set[int] | None) -> DataFrame | None:
        """The table's rows, of these buckets at least, as they are by now."""
        target = spec.target(self.keep_schema)
        entry = self.warehouse.manifest()["tables"].get(self.stored(target))
        known = self.changes.get(target)
        if known is not None and known.buckets is None:
            return known.rows
        have = set() if known is None else known.buckets
        more = None
        if entry is not None and target not in self.dropped:
            wanted = set(range(entry["buckets"])) if buckets is None else buckets
            more = self.warehouse.read(self.stored(target), wanted - have, spec.types)
        if known is None or more is None:
            return more if known is None else known.rows
        return known.rows.unionByName(more)

    def change(self, rows: DataFrame, spec: TableSpec, strict: bool) -> None:
        """Apply the changes of one table; only the buckets of their keys are read and replaced."""
        target = spec.target(self.keep_schema)
        entry = self.warehouse.manifest()["tables"].get(self.stored(target))
        n = entry["buckets"] if entry else self.warehouse.buckets
        changes, _ = table_changes(rows, spec)
        both = F.array(bucket_of((F.col(f"_old_{k}") for k in spec.keys), n), bucket_of((F.col(k) for k in spec.keys), n))
        found = changes.agg(F.array_distinct(F.flatten(F.collect_set(both))).alias("buckets"), F.max(_moved(spec)).alias("moved")).first()
        buckets = set(found["buckets"])
        base = self.base(spec, buckets)
        if strict and (bad := refused(base, rows, spec).limit(5).collect()):
            raise ValueError(f"changes that meet no row, or more than one, in {target}: {[(r['lsn']['lsn']['lsn'], r['reason']) for r in bad]}")
        known = self.changes.get(target)
        covered = None if known is not None and known.buckets is None else buckets | (known.buckets if known else set())
        if entry is None or target in self.dropped:
            covered = None
        self.changes[target] = Change(apply(base, rows, spec, bool(found["moved"])), spec.keys, spec.types, covered)

    def define(self, database: str, operation: tuple) -> None:
        """A change of a table's definition, and what it means for the stored rows."""
        registry = self.registries[database]
        kind, table, *args = operation
        if kind not in ("create", "drop") and table not in registry.tables:
            return  # a table that is not replayed
        if kind == "create" and table in registry.tables:
            return
        before = self.spec(database, table) if table in registry.tables else None
        self.registries[database] = registry = registry.apply(kind, table, *args)
        if kind == "create" or before is None:
            return
        target = before.target(self.keep_schema)
        if kind == "drop":
            stored = self.stored(target)
            self.renamed.pop(stored, None)
            self.dropped.append(stored)
            self.changes.pop(target, None)
        elif kind == "rename":
            after = self.spec(database, args[1])
            new = after.target(self.keep_schema)
            if target in self.changes:
                self.changes[new] = self.changes.pop(target)
            if self.stored(target) in self.warehouse.manifest()["tables"] and target not in self.dropped:
                self.renamed[self.stored(target)] = new
        else:
            after = self.spec(database, table)
            known = self.changes.get(target)
            if kind == "add" and known is None:
                return  # old files read as null in the new column
            rows = self.base(before, None)
            if rows is not None:
                self.changes[target] = Change(registry.conformed(rows, table, kind, *args), after.keys, after.types)


def replay_batch(warehouse: Warehouse, spool: DataFrame, specs: list[TableSpec], batch: int, *, slots: dict[str, str] | None = None, keep_schema: bool = False, hook: Hook | None = None, excluded: list[str] | None = None, strict: bool = False, unknown: str = "stop", resolved: Iterable[tuple[str, int]] = ()) -> bool:
    """Apply one batch of whole transactions to all tables and commit it with the slots' progress.

    ``specs`` say what the tables are until the manifest knows them; later their DDL events do.  Each database's changes
    are cut at its DDL events: those before are applied to the old columns, those after to the new ones, in one commit.
    An unknown statement stops the replay before its transaction (``unknown``: "stop"), or is kept in the manifest and
    passed over ("quarantine", or if its (database, position) is among ``resolved``), and so does a request to stop; what
    comes before is committed and ReplayStopped raised.  ``strict`` raises if a change does not meet exactly one row.
    Rows sent again are passed over: those up to the slot's progress, and equal ones.
    """
    done = warehouse.manifest()
    if batch <= done["batch"]:
        return False
    # nothing of a slot without progress was applied, so position 0 is not passed over either
    past = F.lit(None).cast("bigint")
    for s, n in done["progress"].items():
        past = F.when(F.col("source_slotname") == s, F.lit(n).cast("bigint")).otherwise(past)
    ahead = F.coalesce(F.col("lsn_start") > past, F.col("lsn_start").isNotNull())
    again = ["database", "source_slotname", "lsn_start", *(["seq"] if "seq" in spool.columns else []), "payload"]
    fresh = parsed(spool.where(ahead).dropDuplicates(again), slots)
    registries = {d: ddl.SchemaRegistry(**r) for d, r in done["schemas"].items()}
    for spec in specs:
        registry = registries.setdefault(spec.database, ddl.SchemaRegistry({}, {}))
        if spec.database not in done["schemas"]:
            registry.tables[f"{spec.schema}.{spec.name}"] = dict(spec.types)
            registry.keys[f"{spec.schema}.{spec.name}"] = list(spec.keys)
    run = _Run(warehouse, keep_schema, registries, quarantine=list(done["quarantine"]))

    # statements are few; a record of that table other than an insert says nothing
    names, values = F.col("r.columnnames"), F.col("r.columnvalues")
    text = lambda c: payload.value_at(names, values, c)
    events = fresh.where(is_ddl_event(F.col("r.schema"), F.col("r.table")) & (F.col("r.kind") == "insert"))
    events = events.select("database", "source_slotname", "lsn_start", position(events).alias("at"), *(["xid"] if "xid" in spool.columns else []), text("current_query").alias("query"), text("search_path").alias("path"))
    events = sorted(events.collect(), key=lambda r: (r["database"], tuple(r["at"])))
    stops: dict[str, ReplayStopped] = {}
    fences: dict[str, list] = {}
    for e in events:
        d = e["database"]
        if d in stops or d not in registries:
            continue
        rule, action = ddl.decide(e["query"] or "")
        passed = (d, e["lsn_start"]) in set(resolved)
        if STOP.match(e["query"] or "") and not passed:
            stops[d] = ReplayStopped("stop requested", d, e["lsn_start"], e["query"])
        elif action == "fatal" and not passed and unknown == "stop":
            stops[d] = ReplayStopped("unknown statement", d, e["lsn_start"], e["query"])
        else:
            if action == "fatal":
                run.quarantine.append({"database": d, "lsn": e["lsn_start"], "statement": e["query"]})
            fences.setdefault(d, []).append((e, action))
    limit = F.lit(True)
    for d, stop in stops.items():
        # nothing of the stopping transaction
        mine = fresh.where(F.col("database") == d)
        xid = next((e["xid"] for e in events if e["database"] == d and e["lsn_start"] == stop.lsn and "xid" in e and e["xid"] is not None), None)
        first = stop.lsn if xid is None else min(stop.lsn, mine.where(F.col("xid") == xid).agg(F.min("lsn_start")).first()[0])
        limit = limit & ~((F.col("database") == d) & (F.col("lsn_start") >= first))
        fences[d] = [(e, a) for e, a in fences.get(d, []) if e["lsn_start"] < first]
    rows = _changes(fresh.where(limit), excluded, hook)
    epoch = F.lit(0)
    for d, found in fences.items():
        for e, _ in found:
            at = F.struct(F.lit(e["at"]["lsn"]).cast("bigint").alias("lsn"), F.lit(e["at"]["seq"]).cast("bigint").alias("seq"))
            epoch = epoch + F.when((F.col("database") == d) & (position(fresh) > at), 1).otherwise(0)
    rows = rows.withColumn("epoch", epoch)
    present = rows.groupBy("epoch", "database", F.concat_ws(".", "r.schema", "r.table").alias("table")).count().collect()
    for n in range(max([len(f) for f in fences.values()], default=0) + 1):
        for r in present:
            if r["epoch"] == n and r["database"] in registries and r["table"] in registries[r["database"]].tables:
                run.change(rows.where(F.col("epoch") == n), run.spec(r["database"], r["table"]), strict)
        for d, found in fences.items():
            if n < len(found) and found[n][1] == "rewrite":
                for operation in ddl.operations(found[n][0]["query"], ddl.first_schema(found[n][0]["path"])):
                    run.define(d, operation)
    for spec in specs:  # tables that have no rows yet
        target = spec.target(keep_schema)
        if target not in done["tables"] and target not in run.changes and f"{spec.schema}.{spec.name}" in registries.get(spec.database, ddl.SchemaRegistry({}, {})).tables:
            kinds = ", ".join(f"`{c}` {t}" for c, t in spark_types(spec.types).items())
            run.changes[target] = Change(warehouse.spark.createDataFrame([], kinds), spec.keys, spec.types)
    progress = {r[0]: r[1] for r in fresh.where(limit).groupBy("source_slotname").agg(F.max("lsn_start")).collect() if r[0] is not None}
    schemas = {d: {"tables": r.tables, "keys": r.keys, "epoch": r.epoch} for d, r in registries.items()}
    out = warehouse.commit(run.changes, progress, batch, renamed=run.renamed, dropped=run.dropped, part=bool(stops), schemas=schemas, quarantine=run.quarantine)
    if stops:
        raise next(iter(stops.values()))
    return out


def base_backup(warehouse: Warehouse, sources: dict[str, DataFrame], specs: list[TableSpec], slot: str, consistent_lsn: int, *, references: list[tuple[str, list[str], str, list[str]]] = (), keep_schema: bool = False) -> dict[str, int]:
    """Copy all tables at a snapshot, check keys before references, and begin the slot's progress at its position.

    Returns the numbers of violations by check.
    """
    found = {}
    by_name = {s.name: s for s in specs}
    for spec in specs:
        if spec.keys:
            found[f"key of {spec.name}"] = fold.duplicate_keys(sources[spec.name], list(spec.keys)).count()
    for child, columns, parent, parent_columns in references:
        found[f"{child} to {parent}"] = fold.orphans(sources[child], sources[parent], columns, parent_columns).count()
    tables = {by_name[n].target(keep_schema): Change(df, by_name[n].keys, by_name[n].types) for n, df in sources.items() if n in by_name}
    warehouse.commit(tables, {slot: consistent_lsn}, warehouse.manifest()["batch"] + 1)
    return found
