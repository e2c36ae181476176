"""Folding change records into the current state of keyed tables.

One shuffle by key replaces the row-at-a-time replay: for every column the latest change that carries it counts, and
keys whose last change is a delete go.  Partial aggregation before the exchange keeps hot keys cheap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fold(changes: DataFrame, keys: list[str], columns: dict[str, Column], order: str = "lsn", kind: str = "kind") -> DataFrame:
    """The live rows after all changes.

    ``columns``: for each column, whether a change carries it.  An explicit null that a change carries is a value.
    An insert carries all columns, so that nothing of a deleted row comes back.
    """
    newest = {c: F.max_by(c, F.when(p | (F.col(kind) == "insert"), F.col(order))).alias(c) for c, p in columns.items()}
    state = changes.groupBy(*keys).agg(*newest.values(), F.max_by(kind, order).alias("_last"))
    return state.where("_last <> 'delete'").drop("_last")


def apply_changes(base: DataFrame, changes: DataFrame, keys: list[str], columns: dict[str, Column], order: str = "lsn", kind: str = "kind") -> DataFrame:
    """The base table after the changes: base rows count as inserts before all of them; one shuffle by key."""
    first = base.select(*keys, *columns, F.lit("insert").alias(kind), F.lit(-1).cast("bigint").alias(order), *(F.lit(True).alias(f"_has_{c}") for c in columns))
    then = changes.select(*keys, *columns, kind, F.col(order).cast("bigint").alias(order), *(p.alias(f"_has_{c}") for c, p in columns.items()))
    return fold(first.unionByName(then), keys, {c: F.col(f"_has_{c}") for c in columns}, order, kind)


def violations(changes: DataFrame, keys: list[str], order: str = "lsn", kind: str = "kind") -> DataFrame:
    """Changes that a row-by-row replay would refuse: an insert of a live key, an update or delete of a dead one."""
    before = F.lag(kind).over(Window.partitionBy(*keys).orderBy(order))
    live = before.isNotNull() & (before != "delete")
    checked = changes.withColumn("_live", live)
    known = F.when(F.col(kind).isin("insert", "update", "delete"), True).otherwise(F.raise_error(F.concat(F.lit("unknown operation: "), F.col(kind))).cast("boolean"))
    reason = F.when((F.col(kind) == "insert") & F.col("_live"), "insert of a live key").when((F.col(kind) != "insert") & ~F.col("_live"), "change of a missing key")
    return checked.withColumn("reason", reason).where(known & F.col("reason").isNotNull()).drop("_live")


def _written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again, which cuts its lineage."""
    from ..plans import store

    path = store.scratch(df.sparkSession, "lives")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold_key_changes(changes: DataFrame, old: str, new: str, columns: dict[str, Column], order: str = "lsn", kind: str = "kind") -> DataFrame:
    """The live rows where updates may change the key from ``old`` to ``new``: columns ``key`` and ``columns``.

    A change of key ends the row at the old key and starts one at the new key, which takes the columns it does not
    carry from there.  Each key's changes are cut into such lives and folded; then a life's missing columns are
    taken from the life it came from, by joins that double the distance each time, so that chains of n key changes
    need log2(n) joins and no task holds a chain.
    """
    moved = (F.col(kind) == "update") & ~F.col(old).eqNullSafe(F.col(new))
    flags = {f"_has_{c}": (p | (F.col(kind) == "insert")) & (F.col(kind) != "delete") for c, p in columns.items()}
    named = changes.withColumns(flags | {"_moved": moved})
    here = named.select(F.when(F.col(kind) == "delete", F.col(old)).otherwise(F.col(new)).alias("key"), F.col(order).alias("_at"), F.when(F.col("_moved"), "arrive").otherwise(F.col(kind)).alias("_kind"), F.when(F.col("_moved"), F.col(old)).alias("_from"), *columns, *flags)
    gone = named.where("_moved").select(F.col(old).alias("key"), F.col(order).alias("_at"), F.lit("leave").alias("_kind"), F.lit(None).cast(changes.schema[old].dataType).alias("_from"), *columns, *(F.lit(False).alias(f) for f in flags))
    line = Window.partitionBy("key").orderBy("_at", F.when(F.col("_kind") == "leave", 0).otherwise(1)).rowsBetween(Window.unboundedPreceding, 0)
    lives = here.unionByName(gone).withColumn("_life", F.sum(F.col("_kind").isin("insert", "arrive").cast("int")).over(line))
    state = lives.groupBy("key", "_life").agg(
        *(F.max_by(c, F.when(F.col(f"_has_{c}"), F.col("_at"))).alias(c) for c in columns),
        *(F.max(f"_has_{c}").alias(f"_has_{c}") for c in columns),
        F.max_by("_kind", F.struct("_at", F.when(F.col("_kind") == "leave", 0).otherwise(1))).alias("_last"),
        F.min(F.when(F.col("_kind") == "arrive", F.col("_at"))).alias("_since"),
        F.first("_from", ignorenulls=True).alias("_from"),
        F.max(F.when(F.col("_kind") == "leave", F.col("_at"))).alias("_until"),
    )
    # a life is named by the change that ended it
    state = state.withColumn("_parent_key", F.col("_from")).withColumn("_parent_at", F.col("_since"))
    while True:
        open_ = F.lit(False)
        for c in columns:
            open_ = open_ | ~F.col(f"_has_{c}")
        state = _written(state)
        if state.where(open_ & F.col("_parent_at").isNotNull()).isEmpty():
            break
        up = state.where("_until IS NOT NULL").select(F.col("key").alias("_k"), F.col("_until").alias("_u"), *(F.col(c).alias(f"_up_{c}") for c in columns), *(F.col(f"_has_{c}").alias(f"_up_has_{c}") for c in columns), F.col("_parent_key").alias("_pk"), F.col("_parent_at").alias("_pa"))
        joined = state.join(up, (F.col("_parent_key") == F.col("_k")) & (F.col("_parent_at") == F.col("_u")), "left")
        state = joined.select(
            "key", "_life", "_last", "_until",
            *(F.when(F.col(f"_has_{c}"), F.col(c)).otherwise(F.col(f"_up_{c}")).alias(c) for c in columns),
            *((F.col(f"_has_{c}") | F.coalesce(f"_up_has_{c}", F.lit(False))).alias(f"_has_{c}") for c in columns),
            F.col("_pk").alias("_parent_key"), F.col("_pa").alias("_parent_at"),
        )
    return state.where("_last NOT IN ('delete', 'leave')").select("key", *columns)


def duplicate_keys(table: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their numbers."""
    return table.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(table: DataFrame, parent: DataFrame, columns: list[str], parent_columns: list[str]) -> DataFrame:
    """Rows whose reference has no row in the parent; a null reference refers to nothing."""
    on = [F.col(f"_t.{a}") == F.col(f"_p.{b}") for a, b in zip(columns, parent_columns, strict=True)]
    some = table.dropna(subset=columns).alias("_t")
    return some.join(parent.alias("_p"), on, "left_anti")


def archive(spool: DataFrame, applied: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The spool without applied rows, and the applied rows for the archive."""
    done = applied.select(*keys).distinct()
    return spool.join(done, keys, "left_anti"), spool.join(done, keys, "left_semi")
