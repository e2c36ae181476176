"""Advice on indexes from catalog tables, and what a restore keeps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import quoted_if_needed


def missing_fk_indexes(constraints: DataFrame, indexes: DataFrame, columns: DataFrame) -> DataFrame:
    """CREATE INDEX statements for foreign keys that no index starts with, in any order of the columns.

    constraints: conname, conrelid, contype, conkey; indexes: indrelid, indkey, indnkeyatts; columns: attrelid, attnum,
    attname.  Only the first ``indnkeyatts`` columns of an index are keys.
    """
    keys = constraints.where("contype = 'f'")
    lead = F.slice(F.col("indkey"), F.lit(1), F.least(F.size("conkey"), F.col("indnkeyatts")))
    covered = (F.size(F.array_except(lead, "conkey")) == 0) & (F.size(F.array_except("conkey", lead)) == 0)
    bare = keys.join(indexes, (F.col("conrelid") == F.col("indrelid")) & covered, "left_anti")
    each = bare.select("conname", "conrelid", F.posexplode("conkey").alias("place", "attnum"))
    named = each.join(columns, (F.col("conrelid") == F.col("attrelid")) & (each["attnum"] == columns["attnum"])).select("conname", "conrelid", "place", quoted_if_needed(F.col("attname")).alias("name"))
    listed = named.groupBy("conrelid", "conname").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "name"))), lambda x: x["name"]), ",").alias("names"))
    return listed.select("conrelid", "conname", F.concat(F.lit("CREATE INDEX ON "), F.col("conrelid"), F.lit("("), F.col("names"), F.lit(")")).alias("statement"))


def invalid_indexes(indexes: DataFrame, locks: DataFrame) -> DataFrame:
    """DROP statements for invalid indexes that nobody holds."""
    free = indexes.where("NOT indisvalid").join(locks, F.col("relation") == F.col("indexrelid"), "left_anti")
    return free.select("indexrelid", F.concat(F.lit("DROP INDEX CONCURRENTLY "), F.col("indexrelid")).alias("statement"))


def has_several_unique(indexes: DataFrame) -> DataFrame:
    """Tables and whether more than one unique index is on them."""
    return indexes.groupBy("indrelid").agg(F.count_if("indisunique").alias("n_unique")).withColumn("several", F.col("n_unique") > 1)


#: Kinds of statements by how they begin, and the type of object that they create (None: none).
CREATES = (
    ("schema", r"^create\s+schema\s+(?:if\s+not\s+exists\s+)?"),
    ("extension", r"^create\s+extension\s+(?:if\s+not\s+exists\s+)?"),
    ("function", r"^create\s+(?:or\s+replace\s+)?function\s+"),
    ("event_trigger", r"^create\s+event\s+trigger\s+"),
    ("trigger", r"^create\s+(?:or\s+replace\s+)?(?:constraint\s+)?trigger\s+"),
    ("policy", r"^create\s+policy\s+"),
    ("view", r"^create\s+(?:or\s+replace\s+)?view\s+"),
    ("sequence", r"^create\s+sequence\s+(?:if\s+not\s+exists\s+)?"),
    ("index", r"^create\s+(?:unique\s+)?index\s+(?:concurrently\s+)?(?:if\s+not\s+exists\s+)?"),
    ("type", r"^create\s+type\s+"),
    ("table", r"^create\s+(?:unlogged\s+)?table\s+(?:if\s+not\s+exists\s+)?"),
)
NO_OBJECT = r"^(set|select|with|alter|comment|begin|start|commit|rollback|insert|update|delete|vacuum|drop|do|truncate|create\s+cast|grant|revoke)\b"


def object_created(statement: Column) -> tuple[Column, Column]:
    """Type and name of the object that a statement creates; both null if none; an unknown statement has type
    ``unknown``."""
    text = F.trim(F.regexp_replace(statement, r"^(?:\s*--[^\n]*\n)+", ""))
    kind, name = F.when(text.rlike(f"(?i){NO_OBJECT}"), None), F.when(text.rlike(f"(?i){NO_OBJECT}"), None)
    for what, start in CREATES:
        kind = kind.when(text.rlike(f"(?i){start}"), what)
        name = name.when(text.rlike(f"(?i){start}"), F.regexp_extract(text, f'(?i){start}((?:"[^"]*"|[^\\s"(;.]+)(?:[.](?:"[^"]*"|[^\\s"(;.]+))?)', 1))
    return kind.otherwise("unknown"), name


def routing(statement: Column) -> Column:
    """What a restore does with a statement: ``skip``, ``post`` (after the data) or ``pre``."""
    s = lambda p: statement.rlike(f"(?is)^\\s*{p}")
    skipped = s(r"create\s+(?:or\s+replace\s+)?(?:constraint\s+|event\s+)?trigger\b") | s(r"(?:grant|revoke|comment|create\s+policy|create\s+cast|alter\s+default\s+privileges|alter\s+index)\b") | s(r"alter\s+.*\bowner\s+to\b") | s(r"alter\s+table\s.*\benable\s+row\s+level\s+security") | s(r"alter\s+table\s.*\breplica\s+identity\b")
    post = s(r"create\s+(?:unique\s+)?index\b") | s(r"alter\s+table\s.*\badd\s+constraint\b") | s(r"alter\s+table\s.*\bcluster\s+on\b")
    return F.when(post & ~s(r"alter\s+index\b"), "post").when(skipped, "skip").otherwise("pre")


def post_data_kept(statement: Column) -> Column:
    """Of the statements after the data: primary, unique and foreign keys and unique indexes are kept; checks,
    exclusions, clustering and other indexes are not; several commands in one statement always are."""
    s = lambda p: statement.rlike(f"(?is)^\\s*{p}")
    many = s(r"alter\s+table\s+[^,(]*(?:\([^)]*\)[^,(]*)*,")
    add = s(r"alter\s+table\s.*\badd\s+constraint\b")
    key = s(r"alter\s+table\s.*\badd\s+constraint\s+\S+\s+(?:primary\s+key|unique|foreign\s+key)\b")
    return F.when(s(r"create\s+index\b"), False).when(s(r"alter\s+table\b") & many, True).when(add, key).when(s(r"alter\s+table\s.*\bcluster\s+on\b"), False).otherwise(True)
