"""Restore of a schema: what runs before the data, what after, and what may fail."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import advisor


@dataclass
class Outcome:
    """What ran, what failed as it may, what was left out, and the statements for after the data, keys first."""

    executed: list[str] = field(default_factory=list)
    failed: list[tuple[str, str]] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    post: list[str] = field(default_factory=list)


def restore_schema(spark: SparkSession, statements: list[str], execute: Callable[[str], None], *, blacklist: set[tuple[str, str]] = frozenset(), failable: set[tuple[str, str]] = frozenset()) -> Outcome:
    """Run the statements that come before the data, in order.

    ``blacklist`` and ``failable`` hold (type, name) of created objects: the first are left out, an error of the
    second is recorded and passed over; any other error ends the restore.  A dump's statements are few.
    """
    kind, name = advisor.object_created(F.col("s"))
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(statements)], "i int, s string")
    found = rows.select("i", "s", kind.alias("kind"), name.alias("name"), advisor.routing(F.col("s")).alias("route"), advisor.post_data_kept(F.col("s")).alias("kept"), F.col("s").rlike("(?i)foreign\\s+key").alias("reference"))
    out, post = Outcome(), []
    for r in sorted(found.collect(), key=lambda r: r["i"]):
        made = (r["kind"], r["name"])
        if r["route"] == "skip" or made in blacklist or (r["route"] == "post" and not r["kept"]):
            out.skipped.append(r["s"])
        elif r["route"] == "post":
            post.append(r)
        else:
            try:
                execute(r["s"])
                out.executed.append(r["s"])
            except Exception as e:  # noqa: BLE001  whatever the target says
                if made not in failable:
                    raise
                out.failed.append((r["s"], str(e)))
    out.post = [r["s"] for r in sorted(post, key=lambda r: (r["reference"], r["i"]))]  # keys before references
    return out
