"""Running sums over long ordered streams, in two levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a block, on average.
BLOCK_ROWS = 100_000


def running_sum(df: DataFrame, groups: list[str], order: str, value: Column, name: str, *, own: bool = True, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows of the same group up to this one, or before it if not
    ``own``.  ``order`` is a whole number without ties inside a group; null values count as 0.

    A group may be one stream of any length: its numbers are cut into blocks, a window adds up the blocks' sums, of
    which there are few, and another one the rows inside each block.
    """
    n, low, high = df.agg(F.count(F.lit(1)), F.min(order), F.max(order)).first()
    # as many numbers in a block as make ``block_rows`` rows on average
    width = max(1, (high - low + 1) * block_rows // n) if n and low is not None else 1
    cut = df.withColumns({"_block": F.floor((F.col(order) - F.lit(low or 0)) / width).cast("bigint"), "_value": F.coalesce(value.cast("bigint"), F.lit(0).cast("bigint"))})
    sums = cut.groupBy(*groups, "_block").agg(F.sum("_value").alias("_sum"))
    earlier = Window.partitionBy(*groups).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*(F.col(g).alias(f"_of_{g}") for g in groups), F.col("_block").alias("_at"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0).cast("bigint")).alias("_before"))
    inside = Window.partitionBy(*groups, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow if own else -1)
    same = F.col("_block").eqNullSafe(F.col("_at"))  # null groups are groups, too
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    out = cut.join(before, same).withColumn(name, F.col("_before") + F.coalesce(F.sum("_value").over(inside), F.lit(0).cast("bigint")))
    return out.select(*df.columns, name)
