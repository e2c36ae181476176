"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import discard, materialize


def components(edges: DataFrame) -> DataFrame:
    """For ``edges`` (a, b): one row per vertex of an edge between different vertices, with the component's smallest
    vertex: (vertex, component).

    Each step points vertices at the smallest one that their neighbours know, by a pre-aggregated minimum and a join on
    the vertex, whose large partitions Spark can split.  Both half steps are written, and the tables they came from
    deleted; the second one's count and checksum are taken while it is written, and a step that leaves them as they
    were is the last.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = materialize(now, "links")
    before = None
    while True:
        # large star: every greater neighbour of a vertex is pointed at the smallest of its neighbourhood
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = materialize(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")), "large")
        discard(now)
        # small star: every smaller neighbour, and the vertex, are pointed at the smallest one
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        ends = F.explode(F.array("a", "b")).alias("a")
        small = large.join(least, "a").select(ends, F.col("m").alias("b")).where("a <> b").distinct()
        seen = Observation()
        edge = F.xxhash64("a", "b")
        now = materialize(small.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(edge).alias("x"), F.sum(F.shiftright(edge, 32)).alias("s")), "links")
        discard(large)
        state = seen.get
        if state == before:
            return now.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
        before = state
