"""Shared pieces: the cluster's shared folder, lineage cuts, Arrow blocks and rolling hashes."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own_root: list[str] = []

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Bytes of a batch of rows that goes to Python, where the session does not say otherwise, and Spark's own number.
BATCH_BYTES, SPARK_BATCH = 4 << 20, 64 << 20
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """From now on batches are bounded by BATCH_BYTES, as each task holds a few of them outside of Spark's memory."""
    if spark.conf.get(BATCH).rstrip("b") == str(SPARK_BATCH):
        spark.conf.set(BATCH, f"{BATCH_BYTES}b")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that ``spark.checkpoint.dir`` names.

    Where it is unset, a temporary one if all executors are in this process; an error on a cluster.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        if not _own_root:
            _own_root.append("file://" + tempfile.mkdtemp(prefix="tidefold-"))
        root = _own_root[0]
    return f"{root.rstrip('/')}/tidefold/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    Shuffle files of the finished step are released, as the written table replaces them.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = shared_dir(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    gc.collect()
    heap = spark._jvm.java.lang.Runtime.getRuntime()
    if heap.totalMemory() - heap.freeMemory() > heap.maxMemory() // 3:
        spark._jvm.System.gc()  # Spark's cleaner releases broadcasts and shuffle files of what the driver has dropped
    out = spark.read.schema(df.schema).parquet(path)
    out._tidefold_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a materialized table that no later step reads."""
    spark = df.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(df._tidefold_path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def numbered(documents: DataFrame, key: str, text: str) -> DataFrame:
    """``row``, doc_id and text, with a number for each row that no other row has.

    It is the id where that is whole and occurs once.  Other rows, usually none, are written with numbers below all ids,
    so that these are the same whenever they are read.
    """
    df = documents.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    odd = df.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL").select("doc_id")
    odd = materialize(odd, "ids")
    if odd.isEmpty():
        return df.select(F.col("doc_id").alias("row"), "doc_id", "text")
    below = F.lit(min(0, df.agg(F.min("doc_id")).first()[0] or 0) - 1)
    same = df["doc_id"].eqNullSafe(odd["doc_id"])
    others = materialize(df.join(odd, same, "left_semi").select((below - F.monotonically_increasing_id()).alias("row"), "doc_id", "text"), "numbered")
    return df.join(odd, same, "left_anti").select(F.col("doc_id").alias("row"), "doc_id", "text").unionAll(others)


def quoted(names: Iterable[str]) -> list[Column]:
    """Columns by their names, whatever characters these have."""
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def release() -> None:
    """Give memory that this process has freed back to the system, as far as its allocators can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim is not None:
        trim(0)


def releasing(run: Callable) -> Callable:
    """``run``, after which the worker releases what it has freed: it waits for its next task beside Spark's own work."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return whole


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow``, also where columns have names that it cannot resolve; ``run`` finds those by position.

    Batches are small, and workers release their memory at the end of each task.
    """
    small_batches(df.sparkSession)
    names = [f"_tf_{i}" if re.search("[.`]", n) else n for i, n in enumerate(df.columns)]
    return df.toDF(*names).mapInArrow(releasing(run), schema)


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most about ``limit`` bytes of ``column`` (one row at least).

    Spark itself bounds a batch by rows and bytes (spark.sql.execution.arrow.maxBytesPerBatch).
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        group = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64)) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column's strings, null as empty."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def bytes_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The column's strings in UTF-8, null as empty."""
    return [x or b"" for x in batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()]


# Multipliers of the hashes; any odd numbers would do.
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD2 = np.uint64(0xC2B2AE3D27D4EB4F)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers."""
    x = x ^ (x >> np.uint64(31))
    x = x * _ODD
    x ^= x >> np.uint64(29)
    x *= _ODD2
    x ^= x >> np.uint64(32)
    return x


_TABLE = mix64(np.arange(1, 257, dtype=np.uint64))
_STEP = int(_ODD)
_BACK = pow(_STEP, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        p = np.full(max(n, 1 << 16), base, np.uint64)
        p[0] = 1
        have = np.cumprod(p, dtype=np.uint64)
        if n <= 8 << 20:
            _powers[base] = have
    return have[:n]


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """Sums S of table[byte] * step^-i, from which any substring's hash follows."""
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_TABLE[buf] * _power(_BACK, len(buf)), out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte string [start, end); depends on the bytes and the length only."""
    raw = (sums[end] - sums[start]) * _power(_STEP, len(sums))[start]
    return mix64(raw + (end - start).astype(np.uint64) * _ODD2)


def rolling_hash(sums: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all windows of ``width`` bytes."""
    n = len(sums) - 1
    if n < width:
        return np.zeros(0, np.uint64)
    raw = (sums[width:] - sums[:-width]) * _power(_STEP, n - width + 1)
    return mix64(raw + np.uint64(width * int(_ODD2) % (1 << 64)))


def window_hash(ids: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all windows of ``width`` consecutive 64-bit values."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(width):
        h *= _ODD2
        h += ids[j : j + n]
    return mix64(h)


def word_spans(buf: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes for which ``is_word[byte]`` is true."""
    flags = np.zeros(len(buf) + 2, np.int8)
    flags[1:-1] = is_word[buf]
    edge = np.diff(flags)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table that is true for bytes outside the given ranges."""
    out = np.ones(256, bool)
    for a, b in ranges:
        out[a : b + 1] = False
    return out


def lowered() -> np.ndarray:
    """A table that maps A-Z to a-z and keeps other bytes."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


#: Words [^\x20\x09-\x0D]+ in UTF-8 bytes.
SPACE_WORDS = byte_class((0x20, 0x20), (0x09, 0x0D))
#: Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text in UTF-8 bytes.
ALNUM_WORDS = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = lowered()
