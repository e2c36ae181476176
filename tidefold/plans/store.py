"""Small files in any store that Spark reaches: manifests are replaced by one rename."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write beside the target, then rename: readers see the old file or the new one, never a part."""
    fs, where = _path(spark, path)
    _, beside = _path(spark, f"{path}.new")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri() if where.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(beside), fs.makeQualified(where), options)


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, where = _path(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _path(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _path(spark, path)
    fs.delete(where, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that ``spark.checkpoint.dir`` names, or, where all executors are in this process, in a
    temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tidefold-")
    return f"{root.rstrip('/')}/tidefold/{name}-{uuid.uuid4().hex}"
