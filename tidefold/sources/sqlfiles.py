"""SQL files as statements: each file is split where it is read."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from ..operators.sqltext import Splitter, check


def read_statements(spark: SparkSession, path: str) -> DataFrame:
    """file, position, statement and error: what check() finds, or text that does not end as a statement."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, text in zip(batch["path"], batch["text"], strict=True):
                splitter = Splitter()
                splitter.feed(text or "")
                found = splitter.take()
                rows += [(name, i, s, check(s)) for i, s in enumerate(found)]
                if rest := splitter.rest():
                    rows.append((name, len(found), rest, "no end of statement"))
            yield pd.DataFrame(rows, columns=["file", "position", "statement", "error"])

    files = spark.read.text(path, wholetext=True).selectExpr("_metadata.file_path AS path", "value AS text")
    return files.mapInPandas(run, "file string, position int, statement string, error string")
