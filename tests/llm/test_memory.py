"""What Python workers hold beside Spark's own memory: batches while they work, nothing freed while they wait."""

import os
import sys
import time
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidefold.llm.common import map_arrow


def resident_mb(pid):
    return int(Path(f"/proc/{pid}/statm").read_text().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 1e6


def test_batches_are_small(spark):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows]), "size": pa.array([b.nbytes])})

    docs = spark.range(0, 10_000, 1, 1).select("id", F.repeat(F.col("id").cast("string"), 1000).alias("text"))
    out = map_arrow(docs, run, "n bigint, size bigint").collect()
    assert sum(r["n"] for r in out) == 10_000 and max(r["size"] for r in out) < 5 << 20


def test_waiting_workers_hold_no_freed_memory(spark):
    def run(batches):
        for _ in batches:
            before = resident_mb(os.getpid())
            held = [np.ones(60_000, np.uint8) for _ in range(5_000)]  # 300 MB in pieces, as of texts
            most = resident_mb(os.getpid())
            sys.tf_kept = held[::50]  # some stay between those that are freed
            del held
            yield pa.RecordBatch.from_pydict({"pid": [os.getpid()], "before": [before], "most": [most]})

    r = map_arrow(spark.range(0, 1, 1, 1), run, "pid bigint, before double, most double").collect()[0]
    assert r["most"] > r["before"] + 250
    time.sleep(0.5)
    assert resident_mb(r["pid"]) < r["before"] + 60
