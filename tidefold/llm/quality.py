"""Quality rules with risk-controlled thresholds.

Text statistics are taken in one narrow pass over whole texts.  Each rule is a score that is higher for worse
texts; its level says how far above the upper quartile of its stratum it is, in quarters of the distance between the
quartiles, which are those of the documents without labels.  A document is rejected if any rule's level reaches the
stratum's cutoff.  Labelled documents are the holdout: within each stratum, the share of good documents (quality 1)
that a cutoff rejects by all rules together has an exact (Clopper-Pearson) upper bound.  The cutoffs are tested from the
mildest to the strictest until one fails (fixed-sequence testing), each at the whole ``alpha``, so a stratum is one
hypothesis family; Bonferroni's correction over the strata with at least ``least_good`` good labelled documents, which are
tested, keeps the chance of any error below ``delta``.  Quartiles, levels' histograms and cutoffs are tables with a row
for each stratum, so there may be any number of strata.

Defined results: null texts have no words and fail the base rules; documents of a stratum that is not tested, or whose
first test fails, are judged by the base rules alone; a null stratum is one of its own; repeated rows are judged alike,
and repeated labels, of repeated rows too, count as often as they occur; labels of unknown documents, and null ones, do
not count; of levels that tie with the cutoff all are rejected; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE_WORDS, blocks, bytes_of, map_arrow, materialize, mix64, prefix_sums, quoted, span_hash, window_hash, word_spans

SYMBOLS = b"#*$%&|<>"
REPEAT_WIDTH = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
GRID = 64

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def statistics(texts: list[bytes]) -> list[np.ndarray]:
    """The COUNTS of each text."""
    n = len(texts)
    buf = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    start, end = word_spans(buf, SPACE_WORDS)
    first = np.searchsorted(start, begins)
    doc = np.repeat(np.arange(n), np.diff(first))
    points = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))
    per_doc = lambda values: np.bincount(doc, values, n).astype(np.int64)
    chars = per_doc(points[end] - points[start])
    marks = np.concatenate(([0], np.cumsum(_SYMBOL[buf])))
    symbols = marks[begins[1:]] - marks[begins[:-1]]
    repeats = np.zeros(n, np.int64)
    h = window_hash(span_hash(prefix_sums(buf), start, end), REPEAT_WIDTH)
    if len(h):
        whole = doc[: len(h)] == doc[REPEAT_WIDTH - 1 :]
        at = np.flatnonzero(whole)
        keys = h[at] ^ mix64(doc[at].astype(np.uint64) + np.uint64(1))  # equal windows of one text
        order = np.argsort(keys)
        same = keys[order[1:]] == keys[order[:-1]]
        twice = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        hit = at[order[twice]] if len(at) else at
        size = len(start) + 1
        edge = np.bincount(hit, minlength=size) - np.bincount(hit + REPEAT_WIDTH, minlength=size)
        repeats = per_doc((np.cumsum(edge[:-1]) > 0).astype(np.int64))
    lines = np.zeros(n, np.int64)
    for d, text in enumerate(texts):
        seen: set[bytes] = set()
        for line in text.split(b"\n"):
            if line in seen:
                lines[d] += 1
            elif line.strip():
                seen.add(line)
    return [np.diff(first).astype(np.int64), chars, symbols.astype(np.int64), lines, repeats]


def features(documents: DataFrame, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with the COUNTS of every whole text; a narrow step.  A column of their names is replaced."""
    kept = list(dict.fromkeys((*keep, text)))
    out = [c for c in kept if c in keep and c not in COUNTS]
    schema = T.StructType([*documents.select(*quoted(out)).schema, *T.StructType.fromDDL(", ".join(f"{c} bigint" for c in COUNTS))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            own = [block.column(kept.index(c)) for c in out]
            yield pa.RecordBatch.from_arrays([*own, *map(pa.array, statistics(bytes_of(block, text)))], names=schema.names)

    return map_arrow(documents.select(*quoted(kept)), run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def rule_scores() -> dict[str, Column]:
    """Scores from 0 to 1, higher for worse texts; null where a text has no words."""
    words = F.when(F.col("n_words") > 0, F.col("n_words"))
    chars = F.when(F.col("word_chars") > 0, F.col("word_chars"))
    mean = chars / words
    return {
        "symbols": F.col("n_symbols") / chars,
        "repeats": F.col("n_repeat_words") / words,
        "lines": F.when(words.isNotNull(), F.least(F.lit(1.0), 8 * F.col("n_dup_lines") / words)),
        "long_words": F.when(mean.isNotNull(), F.least(F.lit(1.0), mean / 64)),
        "short_words": 1 / (1 + mean),
        "few_words": 1 / (1 + words / 32),
    }


def upper_bound(k: int, n: int, level: float) -> float:
    """Exact upper confidence bound of a binomial share, k of n seen: P(X <= k; share) = level."""
    if n == 0 or k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in range(k + 1)]

    def tail(p: float) -> float:
        a, b = math.log(p), math.log1p(-p)
        terms = [c + i * a + (n - i) * b for i, c in enumerate(logs)]
        top = max(terms)
        return top + math.log(sum(math.exp(x - top) for x in terms))

    low, high, goal = k / n, 1.0 - 1e-12, math.log(level)
    low = max(low, 1e-12)
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if tail(middle) > goal else (low, middle)
    return high


def cutoff(good: list[int], alpha: float, level: float) -> int:
    """The smallest level that is rejected (GRID + 1: none), from the numbers of good documents by level."""
    n, rejected, cut = sum(good), 0, GRID + 1
    while cut > 0 and upper_bound(rejected + good[cut - 1], n, level) <= alpha:
        cut -= 1
        rejected += good[cut]
    return cut


def cutoffs(cells: DataFrame, alpha: float, level: float) -> DataFrame:
    """(_stratum, _cut) from (_stratum, b, n): good documents by level."""
    lists = cells.groupBy("_stratum").agg(F.collect_list(F.struct("b", "n")).alias("cells"))  # GRID + 1 at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = []
            for found in batch.column(1).to_pylist():
                good = [0] * (GRID + 1)
                for c in found:
                    good[c["b"]] += c["n"]
                cuts.append(cutoff(good, alpha, level))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cuts, pa.int32())], names=["_stratum", "_cut"])

    return lists.mapInArrow(run, "_stratum string, _cut int")


def judge(documents: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", stratum: str = "lang", quality: str = "quality", alpha: float = 0.03, delta: float = 0.05, least_good: int = 100) -> DataFrame:
    """One row per document: ``key``, the COUNTS, base_failed, kept and failed_rules (an array of rule names)."""
    own = F.when(F.col(f"`{stratum}`").isNull(), "").otherwise(F.concat(F.lit("="), F.col(f"`{stratum}`").cast("string")))
    base = features(documents.withColumn("_stratum", own), text=text, keep=(key, "_stratum"))
    base = materialize(base, "quality")  # small: no texts
    rules = rule_scores()
    # the rows of tables with one row a stratum are broadcast if Spark measures that they are few, else dealt
    labelled = base.join(labels.select(F.col(key), F.col(quality).alias("_quality")), key).where((F.col("_quality") == 1) & ~base_failed())
    tested = materialize(labelled.groupBy("_stratum").agg(F.count("*").alias("n")).where(F.col("n") >= least_good).select("_stratum"), "strata")
    level = delta / max(1, tested.count())
    # the order of the tests comes from documents without labels, so that it does not depend on the holdout
    others = base.where(~base_failed()).join(labels.select(key), key, "left_anti").join(tested, "_stratum")
    quartiles = others.groupBy("_stratum").agg(*(F.percentile_approx(x, [0.25, 0.75], 1000).alias(r) for r, x in rules.items()))
    shape = lambda q: F.when(q.isNull(), F.array(F.lit(0.0), F.lit(4 / GRID))).otherwise(F.array(q[1], F.greatest(q[1] - q[0], F.lit(1 / GRID))))
    shapes = tested.join(quartiles, "_stratum", "left").select("_stratum", *(shape(F.col(r)).alias(f"_{r}") for r in rules))
    shapes = materialize(shapes, "shapes")
    levels = {r: F.coalesce(F.least(F.lit(GRID), F.greatest(F.lit(0), F.floor(4 * (x - F.col(f"_{r}")[0]) / F.col(f"_{r}")[1]))), F.lit(0)).cast("int") for r, x in rules.items()}
    cells = labelled.join(shapes, "_stratum").select("_stratum", F.greatest(*levels.values()).alias("b")).groupBy("_stratum", "b").agg(F.count("*").alias("n"))
    table = materialize(shapes.join(cutoffs(cells, alpha, level), "_stratum"), "cutoffs")
    failed = F.array_compact(F.array(*(F.when(x >= F.col("_cut"), F.lit(r)) for r, x in levels.items())))
    judged = base.join(table, "_stratum", "left")
    return judged.select(key, *COUNTS, base_failed().alias("base_failed"), failed.alias("failed_rules")).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
