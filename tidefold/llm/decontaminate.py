"""Benchmark decontamination: a broadcast hash set of normalised benchmark n-grams, scanned by token windows.

Texts are lower-cased (A-Z) and cut into words; a benchmark item gives its windows of ``width`` consecutive words,
or one shorter window if it has fewer words.  The hashes of all windows go to every executor; document windows whose
hash is in the set are compared word for word before they count.  Documents are scanned in one narrow pass.

The set is sent in portions of at most ``portion_windows`` windows, long items in several parts, so that what is
built and broadcast at a time never grows with the tables; one portion is the usual case.  Where there are more, each
pass adds what its portion hits to the rows of the pass before, which are written in between: rows are never joined.

Defined results: null or empty texts have no words; items without words have no windows; windows of items with a null
id hit, but add no id; items with equal texts or ids all count, an id once; repeated rows and null ids are rows like
others and give equal results; an empty benchmark hits nothing; columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM_WORDS, LOWER, blocks, bytes_of, map_arrow, materialize, prefix_sums, quoted, span_hash, window_hash, word_spans

SPANS = "array<struct<start:bigint,end:bigint>>"
_FILTER_BITS = 20


def words_of(text: str) -> list[bytes]:
    """The words of a text in lower case."""
    low = LOWER[np.frombuffer(text.encode(), np.uint8)]
    raw = low.tobytes()
    return [raw[a:b] for a, b in zip(*(x.tolist() for x in word_spans(low, ALNUM_WORDS)), strict=True)]


class Windows:
    """The windows of some items, given by their words: in the order of their hashes, as places in the joined words."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], width: int):
        self.names = [item for item, _ in items]
        self.text = b" ".join(w for _, words in items for w in words)
        buf = np.frombuffer(self.text, np.uint8)
        start, end = word_spans(buf, ALNUM_WORDS)
        ids = span_hash(prefix_sums(buf), start, end)
        first = np.cumsum([0, *(len(words) for _, words in items)])
        sizes = np.minimum(np.diff(first), width)
        #: by number of words: hashes in order, and the item, begin and end of each window
        self.windows: dict[int, tuple[np.ndarray, ...]] = {}
        self.filters = {}
        for n in set(sizes[sizes > 0].tolist()):
            of = np.flatnonzero(sizes == n)
            item = np.repeat(of, first[of + 1] - first[of] - n + 1)
            h = window_hash(ids, n)
            at = np.concatenate([np.arange(first[i], first[i + 1] - n + 1) for i in of])
            order = np.argsort(h[at], kind="stable")
            at = at[order]
            self.windows[n] = h[at], item[order].astype(np.int32), start[at].astype(np.int32), end[at + n - 1].astype(np.int32)
            self.filters[n] = np.zeros(1 << _FILTER_BITS, bool)
            self.filters[n][h[at] >> np.uint64(64 - _FILTER_BITS)] = True

    def owners(self, n: int, h: int, words: bytes) -> set[int]:
        """The items that have this window of n words, compared word for word."""
        known, item, begin, end = self.windows[n]
        at, found = int(np.searchsorted(known, h)), set()
        while at < len(known) and known[at] == h:
            if self.text[begin[at] : end[at]] == words:
                found.add(int(item[at]))
            at += 1
        return found

    def scan(self, texts: list[bytes]) -> list[tuple[int, list[dict], list[dict], list[str]]]:
        """For each text: its number of words, the runs of hit words, as word numbers and as bytes, and the items."""
        buf = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        low = LOWER[buf]
        start, end = word_spans(low, ALNUM_WORDS)
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        first = np.searchsorted(start, begins)  # of each text's words
        doc = np.repeat(np.arange(len(texts)), np.diff(first))
        ids = span_hash(prefix_sums(low), start, end)
        edge = np.zeros(len(start) + 1, np.int32)
        found: dict[int, set[str]] = {}
        for n, (known, *_) in self.windows.items():
            h = window_hash(ids, n)
            at = np.flatnonzero(self.filters[n][h >> np.uint64(64 - _FILTER_BITS)])
            at = at[doc[at] == doc[at + n - 1]]
            at = at[known[np.minimum(np.searchsorted(known, h[at]), len(known) - 1)] == h[at]]
            for i in at.tolist():
                words = b" ".join(low[a:b].tobytes() for a, b in zip(start[i : i + n].tolist(), end[i : i + n].tolist(), strict=True))
                if owners := self.owners(n, h[i], words):
                    edge[i] += 1
                    edge[i + n] -= 1
                    found.setdefault(int(doc[i]), set()).update(owners)
        hit = np.cumsum(edge[:-1]) > 0
        out = []
        for d in range(len(texts)):
            a, b = int(first[d]), int(first[d + 1])
            runs, spans = [], []
            if d in found:
                flags = np.diff(np.concatenate(([0], hit[a:b].astype(np.int8), [0])))
                runs = [{"start": int(x), "end": int(y)} for x, y in zip(np.flatnonzero(flags == 1), np.flatnonzero(flags == -1), strict=True)]
                spans = [{"start": int(start[a + r["start"]] - begins[d]), "end": int(end[a + r["end"] - 1] - begins[d])} for r in runs]
            names = {self.names[i] for i in found.get(d, ())}
            out.append((b - a, runs, spans, sorted(x for x in names if x is not None)))
        return out


def portions(benchmark: DataFrame, item: str, text: str, width: int, most: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The items as words, in lists of at most about ``most`` words; a long item comes in parts that share words, so
    that each of its windows is in one of them."""
    rows, size = [], 0
    for r in benchmark.select(F.col(item).cast("string"), F.col(text)).where(F.col(text).isNotNull()).toLocalIterator():
        words = words_of(r[1])
        for a in range(0, max(1, len(words) - width + 1), max(1, most)):
            part = words[a : a + most + width - 1]
            if rows and size + len(part) > most:
                yield rows
                rows, size = [], 0
            if part:
                rows.append((r[0], part))
                size += len(part)
    yield rows


def _united(old: list[dict], new: list[dict]) -> list[dict]:
    """Spans sorted and joined where they overlap or touch."""
    done: list[dict] = []
    for s in sorted([*old, *new], key=lambda s: s["start"]):
        if done and done[-1]["end"] >= s["start"]:
            done[-1]["end"] = max(done[-1]["end"], s["end"])
        else:
            done.append(dict(s))
    return done


def scan(documents: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", width: int = 10, portion_windows: int = 1_000_000, keep: tuple[str, ...] = (), prefix: str = "") -> DataFrame:
    """One row per document: ``key``, the columns ``keep``, n_words, word_spans, byte_spans and item_ids.

    ``prefix`` is put before these names; a column of ``keep`` with one of them is replaced.
    """
    spark = documents.sparkSession
    new = [prefix + x for x in ("n_words", "word_spans", "byte_spans", "item_ids")]
    out_names = [c for c in dict.fromkeys((key, *keep)) if c not in new]
    added = T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in zip(new, ("bigint", SPANS, SPANS, "array<string>"), strict=True)))
    own = documents.select(*quoted(out_names)).schema
    kinds = (pa.int64(), *[pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))] * 2, pa.list_(pa.string()))
    scanned = "_tf_scanned"

    def one_pass(df: DataFrame, items: list[tuple[str | None, list[bytes]]], first: bool, last: bool) -> DataFrame:
        shared = spark.sparkContext.broadcast(Windows(items, width))  # portion_windows at most
        schema = T.StructType([*own, *added, *([] if last else [T.StructField(scanned, T.StringType())])])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            windows = shared.value
            for block in blocks(batches, scanned):
                found = windows.scan(bytes_of(block, scanned))
                if not first:
                    before = zip(*(block.column(len(out_names) + i).to_pylist() for i in range(4)), strict=True)
                    found = [(n, _united(r, a), _united(s, b), sorted({*x, *y})) for (n, r, s, x), (_, a, b, y) in zip(before, found, strict=True)]
                columns = [block.column(i) for i in range(len(out_names))]
                columns += [pa.array(x, k) for x, k in zip(zip(*found, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*columns, *([] if last else [block.column(block.num_columns - 1)])], names=schema.names)

        return map_arrow(df, run, schema)

    out = documents.select(*quoted(out_names), F.col(f"`{text}`").alias(scanned))
    waiting = None
    for n, items in enumerate(portions(benchmark, item, item_text, width, portion_windows)):
        if waiting is not None:
            out = materialize(one_pass(out, waiting, n == 1, False), "scanned")
        waiting = items
        count = n
    return one_pass(out, waiting, count == 0, True)


def n_hit(prefix: str = ""):
    """Hit words of a scanned row."""
    return F.aggregate(f"`{prefix}word_spans`", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])


def clean(documents: DataFrame, benchmark: DataFrame, *, action: str = "remove_documents", max_hit_share: float = 0.0, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Documents without benchmark passages, in their own columns.

    ``remove_documents`` drops documents with more than ``max_hit_share`` of their words hit;
    ``remove_spans`` cuts the hit words out of the text and keeps every document.
    """
    names, p = documents.columns, "_tf_"
    found = scan(documents, benchmark, key=key, text=text, keep=tuple(names), prefix=p, **options)
    if action == "remove_documents":
        return found.where(n_hit(p) <= max_hit_share * F.col(f"{p}n_words")).select(*quoted(names))
    if action != "remove_spans":
        raise ValueError(f"unknown action {action!r}")
    raw, spans = F.encode(F.col(f"`{text}`"), "utf-8"), f"{p}byte_spans"
    starts = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.octet_length(F.col(f"`{text}`")).cast("bigint")))
    pieces = F.zip_with(starts, ends, lambda a, b: F.decode(F.substring(raw, (a + 1).cast("int"), (b - a).cast("int")), "utf-8"))
    return found.withColumn(text, F.when(F.size(spans) > 0, F.array_join(pieces, "")).otherwise(F.col(f"`{text}`"))).select(*quoted(names))
