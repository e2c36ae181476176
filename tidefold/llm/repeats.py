"""Exact removal of repeated byte strings by a depth-limited radix sort of suffixes.

Suffixes are ordered through their first ``length`` bytes only, by most-significant-digit passes of eight bytes; a
suffix that is alone in its group drops out, and the groups left at the end are exactly the windows of ``length``
bytes that start more than once.  Every byte of such a window is removed.

Only suffixes that can be repeated are sorted, and only next to those they can be equal to.  Each window has an
anchor, its ``gram`` bytes with the least hash (the leftmost of equal ones).  Equal windows have equal anchors at
equal offsets, so:

* anchors whose hash occurs once in the corpus have no repeated windows, and go;
* of the stretches of windows that share an anchor, those that are alike as a whole (by hashes) are one kind; two of
  a kind, or the only one, are dealt by their anchor and sorted there.  What the sort finds in a kind is then removed from
  all its stretches, whose bytes have to have the same 128-bit digest;
* anchors with more windows than a task sorts at a time (ITEMS) are dealt anew: their windows are halved by their offset
  from the anchor, which makes the part that all windows of a half have in common longer, and dealt by that part; and
  so on, until a task can take them or a half is one window, whose equals may be dealt in any way.

Defined results: null texts are empty; texts shorter than ``length`` have no windows; overlapping windows of one
document count; long documents are read in segments of bounded memory; repeated rows are copies of one another, and rows
with a null id, or with one id and different texts, are documents like others; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, bytes_of, discard, materialize, numbered, prefix_sums, rolling_hash, span_hash

SEGMENT = 1 << 20
#: Windows sorted at a time.
ITEMS = 1_000_000


def window_minimum(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, by doubling."""
    done = 1
    while 2 * done <= width:
        h = np.minimum(h[:-done], h[done:])
        done *= 2
    return np.minimum(h[: len(h) - (width - done)], h[width - done :]) if done < width else h


def anchors(buf: np.ndarray, begins: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchors of the texts [begin, end) of a buffer: hash, hash of the stretch, position, first and last window."""
    none = np.zeros(0, np.int64)
    if not len(buf) or (ends - begins).max(initial=0) < length:
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    sums = prefix_sums(buf)
    h = rolling_hash(sums, gram)
    width = length - gram + 1
    least = window_minimum(h, width)
    edge = np.zeros(len(buf) + 1, np.int32)
    long = ends - begins >= length
    np.add.at(edge, begins[long], 1)
    np.add.at(edge, ends[long] - length + 1, -1)
    starts = np.flatnonzero(np.cumsum(edge[:-1]))
    value = least[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (value[1:] != value[:-1]) | (starts[1:] != starts[:-1] + 1)
    first_of_text = np.zeros(len(buf) + 1, bool)
    first_of_text[begins[long]] = True
    new |= first_of_text[starts]
    at = np.flatnonzero(new)
    lo, hi = starts[at], starts[np.concatenate((at[1:], [len(starts)])) - 1]
    place = np.empty(len(lo), np.int64)
    for a in range(0, len(lo), 4096):
        part = lo[a : a + 4096]
        place[a : a + 4096] = part + np.argmax(h[part[:, None] + np.arange(width)] == least[part][:, None], axis=1)
    tied = np.flatnonzero(hi > place)
    if len(tied):  # the same gram again within a window: each occurrence serves the windows that end before the next
        rows = []
        for t in tied.tolist():
            seen = lo[t] + np.flatnonzero(h[lo[t] : hi[t] + width] == least[lo[t]])
            since = np.concatenate(([lo[t]], seen[:-1] + 1))
            ok = since <= hi[t]
            rows.append((seen[ok], since[ok], np.minimum(seen[ok], hi[t])))
        keep = np.ones(len(lo), bool)
        keep[tied] = False
        place, lo, hi = (np.concatenate((x[keep], *(r[k] for r in rows))) for k, x in enumerate((place, lo, hi)))
    return h[place], span_hash(sums, lo, hi + length) ^ (place - lo).astype(np.uint64), place, lo, hi


def _segments(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int, int]]]]:
    """Buffers of about SEGMENT bytes with (text number, offset in it, begin, end); long texts in overlapping parts."""
    parts, size = [], 0
    for i, text in enumerate(texts):
        for a in range(0, max(1, len(text) - length + 1), SEGMENT):
            piece = text[a : a + SEGMENT + length - 1]
            if len(piece) < length:
                continue
            parts.append((i, a, piece))
            size += len(piece)
            if size >= SEGMENT:
                yield _joined(parts)
                parts, size = [], 0
    if parts:
        yield _joined(parts)


def _joined(parts: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, list[tuple[int, int, int, int]]]:
    ends = np.cumsum([len(p) for _, _, p in parts]).tolist()
    return np.frombuffer(b"".join(p for _, _, p in parts), np.uint8), [(i, a, e - len(p), e) for (i, a, p), e in zip(parts, ends, strict=True)]


def radix_repeats(data: np.ndarray, start: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Numbers of the suffixes (by their starts in ``data``) whose first ``length`` bytes another one of the same group
    has too.  Most-significant-digit passes; groups whose digits are all equal are not moved."""
    order = np.argsort(group, kind="stable")
    item = order
    g = group[order]
    rest = length % 8
    words = np.ndarray((max(0, len(data) - 7),), ">u8", data.tobytes(), strides=(1,))
    for depth in [*range(0, length - 7, 8), *([length - 8] if rest and length >= 8 else [])]:
        g = np.cumsum(np.concatenate(([0], (g[1:] != g[:-1]).astype(np.int64)))) if len(g) else g
        keep = np.bincount(g)[g] > 1 if len(g) else np.zeros(0, bool)
        item, g = item[keep], g[keep]
        if not len(item):
            break
        digit = words[start[item] + depth].astype(np.uint64)
        same = g[1:] == g[:-1]
        differs = same & (digit[1:] != digit[:-1])
        if differs.any():
            mixed = np.zeros(int(g[-1]) + 1, bool)
            mixed[g[1:][differs]] = True
            move = np.flatnonzero(mixed[g])
            by = move[np.lexsort((digit[move], g[move]))]
            item[move], digit[move] = item[by], digit[by]
            # a group's rows stand together, so its number need not move
        cut = np.concatenate(([0], ((g[1:] != g[:-1]) | (digit[1:] != digit[:-1])).astype(np.int64)))
        g = np.cumsum(cut)
    if not len(g):
        return np.zeros(0, np.int64)
    g = np.cumsum(np.concatenate(([0], (g[1:] != g[:-1]).astype(np.int64))))
    return item[np.bincount(g)[g] > 1]


#: A stretch to be sorted: its group, the offsets from the anchor that the group has, its kind, whether it speaks for
#: others of its kind, its row, the places of the anchor, of the first window of the kind and of its own, and its bytes.
STRETCH = "bucket bigint, least int, most int, anchor bigint, stretch bigint, alone boolean, speaks boolean, row bigint, place bigint, origin bigint, lo bigint, bytes binary"
LONG = pa.int64()
KINDS = (LONG, pa.int32(), pa.int32(), LONG, LONG, pa.bool_(), pa.bool_(), LONG, LONG, LONG, LONG, pa.binary())
NAMES = [x.split()[0] for x in STRETCH.split(", ")]
#: What the sort finds: repeated bytes of a row, or of a kind, from its stretches' begin on, with their digest.
FOUND = "row bigint, anchor bigint, stretch bigint, start bigint, end bigint, digest binary"


def digest(data: bytes) -> bytes:
    return blake2b(data, digest_size=16).digest()


def _repeated(rows: list[tuple], length: int) -> list[tuple]:
    """Rows of FOUND for stretches of whole groups."""
    data = np.frombuffer(b"".join(r[11] for r in rows), np.uint8)
    sizes = np.array([len(r[11]) for r in rows])
    begin = np.cumsum(sizes) - sizes
    count = sizes - length + 1
    row = np.repeat(np.arange(len(rows)), count)
    nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    offset = np.array([r[8] - r[10] for r in rows])[row] - nth
    _, group = np.unique(np.array([r[0] for r in rows], np.int64), return_inverse=True)
    hit = np.sort(radix_repeats(data, begin[row] + nth, group[row] * (length + 1) + offset, length))
    speaks = np.array([r[5] or r[6] for r in rows])
    hit = hit[speaks[row[hit]]]
    if not len(hit):
        return []
    new = np.concatenate(([True], (hit[1:] != hit[:-1] + 1) | (row[hit[1:]] != row[hit[:-1]])))
    a = np.flatnonzero(new)
    b = np.concatenate((a[1:], [len(hit)])) - 1
    out = []
    for i, x, y in zip(row[hit[a]].tolist(), nth[hit[a]].tolist(), nth[hit[b]].tolist(), strict=True):
        r = rows[i]
        if r[5]:
            out.append((r[7], None, None, r[10] + x, r[10] + y + length, None))
        else:
            out.append((None, r[3], r[4], r[10] - r[9] + x, r[10] - r[9] + y + length, digest(r[11][x : y + length])))
    return out


def _batch(rows: list[tuple], kinds: tuple, names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for a in range(0, batch.num_rows, 1024):
            yield from zip(*(c.to_pylist() for c in batch.slice(a, 1024).columns), strict=True)


def sorted_repeats(stretches: DataFrame, length: int, items: int) -> DataFrame:
    """FOUND for the stretches; groups meet in a task and are sorted there, some groups at a time."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, names = (*[LONG] * 5, pa.binary()), [x.split()[0] for x in FOUND.split(", ")]
        rows: list[tuple] = []
        windows = 0
        for row in _rows(batches):
            if windows > items and row[0] != rows[-1][0]:
                yield _batch(_repeated(rows, length), kinds, names)
                rows, windows = [], 0
            rows.append(row)
            windows += len(row[11]) - length + 1
        if rows:
            yield _batch(_repeated(rows, length), kinds, names)

    parts = int(stretches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stretches.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(sort, FOUND)


def halved(stretches: DataFrame, length: int) -> DataFrame:
    """The stretches in two parts by their windows' offsets, dealt by what all windows of a part have in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for bucket, least, most, anchor, stretch, alone, speaks, row, place, origin, lo, data in _rows(batches):
            hi, middle = lo + len(data) - length, (least + most) // 2
            for x, y in ((least, middle), (middle + 1, most)):
                first, last = max(lo, place - y), min(hi, place - x)
                if first <= last:
                    same = data[place - x - lo : place - y + length - lo]
                    group = blake2b(b"%d %d %d " % (bucket, x, y) + same, digest_size=8).digest()
                    out.append((int.from_bytes(group, "little", signed=True), x, y, anchor, stretch, alone, speaks, row, place, origin, first, data[first - lo : last - lo + length]))
            if len(out) >= 1024:
                yield _batch(out, KINDS, NAMES)
                out = []
        if out:
            yield _batch(out, KINDS, NAMES)

    return stretches.mapInArrow(run, STRETCH)


def covered(source: DataFrame, *, length: int = 200, gram: int = 64, items: int = ITEMS) -> DataFrame:
    """Of ``source`` (row, text): stretches (row, start, end, digest) of bytes in repeated windows; they may overlap.
    Where there is a digest, it is that of the bytes, and a stretch with other bytes does not count."""
    width = length - gram
    if width > 255 or length < 8:
        raise ValueError("length must be 8 at least and less than 256 above gram")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            ids = np.array(block.column(0).to_pylist(), np.int64)
            for buf, parts in _segments(bytes_of(block, "text"), length):
                number, offset, begins, ends = (np.array(x, np.int64) for x in zip(*parts, strict=True))
                h, stretch, place, lo, hi = anchors(buf, begins, ends, length, gram)
                part = np.searchsorted(ends, lo, side="right")
                shift = offset[part] - begins[part]
                # a position, and the distances to its first and last windows, in one number
                packed = ((place + shift) << 16) | ((place - lo) << 8) | (hi - lo)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h.view(np.int64), stretch.view(np.int64), ids[number[part]], packed)], names=["anchor", "stretch", "row", "packed"])

    found = materialize(source.mapInArrow(find, "anchor bigint, stretch bigint, row bigint, packed bigint"), "anchors")
    several = materialize(found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "several")
    shared = materialize(found.join(several, "anchor"), "shared")
    discard(found)
    discard(several)
    place, lo = F.shiftright("packed", 16), F.shiftright("packed", 16) - F.shiftright("packed", 8).bitwiseAND(F.lit(255))
    hi = lo + F.col("packed").bitwiseAND(F.lit(255))

    one, other = (F.struct(f("row").alias("row"), f("packed").alias("packed")) for f in (F.first, F.last))
    kinds = shared.groupBy("anchor", "stretch").agg(F.count("*").alias("copies"), one.alias("one"), other.alias("other"))
    both = F.when(F.col("copies") > 1, F.array(F.col("one"), F.col("other"))).otherwise(F.array(F.col("one")))
    edges = kinds.select("anchor", "stretch", "copies", F.posexplode(both).alias("nth", "e")).select("anchor", "stretch", "copies", "nth", "e.*")
    edges = edges.select("row", F.struct("anchor", "stretch", (F.col("copies") == 1).alias("alone"), (F.col("nth") == 0).alias("speaks"), place.alias("place"), lo.alias("lo"), hi.alias("hi")).alias("edge"))
    by_row = edges.groupBy("row").agg(F.collect_list("edge").alias("edges"))  # as many as its text has anchors

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            rows = []
            for i, t, edges in zip(block.column(0).to_pylist(), bytes_of(block, "text"), block.column(2).to_pylist(), strict=True):
                rows += [(e["anchor"], 0, width, e["anchor"], e["stretch"], e["alone"], e["speaks"], i, e["place"], e["lo"], e["lo"], t[e["lo"] : e["hi"] + length]) for e in edges]
                if len(rows) > 4096:
                    yield _batch(rows, KINDS, NAMES)
                    rows = []
            yield _batch(rows, KINDS, NAMES)

    left = materialize(source.join(by_row, "row").mapInArrow(cut, STRETCH), "edges")
    hits = []
    while True:
        n = F.sum(F.octet_length("bytes") - length + 1)
        sizes = left.groupBy("bucket", (F.col("least") == F.col("most")).alias("last")).agg(n.alias("windows")).where(f"windows > {items}")
        sizes = materialize(sizes, "sizes")
        if sizes.isEmpty():
            hits.append(materialize(sorted_repeats(left, length, items), "hits"))
            break
        # equals of one window: any two of them tell that both are repeated, so each part has many
        parts = F.floor(2 * F.col("windows") / items).cast("int") + 1
        dealt = left.join(sizes, "bucket", "left").withColumn("bucket", F.when(F.col("last"), F.xxhash64("bucket", F.pmod(F.xxhash64("row", "lo"), parts))).otherwise(F.col("bucket")))
        dealt = materialize(dealt, "dealt")
        hits.append(materialize(sorted_repeats(dealt.where("last OR windows IS NULL").drop("last", "windows"), length, items), "hits"))
        again = halved(dealt.where("NOT last").drop("last", "windows"), length)
        discard(left)
        again = materialize(again, "edges")
        pairs = materialize(again.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket"), "several")
        left = materialize(again.join(pairs, "bucket"), "edges")
        discard(again)
        discard(dealt)
    discard(left)
    spans = []
    for h in hits:
        spans.append(h.where("row IS NOT NULL").select("row", "start", "end", "digest"))
        kind = h.where("row IS NULL").select("anchor", "stretch", F.col("start").alias("a"), F.col("end").alias("b"), "digest")
        spans.append(shared.join(kind, ["anchor", "stretch"]).select("row", (lo + F.col("a")).alias("start"), (lo + F.col("b")).alias("end"), "digest"))
    out = spans[0]
    for x in spans[1:]:
        out = out.unionAll(x)
    return out


def remove(documents: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, n_bytes, removed (spans of bytes) and kept (the remaining bytes)."""
    source = numbered(documents, key, text)
    spans = covered(source.select("row", "text"), **options).groupBy("row").agg(F.collect_list(F.struct("start", "end", "digest")).alias("spans"))
    spans = materialize(spans, "spans")
    names = ["doc_id", "n_bytes", "removed", "kept"]
    pairs = pa.list_(pa.struct([("start", LONG), ("end", LONG)]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            rows = []
            for i, t, found in zip(block.column(0).to_pylist(), bytes_of(block, "text"), block.column(2).to_pylist(), strict=True):
                runs: list[list[int]] = []
                for a, b in sorted((s["start"], s["end"]) for s in found or () if s["digest"] is None or s["digest"] == digest(t[s["start"] : s["end"]])):
                    if runs and a <= runs[-1][1]:
                        runs[-1][1] = max(b, runs[-1][1])
                    else:
                        runs.append([a, b])
                at, kept = 0, []
                for a, b in runs:
                    kept.append(t[at:a])
                    at = b
                kept.append(t[at:])
                rows.append((i, len(t), [{"start": a, "end": b} for a, b in runs], b"".join(kept)))
            yield _batch(rows, (LONG, LONG, pairs, pa.binary()), names)

    met = source.join(spans, "row", "left").select("doc_id", "text", "spans")
    return met.mapInArrow(cut, "doc_id bigint, n_bytes bigint, removed array<struct<start:bigint,end:bigint>>, kept binary")
