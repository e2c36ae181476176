"""WARC archives of page captures, and their index by an external merge.

Writing: every page becomes a WARC/1.1 record, made of SQL expressions and written by Spark's own text writer, whose
line end is the blank line that ends a record; files have about FILE_BYTES, and never more than FILE_LIMIT.  Of pages
with equal payloads of at least ``min_bytes``, the one with the smallest id is a response, the others are revisits that
name it and carry no payload.  Reading parses the files, recomputes each response's digest and gives one row per record.

Index: each archive file's captures are sorted by URL key and timestamp where they are read; written, these are the runs.
The key space is cut into ranges at sampled keys, so many that a range has about ``range_rows`` captures however many
there are; each range's slices of the runs, still in their order, are merged by a loser tree, so that the ranges in
their order hold the capture histories in global order.  Only keys are Python objects, and ids break ties, so one URL
with any share of the captures is still cut into many ranges.

Defined results: null payloads are empty; null URLs have no target; control characters in URLs are left out; a row
without an id is a response; of repeated rows each gives a record, and all rows with the response's id and payload are
responses; an empty table gives no records; timestamps come from ``timestamp`` (a column or an expression), or else
count seconds by id, modulo a hundred years, from EPOCH.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize

EPOCH = "2020-01-01 00:00:00"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
FILE_BYTES, FILE_LIMIT = 64 << 20, 1 << 30
#: Header lines of a record have fewer bytes without the URL.
HEADER_BYTES = 1000
RANGE_ROWS = 100_000
END = "\r\n\r\n"


def base32_sha1(sha1_hex: Column) -> Column:
    """The upper-case base32 of a hex SHA-1, five bytes at a time."""
    chars = []
    for group in range(4):
        n = F.conv(F.substring(sha1_hex, 1 + 10 * group, 10), 16, 10).cast("bigint")
        for shift in range(35, -1, -5):
            digit = F.shiftright(n, shift).bitwiseAND(F.lit(31))
            chars.append(F.substring(F.lit(ALPHABET), (digit + 1).cast("int"), F.lit(1)))
    return F.concat(*chars)


def roles(pages: DataFrame, *, key: str = "page_id", payload: str = "html", min_bytes: int = 0) -> DataFrame:
    """Pages that repeat an earlier payload, each once: _page, _sha1, _first (the response's id).  Groups are
    pre-aggregated, and written, so that the join that follows can split a payload that many pages have."""
    body = F.coalesce(F.encode(payload, "utf-8"), F.lit(b""))
    digest = pages.select(F.col(key).cast("bigint").alias("_page"), F.sha1(body).alias("_sha1"), F.octet_length(body).alias("_n")).where((F.col("_n") >= min_bytes) & F.col("_page").isNotNull()).drop("_n")
    firsts = digest.groupBy("_sha1").agg(F.min("_page").alias("_first"), F.max("_page").alias("_last")).where("_first <> _last").drop("_last")
    firsts = materialize(firsts, "firsts")
    return digest.join(firsts, "_sha1").where("_page <> _first").distinct()


def record_id(page: Column) -> Column:
    h = F.md5(page.cast("string").cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def write(pages: DataFrame, path: str, *, key: str = "page_id", url: str = "url", payload: str = "html", timestamp: Column | None = None, min_bytes: int = 0) -> None:
    """Write the archive to ``path``."""
    again = materialize(roles(pages, key=key, payload=payload, min_bytes=min_bytes), "revisits")
    size = HEADER_BYTES + F.coalesce(F.octet_length(payload), F.lit(0)) + F.coalesce(F.octet_length(url), F.lit(0))
    mean, most = pages.agg(F.avg(size), F.max(size)).first()
    records = max(1, min(int(FILE_BYTES / (mean or 1)), FILE_LIMIT // (most or 1)))
    page, body = F.col(key).cast("bigint"), F.coalesce(F.col(payload), F.lit(""))
    when = F.timestamp_seconds(F.expr(f"unix_seconds(timestamp '{EPOCH}')") + F.pmod(page, F.lit(100 * 365 * 86_400))) if timestamp is None else timestamp
    rows = pages.select(page.alias("_page"), F.regexp_replace(F.coalesce(F.col(url), F.lit("")), r"[\x00-\x20\x7f]", "").alias("_url"), body.alias("_body"), F.sha1(F.encode(body, "utf-8")).alias("_sha1"), F.date_format(F.coalesce(when, F.expr(f"timestamp '{EPOCH}'")), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("_when"))
    rows = rows.join(again, ["_page", "_sha1"], "left")  # broadcast by its measured size if small, else by a sort-merge join
    first = F.col("_first")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("_body"), F.lit(END))
    block = F.when(first.isNull(), F.concat(http, F.col("_body"))).otherwise(http)
    digest = base32_sha1(F.col("_sha1"))
    fields = [
        ("WARC-Type", F.when(first.isNull(), "response").otherwise("revisit")),
        ("WARC-Record-ID", record_id(F.col("_page"))),
        ("WARC-Date", F.col("_when")),
        ("WARC-Target-URI", F.when(F.col("_url") != "", F.col("_url"))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        ("WARC-Profile", F.when(first.isNotNull(), "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        ("WARC-Refers-To", F.when(first.isNotNull(), record_id(first))),
        ("X-Capture-Id", F.col("_page").cast("string")),
        ("X-Refers-To-Capture-Id", first.cast("string")),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", F.octet_length("_block").cast("string")),
    ]
    lines = [F.lit("WARC/1.1\r\n"), *(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")) for name, value in fields)]
    record = F.concat(*lines, F.lit("\r\n"), F.col("_block"))
    rows.withColumn("_block", block).select(record.alias("record")).write.option("lineSep", END).option("maxRecordsPerFile", records).text(path)


def parse(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Offset, length, header fields and block of each record."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if not version.startswith("WARC/1."):
            raise ValueError(f"no record at byte {at}")
        head = dict(line.split(": ", 1) for line in lines)
        size = int(head["Content-Length"])
        stop = end + 4 + size
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} has a wrong length")
        yield at, stop + 4 - at, head, data[end + 4 : stop]
        at = stop + 4


def url_key(url: str) -> str:
    """The sorting key of a URL: host names reversed, in lower case, then the path; no scheme, port, user or fragment."""
    m = re.match(r"(?:[a-z][a-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)(?::\d+)?([^#]*)", url, re.I)
    host, rest = m.groups()
    return ",".join(reversed(host.lower().removeprefix("www.").split("."))) + ")" + (rest.lower() or "/")


CAPTURE = "url_key string, ts string, page_id bigint, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, file string, offset bigint, length bigint"


def place(row: tuple) -> tuple:
    """The order of captures: URL key, timestamp, id (null first)."""
    return row[0], row[1], row[2] is not None, row[2] or 0


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, sorted by URL key and timestamp within each file: a run of the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = []
                for offset, length, head, block in parse(data):
                    http, _, body = block.partition(b"\r\n\r\n")
                    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind, first = head["WARC-Type"], head.get("X-Refers-To-Capture-Id")
                    if kind == "response" and (len(body) != size or base64.b32encode(hashlib.sha1(body).digest()).decode() != digest):
                        raise ValueError(f"damaged payload in {name} at byte {offset}")
                    rows.append((url_key(head.get("WARC-Target-URI", "")), re.sub(r"\D", "", head["WARC-Date"]), int(head["X-Capture-Id"]) if "X-Capture-Id" in head else None, kind, None if first is None else int(first), size, digest, name.rsplit("/", 1)[-1], offset, length))
                rows.sort(key=place)
                if rows:
                    long, string = pa.int64(), pa.string()
                    kinds = (string, string, long, string, long, long, string, string, long, long)
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in CAPTURE.split(", ")])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(run, CAPTURE)


class LoserTree:
    """Merges sorted iterators: each inner node keeps the loser of its match, so that a step plays one path."""

    def __init__(self, runs: list[Iterator], key):
        self.runs, self.key = runs, key
        self.n = max(1, len(runs))
        self.heads = [next(r, None) for r in runs] or [None]
        self.keys = [None if h is None else key(h) for h in self.heads]
        self.losers = [-1] * self.n
        self.winner = -1
        for i in range(self.n):
            self._play(i)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.keys[a], self.keys[b]
        return y is None or (x is not None and (x, a) <= (y, b))

    def _play(self, i: int) -> None:
        node = (i + self.n) // 2
        while node:
            held = self.losers[node]
            if held < 0:  # the first to come waits for the other branch
                self.losers[node] = i
                return
            if self._before(held, i):
                self.losers[node], i = i, held
            node //= 2
        self.winner = i

    def __iter__(self) -> Iterator:
        while (i := self.winner) >= 0 and self.heads[i] is not None:
            yield self.heads[i]
            self.heads[i] = head = next(self.runs[i], None)
            self.keys[i] = None if head is None else self.key(head)
            self._play(i)


def merged(captures: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The captures of a written table of runs in global order: partitions by ascending ranges, each merged from its
    slices of the runs.  A task holds the captures of its range as Arrow columns, and their keys."""
    ranges = max(int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-captures.count() // range_rows))
    at = [captures.columns.index(c) for c in ("url_key", "ts", "page_id", "file")]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        runs: list[list[tuple]] = []
        of: dict[str, list[tuple]] = {}
        n = 0
        for batch in batches:
            kept.append(batch)
            for url, ts, page, file in zip(*(batch.column(i).to_pylist() for i in at), strict=True):
                head = place((url, ts, page)), n
                run = of.get(file)
                if run is None or run[-1] > head:  # a slice that does not go on where the file's last one ended
                    run = of[file] = []
                    runs.append(run)
                run.append(head)
                n += 1
        if not kept:
            return
        table = pa.Table.from_batches(kept)
        order = pa.array((row for _, row in LoserTree([iter(r) for r in runs], lambda x: x)), pa.int64())
        for a in range(0, n, 4096):
            yield from table.take(order[a : a + 4096]).combine_chunks().to_batches()

    return captures.repartitionByRange(ranges, "url_key", "ts", "page_id").mapInArrow(merge, CAPTURE)
