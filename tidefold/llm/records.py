"""Token-id output in length-delimited binary records with masked checksums and a separate offset index.

File format (all integers little-endian), one record after the other:

    int64   key (the document's id; the smallest int64 stands for null)
    uint32  width: bytes of an id, 2 or 4
    uint32  length of the payload in bytes
    uint32  masked CRC-32 of the 16 bytes above
    ...     payload: the ids
    uint32  masked CRC-32 of the payload
    "\n"    end of the record

A checksum is masked, as it would otherwise be likely to meet checksums of data that hold checksums: rotated right
by 15 bits plus a constant.  Ids take two bytes if the vocabulary allows it.

Writing: rows are dealt by ranges of the key and sorted inside each, so that the files in the order of their numbers
hold ascending keys; the files go through Spark's own writer (its newline is the end of each record), which commits
whole tasks only and works with any store.  There are as many ranges as the texts' bytes, which are counted, ask for.
Reading: each file is one value of Spark's binaryFile source, so a file must stay far below 2 GB; ranges have about
FILE_BYTES of text, and one text can have 2 GB at most.  The index has a row for each record (file, offset, length,
number of ids), with which records can be read in any order.

Defined results: null text counts as empty; repeated keys give a record each, in any order among them; null keys come
first; an empty table gives an empty index.
"""

from __future__ import annotations

import json
import math
import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, blocks, map_arrow, materialize

HEAD = struct.Struct("<qIII")
NULL_KEY = -(1 << 63)
MASK = 0xA282EAD8
#: Bytes of text for each file.
FILE_BYTES = 32 << 20
#: Pieces kept with their ids in each Python worker (some 160 bytes each).
MEMO_WORDS = 300_000
#: Bytes of text that are cut at a time; some 25 times as many are taken meanwhile.
PORTION_BYTES = 1 << 20
#: Letters and marks that no other character joins in a token, and the mark of a word's last token in the vocabulary.
LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]"
MARKS = r"[!-&(-/:-@\[-`{-~]"
END_MARK = "</w>"
#: Kinds of bytes: white space, letters, digits, marks, others (letters of two bytes are found by both).
SPACE, LETTER, DIGIT, MARK, OTHER = range(5)
CLASSES = np.array([SPACE if c in " \t\n\v\f\r" else LETTER if re.match("[A-Za-z]", c) else DIGIT if re.match("[0-9]", c) else MARK if re.match(MARKS, c) else OTHER for c in map(chr, range(256))], np.uint8)


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def frame(key: int | None, ids: np.ndarray, width: int) -> bytes:
    payload = ids.astype("<u2" if width == 2 else "<u4", copy=False).tobytes()
    head = HEAD.pack(NULL_KEY if key is None else key, width, len(payload), 0)[:16]
    return b"".join((head, masked(head).to_bytes(4, "little"), payload, masked(payload).to_bytes(4, "little"), b"\n"))


def frames(data: bytes) -> Iterator[tuple[int | None, int, int, np.ndarray]]:
    """Key, offset, length and ids of each record; raises ValueError where a checksum or an end is wrong."""
    at = 0
    while at < len(data):
        key, width, size, crc = HEAD.unpack_from(data, at)
        end = at + 20 + size + 5
        payload = data[at + 20 : end - 5]
        if masked(data[at : at + 16]) != crc or masked(payload) != int.from_bytes(data[end - 5 : end - 1], "little") or data[end - 1] != 10:
            raise ValueError(f"damaged record at byte {at}")
        yield None if key == NULL_KEY else key, at, end - at, np.frombuffer(payload, "<u2" if width == 2 else "<u4")
        at = end


class WordEncoder:
    """Encodes texts with the tokenizers library, keeping the ids of the pieces of words.

    Its tokenizer must drop white space, so that no token spans it, and normalize without context: then the ids of a
    text are those of its words.  A word of LETTERS, digits and MARKS only is cut into runs of letters, runs of marks and
    single digits, if the tokenizer cuts there too, which is tried at the start; any other word is one piece.  Texts with
    the mark of a special token are handed over whole.

    Texts are cut by bytes, many at a time; the library sees each piece when it is new.
    """

    def __init__(self, path: str, text: str | None = None):
        if text is None:
            with open(path, encoding="utf-8") as f:
                text = f.read()
        self.spec = text
        self._ready = False

    def __getstate__(self) -> dict:
        return {"spec": self.spec, "_ready": False}

    def start(self) -> None:
        if self._ready:
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(self.spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.ends = np.zeros(self.size, bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.ends[i] = token.endswith(END_MARK)
        self.letters = re.compile(f"{LETTERS}+")
        self.kind = "<u2" if self.size <= 1 << 16 else "<u4"
        # whether capitals have the ids of small letters
        letters = [c for c in map(chr, range(0x41, 0x100)) if self.letters.fullmatch(c)]
        capitals = [c for c in letters if c != c.lower()]
        ids = lambda words: [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        self.lowers = ids([f"a{c}a" for c in capitals]) == ids([f"a{c.lower()}a" for c in capitals])
        # whether a word's runs of letters, runs of marks and digits are encoded one by one
        runs = ["the", "été", "s", "7", *(m for m in map(chr, range(0x21, 0x7F)) if re.fullmatch(MARKS, m)), "...", "$(*"]
        pairs = [(x, y) for x in runs for y in runs if _class(x) != _class(y) or x == y == "7"]
        alone = dict(zip(runs, ids(runs), strict=True))
        self.cuts = ids([x + y + x for x, y in pairs]) == [alone[x] + alone[y] + alone[x] for x, y in pairs]
        # the same merges without the steps that leave small letters as they are
        spec = json.loads(self.spec) | {"normalizer": None, "added_tokens": [], "truncation": None, "padding": None, "post_processor": None}
        steps = [{"type": "CharDelimiterSplit", "delimiter": " "}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
        self.small = Tokenizer.from_str(json.dumps(spec | {"pre_tokenizer": {"type": "Sequence", "pretokenizers": steps}}))
        small = [f"{x}{y}{x}" for x in letters for y in letters if x + y == (x + y).lower()]
        if [e.ids for e in self.small.encode_batch_fast(small, add_special_tokens=False)] != ids(small):
            self.small = self.tokenizer
        self.memo = _Memo(self.kind)
        self._ready = True

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all pieces in one array, where those of each begin there, and how many it has.  Pieces of letters are
        encoded many at a time, as the last token of each has a mark."""
        parts, so_far = [np.zeros(0, self.kind)], 0
        begin, size = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        plain = [i for i, w in enumerate(pieces) if self.letters.fullmatch(w)]
        rest = set(range(len(pieces))).difference(plain)
        for a in range(0, len(plain), 2000):
            part = plain[a : a + 2000]
            text = " ".join([pieces[i] for i in part])
            by = self.small if text.islower() else self.tokenizer
            ids = np.array(by.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(part) and stops[-1] == len(ids):
                size[part] = np.diff(stops, prepend=0)
                begin[part] = so_far + stops - size[part]
                so_far += len(ids)
                parts.append(ids.astype(self.kind))
            else:
                rest.update(part)
        rest = sorted(rest)
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([pieces[i] for i in rest], add_special_tokens=False), strict=True):
            begin[i], size[i] = so_far, len(e)
            so_far += len(e)
            parts.append(np.array(e.ids, self.kind))
        return np.concatenate(parts), begin, size

    def _cut(self, buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        """Where the pieces of the texts that begin at ``bounds`` start, and the pieces, in small letters if the
        tokenizer has them."""
        kinds, low = CLASSES[buf], LOWER[buf] if self.lowers else buf.copy()
        lead = np.flatnonzero(buf[:-1] == 0xC3)
        if len(lead):  # letters of two bytes
            then = buf[lead + 1]
            good = (then >= 0x80) & (then < 0xC0) & (then != 0x97) & (then != 0xB7)
            kinds[lead[good]] = kinds[lead[good] + 1] = LETTER
            if self.lowers:
                low[lead[good & (then < 0x9F)] + 1] += 0x20
        other = kinds == OTHER if self.cuts else kinds != SPACE
        edge = np.empty(len(buf), bool)
        if other.any():  # words that are one piece
            edge[:1] = True
            np.not_equal(kinds[1:] == SPACE, kinds[:-1] == SPACE, out=edge[1:])
            edge[bounds] = True
            starts = np.flatnonzero(edge)
            whole = np.logical_or.reduceat(other, starts)
            bytes_ = np.repeat(whole, np.diff(starts, append=len(buf)))
            kinds[bytes_] = OTHER
            low[bytes_] = buf[bytes_]
        edge[:1] = True
        np.not_equal(kinds[1:], kinds[:-1], out=edge[1:])
        edge |= kinds == DIGIT
        edge[bounds] = True
        starts = np.flatnonzero(edge)
        kept = kinds[starts] != SPACE
        sizes = np.diff(starts, append=len(buf))[kept]
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        data = low[kinds != SPACE]
        return starts[kept], pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])

    def encode_column(self, column: pa.Array, end: int | None = None) -> list[np.ndarray]:
        """The ids of each text (null: none), with the id ``end`` after them if given."""
        self.start()
        column = pc.fill_null(column, "").cast(pa.large_binary())
        if not len(column):
            return []
        at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        buf = np.frombuffer(column.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
        at = at - at[0]
        alone: dict[int, np.ndarray] = {}
        for mark in self.marks:
            for i in np.flatnonzero(pc.match_substring(column, mark).to_numpy(zero_copy_only=False)).tolist():
                alone[i] = np.array(self.tokenizer.encode(column[i].as_py().decode("utf-8"), add_special_tokens=False).ids, self.kind)
        if alone:
            buf = buf.copy()
            for i in alone:
                buf[at[i] : at[i + 1]] = 0x20
        parts, before, since = [], np.zeros(len(at), np.int64), 0  # before: ids before each text
        for a, b in _portions(buf):
            inside = slice(*np.searchsorted(at, [a, b]))
            starts, pieces = self._cut(buf[a:b], at[inside] - a)
            coded = pieces.dictionary_encode()
            slots = self.memo.find(coded.dictionary, self._encode_pieces)[coded.indices.to_numpy()]
            ids, sums = self.memo.joined(slots)
            before[inside] = since + sums[np.searchsorted(starts, at[inside] - a)]
            since += len(ids)
            parts.append(ids)
        before[at == len(buf)] = since
        ids = np.concatenate(parts) if parts else np.zeros(0, self.kind)
        tail = np.array([] if end is None else [end], self.kind)
        return [np.concatenate([alone[i] if i in alone else ids[a:b], tail]) for i, (a, b) in enumerate(pairwise(before.tolist()))]

    def encode_batch(self, texts: list[str], end: int | None = None) -> list[np.ndarray]:
        """encode_column() of a list."""
        return self.encode_column(pa.array(texts, pa.large_string()), end)


def _class(piece: str) -> int:
    return LETTER if re.fullmatch(f"{LETTERS}+", piece) else int(CLASSES[ord(piece[0])])


def _portions(buf: np.ndarray) -> Iterator[tuple[int, int]]:
    """Spans of about PORTION_BYTES that end after white space, or longer ones where there is none."""
    a = 0
    while a < len(buf):
        b = a + PORTION_BYTES
        while b < len(buf) and CLASSES[buf[b - 1]] != SPACE:
            near = np.flatnonzero(CLASSES[buf[b : b + 4096]] == SPACE)
            b += int(near[0]) + 1 if len(near) else 4096
        yield a, min(b, len(buf))
        a = b


class _Memo:
    """Pieces with their ids, those in one array.  When there are more than MEMO_WORDS, or than 16 times as many ids, those used
    last are kept, up to half of that."""

    def __init__(self, kind: str):
        self.place: dict[bytes, int] = {}  # in the order of the places
        self.ids = np.zeros(0, kind)
        self.begin, self.size, self.used = (np.zeros(0, np.int64) for _ in range(3))
        self.clock = 0

    def find(self, pieces: pa.Array, encode: Callable) -> np.ndarray:
        """The place of each of the distinct ``pieces``; new ones get their ids by ``encode``."""
        if len(self.place) > MEMO_WORDS or len(self.ids) > 16 * MEMO_WORDS:
            self._shrink()
        self.clock += 1
        words = pieces.to_numpy(zero_copy_only=False).tolist()
        found = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(found < 0)
        if len(new):
            found[new] = len(self.place) + np.arange(len(new))
            fresh = [words[i] for i in new.tolist()]
            ids, begin, sizes = encode([w.decode("utf-8") for w in fresh])
            self.place.update(zip(fresh, found[new].tolist(), strict=True))
            self.begin = np.concatenate([self.begin, len(self.ids) + begin])
            self.size, self.used = np.concatenate([self.size, sizes]), np.concatenate([self.used, np.zeros(len(new), np.int64)])
            self.ids = np.concatenate([self.ids, ids])
        self.used[found] = self.clock
        return found

    def joined(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces at ``places``, one after the other, and how many are before each piece and in all."""
        sizes = self.size[places]
        sums = np.concatenate([[0], np.cumsum(sizes)])
        return self.ids[np.repeat(self.begin[places] - sums[:-1], sizes) + np.arange(sums[-1])], sums

    def _shrink(self) -> None:
        order = np.argsort(-self.used, kind="stable")[: MEMO_WORDS // 2]
        order = np.sort(order[np.cumsum(self.size[order]) <= 8 * MEMO_WORDS])
        self.ids, sums = self.joined(order)
        self.begin, self.size, self.used = sums[:-1], self.size[order], self.used[order]
        words = list(self.place)
        self.place = {words[i]: place for place, i in enumerate(order.tolist())}


def write(df: DataFrame, encoder: WordEncoder, path: str, *, key: str = "doc_id", text: str = "text", end_id: int | None = 1) -> None:
    """Encode ``text`` and write the records to ``path`` in ascending order of ``key``."""
    spark = df.sparkSession
    size = df.agg(F.sum(F.octet_length(text).cast("bigint"))).first()[0] or 0
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES))
    shared = spark.sparkContext.broadcast(encoder)  # the size of the vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value
        encoder.start()
        width = 2 if encoder.size <= 1 << 16 else 4
        for block in blocks(batches, "text", PORTION_BYTES):
            ids = encoder.encode_column(block.column(1), end_id)
            keys = block.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([frame(k, x, width)[:-1] for k, x in zip(keys, ids, strict=True)], pa.binary())], names=["frame"])

    dealt = df.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")).repartitionByRange(files, "key").sortWithinPartitions("key")
    # the writer itself ends each record with its newline
    map_arrow(dealt, run, "frame binary").select(F.col("frame").cast("string")).write.option("lineSep", "\n").text(path)


def scan(spark, path: str) -> DataFrame:
    """Read all files in full: key, file, offset, length, start_in_file, n_ids and ids_crc32 (of 32-bit ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, start = [], 0
                for key, offset, length, ids in frames(data):
                    rows.append((key, name.rsplit("/", 1)[-1], offset, length, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), *[pa.int64()] * 5), strict=True)], names=["key", "file", "offset", "length", "start_in_file", "n_ids", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return map_arrow(files, run, "key bigint, file string, offset bigint, length bigint, start_in_file bigint, n_ids bigint, ids_crc32 bigint")


def before(totals: DataFrame, parts: int) -> DataFrame:
    """Of (file, n): file and the sum of n over all files with smaller numbers, by sums of ``parts`` files' blocks: a
    window inside each block, and one over the blocks, so that no task sees more than about the root of the files."""
    number = F.regexp_extract("file", r"part-(\d+)", 1).cast("bigint")
    each = totals.select("file", "n", number.alias("number")).withColumn("block", F.floor(F.col("number") / parts))
    blocks = each.groupBy("block").agg(F.sum("n").alias("all"))
    blocks = blocks.select("block", (F.sum("all").over(Window.orderBy("block")) - F.col("all")).alias("since"))
    own = F.sum("n").over(Window.partitionBy("block").orderBy("number", "file")) - F.col("n")
    return each.withColumn("own", own).join(blocks, "block").select("file", (F.col("own") + F.col("since")).alias("before"))


def index(spark, path: str) -> DataFrame:
    """The offset index, read from the files and written to ``path``/_index: scan()'s columns and ``start``, the
    number of ids in all records before."""
    where = f"{path.rstrip('/')}/_index"
    found = scan(spark, path)
    found.write.parquet(where)
    found = spark.read.schema(found.schema).parquet(where)
    totals = materialize(found.groupBy("file").agg(F.sum("n_ids").alias("n")), "totals")
    starts = materialize(before(totals, math.isqrt(totals.count()) + 1), "starts")
    return found.join(starts, "file").select("*", (F.col("before") + F.col("start_in_file")).alias("start")).drop("before")


def fetch(spark, path: str, file: str, offset: int, length: int) -> tuple[int | None, list[int]]:
    """Key and ids of one record by its index entry, from any store that Spark reads."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{file}")
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).open(where)
    try:
        stream.seek(offset)
        data = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, length))
    finally:
        stream.close()
    return next((k, ids.tolist()) for k, _, _, ids in frames(data))
