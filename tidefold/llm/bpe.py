"""BPE encoding and decoding by a tokenization automaton.

The ranked merges are compiled by successive merge gadgets into a deterministic automaton over tokens.  It starts with
one state and a loop for every byte.  The gadget of a merge (u, v) -> w looks at the state that u leads to: if v
leaves it, u is led to a copy of that state without the arc v, and an arc w is put beside every arc u, leading
where v led.  After all gadgets the automaton accepts exactly the correct tokenizations, one for every string,
and the state after a token depends on the token alone.

The compiled table has a row for the state after each token: the arcs that it lacks.  Tokens are numbered so that a
token is followed by those built on its front, the latest first; an arc that a gadget removes, with all later arcs put
beside it, is then one interval of numbers, and a copied state is a copied row.  Rows are sorted, disjoint intervals
in integer arrays, and a transition is one binary search in a row.

A pre-split word is encoded by the table alone.  Every prefix has one tokenization, so exactly one arc enters each
position of the word: of the arcs whose labels end there, the one that the state at its beginning has.  Each position is
decided at most once, and the arcs that lead to the word's end are its tokens.  Decoding emits the labels of the arcs.

Defined results: null text counts as empty; empty text has no tokens; texts of any length are encoded whole; the
strings of added special tokens become their ids, as the tokenizers library does by default; rows are independent of
one another, so repeated rows and null keys give equal rows, and an empty table gives none.
"""

from __future__ import annotations

import copy
import json
import re
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, map_arrow, texts_of

#: Fixed value: the public pattern that splits text before the merges of this vocabulary family.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Below this code point the regex module and the tokenizers library agree on letters, digits and white space,
#: and white space is SPACES.
AGREED = 0x530
SPACES = "\\t-\\r \\x85\\xa0"
#: Pieces that the split pattern never crosses: a word with its punctuation and the blank before it, or white space.
CHUNK = f" ?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
#: Words, and chunks, kept with their ids in each Python worker, and as many of those used before them.
MEMO_WORDS = 100_000
#: Texts handled at a time as Python objects.
ROWS = 128


def byte_characters() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for themselves."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class MergeAutomaton:
    """The compiled automaton of ranked merges over byte strings; ``arcs`` maps an arc's label to its token id."""

    def __init__(self, arcs: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        size = 1 + max(arcs.values(), default=-1)
        labels = {i: label for label, i in arcs.items()}
        front, built = array("i", [-1]) * size, bytearray(size)
        beside: dict[int, list[int]] = {}
        gadgets = []
        for left, right in merges:
            u, v, w = arcs[left], arcs[right], arcs[left + right]
            if front[w] >= 0 or len(labels[w]) == 1:
                raise ValueError(f"two merges give {labels[w]!r}")
            if any(len(labels[x]) > 1 and front[x] < 0 for x in (u, v)):
                raise ValueError(f"the parts of {labels[w]!r} are merged after it")
            front[w] = u
            beside.setdefault(u, []).append(w)
            gadgets.append((u, v, w))
        # a token's number, and of how many tokens it is the front, itself included
        number, weight = array("i", [-1]) * size, array("i", [1]) * size
        stack, order = [i for i in labels if len(labels[i]) == 1], []
        while stack:
            order.append(t := stack.pop())
            stack.extend(beside.get(t, ()))
        for at, t in enumerate(order):
            number[t] = at
        for t in reversed(order):
            if front[t] >= 0:
                weight[front[t]] += weight[t]
        # the gadgets: rows of intervals of numbers, shared until a gadget extends one
        rows: list[tuple] = [()] * size
        so_far = array("i", [0]) * size
        for t in labels:
            built[t] = len(labels[t]) == 1
        for u, v, w in gadgets:
            at = number[v]
            if built[u] and built[v] and not any(a <= at < b for a, b in rows[u]):
                built[w] = 1  # otherwise no path ever takes this arc
            rows[w] = rows[v]
            rows[u] += ((at, at + weight[v] - so_far[v]),)
            so_far[u] += weight[w]
        # by number: the row of the state after a token, the token's id and its label's length
        self.row, self.begin, self.end = array("i", [0]), array("i"), array("i")
        for intervals in [*(rows[t] for t in order), ()]:  # the last state is the first one of a word, with every arc
            last = -1
            for a, b in sorted(intervals):
                if a > last:
                    self.begin.append(a)
                    self.end.append(b)
                elif b > last:
                    self.end[-1] = b
                last = max(last, b)
            self.row.append(len(self.begin))
        self.token, self.size = array("i", order), array("i", (len(labels[t]) for t in order))
        self.taken = bytes(built[t] for t in order)
        self.text = b"".join(labels[t] for t in order)
        self._root: dict | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_root": None}

    def labels(self) -> dict[int, bytes]:
        ends = list(accumulate(self.size))
        return {t: self.text[end - size : end] for t, size, end in zip(self.token, self.size, ends, strict=True)}

    def _spell(self) -> None:
        """The tree of the arcs' labels, read backwards: by byte the next node and the number of the arc, or -1."""
        self._root = {}
        labels = self.labels()
        for number, t in enumerate(self.token):
            if self.taken[number]:
                node, label = self._root, labels[t]
                for byte in label[:0:-1]:
                    node = node.setdefault(byte, ({}, -1))[0]
                node[label[0]] = node.get(label[0], ({},))[0], number

    def path(self, word: bytes) -> tuple[int, ...]:
        """The arcs of the only accepted path that spells ``word``, in time linear in the word.

        One arc enters each position: of the arcs that end there, the one that leaves the state where it begins.
        Positions are decided from the word's end on demand, each once.
        """
        if self._root is None:
            self._spell()
        root, row, begin, end = self._root, self.row, self.begin, self.end
        entered = {0: len(self.token)}
        at = len(word)
        waiting: list[tuple[int, list]] = []
        while True:
            arcs: list[tuple[int, int]] = []  # that end here, the longest last
            since, node = at, root
            while since:
                since -= 1
                if (known := node.get(word[since])) is None:
                    break
                node, arc = known
                if arc >= 0:
                    arcs.append((since, arc))
            while arcs:
                since, arc = arcs[-1]
                if (state := entered.get(since)) is None:
                    break  # where this arc begins is decided first
                low, high = row[state], row[state + 1]
                if low == high or (k := bisect_right(begin, arc, low, high)) == low or end[k - 1] <= arc:
                    entered[at] = arc
                    if not waiting:
                        break
                    at, arcs = waiting.pop()
                else:
                    arcs.pop()
            else:
                if word:
                    raise ValueError(f"no token ends with byte {word[at - 1]}")
                return ()
            if state is None:
                waiting.append((at, arcs))
                at = since
            else:
                break
        out, token, size = [], self.token, self.size
        while at:
            out.append(token[arc := entered[at]])
            at -= size[arc]
        out.reverse()
        return tuple(out)


class Codec:
    """Encoder and decoder of a byte-level tokenizer file."""

    def __init__(self, spec: dict):
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("a byte-level BPE tokenizer without normalizer is needed")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take their surroundings along are not supported")
        to_byte = byte_characters()
        as_bytes = lambda s: bytes(map(to_byte.__getitem__, s))
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        arcs = {as_bytes(s): i for s, i in model["vocab"].items() if s not in added}
        merges = [tuple(map(as_bytes, m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
        self.automaton = MergeAutomaton(arcs, merges)
        self.added = added
        self.memo_words = MEMO_WORDS
        self._memo: _Memo | None = None

    def with_memo(self, words: int) -> Codec:
        """The same codec, keeping so many words and chunks in each Python worker (some 500 bytes for both)."""
        other = copy.copy(self)
        other.memo_words, other._memo = words, None
        return other

    @classmethod
    def load(cls, path: str) -> Codec:
        with open(path, encoding="utf-8") as f:
            return cls(json.load(f))

    def __getstate__(self) -> dict:
        return {"automaton": self.automaton, "added": self.added, "memo_words": self.memo_words, "_memo": None}

    @property
    def memo(self) -> _Memo:
        if self._memo is None:
            self._memo = _Memo(self.automaton, self.memo_words)
            self.labels = self.automaton.labels() | {i: s.encode() for s, i in self.added.items()}
            self._chunks = re.compile(CHUNK)
            self._odd = re.compile(f"[^\\x00-{chr(AGREED)}\\u2010-\\u2027\\u20ac\\u4e00-\\u9fa5]")
            self._special = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
            from tokenizers.pre_tokenizers import ByteLevel

            self._library = ByteLevel(add_prefix_space=False)
        return self._memo

    def _plain(self, text: str) -> list[int]:
        memo = self.memo
        if self._odd.search(text):  # rare code points: the library's own splitting, by spans
            return list(chain.from_iterable(memo.word(text[a:b]) for _, (a, b) in self._library.pre_tokenize_str(text)))
        return list(chain.from_iterable(map(memo.__getitem__, self._chunks.findall(text))))

    def encode(self, text: str) -> list[int]:
        self.memo  # noqa: B018  compiles the patterns
        if self._special is None or not (found := list(self._special.finditer(text))):
            return self._plain(text)
        out: list[int] = []
        at = 0
        for m in found:
            out += self._plain(text[at : m.start()])
            out.append(self.added[m.group()])
            at = m.end()
        return out + self._plain(text[at:])

    def decode(self, ids: list[int]) -> bytes:
        """The labels of the path's arcs, one after the other; ids without an arc are passed over."""
        self.memo  # noqa: B018  spells the labels
        try:
            return b"".join(map(self.labels.__getitem__, ids))
        except KeyError:
            return b"".join(self.labels.get(i, b"") for i in ids)


class _Memo(dict):
    """Ids by chunk, and by word in ``words``, each in two generations: when the younger is full, it takes the
    place of the older."""

    def __init__(self, automaton: MergeAutomaton, most: int):
        super().__init__()
        self.automaton, self.most, self.older = automaton, most, {}
        self.words: dict[str, tuple[int, ...]] = {}
        self.older_words: dict[str, tuple[int, ...]] = {}
        self.split = regex.compile(SPLIT)

    def word(self, word: str) -> tuple[int, ...]:
        ids = self.words.get(word)
        if ids is None:
            ids = self.older_words.get(word)
            if ids is None:
                ids = self.automaton.path(word.encode("utf-8"))
            if len(word) <= 64:
                if len(self.words) >= self.most:
                    self.older_words, self.words = self.words, {}
                self.words[word] = ids
        return ids

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        ids = self.older.get(chunk)
        if ids is None:
            ids = tuple(chain.from_iterable(map(self.word, self.split.findall(chunk))))
        if len(chunk) <= 64:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[chunk] = ids
        return ids


def encode(df: DataFrame, codec: Codec, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with ``out``: the token ids of ``text`` (null: none).  A column named ``out`` is replaced.

    A narrow step: no shuffle, memory by blocks of a few MB.
    """
    at = df.sparkSession.sparkContext.broadcast(codec)  # the size of the vocabulary file, whatever the data

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = at.value
        for batch in batches:
            flat, offsets = array("i"), [0]
            for a in range(0, len(batch), ROWS):  # few texts at a time as Python objects
                for x in batch.slice(a, ROWS).to_pylist():
                    flat.extend(codec.encode(x or ""))
                    offsets.append(len(flat))
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(flat, np.int32) if flat else [], pa.int32()))

    return df.withColumn(out, ids(F.col(text)))


def decode(df: DataFrame, codec: Codec, ids: str = "ids", out: str = "text") -> DataFrame:
    """``df`` with ``out``: the text of the token ids (null: empty); invalid UTF-8 becomes U+FFFD."""
    at = df.sparkSession.sparkContext.broadcast(codec)

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = at.value
        for batch in batches:
            texts = []
            for a in range(0, len(batch), ROWS):
                texts += [codec.decode(x or []).decode("utf-8", "replace") for x in batch.slice(a, ROWS).to_pylist()]
            yield pa.array(texts, pa.string())

    return df.withColumn(out, texts(F.col(ids)))


def encode_decode(df: DataFrame, codec: Codec, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ids, n_tokens, and ``text`` decoded from the ids: both directions in one worker of each task."""
    at = df.sparkSession.sparkContext.broadcast(codec)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = at.value
        for block in blocks(batches, text):
            flat, offsets, texts = array("i"), [0], []
            for t in texts_of(block, text):
                ids = codec.encode(t)
                flat.extend(ids)
                offsets.append(len(flat))
                texts.append(codec.decode(ids).decode("utf-8", "replace"))
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(flat, np.int32) if flat else [], pa.int32()))
            yield pa.RecordBatch.from_arrays([block.column(0), ids, pa.array(np.diff(offsets).astype(np.int64)), pa.array(texts, pa.string())], names=[key, "ids", "n_tokens", text])

    return map_arrow(df.select(key, text), run, f"`{key}` {kind}, ids array<int>, n_tokens bigint, `{text}` string")


def round_trip(df: DataFrame, codec: Codec, key: str, text: str, schema: str, row) -> DataFrame:
    """Encode and decode in one narrow pass, so that ids need not leave the worker: ``row(key, ids, decoded)``
    gives the values of ``schema``, of bigint and string columns."""
    at = df.sparkSession.sparkContext.broadcast(codec)
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64() if x.endswith(" bigint") else pa.string() for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = at.value
        for block in blocks(batches, text):
            keys, rows = block.column(0).to_pylist(), []
            for k, t in zip(keys, texts_of(block, text), strict=True):
                ids = codec.encode(t)
                rows.append(row(k, ids, codec.decode(ids)))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return df.select(key, text).mapInArrow(run, schema)


_decimals: list[bytes] = []


def digests(key: Column, ids: list[int], decoded: bytes) -> tuple:
    """doc_id, n_tokens, and the hex SHA-256 of the comma-joined ids and of the decoded text."""
    import hashlib

    if ids and (most := max(ids)) >= len(_decimals):
        _decimals.extend(b"%d" % i for i in range(len(_decimals), 2 * most + 1))
    return key, len(ids), hashlib.sha256(b",".join(map(_decimals.__getitem__, ids))).hexdigest(), hashlib.sha256(decoded).hexdigest()
