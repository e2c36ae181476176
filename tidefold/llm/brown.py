"""Language-model scoring with Brown class-based bigrams.

The probability of a token is that of its class after the class before it, times that of the word in its class.
Every training word has a class.  The most frequent words are put into classes by the exchange algorithm, which moves
one word at a time to the class where the training text's class bigrams are most likely; each other training word then
goes, by the same measure, to the class that suits the classes of its own neighbours.  Words that training does not
have form one more class, with the probability that they have without classes; text ends form the last one.
Transitions are counted over the classes of all training tokens and smoothed towards the classes' overall shares.

Word counts are made in each task, summed by word and kept as a table; so are the neighbours' classes of all words
outside the ``cluster_words`` most frequent ones, and the class of each word follows from them where they are summed.
Bigrams of words reach the driver only for ``cluster_words`` words, those of classes for all.  The ``local_words`` most
frequent words go to every executor, a bounded table; rarer words of a text are joined with the table of words, one
row for each text and word.  Of each text its classes are kept, one byte a token: they are counted, then scored.

Defined results: null texts count as empty and have one token, their end; without training texts every token is
unknown; texts with equal ids are scored each for itself.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, bytes_of, discard, materialize

#: Added to counts.
ADD = 0.1
#: Weight of the classes' overall shares in each transition, in counts.
PRIOR = 10.0
FLUSH = 150_000


def words_of(text: bytes) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ of the text with A-Z in lower case."""
    return text.lower().split()


def word_counts(training: DataFrame, text: str) -> DataFrame:
    """(word, c) over all training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()).cast(pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "c"])

        seen: Counter = Counter()
        for block in blocks(batches, text):
            for t in bytes_of(block, text):
                seen.update(words_of(t))
            if len(seen) > FLUSH:
                # what came once goes on; the frequent words stay for the next blocks
                common = Counter(dict(seen.most_common(FLUSH // 5)))
                seen -= common
                yield out()
                seen = common
        if seen:
            yield out()

    return training.select(text).mapInArrow(run, "word string, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def most_frequent(counts: DataFrame, n: int) -> list[tuple[bytes, int]]:
    """At most ``n`` words with their counts, most frequent first: all those above a count, found from a histogram."""
    bins = counts.groupBy(F.floor(8 * F.log2("c")).alias("b")).agg(F.count("*").alias("words"), F.min("c").alias("least")).orderBy(F.desc("b")).collect()
    total, least = 0, None
    for r in bins:
        if total + r["words"] > n:
            break
        total, least = total + r["words"], r["least"]
    if least is None:
        return []
    found = counts.where(F.col("c") >= least).toArrow()
    pairs = zip(found["word"].cast(pa.binary()).to_pylist(), found["c"].to_pylist(), strict=True)
    return sorted(pairs, key=lambda x: (-x[1], x[0]))


def bigram_counts(training: DataFrame, text: str, ids: dict[bytes, int]) -> np.ndarray:
    """Counts of symbol pairs: the words of ``ids``, any other word, and the text's bounds, in this order."""
    size = len(ids) + 2
    shared = training.sparkSession.sparkContext.broadcast(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = shared.value
        total = np.zeros(size * size, np.int64)
        for block in blocks(batches, text, 1 << 20):
            seq: list[int] = [size - 1]
            for t in bytes_of(block, text):
                seq.extend(map(ids.get, words_of(t), repeat(size - 2)))
                seq.append(size - 1)
            a = np.array(seq, np.int64)
            total += np.bincount(a[:-1] * size + a[1:], minlength=size * size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["pair", "n"])

    found = training.select(text).mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size * size, np.int64)
    out[found["pair"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(size, size)


def exchange(pairs: np.ndarray, classes: int, rounds: int = 4) -> np.ndarray:
    """Classes of the words (all symbols but the last two), by the exchange algorithm.

    A word moves to the class that makes sum f(n(c, d)) - sum f(n(c, .)) - sum f(n(., c)) largest, f(x) = x log x.
    The last two symbols are classes of their own, numbered ``classes`` and ``classes`` + 1.
    """
    n_words = len(pairs) - 2
    of = np.concatenate((np.minimum(np.arange(n_words), classes - 1), [classes, classes + 1]))
    size = classes + 2
    m = np.zeros((size, size))
    np.add.at(m, (of[:, None].repeat(len(of), 1), of[None, :].repeat(len(of), 0)), pairs)

    def f(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1))

    inner = np.arange(classes)
    for _ in range(rounds):
        moved = 0
        for w in range(n_words):
            to = np.bincount(of, pairs[w], size)
            since = np.bincount(of, pairs[:, w], size)
            own, k = float(pairs[w, w]), of[w]
            to[k] -= own
            since[k] -= own
            m[k] -= to
            m[:, k] -= since
            m[k, k] -= own
            row, column = m.sum(axis=1) + since, m.sum(axis=0) + to  # wherever the word goes
            out, into = to.sum() + own, since.sum() + own
            gain = (f(m[:classes] + to) - f(m[:classes])).sum(axis=1) + (f(m[:, :classes].T + since) - f(m[:, :classes].T)).sum(axis=1)
            d = m[inner, inner]
            gain += f(d + to[:classes] + since[:classes] + own) + f(d) - f(d + to[:classes]) - f(d + since[:classes])
            gain -= f(row[:classes] + out) - f(row[:classes]) + f(column[:classes] + into) - f(column[:classes])
            best = int(np.argmax(gain))
            if gain[best] <= gain[k] + 1e-9:
                best = k
            m[best] += to
            m[:, best] += since
            m[best, best] += own
            moved += best != k
            of[w] = best
        if not moved:
            break
    return of[:-2]


def class_counts(pairs: np.ndarray, of: np.ndarray, classes: int) -> np.ndarray:
    """Counts of class pairs from those of symbols, of which the last two are the classes after ``classes``."""
    of = np.concatenate((of, [classes, classes + 1])).astype(np.int64)
    m = np.zeros((classes + 2, classes + 2))
    np.add.at(m, (of[:, None].repeat(len(of), 1), of[None, :].repeat(len(of), 0)), pairs)
    return m


def neighbours(training: DataFrame, text: str, classes: dict[bytes, int], n_classes: int) -> DataFrame:
    """(word, at, n) for the words outside ``classes``: how often class ``at`` comes after the word, or, with the
    number of classes and the two others added to it, before the word."""
    size, shared = n_classes + 2, training.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            cells, times = np.unique(np.concatenate(held), return_counts=True)
            words = pa.array(list(seen), pa.binary()).cast(pa.string()).take(pa.array(cells // (2 * size)))
            return pa.RecordBatch.from_arrays([words, pa.array((cells % (2 * size)).astype(np.int32)), pa.array(times)], names=["word", "at", "n"])

        of, seen, held, n = shared.value, {}, [], 0
        for block in blocks(batches, text, 1 << 20):
            # classes, and -1 - number for the words without one
            seq: list[int] = [size - 1]
            for t in bytes_of(block, text):
                seq.extend(of[w] if w in of else -1 - seen.setdefault(w, len(seen)) for w in words_of(t))
                seq.append(size - 1)
            a = np.array(seq, np.int64)
            at = np.flatnonzero(a < 0)
            known = np.where(a < 0, size - 2, a)
            first = (-1 - a[at]) * (2 * size)
            held += [first + known[at + 1], first + size + known[at - 1]]
            n += 2 * len(at)
            if n > 16 * FLUSH or len(seen) > 2 * FLUSH:
                yield out()
                seen, held, n = {}, [], 0
        if n:
            yield out()

    return training.select(text).mapInArrow(run, "word string, at int, n bigint")


def suited(cells: DataFrame, m: np.ndarray) -> DataFrame:
    """(word, c, k): each word's count, and the class to which the exchange algorithm would move it by its neighbours."""
    size, classes = len(m), len(m) - 2
    shared = cells.sparkSession.sparkContext.broadcast(m)

    def f(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        beside = np.concatenate((m[:classes].T, m[:, :classes]))  # what a class has after it, and before it
        before = f(beside)
        row, column = m.sum(axis=1)[:classes], m.sum(axis=0)[:classes]
        taken = row + column > 0
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                lists = part.column(1)
                offsets = lists.offsets.to_numpy()
                at, n = (x.to_numpy() for x in lists.flatten().flatten())
                begins = (offsets - offsets[0])[:-1]
                c = np.add.reduceat(np.where(at < size, n, 0), begins)
                gain = np.add.reduceat(f(beside[at] + n[:, None]) - before[at], begins)
                gain -= f(row + c[:, None]) - f(row) + f(column + c[:, None]) - f(column)
                if taken.any():
                    gain[:, ~taken] = -np.inf  # a class that is empty suits every word by itself, not all of them
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(c), pa.array(gain.argmax(axis=1).astype(np.int32))], names=["word", "c", "k"])

    each = cells.repartition("word").groupBy("word", "at").agg(F.sum("n").alias("n"))
    return each.groupBy("word").agg(F.collect_list(F.struct("at", "n")).alias("cells")).mapInArrow(run, "word string, c bigint, k int")


class Model:
    """What each task needs: the frequent words' classes, counts and emissions, transitions, and totals.

    The first ``n_cluster`` words have ``classes``.  ``in_class`` has the classes' tokens if all words have a class;
    otherwise words without one share a class with the unknown ones.  ``pairs`` are counts of symbols; without them
    learn() has to follow.
    """

    def __init__(self, frequent: list[tuple[bytes, int]], n_cluster: int, classes: np.ndarray, n_classes: int, pairs: np.ndarray | None, tokens: int, distinct: int, texts: int, in_class: np.ndarray | None = None):
        self.index = {w: i for i, (w, _) in enumerate(frequent)}
        c = np.array([x for _, x in frequent] + [0.0])
        self.rare, self.bound = n_classes, n_classes + 1
        #: the class of each frequent word; the last entry is for all others
        self.of = np.concatenate((classes, np.full(len(c) - len(classes), self.rare))).astype(np.int64)
        rare_tokens = rare_words = 0
        if in_class is None:
            in_class = np.bincount(classes, c[: len(classes)], n_classes) if len(classes) else np.zeros(n_classes)
            rare_tokens, rare_words = tokens - texts - int(c[:n_cluster].sum()), distinct - (texts > 0) - n_cluster
        self.in_class = in_class
        self.log_rare = math.log10(rare_tokens + ADD * (rare_words + 1))
        self.log_all = math.log10(tokens + ADD * (distinct + 1))
        self.unknown = ADD / (tokens + ADD * (distinct + 2))
        self.log_c = np.log10(c + ADD)
        self.log_c[-1] = 0  # added by the join
        self.emission = self.log_c - self.log_rare
        with np.errstate(divide="ignore", invalid="ignore"):
            self.emission[:n_cluster] = np.log10(c[:n_cluster] / in_class[classes])
        self.emission[-1] = 0  # added by the join
        self.log_end = math.log10(texts + ADD)
        self.end_known = int(texts > 0)
        if pairs is not None:
            self.learn(class_counts(pairs, classes, n_classes))

    def learn(self, m: np.ndarray) -> None:
        """Transitions from the counts of class pairs; an unknown word is as likely after any class."""
        some = np.concatenate((self.in_class > 0, [True, True]))  # classes with members
        share = (m.sum(axis=0) + some) / (m.sum() + some.sum())
        after = (1 - self.unknown) * (m + PRIOR * share) / (m.sum(axis=1, keepdims=True) + PRIOR)
        after[:, self.rare] += self.unknown
        with np.errstate(divide="ignore"):
            self.transition = np.log10(after)

    def encode(self, texts: list[bytes]) -> tuple:
        """For each text: tokens, known ones, base score and emissions without the rarer words, and its words' classes;
        the rarer words follow as one list with its offsets, their places as one more with its own."""
        get, none = self.index.get, len(self.of) - 1
        split = [words_of(t) for t in texts]
        sizes = np.array([len(w) for w in split])
        at = np.fromiter(map(get, (w for words in split for w in words), repeat(none)), np.int64, int(sizes.sum()))
        begins = np.cumsum(sizes) - sizes
        classes = self.of[at].astype(np.uint8).tobytes()
        doc = np.repeat(np.arange(len(texts)), sizes)
        emitted = np.bincount(doc, self.emission[at], len(texts)).astype(float)  # integers where all texts are empty
        base = np.bincount(doc, self.log_c[at], len(texts)) + self.log_end - (sizes + 1) * self.log_all
        known = np.bincount(doc, at != none, len(texts)).astype(np.int64) + self.end_known
        missing = at == none
        words, offsets, places, place_offsets, kept = [], [0], [], [0], []
        for d, b in enumerate(begins.tolist()):
            found: dict[bytes, list[int]] = {}
            for i in np.flatnonzero(missing[b : b + len(split[d])]).tolist():
                found.setdefault(split[d][i], []).append(i)
            words += found
            for own in found.values():
                places += own
                place_offsets.append(len(places))
            offsets.append(len(words))
            kept.append(classes[b : b + len(split[d])])
        return sizes + 1, known, base, emitted, kept, words, offsets, places, place_offsets

    def steps(self, classes: list[bytes]) -> np.ndarray:
        """The score of each text's transitions, its end included."""
        seq = bounded(classes, self.bound)
        begins = np.cumsum([0, *(len(c) + 1 for c in classes)])[:-1]
        return np.add.reduceat(self.transition[seq[:-1], seq[1:]], begins)


def bounded(classes: list[bytes], bound: int) -> np.ndarray:
    """The texts' classes one after another, with a bound before, between and after them."""
    end = bytes([bound])
    return np.frombuffer(end + end.join(classes) + end, np.uint8)


def transition_counts(sequences: DataFrame, n_classes: int) -> np.ndarray:
    """Counts of class pairs over all tokens of the ``classes`` of texts."""
    size = n_classes + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for block in blocks(batches, "classes"):
            a = bounded([x or b"" for x in block.column(0).to_pylist()], size - 1).astype(np.int64)
            total += np.bincount(a[:-1] * size + a[1:], minlength=size * size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["pair", "n"])

    found = sequences.select("classes").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size * size)
    out[found["pair"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(size, size)


def score(documents: DataFrame, training: Column, *, key: str = "doc_id", text: str = "text", cluster_words: int = 1000, classes: int = 48, local_words: int = 200_000) -> DataFrame:
    """One row per document: ``key``, training, n_tokens, n_known, train_tokens, base_score, score and perplexity.

    ``training`` says which documents the model learns from.  ``classes`` is 250 at most.
    """
    if classes > 250:
        raise ValueError("a class takes one byte")
    spark = documents.sparkSession
    source = documents.select(F.col(key), training.alias("training"), F.col(text).alias("text"))
    learn = source.where("training")
    counts = materialize(word_counts(learn, "text"), "words")
    words, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    texts = learn.select(key).count()
    frequent = most_frequent(counts, local_words)
    n_cluster = min(cluster_words, len(frequent))
    core = frequent[:n_cluster]
    pairs = bigram_counts(learn, "text", {w: i for i, (w, _) in enumerate(core)})
    of = exchange(pairs, classes)
    rest = suited(neighbours(learn, "text", {w: int(k) for (w, _), k in zip(core, of, strict=True)}, classes), class_counts(pairs, of, classes))
    first = spark.createDataFrame([(w.decode(), c, int(k)) for (w, c), k in zip(core, of, strict=True)], "word string, c bigint, k int")
    placed = materialize(rest.unionByName(first), "classes")
    discard(counts)
    in_class = np.zeros(classes)
    for r in placed.groupBy("k").agg(F.sum("c").alias("c")).collect():
        in_class[r["k"]] = r["c"]
    local_k = placed.where(F.col("c") >= (frequent[-1][1] if frequent else 0)).select("word", "k").toArrow()
    class_of = dict(zip(local_k["word"].cast(pa.binary()).to_pylist(), local_k["k"].to_pylist(), strict=True))
    tokens = words + texts
    model = Model(frequent, len(frequent), np.array([class_of[w] for w, _ in frequent], np.int64), classes, None, tokens, distinct + (texts > 0), texts, in_class)
    shared = spark.sparkContext.broadcast(model)  # local_words words at most
    item = pa.struct([("word", pa.string()), ("at", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        model = shared.value
        row = TaskContext.get().partitionId() << 40  # a number for each row, so that equal ids stay apart
        for block in blocks(batches, "text", 1 << 20):
            n, known, base, value, own, words, offsets, places, place_offsets = model.encode(bytes_of(block, "text"))
            at = pa.ListArray.from_arrays(pa.array(place_offsets, pa.int32()), pa.array(places, pa.int32()))
            rare = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(words, pa.binary()).cast(pa.string()), at], fields=list(item)))
            rows = pa.array(np.arange(row, row + block.num_rows))
            row += block.num_rows
            yield pa.RecordBatch.from_arrays([rows, block.column(0), block.column(1), *map(pa.array, (n, known, base, value)), pa.array(own, pa.binary()), rare], names=["row", key, "training", "n", "known", "base", "value", "classes", "rare"])

    kind = documents.schema[key].dataType.simpleString()
    local = source.mapInArrow(run, f"row bigint, `{key}` {kind}, training boolean, n bigint, known bigint, base double, value double, classes binary, rare array<struct<word:string,at:array<int>>>")
    local = materialize(local, "texts")
    rare = local.select("row", F.inline("rare")).join(placed, "word", "left")
    times = F.size("at")
    base = times * F.log10(F.coalesce("c", F.lit(0)) + F.lit(ADD))
    in_own = F.element_at(F.array(*(F.lit(float(x)) for x in in_class)), F.col("k") + 1)
    emitted = F.when(F.col("c").isNotNull(), times * F.log10(F.col("c") / in_own)).otherwise(0.0)
    fill = F.collect_list(F.struct(F.coalesce("k", F.lit(classes)).alias("k"), "at"))
    sums = rare.groupBy("row").agg(F.sum(base).alias("more"), F.sum(emitted).alias("more_value"), F.sum(F.when(F.col("c").isNotNull(), times).otherwise(0)).alias("more_known"), fill.alias("fill"))
    whole = local.drop("rare").join(sums, "row", "left").select("classes", "fill", key, "training", F.col("n").alias("n_tokens"), (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), (F.col("value") + F.coalesce("more_value", F.lit(0.0))).alias("emitted"))
    rest_names = whole.columns[2:]

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for own, more in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if more:
                    a = np.frombuffer(own, np.uint8).copy()
                    for x in more:
                        a[x["at"]] = x["k"]
                    own = a.tobytes()
                out.append(own)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), *batch.columns[2:]], names=["classes", *rest_names])

    sequences = materialize(whole.mapInArrow(filled, f"classes binary, `{key}` {kind}, training boolean, n_tokens bigint, n_known bigint, base_score double, emitted double"), "sequences")
    discard(local)
    model.learn(transition_counts(sequences.where("training"), classes))
    model.index, model.log_c, model.emission, model.of = {}, None, None, None  # the transitions are all that is left to send
    last = spark.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "classes"):
            value = last.value.steps([x or b"" for x in block.column(0).to_pylist()]) + block.column(6).to_numpy()
            yield pa.RecordBatch.from_arrays([*block.columns[1:6], pa.array(value)], names=[*rest_names[:-1], "score"])

    out = sequences.mapInArrow(scored, f"`{key}` {kind}, training boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    out = out.select(key, "training", "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
