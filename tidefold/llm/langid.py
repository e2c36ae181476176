"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are n-grams (1 to 3 characters) of the lower-cased letters, with one blank between words, hashed into a
fixed number of columns.  A text's value for a column is its share of the text's n-grams times the inverse document
frequency in all training documents.  Weights are learned with follow-the-regularised-leader (FTRL-proximal) under an
elastic-net penalty: the L1 part makes them sparse, the L2 part bounds them.  Temperature calibration on sample
documents that the weights have not seen turns the scores into probabilities.

Languages and document frequencies come from all training documents; the weights are fitted on a sample of them, a
documented bound: ``sample_rows`` shared by the languages as they occur, but at least ``least_rows`` for each.  The
``most_languages`` most frequent languages are learned, as the table has a column for each.  What reaches the driver are
the sample's n-gram counts and one number for each of the ``COLUMNS`` columns.  Prediction reads every whole text in one
narrow pass: the score is linear, so it is a mean of table rows over the text's n-grams.

Defined results: null texts and texts without a letter get the language ``und`` and score 0; without any labelled text
all get it; of languages that tie the first by name is taken; repeated rows count as often as they occur and get equal
predictions; language, source and id are never inputs of a prediction; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import blocks, map_arrow, quoted, texts_of

UNDETERMINED = "und"
BITS = 17
COLUMNS = 1 << BITS
#: FTRL step sizes and penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.002, 0.0005
EPOCHS = 4
#: Shares of n-grams are small numbers; this factor brings them to the size the step sizes are made for.
SCALE = 50.0

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all texts, one row of three for each character kept, and where each text begins."""
    letter = _letter_table()
    points = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    sizes = np.array([len(p) + 1 for p in points])
    ends = np.cumsum(sizes)
    buf = np.full(int(ends[-1]) + 2, 32, np.uint32)
    for p, e in zip(points, ends.tolist(), strict=True):
        buf[e - len(p) : e] = p
    # a blank stands before each text and for every run of other characters
    is_letter = letter[buf]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    begin = np.concatenate(([0], ends[:-1]))
    keep[begin] = True
    keep[ends[-1] :] = False
    code = np.where(is_letter, buf, 32)
    at = np.cumsum(keep) - 1
    code = code[keep]
    begins = at[begin]
    a = code * np.uint32(0x9E3779B1)
    b = np.empty_like(a)
    b[:-1], b[-1] = code[1:], 32
    c = np.empty_like(a)
    c[:-2], c[-2:] = code[2:], 32
    c[np.concatenate((begins[1:], [len(code)])) - 1] = 32  # n-grams end with their text
    two = (a ^ (b * np.uint32(0x85EBCA77))) * np.uint32(0xC2B2AE3D)
    three = (two ^ (c * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
    shift = np.uint32(32 - BITS)
    grams = np.stack((((a ^ (a >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> shift, (two ^ (two >> np.uint32(13))) >> shift, (three ^ (three >> np.uint32(13))) >> shift), axis=1)
    return grams, begins


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


class Model:
    """Languages, a weight for each column and language (IDF included), biases and the temperature."""

    def __init__(self, languages: list[str], table: np.ndarray, bias: np.ndarray, temperature: float):
        self.languages, self.table, self.bias, self.temperature = languages, table, bias, temperature

    def scores(self, texts: list[str]) -> np.ndarray:
        grams, begins = ngrams(texts)
        rows = self.table[grams[:, 0]]
        rows += self.table[grams[:, 1]]
        rows += self.table[grams[:, 2]]
        # of three n-grams for each kept character
        sizes = np.diff(np.concatenate((begins, [len(grams)]))) * 3
        return np.add.reduceat(rows, begins, axis=0, dtype=np.float64) * (SCALE / sizes)[:, None] + self.bias

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        known = [bool(t) and has_letter(t) for t in texts]
        out = [(UNDETERMINED, 0.0)] * len(texts)
        some = [i for i, k in enumerate(known) if k]
        if not some or not self.languages:
            return out
        z = self.scores([texts[i] for i in some]) / self.temperature
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        for i, k, row in zip(some, best.tolist(), p, strict=True):
            out[i] = self.languages[k], float(row[k])
        return out


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], classes: np.ndarray, n_classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights (COLUMNS x classes) and biases; the last row of the state is the bias, without penalty."""
    z = np.zeros((COLUMNS + 1, n_classes))
    n = np.zeros_like(z)

    def weights(at: np.ndarray) -> np.ndarray:
        w = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        w[np.abs(z[at]) <= L1] = 0
        w[-1] = -z[at[-1]] / ((BETA + np.sqrt(n[at[-1]])) / ALPHA)
        return w

    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)).tolist():
            at, x = rows[i]
            w = weights(at)
            logits = x @ w
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[classes[i]] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    every = np.arange(COLUMNS + 1)
    w = weights(every)
    return w[:-1], w[-1]


def temperature(logits: np.ndarray, classes: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search over its logarithm."""
    if not len(classes):
        return 1.0

    def loss(t: float) -> float:
        z = logits / np.exp(t)
        z = z - z.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(classes)), classes]))

    low, high, g = np.log(0.25), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - g * (high - low), low + g * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Of all texts (column ``text``) with a letter: their number, and how many have each column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, place = np.zeros(COLUMNS + 1, np.int64), np.zeros(COLUMNS, np.int64)
        for block in blocks(batches, "text"):
            some = [t for t in texts_of(block, "text") if has_letter(t)]
            if not some:
                continue
            grams, begins = ngrams(some)
            total[COLUMNS] += len(some)
            for a, b in zip(begins, [*begins[1:], len(grams)], strict=True):
                own = grams[a:b].ravel()
                at = np.arange(len(own))
                place[own] = at  # of equal columns, the last one stays
                total[own[place[own] == at]] += 1
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["at", "n"])

    found = map_arrow(texts.select("text"), run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(COLUMNS + 1, np.int64)
    out[found["at"].to_numpy()] = found["n"].to_numpy()
    return int(out[COLUMNS]), out[:COLUMNS]


def train(documents: DataFrame, *, text: str = "text", lang: str = "lang", order: Column | None = None, sample_rows: int = 2000, least_rows: int = 200, most_languages: int = 256) -> Model:
    """Fit on the first documents of each language in the pseudo-random order ``order``."""
    some = documents.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    order = F.xxhash64(F.col(text)) if order is None else order
    keyed = some.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), order.cast("bigint").alias("o"))
    counts = {r["lang"]: r["n"] for r in keyed.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most_languages).collect()}
    total = sum(counts.values())
    # a hash threshold first, so that the sample is small before it is sorted
    quota, below = {}, F.lit(False)
    for language, n in counts.items():
        most = max(least_rows, sample_rows * n // total)
        mine = F.col("lang") == F.lit(language)
        quota[language] = most
        below = F.when(mine, F.col("o") < int(-(1 << 63) + (1.3 * most / n) * (1 << 64)) if n > 1.3 * most else True).otherwise(below)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            out = []
            for language, t, o in zip(block.column(0).to_pylist(), texts_of(block, "text"), block.column(2).to_pylist(), strict=True):
                if has_letter(t):
                    found, times = np.unique(ngrams([t])[0], return_counts=True)
                    out.append((language, o, found.astype(np.int32), times.astype(np.float32)))
            if out:
                a, b, c, d = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(c, pa.list_(pa.int32())), pa.array(d, pa.list_(pa.float32()))], names=["lang", "o", "grams", "times"])

    counted = map_arrow(keyed.where(below), count, "lang string, o bigint, grams array<int>, times array<float>")
    sample = counted.toArrow().sort_by([("o", "ascending"), ("lang", "ascending")])  # somewhat more than the quotas
    left, taken = dict(quota), []
    for i, language in enumerate(sample["lang"].to_pylist()):
        if left[language]:
            left[language] -= 1
            taken.append(i)
    sample = sample.take(pa.array(taken, pa.int64()))
    languages = sorted(set(sample["lang"].to_pylist()))
    if not languages:
        return Model([], np.zeros((1, 1), np.float32), np.zeros(1), 1.0)
    documents_, seen = document_frequencies(keyed)
    classes = np.array([languages.index(x) for x in sample["lang"].to_pylist()])
    grams = [np.asarray(x.values) for x in sample["grams"]]
    times = [np.asarray(x.values, np.float64) for x in sample["times"]]
    idf = np.log((1 + documents_) / (1 + seen)) + 1
    idf[seen < 2] = 0  # n-grams of a single document say nothing about others
    rows = [(np.concatenate((g, [COLUMNS])), np.concatenate((t / t.sum() * idf[g] * SCALE, [1.0]))) for g, t in zip(grams, times, strict=True)]
    held = np.arange(len(rows)) % 5 == 4  # for the calibration
    if held.all() or not held.any():
        held[:] = False
    w, bias = ftrl([r for r, h in zip(rows, held, strict=True) if not h], classes[~held], len(languages))
    logits = np.array([x[:-1] @ w[at[:-1]] + bias for (at, x), h in zip(rows, held, strict=True) if h]).reshape(-1, len(languages))
    return Model(languages, (w * idf[:, None]).astype(np.float32), bias, temperature(logits, classes[held]))


def predict(documents: DataFrame, model: Model, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",), names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The columns ``keep`` with the language and its score, called ``names``, for every row; a narrow step.

    A column of ``keep`` with one of these names is replaced.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)  # COLUMNS rows, whatever the data
    kept = list(dict.fromkeys((*keep, text)))
    out = [c for c in kept if c in keep and c not in names]
    schema = T.StructType([*documents.select(*quoted(out)).schema, *T.StructType.fromDDL(f"`{names[0]}` string, `{names[1]}` double")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for block in blocks(batches, text, 1 << 20):
            languages, scores = zip(*model.predict(texts_of(block, text)), strict=True)
            own = [block.column(kept.index(c)) for c in out]
            yield pa.RecordBatch.from_arrays([*own, pa.array(languages), pa.array(scores)], names=schema.names)

    return map_arrow(documents.select(*quoted(kept)), run, schema)
