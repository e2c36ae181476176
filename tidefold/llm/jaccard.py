"""N-gram Jaccard self-join with adaptive multi-match prefixes, and its components.

A document's set are its distinct shingles.  All sets are ordered by one global order; two sets with a Jaccard
similarity of at least t share at least l of their l-prefixes, the first n - ceil(t n) + l tokens.  Long prefixes
bring more list entries, but more shared tokens are asked for before a pair is verified; for each document the l is
taken that makes list entries plus the expected verifications cheapest, from the lengths of its tokens' lists.

The steps, none of which gathers a group in one task:

* Tokens that are frequent anywhere in the corpus (found by counts of each task, a bounded list) go to the end of
  the order, so that shared passages do not fill the prefixes.  Any such list gives a valid order.
* Documents with equal sets are one class; only its smallest id, the representative, goes on.  Sets are equal if the
  sum and the exclusive or of their scrambled 64-bit hashes and their sizes are.
* Dense groups are contracted first: each representative is compared with the smallest one in the lists of its
  tokens, if they share many of them, and takes the smallest one that it is similar to as its label.
* Then every pair of representatives with different labels that shares enough tokens of its prefixes is verified.
  The prefixes are cut to what the sizes of both sets ask for, so texts that differ in more words than a similar pair
  can, such as distant copies of one text, do not meet; lists with one label give no pairs, as members of one
  component need no verification of their own.  Long lists are dealt over several tasks.
* Verification compares the shingles themselves, word for word.  Links join components.

Defined results: null and empty texts have empty sets and are linked with nothing; a text of fewer words than a
shingle has its whole sequence as one; repeated rows are in one component; ids are whole numbers below 2^62; documents
with a null id are compared like others, and a component of such documents alone has a null id; rows of one id with
different texts are linked each for itself, and what is linked with one of them may be linked with all; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, SPACE_WORDS, blocks, bytes_of, discard, map_arrow, materialize, mix64, prefix_sums, span_hash, window_hash, word_spans
from .graph import components

#: The longest extension of a prefix, and the cost of a verification in list entries.
MOST = 4
VERIFY_COST = 50
#: Frequent tokens: those counted FREQUENT times in a task, at most FREQUENT_LIST of a task and of the corpus.
FREQUENT, FREQUENT_LIST = 4, 2000
FREQUENT_ALL = 100_000
#: Bits of the bitmap of candidates (2^24: 2 MB), and shingles kept in a worker while pairs are verified.
FILTER_BITS = 24
RECENT = 30_000


def shingle_hashes(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles."""
    buf = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    low = LOWER[buf]
    start, end = word_spans(low, SPACE_WORDS)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    first = np.searchsorted(start, begins).tolist()
    ids = span_hash(prefix_sums(low), start, end)
    whole = window_hash(ids, width)
    out = []
    for a, b in zip(first, first[1:], strict=False):
        n = b - a
        out.append(np.unique(whole[a : b - width + 1] if n >= width else window_hash(ids[a:b], n) if n else whole[:0]))
    return out


def shingle_set(text: str, width: int) -> set:
    """The shingles themselves."""
    words = text.encode().lower().split()
    if len(words) < width:
        return {b" ".join(words)} if words else set()
    return set(zip(*(words[i:] for i in range(width)), strict=False))


def similar(a: set, b: set, percent: int) -> bool:
    both = len(a & b)
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def frequent_tokens(documents: DataFrame, text: str, width: int) -> np.ndarray:
    """Tokens that many documents of a task share; at most FREQUENT_ALL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        for block in blocks(batches, text):
            sets = shingle_hashes(bytes_of(block, text), width)
            tokens, times = np.unique(np.concatenate(sets), return_counts=True)
            tokens, times = tokens[times > 1], times[times > 1]
            every, back = np.unique(np.concatenate((held[0], tokens)), return_inverse=True)
            total = np.bincount(back, np.concatenate((held[1], times)), len(every)).astype(np.int64)
            if len(every) > 8 * FREQUENT_LIST:
                top = np.argsort(-total, kind="stable")[: 4 * FREQUENT_LIST]
                every, total = every[top], total[top]
            held = every, total
        tokens, times = held
        top = np.argsort(-times, kind="stable")[:FREQUENT_LIST]
        top = top[times[top] >= FREQUENT]
        yield pa.RecordBatch.from_arrays([pa.array(tokens[top].view(np.int64)), pa.array(times[top])], names=["token", "times"])

    counted = map_arrow(documents.select(text), run, "token bigint, times bigint").groupBy("token").agg(F.sum("times").alias("times"))
    found = counted.orderBy(F.desc("times"), "token").limit(FREQUENT_ALL).select("token").toArrow()
    return np.sort(found["token"].to_numpy().astype(np.int64).view(np.uint64))


def prefixes(documents: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """_id, n, the set's signature s1 and s2, base (tokens of the 1-prefix) and prefix (tokens in global order)."""
    shared = documents.sparkSession.sparkContext.broadcast(frequent_tokens(documents, text, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = shared.value
        for block in blocks(batches, "_text"):
            sets = shingle_hashes(bytes_of(block, "_text"), width)
            every = np.concatenate(sets)
            at = np.minimum(np.searchsorted(common, every), max(0, len(common) - 1))
            late = common[at] == every if len(common) else np.zeros(len(every), bool)
            rows, o = [], 0
            for s in sets:
                n = len(s)
                is_late = late[o : o + n]
                o += n
                base = n - -(-percent * n // 100) + 1 if n else 0
                ordered = np.concatenate((s[~is_late], s[is_late]))[: base + MOST - 1]
                s1 = int(mix64(s).sum(dtype=np.uint64).view(np.int64))
                s2 = int(np.bitwise_xor.reduce(mix64(s + np.uint64(77))).view(np.int64)) if n else 0
                rows.append((n, s1, s2, base, ordered.view(np.int64)))
            n, s1, s2, base, prefix = zip(*rows, strict=True)
            long = pa.int64()
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(n, long), pa.array(s1, long), pa.array(s2, long), pa.array(base, long), pa.array(prefix, pa.list_(long))], names=["_id", "n", "s1", "s2", "base", "prefix"])

    return map_arrow(documents.select(vertex(key, text).alias("_id"), F.col(text).alias("_text")), run, "_id bigint, n bigint, s1 bigint, s2 bigint, base bigint, prefix array<bigint>")


#: Null ids count as numbers from here on, made of the text; ids are less.
NULL_IDS = 1 << 62
#: Rows of a token's list that one task takes on the smaller sets' side.
SPLIT = 1000


def vertex(key: str, text: str) -> Column:
    """The number by which a document is known here: its id, or a number made of its text if it has none."""
    return F.coalesce(F.col(key).cast("bigint"), F.xxhash64(text).bitwiseAND(F.lit(NULL_IDS - 1)) + F.lit(NULL_IDS))


def with_ids(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``documents`` whose ``_id`` is in ``ids``, which may hold an id more than once.

    A bitmap of FILTER_BITS hashed ids, whatever their number, goes to every executor first, so that most other rows
    are not shuffled; the join that follows is exact.
    """
    bit = lambda c: F.xxhash64(c).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    one = F.expr("shiftleft(1L, cast(xxhash64(_id) & 63 as int))")
    bitmap = ids.select(F.shiftright(bit("_id"), 6).alias("_word"), one.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    met = documents.withColumn("_word", F.shiftright(bit("_id"), 6)).join(F.broadcast(bitmap), "_word")  # 2^(FILTER_BITS - 6) rows at most
    # the exact join is on what the bitmap has let through, so that the optimizer cannot put it before the bitmap
    met = met.withColumn("_hit", F.when(F.col("_bits").bitwiseAND(one) != 0, F.col("_id"))).where("_hit IS NOT NULL").drop("_word", "_bits")
    return met.join(ids.select(F.col("_id").alias("_hit")), "_hit", "left_semi").drop("_hit")


def verified(pairs: DataFrame, documents: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose texts' sets are similar enough.  Texts of documents in pairs meet by sort-merge joins."""
    pairs = materialize(pairs.select("a", "b"), "pairs")
    texts = with_ids(documents.select(vertex(key, text).alias("_id"), F.col(text).alias("_text")), pairs.select(F.explode(F.array("a", "b")).alias("_id")))
    texts = materialize(texts, "candidates")
    met = pairs.join(texts.select(F.col("_id").alias("a"), F.col("_text").alias("ta")), "a").join(texts.select(F.col("_id").alias("b"), F.col("_text").alias("tb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: dict[str, set] = {}
        held = 0

        def shingles(t: str) -> set:
            nonlocal held
            s = recent.get(t)
            if s is None:
                s = shingle_set(t or "", width)
                if held > RECENT:
                    recent.clear()
                    held = 0
                recent[t] = s
                held += len(s)
            return s

        for batch in batches:
            for at in range(0, batch.num_rows, 64):  # few texts at a time as Python objects
                part = batch.slice(at, 64)
                ta, tb = (c.to_pylist() for c in part.columns[2:])
                hit = [similar(shingles(x), shingles(y), percent) for x, y in zip(ta, tb, strict=True)]
                if any(hit):
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"]).filter(pa.array(hit, pa.bool_()))

    links = materialize(map_arrow(met.select("a", "b", "ta", "tb"), run, "a bigint, b bigint"), "links")
    discard(pairs)
    discard(texts)
    return links


def grouped(documents: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = 3, percent: int = 90) -> DataFrame:
    """One row per document, with its number of vertex(): _id, n, rep (the smallest number with an equal set) and
    component."""
    found = materialize(prefixes(documents, key, text, width, percent), "prefixes")
    some = found.where("n > 0")
    classes = materialize(some.groupBy("s1", "s2", "n").agg(F.min("_id").alias("rep")), "classes")
    reps = some.join(classes.select(F.col("rep").alias("_id")), "_id", "left_semi").dropDuplicates(["_id", "s1", "s2"])
    tokens = reps.select(F.col("_id").alias("rep"), "n", "base", F.posexplode("prefix").alias("pos", "token"))
    lists = tokens.groupBy("token").agg(F.count("*").alias("df"), F.min("rep").alias("hub")).where("df > 1")
    shared = materialize(tokens.join(lists, "token"), "lists")

    # dense groups first: each with the smallest document of its lists
    hubs = shared.where("rep <> hub").groupBy("rep", "hub", "base").agg(F.count("*").alias("times")).where(f"2 * times >= base + {MOST - 1}")
    near = verified(hubs.select(F.col("hub").alias("a"), F.col("rep").alias("b")), documents, key, text, width, percent)
    up = near.groupBy(F.col("b").alias("rep")).agg(F.min("a").alias("label"))
    over = up.select(F.col("rep").alias("label"), F.col("label").alias("above"))
    labels = materialize(up.join(over, "label", "left").select("rep", F.coalesce("above", "label").alias("label")), "labels")
    entry = shared.drop("df", "hub").join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    mixed = entry.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("df")).where("low <> high")

    # then all pairs of different labels, each document with the prefix that costs least
    own = Window.partitionBy("rep")  # as many rows as its prefix is long
    sums = [F.sum(F.when(F.col("pos") < F.col("base") + l - 1, F.col("df") - 1).otherwise(0)).over(own) for l in range(1, MOST + 1)]
    entry = entry.join(mixed.select("token", "df"), "token").withColumns({f"s{l}": x for l, x in enumerate(sums, 1)})
    costs = [F.col(f"s{l}") * (1 + VERIFY_COST / l) for l in range(1, MOST + 1)]
    best = F.least(*costs)
    choice = F.lit(1)
    for l in range(MOST, 0, -1):
        choice = F.when(costs[l - 1] == best, F.lit(l)).otherwise(choice)
    small = F.col("n") < 10  # as many tokens as MOST must be shared by any similar pair
    entry = entry.select("rep", "n", "label", "pos", "token", "df", F.when(small, F.lit(1)).otherwise(choice).alias("l"))
    entry = materialize(entry, "lists")
    discard(shared)
    # x is the smaller set.  The sizes say how many tokens must be shared, and so how long both prefixes are.  A long
    # list is dealt over several tasks on the side of x.
    parts = F.ceil(F.col("df") / SPLIT).cast("int")
    shares = lambda size: F.expr(f"({percent} * ({size}) + {99 + percent}) div {100 + percent}")
    x = entry.where(F.col("pos") < F.col("n") - shares("n + n") + F.col("l"))
    x = x.select("token", F.pmod(F.hash("rep"), parts).alias("part"), F.col("rep").alias("x"), F.col("n").alias("nx"), F.col("label").alias("cx"), F.col("pos").alias("px"), "l")
    y = entry.select("token", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.col("rep").alias("y"), F.col("n").alias("ny"), F.col("label").alias("cy"), F.col("pos").alias("py"))
    smaller = (F.col("nx") < F.col("ny")) | ((F.col("nx") == F.col("ny")) & (F.col("x") < F.col("y")))
    both = shares("nx + ny")
    inside = (F.col("px") < F.col("nx") - both + F.col("l")) & (F.col("py") < F.col("ny") - both + F.col("l"))
    meets = x.join(y, ["token", "part"]).where((F.col("cx") != F.col("cy")) & smaller & (100 * F.col("nx") >= percent * F.col("ny")) & inside)
    pairs = meets.groupBy("x", "y", "l").agg(F.count("*").alias("times")).where("times >= l")
    far = verified(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")), documents, key, text, width, percent)
    discard(entry)

    linked = components(near.unionAll(far)).select(F.col("vertex").alias("rep"), "component")
    classes = classes.join(linked, "rep", "left").select("s1", "s2", "n", "rep", F.coalesce("component", "rep").alias("component"))
    out = found.select("_id", "n", "s1", "s2").join(classes, ["s1", "s2", "n"], "left")
    return out.select("_id", "n", F.coalesce("rep", "_id").alias("rep"), F.coalesce("component", "_id").alias("component"))


def join(documents: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id (smallest id with an equal set) and component_id; options as
    of grouped()."""
    known = lambda c: F.when(F.col(c) < NULL_IDS, F.col(c))
    found = grouped(documents, **options)
    return found.select(known("_id").alias("doc_id"), F.col("n").alias("n_shingles"), known("rep").alias("class_id"), known("component").alias("component_id"))


def representatives(documents: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents, in their own columns, without those linked with one of smaller id: one row of each component."""
    names = [F.col(f"`{c}`") for c in documents.columns]
    places = materialize(grouped(documents, key=key, text=text, **options).select(F.col("_id").alias("_tf_id"), "component"), "places")
    gone = materialize(places.where("_tf_id <> component").select("_tf_id").distinct(), "gone")
    several = materialize(places.where("_tf_id = component").groupBy("_tf_id").agg(F.count("*").alias("n")).where("n > 1").select("_tf_id"), "several")
    numbered = documents.withColumn("_tf_id", vertex(key, text))
    # texts whose bit in a bitmap of the ids to go is not set need no shuffle to stay
    word, one = F.shiftright(F.xxhash64("_tf_id").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)), 6), F.expr("shiftleft(1L, cast(xxhash64(_tf_id) & 63 as int))")
    bitmap = gone.select(word.alias("_tf_word"), one.alias("_tf_bit")).groupBy("_tf_word").agg(F.bit_or("_tf_bit").alias("_tf_bits"))
    met = numbered.withColumn("_tf_word", word).join(F.broadcast(bitmap), "_tf_word", "left")  # 2^(FILTER_BITS - 6) rows at most
    met = met.withColumn("_tf_hit", F.when(F.coalesce("_tf_bits", F.lit(0)).bitwiseAND(one) != 0, F.col("_tf_id"))).drop("_tf_word", "_tf_bits")
    unsure = met.where("_tf_hit IS NOT NULL").join(gone.select(F.col("_tf_id").alias("_tf_hit")), "_tf_hit", "left_anti").select(*names, "_tf_id")
    out = met.where("_tf_hit IS NULL").select(*names, "_tf_id").unionAll(unsure)
    if not several.isEmpty():  # ids of repeated rows: one row of each
        out = out.join(several, "_tf_id", "left_anti").select(*names, "_tf_id").unionAll(numbered.join(several, "_tf_id", "left_semi").dropDuplicates(["_tf_id"]).select(*names, "_tf_id"))
    return out.select(names)
