"""Corpus pipeline over ``documents``: language ID, near-duplicate removal, decontamination, pseudonyms, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written to the cluster's shared folder and
read back as the next one's docs.  All stages but the last return the columns of ``docs``.

Defined results: null texts and texts without a letter are in no language and go at the first stage; of repeated rows,
and of equal or similar texts, one row stays, that of the smallest id (a null id only if no other has one; of equal ids
any); extra columns, whatever their names, pass through the first four stages as they are; empty tables give empty
tables; texts of any length are used whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.llm import bpe, decontaminate, jaccard, langid, pii
from tidefold.llm.common import materialize
from tidefold.llm.queries import codec, table

#: Documents whose calibrated probability of the predicted language is less are rejected.
LEAST_SCORE = 0.5
#: Words and chunks whose tokens a worker keeps, fewer than where it does nothing but BPE; any number gives the same tokens.
MEMO_WORDS = 50_000


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the classifier knows; texts without letters and doubtful ones go."""
    found = langid.predict(docs, langid.train(docs, order=F.xxhash64("doc_id")), keep=tuple(docs.columns), names=("_tf_lang", "_tf_score"))
    return found.where((F.col("_tf_lang") != langid.UNDETERMINED) & (F.col("_tf_score") >= LEAST_SCORE)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of 0.8 on five-word shingles, the document with the smallest id."""
    return jaccard.representatives(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), action="remove_documents")


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets replaced by pseudonyms of the same format."""
    return pii.pseudonymise(docs, pii.SAMPLE_KEY)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, and the text decoded from the ids."""
    return bpe.encode_decode(docs, codec().with_memo(MEMO_WORDS))


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("pseudonyms", pseudonyms), ("tokens", tokens)]

ORACLE_SQL = None  # no stage but the decontamination can be put in SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
