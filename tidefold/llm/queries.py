"""Queries opN_<name> over the whole tables of a scale folder, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, brown, decontaminate, jaccard, langid, oracle, pii, quality, records, repeats, warc
from .common import materialize, shared_dir

#: Folder of the public tokenizers; a parameter, never copied.
def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_codecs: dict[str, bpe.Codec] = {}


def codec(path: str | None = None) -> bpe.Codec:
    path = path or tokenizer_path("byte_bpe_50k.json")
    if path not in _codecs:
        _codecs[path] = bpe.Codec.load(path)
    return _codecs[path]


def op1_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return bpe.round_trip(table(spark, sf_dir, "documents"), codec().with_memo(250_000), "doc_id", "text", schema, bpe.digests)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hits = decontaminate.n_hit()
    items = F.sha2(F.array_join("item_ids", ","), 256)
    return found.select("doc_id", "n_words", hits.alias("n_hit"), F.size("item_ids").cast("bigint").alias("n_items"), items.alias("items_sha256"), (hits > 0).alias("contaminated"))


def op3_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), pii.SAMPLE_KEY, kinds="kinds")
    return found.select("doc_id", "text", F.size("kinds").cast("bigint").alias("n_values"), F.array_join("kinds", ",").alias("kinds"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


def fold(buckets: int):
    """The document's fold: crc32 of its id as text, modulo ``buckets``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % buckets


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = langid.train(documents.where(fold(4) != 2), order=F.xxhash64("doc_id"))
    found = langid.predict(documents, model)
    return found.select("doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op6_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    captures = materialize(warc.read(spark, path), "warc-runs")
    return warc.merged(captures).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = brown.score(table(spark, sf_dir, "documents"), F.coalesce(fold(10) != 0, F.lit(True)))
    return found.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op9_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "records")
    records.write(table(spark, sf_dir, "documents"), records.WordEncoder(tokenizer_path("word_bpe_49k.json")), path)
    found = records.index(spark, path)
    return found.select(F.col("key").alias("doc_id"), "start", F.col("n_ids").alias("n_tokens"), "ids_crc32", "file", "offset", "length")


def op10_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (op1_bpe_encode_decode, op2_decontaminate, op3_pii_pseudonyms, op4_quality_rules, op5_language_id, op6_warc_index, op7_brown_lm, op8_ngram_jaccard_join, op9_token_records, op10_repeated_strings)}
ORACLE: dict[str, str] = dict(oracle.SQL)
