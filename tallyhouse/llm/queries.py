"""One query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_context_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.common import remainder
    from tallyhouse.llm.context_model import score_texts
    scored = score_texts(_table(spark, sf_dir, "documents"), train=remainder("doc_id", 7) != 2)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score", "bits_per_byte")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.decontaminate import contamination
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.substring_dedup import remove_repeats
    return remove_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.common import remainder
    from tallyhouse.llm.quality_model import score_quality
    scored = score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"),
                           learn=remainder("doc_id", 5) != 0)
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tallyhouse.llm.packing import pack_documents
    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.html_text import extract_text
    return extract_text(_table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.pii import KINDS, count_of, find_personal_data, spans_text
    found = find_personal_data(_table(spark, sf_dir, "documents"))
    counts = [count_of("base", k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
                        spans_text(F.col("spans")).alias("spans"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.quality_rules import clean_lines
    return clean_lines(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.secrets import scan_secrets
    spans = F.array_join(F.transform("secrets", lambda s: F.concat_ws(
        ":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return scan_secrets(_table(spark, sf_dir, "documents")).select(
        "doc_id", F.size("found").cast("long").alias("n_candidates"),
        F.size("secrets").cast("long").alias("n_secrets"), spans.alias("spans"),
        F.sha2("redacted_text", 256).alias("redacted_sha256"))


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.near_dup import near_duplicates
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle=2).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.whitening import whiten
    done = whiten(_table(spark, sf_dir, "embeddings"), components=32)
    one = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")
    return done.select("vec_id", "n", "deviation", "identity_error", one).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"),
        F.col("c.explained").alias("explained"), "identity_error")


def op12_byte_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tallyhouse.llm.byte_pair import decode_documents, encode_documents
    path = public_tokenizers.path("byte_bpe_50k.json")
    done = decode_documents(encode_documents(_table(spark, sf_dir, "documents"), path), path)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("text", 256).alias("decoded_sha256"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.ranked_search import rank_documents
    return rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10).select(
        F.col("query_id").alias("item_id"), F.col("rank").cast("int").alias("rank"), "doc_id", "score")


QUERIES = {f.__name__: f for f in (
    op1_context_model, op2_decontamination, op3_substring_dedup, op4_quality_model, op5_packing, op6_html_text,
    op7_personal_data, op8_quality_rules, op9_secret_scan, op10_near_dup, op11_whitening, op12_byte_pair,
    op13_ranked_search)}
