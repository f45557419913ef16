"""Registered queries of the text operators, with their checking SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, collocations, exact_dedup, language, line_dedup, mixing, packing, quality, secrets, simhash, spelling, substring_dedup, url_filter
from ledgerline.llm.sql import ORACLES  # noqa: F401

#: Host, path, allow.
URL_RULES = [("org", "/", True), ("example.org", "/es/", False), ("example.org", "/en/1", False), ("com", "/fr/", True), ("com", "/de/", False)]
RANK_FILE = "byte_bpe_50k.tiktoken"
WORD_FILE = "word_bpe_49k.json"


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf, "documents"))


def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    out = quality.quality(_table(spark, sf, "documents"))
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_words", "n_bad_lines")
    return out.select("doc_id", *measures, F.sha2("clean_text", 256).alias("clean_sha256"))


def op3_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    out = line_dedup.line_dedup(_table(spark, sf, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(_table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_simhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    out = simhash.simhash_groups(_table(spark, sf, "documents"))
    return out.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op6_bpe_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.load_ranks(public_tokenizers.path(RANK_FILE))
    return bpe.round_trip(_table(spark, sf, "documents"), ranks, public_tokenizers.PATTERN)


def op7_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    out = substring_dedup.substring_dedup(_table(spark, sf, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.url_verdicts(_table(spark, sf, "pages"), URL_RULES)


def op9_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    out = secrets.secret_scan(_table(spark, sf, "documents"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op10_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    out = language.identify(docs, language.fit_sample(docs))
    return out.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf, "documents"))


def op12_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf, "documents"))


def op13_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path(WORD_FILE), encoding="utf-8") as file:
        spec = file.read()
    return packing.pack_documents(_table(spark, sf, "documents"), spec)


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_quality_rules, op3_line_dedup, op4_source_mix, op5_simhash_dedup, op6_bpe_round_trip, op7_substring_dedup, op8_url_filter,
    op9_secret_scan, op10_language_id, op11_spelling_variants, op12_collocations, op13_best_fit_packing)}
