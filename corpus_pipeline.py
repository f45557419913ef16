"""Training-corpus pipeline: quality rules, line dedup, near-dedup, source mix, tokens. Each stage is written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, line_dedup, mixing, quality, simhash
from ledgerline.llm.common import WHITE
from ledgerline.llm.queries import RANK_FILE
from ledgerline.session import stored


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their failing lines; ``n_chars`` follows the text. Nothing is shuffled."""
    return quality.keep_good(docs)


def without_frequent_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the frequent lines dropped; ``n_chars`` follows the text. A document that loses all lines goes.

    The other columns are carried as one struct, so they may have any names.
    """
    rows = docs.select("doc_id", "text", F.struct(*[docs[c] for c in docs.columns if c not in ("doc_id", "text")]).alias("row"))
    out = line_dedup.line_dedup(rows)
    left = out.where((F.col("n_dropped") == 0) | (F.length(F.btrim("kept_text", F.lit(WHITE))) > 0))
    changed = F.col("n_dropped") > 0
    new = {"doc_id": F.col("doc_id"), "text": F.when(changed, F.col("kept_text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row")["n_chars"])
    return left.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exactly one row of each group of near copies: the one with the smallest id, ids before nulls.

    Rows have a number of their own, written once, so repeated and missing ids are told apart. Of rows with the same id the
    one with the smallest hash of its columns stays; only rows equal in all columns are left to the number.
    """
    others = [docs[c] for c in docs.columns if c not in ("doc_id", "text")]
    content = F.xxhash64("text", *[F.to_json(F.struct(*others))] if others else [])
    rank = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"), content.alias("content"), F.monotonically_increasing_id().alias("number"))
    rows = stored(docs.select(rank.alias("rank"), F.struct(*[docs[c] for c in docs.columns]).alias("row")), "rows")
    groups = simhash.simhash_groups(rows.select("rank", F.col("row.text").alias("text")), id_col="rank")
    kept = groups.where("doc_id.number = component_id.number").select(F.col("doc_id.number").alias("number"))
    return rows.join(kept, rows["rank.number"] == kept["number"], "left_semi").select("row.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it, none included. The other columns are one struct, so they may have any names."""
    plan = mixing.mix(docs).where("copies > 0").select(F.col("doc_id").alias("id"), F.col("source").alias("of"), "copies").distinct()
    own = {"doc_id", "source"}
    others = [docs[c] for c in docs.columns if c not in own]
    rows = docs.select("doc_id", "source", F.struct(*others).alias("row"))
    out = rows.join(plan.hint("shuffle_hash"), rows.doc_id.eqNullSafe(plan.id) & rows.source.eqNullSafe(plan.of))
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    return out.select(*[(F.col(c) if c in own else F.col("row").getField(c)).alias(c) for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row."""
    import public_tokenizers

    return bpe.round_trip(docs, bpe.load_ranks(public_tokenizers.path(RANK_FILE)), public_tokenizers.PATTERN)


STAGES = [("quality", good_quality), ("line_dedup", without_frequent_lines), ("near_dedup", one_of_near_copies), ("mix", mixed), ("tokens", tokens)]

#: SimHash fingerprints and byte-pair merges are not SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
