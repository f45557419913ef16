"""Exact dedup: a two-pass Bloom filter finds possibly repeated hashes; only those rows shuffle."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import narrow
from ledgerline.session import stored

BITS_PER_ROW = 16
#: Upper bound of the filter (32 MiB), hence of what is collected and broadcast. Past 16 million rows a larger share
#: of the rows looks repeated and is shuffled; the result is the same.
MAX_FILTER_BITS = 1 << 28
BLOCK_BITS = 1 << 15


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, sha)`` of every row; sha is the SHA-256 of the text after lower-casing A-Z, null text being empty."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(1), b"")
            sha = [hashlib.sha256(t.as_py().lower()).digest() for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sha, pa.binary())], names=["doc_id", "sha"])

    rows = narrow(docs, doc_id=id_col, text=text_col).withColumn("text", F.col("text").cast("binary"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(digest, f"doc_id {kind}, sha binary")


def _positions(batch: pa.RecordBatch, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two filter positions of each row from the first 16 bytes of its digest."""
    shas = np.frombuffer(b"".join(x[:16] for x in batch.column("sha").to_pylist()), np.uint64).reshape(-1, 2)
    mask = np.uint64(bits - 1)
    return (shas[:, 0] & mask).astype(np.int64), (shas[:, 1] & mask).astype(np.int64)


def _set_bits(packed: np.ndarray, positions: np.ndarray) -> None:
    """Set the bits at sorted distinct positions."""
    if len(positions):
        at, start = np.unique(positions >> 3, return_index=True)
        packed[at] |= np.bitwise_or.reduceat((1 << (positions & 7)).astype(np.uint8), start)


def _has(packed: np.ndarray, positions: np.ndarray) -> np.ndarray:
    return (packed[positions >> 3] >> (positions & 7).astype(np.uint8)) & 1 == 1


def repeated_filter(rows: DataFrame, bits: int) -> np.ndarray:
    """First pass: packed bits of the filter positions that were hit more than once over all rows.

    Each task keeps two bit arrays (hit, hit again) and hands on their non-empty blocks; blocks are merged by number.
    """

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, again = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            if not batch.num_rows:
                continue
            pos, count = np.unique(np.concatenate(_positions(batch, bits)), return_counts=True)
            _set_bits(again, pos[(count > 1) | _has(once, pos)])
            _set_bits(once, pos)
        size = BLOCK_BITS // 8
        for chunk in np.array_split(np.flatnonzero(once.reshape(-1, size).any(axis=1)), 1 + bits // BLOCK_BITS // 256):
            packs = [[zlib.compress(a[b * size:(b + 1) * size].tobytes(), 1) for b in chunk] for a in (once, again)]
            yield pa.RecordBatch.from_arrays([pa.array(chunk, pa.int32()), *[pa.array(p, pa.binary()) for p in packs]], names=["block", "once", "again"])

    def merge(blocks: pa.Table) -> pa.Table:
        once, again = np.zeros(BLOCK_BITS // 8, np.uint8), np.zeros(BLOCK_BITS // 8, np.uint8)
        for a, b in zip(blocks["once"], blocks["again"], strict=True):
            hit = np.frombuffer(zlib.decompress(a.as_py()), np.uint8)
            again |= np.frombuffer(zlib.decompress(b.as_py()), np.uint8) | (once & hit)
            once |= hit
        return pa.table({"block": blocks["block"][:1], "again": pa.array([zlib.compress(again.tobytes(), 1)] if again.any() else [None], pa.binary())})

    found = rows.select("sha").mapInArrow(hits, "block int, once binary, again binary").groupBy("block").applyInArrow(merge, "block int, again binary")
    packed = np.zeros(bits // 8, np.uint8).reshape(-1, BLOCK_BITS // 8)
    for r in found.where(F.col("again").isNotNull()).collect():  # at most MAX_FILTER_BITS, whatever the number of rows
        packed[r["block"]] = np.frombuffer(zlib.decompress(bytes(r["again"])), np.uint8)
    return packed.reshape(-1)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal texts the row with the largest
    id stays. Rows that repeat an id with the same text share its fate; a row without an id stays only where no row of
    its group has one. An empty table gives an empty result; other columns of ``docs`` are ignored.
    """
    rows = stored(digests(docs, id_col, text_col), "digests")
    n = rows.count()
    bits = min(max_bits, max(BLOCK_BITS, 1 << (BITS_PER_ROW * n).bit_length()))
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(repeated_filter(rows, bits))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = shared.value
        for batch in batches:
            if batch.num_rows:
                p, q = _positions(batch, bits)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_has(packed, p) & _has(packed, q))], names=["doc_id", "sha", "maybe"])

    marked = stored(rows.mapInArrow(probe, f"doc_id {kind}, sha binary, maybe boolean"), "marked")
    maybe = marked.where("maybe").select("doc_id", "sha")
    groups = stored(maybe.groupBy("sha").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "groups")
    # A group of this size holds a ten-thousandth of all rows, so there are at most 10,000 of them: safe to broadcast.
    large = max(1000, n // 10_000)
    hot, rest = groups.where(F.col("group_size") > large), groups.where(F.col("group_size") <= large)
    joined = maybe.join(F.broadcast(hot), "sha").unionByName(
        maybe.join(F.broadcast(hot.select("sha")), "sha", "left_anti").join(rest, "sha"))
    alone = marked.where("NOT maybe").select("sha", "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    return alone.unionByName(joined).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def keep_distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged; rows without an id are left out of it only as copies."""
    kept = exact_dedup(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias("stays")).distinct()
    rows = docs.select(docs[id_col].alias("id"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    return rows.join(kept, rows["id"].eqNullSafe(kept["stays"]), "left_semi").select("row.*")
