"""Archived API payloads (JSON text) to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEPOSIT_PAGE = (
    "struct<content: array<struct<id: bigint, enterpriseNumber: string, reference: string, periodEndDateYear: int, depositDate: string, "
    "language: string, modelCode: string, migration: boolean>>, totalElements: int, totalPages: int>"
)
STATUTE_PAGE = (
    "struct<statutes: array<struct<documentId: bigint, deedDate: string, documentStatus: string, documentTitle: string>>, totalItems: bigint>"
)


def deposit_rows(payloads: DataFrame) -> DataFrame:
    """Deposits of paged payloads ``(body)``."""
    page = payloads.select(F.from_json("body", DEPOSIT_PAGE).alias("p"))
    return page.select(F.explode("p.content").alias("d"), "p.totalElements", "p.totalPages").select("d.*", "totalElements", "totalPages")


def statute_rows(payloads: DataFrame) -> DataFrame:
    """Statutes of offset-paged payloads ``(num, body)``; empty pages give no rows."""
    page = payloads.select("num", F.from_json("body", STATUTE_PAGE).alias("p"))
    return page.select("num", F.explode("p.statutes").alias("s"), "p.totalItems").select("num", "s.*", "totalItems")


def completeness(rows: DataFrame) -> DataFrame:
    """Per enterprise: rows received against the announced total."""
    counted = rows.groupBy("num").agg(F.count("*").alias("received"), F.max("totalItems").alias("announced"))
    return counted.withColumn("complete", F.col("received") >= F.col("announced"))
