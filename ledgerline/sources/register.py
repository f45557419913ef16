"""Register dumps: all-string CSV tables with provenance, loaded to Parquet."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.constants import META_FILE, REGISTER_FILES
from ledgerline.sources.landing import bucket_number, land, source_bytes

#: Columns that may hold the enterprise number of a dump, in this order.
ENTITY_KEYS = ("EntityNumber", "EnterpriseNumber", "num")


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header, quote ``"``, doubled quotes, one record per line, every column a string; a BOM is dropped."""
    return (
        spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", False)
        .option("mode", "PERMISSIVE").option("inferSchema", False).csv(path)
    )


def write_raw_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def line_position() -> Column:
    """Position of a scanned row in its source: file, block, row. Orders rows as the file does."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_snapshot_date(spark: SparkSession, folder: str) -> str | None:
    """``SnapshotDate`` of the key/value file (last one wins); None when the file is unreadable."""
    try:
        meta = read_raw_csv(spark, f"{folder}/{META_FILE}").withColumn("at", F.monotonically_increasing_id())
        row = meta.where(F.col("Variable") == "SnapshotDate").agg(F.max_by("Value", "at").alias("v")).first()
        return row["v"]
    except (AnalysisException, PySparkException):
        return None


def with_provenance(df: DataFrame, file: str, snapshot: str | None) -> DataFrame:
    return df.withColumns({
        "_ingested_at": F.current_timestamp(), "_source_file": F.lit(file),
        "_snapshot_date": F.lit(snapshot).cast("string"),
    })


def load_table(spark: SparkSession, source: str, file: str, target: str, snapshot: str | None, keys: Sequence[str] = ENTITY_KEYS) -> int:
    """Load one file; the row count is observed while writing, without a second scan.

    A table with an enterprise key (the first of ``keys`` that it has) is landed in buckets of that key, sorted, so that the
    register's tables join where they lie; others are written as they come.
    """
    seen = Observation(file)
    df = with_provenance(read_raw_csv(spark, f"{source}/{file}"), file, snapshot)
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    key = next((k for k in keys if k in df.columns), None)
    if key is None:
        counted.write.mode("overwrite").parquet(target)
    else:
        land(counted, re.sub(r"\W", "_", file), key, bucket_number(source_bytes(spark, f"{source}/{file}")), path=target)
    return seen.get["rows"]


def load_bronze(spark: SparkSession, source: str, target: str, files: dict[str, str] | None = None) -> dict[str, int]:
    """Load every register file to ``<target>/kbo_<name>`` and return the row counts; a second load replaces the first."""
    snapshot = read_snapshot_date(spark, source)
    counts = {f"kbo_{n}": load_table(spark, source, f, f"{target}/kbo_{n}", snapshot) for n, f in (files or REGISTER_FILES).items()}
    counts["kbo_meta"] = load_table(spark, source, META_FILE, f"{target}/kbo_meta", snapshot)
    return counts
