"""Pages and bounded lists."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_PAGE = 200
MAX_RANGES = 16_384


def page(df: DataFrame, order: str = "num", skip: int = 0, limit: int = 50) -> DataFrame:
    """One page by key; only the page's rows are sorted out and kept. A larger page than ``MAX_PAGE`` is refused."""
    if not 0 <= limit <= MAX_PAGE:
        raise ValueError(f"a page has at most {MAX_PAGE} rows, not {limit}")
    return df.orderBy(order).offset(skip).limit(limit)


class Ordered(NamedTuple):
    """A table in key ranges, one file each, and the order statistics of the ranges: ``(lo, hi, rows)``, one row for each."""

    rows: DataFrame
    ranges: DataFrame
    key: str


def in_order(df: DataFrame, key: str, path: str, ranges: int) -> Ordered:
    """Write ``df`` in about ``ranges`` ranges of its key, sorted; equal keys share a range. Rows without a key have no place and go.

    The ranges are few (their number is the caller's, not the data's), so their statistics may be held by the driver.
    """
    if ranges > MAX_RANGES:
        raise ValueError(f"at most {MAX_RANGES} ranges, not {ranges}")
    df.where(F.col(key).isNotNull()).repartitionByRange(ranges, key).sortWithinPartitions(key).write.mode("overwrite").parquet(f"{path}/rows")
    rows = df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")
    stats = rows.groupBy(F.input_file_name().alias("file")).agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count("*").alias("rows"))
    stats.select("lo", "hi", "rows").write.mode("overwrite").parquet(f"{path}/ranges")
    return Ordered(rows, df.sparkSession.read.schema(stats.drop("file").schema).parquet(f"{path}/ranges"), key)


def seek(table: Ordered, skip: int = 0, limit: int = 50) -> DataFrame:
    """The page of ``limit`` rows after ``skip`` rows in key order: only the ranges it lies in are read and sorted.

    Rows of equal keys may come in any order, so pages of a table with repeated keys need not meet exactly.
    """
    if not 0 <= limit <= MAX_PAGE:
        raise ValueError(f"a page has at most {MAX_PAGE} rows, not {limit}")
    before, first, last, jumped = 0, None, None, 0
    for r in table.ranges.orderBy("lo").collect():  # at most MAX_RANGES rows
        if first is None and before + r["rows"] > skip:
            first, jumped = r, before
        if first is not None and before < skip + limit:
            last = r
        before += r["rows"]
    if first is None or last is None:
        return table.rows.limit(0)
    key = F.col(table.key)
    return table.rows.where((key >= F.lit(first["lo"])) & (key <= F.lit(last["hi"]))).orderBy(key).offset(skip - jumped).limit(limit)


def with_total(rows: DataFrame, all_rows: DataFrame) -> DataFrame:
    """Adds the number of rows the page was cut from."""
    return rows.withColumn("total", all_rows.agg(F.count("*")).scalar())


def newest_first_then_oldest(df: DataFrame, at: str, key: str, limit: int = 20) -> DataFrame:
    """The newest rows, shown oldest first."""
    return df.orderBy(F.desc(at), F.desc(key)).limit(limit).orderBy(at, key)


def by_source_and_year(df: DataFrame) -> DataFrame:
    """Ordered by source and year; the path comes last, so that a common pair does not fall to one task."""
    return df.orderBy(F.coalesce("source", F.lit("")), F.coalesce("year", F.lit("")), "path")
