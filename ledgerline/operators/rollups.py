"""Counts, breakdowns and run summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.constants import SECTOR_LABELS, TARGET_STATUSES
from ledgerline.operators.scale import checked_broadcast
from ledgerline.session import stored


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def check_not_empty(counts: DataFrame) -> dict[str, int]:
    """Counts as a dictionary (one entry per table); raises when a table is empty."""
    found = {r["name"]: r["rows"] for r in counts.collect()}
    empty = [n for n, rows in found.items() if rows == 0]
    if empty:
        raise AssertionError(f"empty tables: {empty}")
    return found


def one_row(counts: DataFrame, names: list[str]) -> DataFrame:
    """Named counts as the columns of one row."""
    return counts.agg(*[F.max(F.when(F.col("name") == n, F.col("rows"))).alias(n) for n in names])


def status_breakdown(targets: DataFrame) -> DataFrame:
    """Totals per status and the share finished (done or error), 0 when there are none."""
    status = F.col("status")
    finished = F.count_if(status.isin("done", "error"))
    return targets.agg(
        F.count("*").alias("total"), *[F.count_if(status == s).alias(s) for s in TARGET_STATUSES],
        F.round(F.coalesce(F.try_divide(finished * 100, F.count("*")), F.lit(0.0)), 1).alias("pct"),
    )


def zero_filled(labels: DataFrame, counts: DataFrame, key: str, value: str) -> DataFrame:
    """Every label once, with 0 where nothing was counted."""
    return labels.join(counts, key, "left").withColumn(value, F.coalesce(value, F.lit(0)))


def sector_breakdown(spark, codes_of: DataFrame) -> DataFrame:
    """Enterprises per sector code, each counted once per code; absent codes give 0."""
    labels = spark.createDataFrame(list(SECTOR_LABELS.items()), "nace_code string, label string")
    counts = codes_of.select("num", "nace_code").distinct().groupBy("nace_code").agg(F.count("*").alias("enterprises"))
    return zero_filled(labels, counts, "nace_code", "enterprises")


def status_tally(spark, targets: DataFrame) -> DataFrame:
    labels = spark.createDataFrame([(s,) for s in TARGET_STATUSES], "status string")
    return zero_filled(labels, targets.groupBy("status").agg(F.count("*").alias("targets")), "status", "targets")


def changed_rows(old: Column, new: Column) -> Column:
    """Number of rows a clean-up changes."""
    return F.count_if(~old.eqNullSafe(new))


def numbered(df: DataFrame, key: str) -> DataFrame:
    """Rows with a 1-based rank by a unique key in its own order, without one task seeing all rows.

    The rows are dealt by key range to the session's shuffle partitions and written once with their range; a rank is the
    rank inside the range plus the number of rows in the ranges before it.
    """
    value = F.col(key)
    marked = stored(df.repartitionByRange(value).withColumn("bucket", F.spark_partition_id()), "ranges")
    sizes = marked.groupBy("bucket").count()
    before = F.sum("count").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("bucket", F.coalesce(before, F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(value))
    return (
        marked.withColumn("place", place).join(checked_broadcast(offsets), "bucket")
        .withColumn("rank", F.col("place") + F.col("before")).drop("bucket", "place", "before")
    )


def run_summary(outcomes: DataFrame, batch: int) -> DataFrame:
    """Seen, processed, skipped and failed keys per batch of ``batch`` keys in key order."""
    ranked = numbered(outcomes, "num")
    lot = F.floor((F.col("rank") - 1) / F.lit(batch)) + 1
    return ranked.groupBy(lot.cast("long").alias("lot")).agg(
        F.count("*").alias("seen"), *[F.count_if(F.col("outcome") == o).alias(o) for o in ("processed", "skipped", "errors")]
    )


def sum_of_squares(rows: DataFrame, column: str) -> DataFrame:
    """``(n, total)`` of a whole-number column. The sum is exact: a BIGINT as long as one holds it, else a decimal of 38 digits."""
    value = F.col(column).cast("decimal(19,0)")
    sums = rows.agg(F.count("*").alias("n"), F.sum(value * value).alias("total"))
    n, total = sums.first()
    small = total is None or total < 1 << 63
    one = rows.sparkSession.createDataFrame([(n, total)], "n long, total decimal(38,0)")
    return one.withColumn("total", F.col("total").cast("long")) if small else one
