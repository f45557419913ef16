"""Incremental processing: keyed state held by the stream itself, batch summaries, changes carried on to yearly metrics and gold."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.merge import set_columns
from ledgerline.operators.picks import last_per_key
from ledgerline.plans.finance import filing_amounts, filing_year, gold, one_filing_per_year, usable_lines, with_growth, with_metrics
from ledgerline.streaming.tail import delivered


def keep_latest(stream: DataFrame, keys: list[str], order: list[str], changes: str, checkpoint: str) -> int:
    """Keep the last row of each key by ``order`` over all batches; returns the last batch number, -1 when nothing was new.

    The state is that of the streaming aggregate: kept per key partition, as changes and snapshots, by Spark's state store
    under the checkpoint. Each batch writes the rows of the keys it changed to its own folder under ``changes``; nothing that
    earlier batches wrote is read or written again. A batch repeated after a crash starts from the state before it and writes
    the same folder. Ties of the whole order may fall either way, so it should tell a key's rows apart.
    """
    seen = {"batch": -1}
    rest = [c for c in stream.columns if c not in keys]
    latest = stream.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("row"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select(*keys, "row.*").write.mode("overwrite").parquet(f"{changes}/batch={batch_id}")
        seen["batch"] = batch_id

    query = latest.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return seen["batch"]


def latest_rows(spark: SparkSession, changes: str, schema, keys: list[str]) -> DataFrame:
    """The state after all batches: each key's row of the last batch that changed it."""
    every = delivered(spark, changes, schema)
    if "batch" not in every.columns:
        return every
    return last_per_key(every, keys, "batch").drop("batch")


def compact(spark: SparkSession, changes: str, schema, keys: list[str], target: str) -> str:
    """Write the state to ``target`` as one batch, to go on from with later changes; the old folders can then be dropped."""
    latest_rows(spark, changes, schema, keys).write.mode("overwrite").parquet(f"{target}/batch=-1")
    return target


def batch_summaries(stream: DataFrame, target: str, checkpoint: str, outcome: str) -> None:
    """Append one summary row per outcome and micro-batch."""

    def summarise(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy(outcome).agg(F.count("*").alias("rows")).withColumn("batch", F.lit(batch_id))
        counts.write.mode("overwrite").parquet(f"{target}/run={batch_id}")

    stream.writeStream.foreachBatch(summarise).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


class Books(NamedTuple):
    """What is kept between refreshes: code amounts and year of every filing; metrics of every enterprise and year."""

    filings: DataFrame
    yearly: DataFrame


def open_books(lines: DataFrame) -> Books:
    """Books from all lines."""
    filings = filing_year(filing_amounts(usable_lines(lines)))
    return Books(filings, with_growth(with_metrics(one_filing_per_year(filings))))


def carry_on(books: Books, lines: DataFrame, changed: DataFrame, keep: Callable[[DataFrame, str], DataFrame] = lambda df, _: df) -> tuple[Books, DataFrame]:
    """Books after a change of lines, and the enterprises whose years changed.

    ``lines`` are all lines as they are now, ``changed`` those that are new, altered or gone (only enterprise and reference
    are read). Filings with a changed line are added up again; the fiscal years they were in or are in now choose their filing
    again; growth follows in the years from the first changed one on. Nothing else is computed: other rows are taken over.
    ``keep`` may store what is used more than once.
    """
    touched = keep(changed.where("num IS NOT NULL AND reference IS NOT NULL").select("num", "reference").distinct(), "touched")
    again = keep(filing_year(filing_amounts(usable_lines(lines.join(touched, ["num", "reference"], "left_semi")))), "filings_again")
    before = books.filings.join(touched, ["num", "reference"], "left_semi")
    years = keep(again.select("num", "year").unionByName(before.select("num", "year")).distinct(), "years_changed")
    filings = keep(books.filings.join(touched, ["num", "reference"], "left_anti").unionByName(again), "filings")
    chosen = with_metrics(one_filing_per_year(filings.join(years, ["num", "year"], "left_semi")))
    plain = books.yearly.drop("croissance_ca")
    since = years.groupBy("num").agg(F.min("year").alias("since"))
    # An enterprise's years are few: those before the first change give the revenue to compare with, those from it on are new.
    own = plain.join(since, "num").join(years, ["num", "year"], "left_anti").unionByName(chosen.join(since, "num"))
    grown = with_growth(own).where(F.col("year") >= F.col("since")).drop("since")
    kept = books.yearly.join(since, "num", "left").where(F.col("since").isNull() | (F.col("year") < F.col("since"))).drop("since")
    return Books(filings, kept.unionByName(grown)), since.select("num")


def refresh_gold(old: DataFrame, books: Books, changed: DataFrame, targets: DataFrame) -> DataFrame:
    """Gold with the rows of the changed enterprises, and of the targets that are not done yet, made again."""
    todo = targets.where(~F.col("status").eqNullSafe("done")).select("num").unionByName(changed.select("num")).distinct()
    of = targets.join(todo, "num", "left_semi")
    return set_columns(old, gold(books.yearly.join(of.select("num"), "num", "left_semi"), of))
