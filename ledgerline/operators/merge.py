"""Upserts on tables with one row per key: join old and new, write a new version.

Both sides have unique keys, so each merge is one shuffle per side without skew. The
result is written next to the old version and never over the path being read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def replace_rows(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Whole-row replace or insert by key."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def keep_rows(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Insert the missing keys, keep existing rows on conflict."""
    return old.unionByName(new.join(old.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def _outer(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    left = old.select(key, F.struct(*[c for c in old.columns if c != key]).alias("old"))
    right = new.select(key, F.struct(*[c for c in new.columns if c != key]).alias("new"))
    return left.join(right, key, "full")


def set_columns(old: DataFrame, new: DataFrame, key: str = "num") -> DataFrame:
    """Set the columns present in ``new`` on its keys; other columns and other rows stay."""
    both = _outer(old, new, key)
    out: list[Column] = []
    names = [c for c in old.columns if c != key] + [c for c in new.columns if c not in old.columns]
    for c in names:
        if c not in new.columns:
            out.append(F.col(f"old.{c}").alias(c))
        elif c not in old.columns:
            out.append(F.col(f"new.{c}").alias(c))
        else:
            out.append(F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c))
    return both.select(key, *out)


def upsert_targets(old: DataFrame, new: DataFrame, on_insert: dict[str, Column], key: str = "num") -> DataFrame:
    """Set the columns of ``new``; the ``on_insert`` columns get their value only for new keys."""
    fresh = new.join(old.select(key), key, "left_anti").select(key, *[v.alias(k) for k, v in on_insert.items()])
    return set_columns(set_columns(old, new, key), fresh, key)


def stale(updated: Column, run: Column, status: Column) -> Column:
    """Row not seen in this run and not done; a missing time keeps the row, a missing status does not."""
    return F.coalesce((updated < run) & ~status.eqNullSafe(F.lit("done")), F.lit(False))


def purge(state: DataFrame, run: Column) -> DataFrame:
    return state.where(~stale(F.col("updated_run"), run, F.col("status")))


def apply_outcomes(targets: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Move processed targets to ``done`` (with counts) or ``error`` (with a message)."""
    failed = F.col("message").isNotNull()
    done = outcomes.where(~failed).select(
        "num", F.lit("done").alias("status"), "scraped_at", F.coalesce("filings", F.lit(0)).alias("filings_count"), "result"
    )
    error = outcomes.where(failed).select(
        "num", F.lit("error").alias("status"), "scraped_at", F.col("message").alias("error")
    )
    known = targets.select("num")
    for change in (done, error):
        targets = set_columns(targets, change.join(known, "num", "left_semi"))
    return targets


def mark(checkpoints: DataFrame, outcomes: DataFrame, source: str) -> DataFrame:
    """Set one source's status (and info) on the checkpoint table."""
    new = outcomes.select("num", F.col("status").alias(source), F.col("info").alias(f"info_{source}"))
    return set_columns(checkpoints, new)


def not_done(keys: DataFrame, checkpoints: DataFrame, source: str, force: bool = False) -> DataFrame:
    """Keys still to process: all with ``force``, else those whose source is not ``done``."""
    if force:
        return keys
    finished = checkpoints.where(F.col(source) == "done").select("num")
    return keys.join(finished, "num", "left_anti")


def copy_missing(tables: dict[str, DataFrame], root: str) -> list[str]:
    """Write the tables that are not yet under ``root``; returns their names. Existing ones are not touched."""
    copied = []
    for name, df in tables.items():
        try:
            df.write.mode("errorifexists").parquet(f"{root}/{name}")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_ALREADY_EXISTS":
                raise
        else:
            copied.append(name)
    return copied
