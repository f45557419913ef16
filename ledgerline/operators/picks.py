"""One row per key, chosen by an order: aggregates that combine map-side, no per-key sort.

``max_by`` / ``min_by`` keep one candidate per key in every task before the shuffle, so
a key holding a third of all rows costs one row per task and no window is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: list[str], order: Column, chooser) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(chooser(F.struct(*rest), order).alias("picked"))
    return picked.select(*keys, "picked.*")


def first_per_key(df: DataFrame, keys: list[str], *order: str | Column) -> DataFrame:
    """Row with the smallest order per key; a NULL in the order sorts first."""
    return _pick(df, keys, F.struct(*order), F.min_by)


def last_per_key(df: DataFrame, keys: list[str], *order: str | Column) -> DataFrame:
    """Row with the largest order per key."""
    return _pick(df, keys, F.struct(*order), F.max_by)


def dedup_activities(activities: DataFrame, code: str = "nace_code", kind: str = "classification") -> DataFrame:
    """First activity per (enterprise, code, classification), NULL counted as empty."""
    keyed = activities.withColumns(
        {"code_key": F.coalesce(F.col(code), F.lit("")), "kind_key": F.coalesce(F.col(kind), F.lit(""))}
    )
    return first_per_key(keyed, ["num", "code_key", "kind_key"], "pos").drop("code_key", "kind_key")


def dedup_array(items: Column, code: str, kind: str) -> Column:
    """The same rule inside one nested array of moderate length, order kept; NULL gives an empty array."""

    def key(a: Column) -> Column:
        return F.concat_ws("|", F.coalesce(a[code], F.lit("")), F.coalesce(a[kind], F.lit("")))

    keys = F.transform(items, key)
    first = F.filter(items, lambda a, i: F.array_position(keys, key(a)) == i + 1)
    return F.coalesce(first, F.array())


def official_names(denominations: DataFrame) -> DataFrame:
    """Name of type 001 with the smallest language; ties by input order."""
    named = denominations.where(F.col("type_code") == "001")
    return named.groupBy("num").agg(F.min_by("valeur", F.struct("language", "pos")).alias("nom_officiel"))


def names_in_language(denominations: DataFrame, lang: str = "FR") -> DataFrame:
    """Name of type 001 in the asked language, else the official one; one row per enterprise."""
    wanted = (F.col("type_code") == "001") & (F.col("language") == ("1" if lang == "FR" else "2"))
    official = F.col("type_code") == "001"
    picked = denominations.groupBy("num").agg(
        F.min_by(F.struct("valeur"), F.when(wanted, F.struct("pos"))).alias("asked"),
        F.min_by("valeur", F.when(official, F.struct("language", "pos"))).alias("nom_officiel"),
    )
    name = F.when(F.col("asked").isNotNull(), F.col("asked.valeur")).otherwise(F.col("nom_officiel"))
    return picked.select("num", name.alias("nom"), "nom_officiel")


def display_names(denominations: DataFrame) -> DataFrame:
    """First non-empty name of type 001, else the first non-empty name of any type."""
    filled = denominations.where(F.coalesce(F.col("valeur"), F.lit("")) != "")
    official = F.col("type_code") == "001"
    return filled.groupBy("num").agg(
        F.min_by("valeur", F.struct((~official).alias("later"), "pos")).alias("denomination")
    )


def seat_addresses(addresses: DataFrame) -> DataFrame:
    """Registered address, else the first one."""
    return first_per_key(addresses, ["num"], (F.col("type_of_address") != "REGO").alias("later"), "pos")


def deposits_by_year(deposits: DataFrame) -> DataFrame:
    """One deposit per fiscal year without the consolidated models.

    A French filing beats the others; among several the last French one, or else the
    first one of the input order, is kept.
    """
    single = deposits.where(~F.coalesce(F.col("model_code"), F.lit("")).startswith("mc"))
    french = F.upper(F.coalesce(F.col("language"), F.lit(""))) == "FR"
    per_year = single.groupBy("num", "period_year").agg(
        F.max_by(F.struct("id", "reference", "language", "migration"), F.when(french, F.col("pos"))).alias("last_french"),
        F.min_by(F.struct("id", "reference", "language", "migration"), "pos").alias("first_any"),
    )
    return per_year.select("num", "period_year", F.coalesce("last_french", "first_any").alias("d")).select(
        "num", "period_year", "d.*"
    )


def latest_usable_deposit(deposits: DataFrame) -> DataFrame:
    """Most recent not migrated filing of the per-year list; no row when there is none."""
    usable = deposits_by_year(deposits).where(~F.coalesce(F.col("migration"), F.lit(False)))
    return last_per_key(usable, ["num"], "period_year")


def dedup_publications(links: DataFrame) -> DataFrame:
    """Publications per enterprise: first within a page, last page wins, first place kept."""
    in_page = links.groupBy("num", "page", "numac").agg(
        F.min_by(F.struct("date", "titre", "pdf_url"), "link_no").alias("pub"), F.min("link_no").alias("link_no")
    )
    across = in_page.groupBy("num", "numac").agg(
        F.max_by("pub", "page").alias("pub"), F.min(F.struct("page", "link_no")).alias("place")
    )
    return across.select("num", "numac", "pub.*", "place")


def fill_forward(yearly: DataFrame, columns: list[str], key: str = "num", year: str = "year") -> DataFrame:
    """Zero counts as missing, then the last earlier value is carried along the years.

    One row per (key, year): a key has no more rows than there are fiscal years.
    """
    w = Window.partitionBy(key).orderBy(year).rowsBetween(Window.unboundedPreceding, 0)
    return yearly.withColumns({c: F.last(F.nullif(F.col(c), F.lit(0.0)), ignorenulls=True).over(w) for c in columns})
