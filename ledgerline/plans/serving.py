"""Directory searches and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.filters import any_token, is_number_search, number_prefix
from ledgerline.operators.lookups import flag_present
from ledgerline.operators.paging import page, with_total
from ledgerline.operators.picks import display_names
from ledgerline.operators.search import keys_with_any
from ledgerline.plans.finance import schema_type, yearly_metrics


def held(shown: DataFrame) -> DataFrame:
    """One page (at most ``MAX_PAGE`` rows) as a local table, so that it is cut out only once."""
    return shown.sparkSession.createDataFrame(shown.collect(), shown.schema)


def matching_numbers(denominations: DataFrame, text: str, names: DataFrame | None = None) -> DataFrame:
    """Enterprises with a name that has one of the words: from a landed token table ``names``, else through all names."""
    if names is not None:
        return keys_with_any(names, "num", text)
    return denominations.where(any_token(F.col("valeur"), text)).select("num").distinct()


def enterprise_page(
    enterprises: DataFrame, denominations: DataFrame, gold_keys: DataFrame, text: str = "", skip: int = 0, limit: int = 50,
    names: DataFrame | None = None,
) -> DataFrame:
    """Directory page of all enterprises by number prefix or name; ``skip`` only without a search text.

    With a landed token table ``names`` a search reads that, else it goes through all names.
    """
    if not text:
        hits = page(enterprises, skip=skip, limit=limit)
    elif is_number_search(text):
        hits = page(enterprises.where(number_prefix(F.col("num"), text)), limit=limit)
    else:
        found = matching_numbers(denominations, text, names)
        hits = page(enterprises.join(found, "num", "left_semi"), limit=limit)
    shown = held(hits.select("num", "juridical_form", "status"))
    keys = F.broadcast(shown.select("num"))
    named = shown.join(display_names(denominations.join(keys, "num", "left_semi")), "num", "left")
    return flag_present(named, gold_keys.join(keys, "num", "left_semi"), "has_gold")


def target_page(
    targets: DataFrame, lines: DataFrame, denominations: DataFrame, text: str = "", skip: int = 0, limit: int = 50,
    names: DataFrame | None = None, gold_names: DataFrame | None = None,
) -> DataFrame:
    """Sector page with the latest year's figures; the page is cut first, and only its keys' filing ``lines`` are evaluated.

    The name is that of the register, else of the target list, else of gold (``gold_names``: ``num, gold_name``).
    """
    if not text:
        hits = targets
    elif is_number_search(text):
        hits = targets.where(number_prefix(F.col("num"), text))
    else:
        keys = matching_numbers(denominations, text, names)
        hits = targets.join(keys, "num", "left_semi")
    shown = held(with_total(page(hits, skip=skip, limit=limit).select("num", "denomination", "status", "nace_codes"), hits))
    keys = F.broadcast(shown.select("num"))  # at most one page of rows
    latest = F.max_by(F.struct(F.col("year").alias("dernier_exercice"), "ca", "resultat_net"), "year").alias("latest")
    own = yearly_metrics(lines.join(keys, "num", "left_semi")).groupBy("num").agg(
        latest, F.count("*").alias("nb_exercices"), schema_type(F.col("ca"), F.col("fonds_propres")).alias("schema_type"))
    shown_names = display_names(denominations.join(keys, "num", "left_semi")).withColumnRenamed("denomination", "silver_name")
    out = shown.join(own, "num", "left").join(shown_names, "num", "left")
    if gold_names is not None:
        out = out.join(gold_names.join(keys, "num", "left_semi").select("num", "gold_name"), "num", "left")
    last = ["gold_name"] if gold_names is not None else []
    return out.select(
        "num", F.coalesce("silver_name", "denomination", *last).alias("denomination"), "status",
        F.coalesce("nb_exercices", F.lit(0)).alias("nb_exercices"), "latest.*", "nace_codes", "schema_type",
        F.col("nb_exercices").isNotNull().alias("has_gold"), "total",
    )
