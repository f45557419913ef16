"""Code dictionary, decoding, officer resolution, document lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.keys import company_number
from ledgerline.functions.text import none_if_empty
from ledgerline.operators.picks import display_names
from ledgerline.operators.scale import BROADCAST_ROWS, fits, lookup

LANGUAGES = ["FR", "NL"]


def code_labels(codes: DataFrame) -> DataFrame:
    """``(category, code, FR, NL)``; the last description of a language wins."""
    return codes.groupBy("category", F.trim("code").alias("code")).agg(
        *[F.max_by("description", F.when(F.col("language") == lang, F.col("pos"))).alias(lang) for lang in LANGUAGES]
    )


def raw_code_labels(codes: DataFrame) -> DataFrame:
    """The same with the code as written."""
    return codes.groupBy("category", "code").agg(
        *[F.max_by("description", F.when(F.col("language") == lang, F.col("pos"))).alias(lang) for lang in LANGUAGES]
    )


class Decoder:
    """Joins labels to code columns; the dictionary's size is checked once."""

    def __init__(self, codes: DataFrame, labels: DataFrame):
        self.labels = labels
        self.small = fits(codes.select("category", "code").distinct(), BROADCAST_ROWS)

    def _join(self, facts: DataFrame, dim: DataFrame, keys: list[str]) -> DataFrame:
        if self.small:
            return facts.join(F.broadcast(dim), keys, "left")
        return lookup(facts, dim, keys, size_of=self.labels)

    def both(self, facts: DataFrame, category: Column, code: str, prefix: str) -> DataFrame:
        """Adds ``<prefix>_fr`` and ``<prefix>_nl``."""
        dim = self.labels.select(
            F.struct("category", "code").alias("label_key"), F.col("FR").alias(f"{prefix}_fr"), F.col("NL").alias(f"{prefix}_nl")
        )
        keyed = facts.withColumn(
            "label_key", F.when(F.col(code).isNotNull(), F.struct(category.alias("category"), F.col(code).alias("code")))
        )
        return self._join(keyed, dim, ["label_key"]).drop("label_key")

    def label(self, facts: DataFrame, category: Column, code: str, out: str, lang: str = "FR") -> DataFrame:
        """Adds the label in ``lang``, else Dutch, else the code itself; NULL stays NULL."""
        dim = self.labels.select(
            F.struct("category", "code").alias("label_key"),
            F.coalesce(none_if_empty(F.col(lang)), none_if_empty(F.col("NL"))).alias("found_label"),
        )
        key = F.when(F.col(code).isNotNull(), F.struct(category.alias("category"), F.trim(F.col(code)).alias("code")))
        joined = self._join(facts.withColumn("label_key", key), dim, ["label_key"])
        return joined.withColumn(out, F.coalesce("found_label", F.col(code))).drop("label_key", "found_label")


def nace_category(version: str = "nace_version") -> Column:
    """Activity codes are listed per version; without one the 2008 list is used."""
    given = F.coalesce(F.col(version), F.lit(""))
    return F.when(given == "", "Nace2008").otherwise(F.concat(F.lit("Nace"), given))


def decode_activities(activities: DataFrame, codes: DataFrame) -> DataFrame:
    """Activities with French and Dutch labels of group, classification and code."""
    decoder = Decoder(codes, raw_code_labels(codes))
    out = decoder.both(activities, F.lit("ActivityGroup"), "activity_group", "group")
    out = decoder.both(out, F.lit("Classification"), "classification", "classification")
    return decoder.both(out, nace_category(), "nace_code", "nace")


def resolve_officers(officers: DataFrame, denominations: DataFrame) -> DataFrame:
    """Officers that are companies get the company's name, its number and a flag; others stay as they are.

    One company may hold a large share of all offices: the join is safe under skew.
    """
    marked = officers.withColumn("ref_bce", company_number(F.col("nom")))
    names = display_names(denominations).select(F.col("num").alias("ref_bce"), F.col("denomination").alias("company"))
    resolved = lookup(marked, names, ["ref_bce"], size_of=denominations)
    return resolved.select(
        *[c for c in officers.columns if c != "nom"], F.coalesce("company", "nom").alias("nom"), "ref_bce",
        F.col("ref_bce").isNotNull().alias("is_company"),
    )


def flag_present(rows: DataFrame, keys: DataFrame, flag: str, key: str = "num") -> DataFrame:
    """Adds a membership flag."""
    marks = keys.select(key).distinct().withColumn(flag, F.lit(True))
    return lookup(rows, marks, [key], size_of=keys).withColumn(flag, F.coalesce(flag, F.lit(False)))


def document_list(catalogue: DataFrame, accounts: DataFrame) -> DataFrame:
    """Catalogued documents and the account files that are not catalogued."""
    listed = catalogue.select(
        "enterprise", F.col("type"), "source", "year", "filename", "path",
        F.coalesce(none_if_empty(F.col("title")), none_if_empty(F.col("reference")), F.col("filename")).alias("label"),
    )
    files = accounts.where((F.coalesce(F.col("reference"), F.lit("")) != "") & F.col("num").isNotNull())
    files = files.select(
        F.col("num").alias("enterprise"), F.lit("comptes_annuels_csv").alias("type"), F.lit("nbb").alias("source"),
        F.coalesce(F.col("period_year").cast("string"), F.lit("")).alias("year"),
        F.concat("reference", F.lit(".csv")).alias("filename"),
        F.concat(F.lit("/"), "num", F.lit("/hbb/"), "reference", F.lit(".csv")).alias("path"), F.col("reference").alias("label"),
    )
    once = files.groupBy("path").agg(F.min(F.struct(*[c for c in files.columns if c != "path"])).alias("f")).select("path", "f.*")
    fresh = once.join(catalogue.select("path"), "path", "left_anti")
    return listed.unionByName(fresh)
