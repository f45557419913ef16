"""Row filters: selections, searches, eligibility."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.constants import FORMS_WITHOUT_DEEDS, PUBLIC_FORMS, SEAT_TYPES, SECTOR_CODES
from ledgerline.functions.dates import filing_year
from ledgerline.functions.keys import clean_number
from ledgerline.functions.text import tokens


def active_numbers(enterprises: DataFrame, only_active: bool = True, limit: int = 0) -> DataFrame:
    """Cleaned, non-empty numbers of the active enterprises; a limit takes the first by number."""
    kept = enterprises.where(F.col("status") == "AC") if only_active else enterprises
    numbers = kept.select(clean_number(F.col("enterprise_number")).alias("num")).where(F.col("num") != "")
    return numbers.orderBy("num").limit(limit) if limit else numbers


def not_in(value: Column, values: list[str]) -> Column:
    """Not one of the values; a missing value passes."""
    return value.isNull() | ~value.isin(values)


def has_main_code(activities: Column, codes: list[str]) -> Column:
    """One array element is the main activity and carries one of the codes."""
    return F.exists(activities, lambda a: (a["classification"] == "MAIN") & a["nace_code"].isin(codes))


def main_activity_of(activities: DataFrame, codes: list[str]) -> DataFrame:
    """Enterprises with such an activity, from the long table."""
    return activities.where((F.col("classification") == "MAIN") & F.col("nace_code").isin(codes)).select("num").distinct()


def sector_enterprises(enterprises: DataFrame, activities: DataFrame, codes: list[str] = SECTOR_CODES) -> DataFrame:
    """Active private legal persons with a main activity of the sector."""
    wanted = enterprises.where(
        (F.col("status") == "AC") & (F.col("type_of_enterprise") == "2") & not_in(F.col("juridical_form"), PUBLIC_FORMS)
    )
    return wanted.join(main_activity_of(activities, codes), "num", "left_semi")


def keep_seats(addresses: Column, field: str, values: list[str] = SEAT_TYPES) -> Column:
    """Only the registered seats of an address array; NULL becomes empty."""
    return F.filter(F.coalesce(addresses, F.array()), lambda a: a[field].isin(values))


def number_prefix(number: Column, text: str) -> Column:
    """Number starts with the digits of a search text; reaches the Parquet scan."""
    return number.startswith(text.replace(".", "").replace(" ", ""))


def is_number_search(text: str) -> bool:
    return text.replace(".", "").replace(" ", "").isdigit()


def name_contains(name: Column, text: str) -> Column:
    return F.contains(F.lower(name), F.lit(text.lower()))


def any_token(text: Column, query: str) -> Column:
    """Text has at least one word of the query."""
    return F.arrays_overlap(tokens(text), tokens(F.lit(query)))


def fiscal_year_kept(deposits: DataFrame, min_year: int | None = None, years: list[str] | None = None) -> DataFrame:
    """Period year from ``min_year`` on, or else a filing year out of ``years``."""
    if min_year is not None:
        period = F.col("period_year").cast("string")
        return deposits.where(period.rlike("^[0-9]+$") & (period.try_cast("int") >= min_year))
    if years:
        return deposits.where(filing_year(F.col("reference"), F.col("deposit_date"), F.col("period_year")).isin(years))
    return deposits


def deeds_expected(form: Column, status: Column) -> Column:
    """Active and not of a legal form without deeds; a missing form passes."""
    return (status == "Active") & not_in(form, FORMS_WITHOUT_DEEDS)


def is_pdf(content: Column) -> Column:
    """Starts with the PDF mark."""
    return F.substring(content, 1, 4) == F.lit(b"%PDF")


def is_large(content: Column, size: int = 1000) -> Column:
    return F.length(content) > size


def is_statute(media: Column, content: Column, size: int = 1000) -> Column:
    """A PDF by its content type, or else at least ``size`` bytes; a missing type is none."""
    return F.coalesce(media.contains("pdf"), F.lit(False)) | F.coalesce(F.length(content) >= size, F.lit(False))


def all_equal(df: DataFrame, **terms: str | None) -> DataFrame:
    """Equality filters for the terms that are given."""
    conditions = [F.col(k) == v for k, v in terms.items() if v]
    return df.where(reduce(lambda a, b: a & b, conditions)) if conditions else df
