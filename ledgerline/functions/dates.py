"""Date strings and fiscal years."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.constants import YEAR_PATTERN


def iso_date(text: Column) -> Column:
    """``DD-MM-YYYY`` to ``YYYY-MM-DD``; anything else stays as it is."""
    parsed = F.try_to_timestamp(text, F.lit("dd-MM-yyyy"))
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), text)


def iso_from(value: Column, data_type: str) -> Column:
    """ISO string from a date, a timestamp or a date string; safe to repeat."""
    if data_type in ("date", "timestamp", "timestamp_ntz"):
        return F.date_format(value, "yyyy-MM-dd")
    return iso_date(value)


def reference_head(reference: Column) -> Column:
    return F.substring_index(F.coalesce(reference, F.lit("")), "-", 1)


def fiscal_year(period_end: Column, reference: Column) -> Column:
    """Year inside the period-end value, else a year leading the reference, else ``?``."""
    found = F.regexp_extract(F.coalesce(period_end, F.lit("")), YEAR_PATTERN, 0)
    head = reference_head(reference)
    return F.when(found != "", found).when(head.rlike(f"^{YEAR_PATTERN}$"), head).otherwise(F.lit("?"))


def year_number(period_end: Column) -> Column:
    """Year inside the period-end value as a number, 0 when it has none, NULL for NULL."""
    found = F.regexp_extract(period_end, YEAR_PATTERN, 0)
    return F.when(period_end.isNotNull(), F.coalesce(found.try_cast("double"), F.lit(0.0)))


def fiscal_year_of(number: Column, reference: Column) -> Column:
    """The fiscal year from :func:`year_number`."""
    return fiscal_year(F.when(number > 0, number.cast("int").cast("string")), reference)


def filing_year(reference: Column, deposit_date: Column, period_year: Column) -> Column:
    """Four digits leading the reference, else the deposit date, else the period year."""
    head = reference_head(reference)
    day = F.substring(F.coalesce(deposit_date, F.lit("")), 1, 4)
    return (
        F.when(head.rlike("^[0-9]{4}$"), head)
        .when(day.rlike("^[0-9]+$"), day)
        .otherwise(F.coalesce(period_year.cast("string"), F.lit("")))
    )


def deed_year(deed_date: Column) -> Column:
    """Year of an ISO date, ``unknown`` when there is none."""
    return F.coalesce(F.nullif(F.substring(deed_date, 1, 4), F.lit("")), F.lit("unknown"))
