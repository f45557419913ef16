"""Company-number keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_number(number: Column) -> Column:
    """Key without dots or spaces."""
    return F.trim(F.regexp_replace(number.cast("string"), "[. ]", ""))


def dotted_number(number: Column) -> Column:
    """Ten digits written ``dddd.ddd.ddd``."""
    return F.concat_ws(".", F.substring(number, 1, 4), F.substring(number, 5, 3), F.substring(number, 8, 3))


def company_number(text: Column) -> Column:
    """Ten-digit number hidden in a text, NULL when the text is not a company number."""
    digits = F.regexp_replace(text, r"\D", "")
    padded = F.when(F.length(digits) == 9, F.concat(F.lit("0"), digits)).otherwise(digits)
    return F.when(F.length(padded) == 10, padded)


def in_shard(number: Column, count: int, index: int) -> Column:
    """Stable shard test: the number modulo ``count``, a hash for keys that are no numbers."""
    value = F.coalesce(number.try_cast("bigint"), F.abs(F.xxhash64(number)))
    return F.pmod(value, F.lit(count)) == index
