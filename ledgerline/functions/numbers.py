"""Amounts and ratios."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.constants import AMOUNT_PATTERN


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed a single time, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _local_amount(text: Column) -> Column:
    packed = F.regexp_replace(F.regexp_replace(text, r"^\s+|\s+$", ""), "[ \u00a0]", "")

    def signed(p: Column) -> Column:
        negative = p.startswith("-") | (p.startswith("(") & p.endswith(")"))
        bare = F.regexp_replace(F.regexp_replace(p, "^-+", ""), r"^[()]+|[()]+$", "")
        value = _once(_once(bare, point), number)
        return F.when(negative, -value).otherwise(value)

    def point(b: Column) -> Column:
        return F.when(b.contains(",") & b.contains("."), F.translate(b, ",.", ".")).otherwise(F.translate(b, ",", "."))

    def number(t: Column) -> Column:
        return F.when(t.rlike(AMOUNT_PATTERN), t.try_cast("double"))

    return _once(packed, signed)


def parse_amount(text: Column) -> Column:
    """Amount in any of the filing notations; NULL when it is none of them.

    ``1.234,5`` and ``1,5`` use a decimal comma, ``1.5`` a decimal point; parentheses
    or a leading minus make it negative. Plain numbers, the common case, are cast at once.
    """
    return F.when(text.rlike(r"^[0-9]+(\.[0-9]+)?$"), text.try_cast("double")).otherwise(_local_amount(text))


def first_amount(values: list[Column]) -> Column:
    """First parsed variant that has a value."""
    return F.coalesce(*values)


def sum_or_first(parts: list[Column], totals: list[Column]) -> Column:
    """Sum of the detailed values that are present, else the first total."""
    total = reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0.0)) for p in parts])
    return F.when(F.coalesce(*parts).isNotNull(), total).otherwise(F.coalesce(*totals))


def ratio(num: Column, den: Column, factor: float = 1) -> Column:
    """``num / den * factor`` to 4 places, NULL without a usable denominator."""
    return F.round(F.try_divide(num, den) * F.lit(factor), 4)


def percent(num: Column, den: Column) -> Column:
    """Percentage to 2 places, NULL for a zero denominator."""
    return F.round(F.try_divide(num, den) * 100, 2)


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))
