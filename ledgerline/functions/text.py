"""Strings: labels, addresses, links, paths and display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.constants import ACCOUNT_PATH, DEFAULT_MEDIA_TYPE, LINE_PATTERN, MEDIA_TYPES, READABLE_ROOTS


def none_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def squeeze(text: Column) -> Column:
    """Runs of white space become one space."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def label(text: Column) -> Column:
    """Squeezed label without its closing colons."""
    return F.trim(F.regexp_replace(squeeze(text), ":+$", ""))


def line_code(line: Column) -> Column:
    return F.trim(F.regexp_extract(line, LINE_PATTERN, 1))


def line_value(line: Column) -> Column:
    return F.trim(F.regexp_extract(line, LINE_PATTERN, 2))


def path_enterprise(path: Column) -> Column:
    return F.regexp_extract(path, "/([^/]+)/hbb/", 1)


def path_reference(path: Column) -> Column:
    return F.regexp_extract(path, r"/hbb/(.+)\.csv$", 1)


def postal_line(street: Column, number: Column, postcode: Column, town: Column) -> Column:
    """``street number, postcode town`` without the empty parts; NULL when all are empty."""
    road = none_if_empty(F.concat_ws(" ", none_if_empty(street), none_if_empty(number)))
    place = none_if_empty(F.concat_ws(" ", none_if_empty(postcode), none_if_empty(town)))
    return none_if_empty(F.concat_ws(", ", road, place))


def bilingual_line(street: Column, number: Column, postcode: Column, town: Column) -> Column:
    """Address line in one language with stray commas and blanks cut off both ends."""
    blank = F.lit("")
    text = F.concat(
        F.coalesce(street, blank), F.lit(" "), F.coalesce(number, blank), F.lit(", "),
        F.coalesce(postcode, blank), F.lit(" "), F.coalesce(town, blank),
    )
    return F.regexp_replace(text, "^[, ]+|[, ]+$", "")


def media_type(name: Column) -> Column:
    """Media type by extension."""
    extension = F.when(name.contains("."), F.lower(F.substring_index(name, ".", -1))).otherwise(F.lit(""))
    out = F.lit(DEFAULT_MEDIA_TYPE)
    for ext, media in MEDIA_TYPES.items():
        out = F.when(extension == ext, F.lit(media)).otherwise(out)
    return out


def path_allowed(path: Column) -> Column:
    """Absolute, no parent step, and under a readable root or an account file."""
    rooted = F.lit(False)
    for root in READABLE_ROOTS:
        rooted = rooted | path.startswith(root)
    return path.startswith("/") & ~path.contains("..") & (rooted | path.rlike(ACCOUNT_PATH))


def clip(text: Column, length: int) -> Column:
    """Leading ``length`` characters, NULL when empty."""
    return none_if_empty(F.substring(text, 1, length))


def absolute_url(href: Column, host: str) -> Column:
    return F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(host), href))


def query_url(base: Column, **params: Column) -> Column:
    """URL with an encoded query string."""
    pairs = [F.concat(F.lit(f"{k}="), F.url_encode(v)) for k, v in params.items()]
    return F.concat(base, F.lit("?"), F.concat_ws("&", *pairs))


def first_integer(text: Column) -> Column:
    return none_if_empty(F.regexp_extract(text, r"\d+", 0)).try_cast("int")


def thousands(value: Column) -> Column:
    """``1,234``, ``-`` for NULL."""
    return F.coalesce(F.format_number(value, 0), F.lit("-"))


def percent_text(value: Column) -> Column:
    """``12.3%``, ``-`` for NULL."""
    return F.when(value.isNull(), "-").otherwise(F.format_string("%.1f%%", value))


def euro_text(value: Column) -> Column:
    """Millions above one million, else whole euros."""
    return F.when(F.abs(value) >= 1e6, F.format_string("%.1fM €", value / 1e6)).otherwise(
        F.concat(F.format_number(value, 0), F.lit(" €"))
    )


def tokens(text: Column) -> Column:
    """Lower-case word tokens, without the empty ones."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}_]+"), lambda t: t != ""))
