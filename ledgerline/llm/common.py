"""Column helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Non-ASCII characters that a full lower-casing might change (anything but small letters, marks, digits, punctuation).
_OTHER_CASE = r"[\x{80}-\x{10FFFF}&&[^\p{Ll}\p{Lo}\p{M}\p{P}\p{Z}\p{Nd}]]"


def whole(text: str | Column) -> Column:
    """The text, an empty one for null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Character-wise translation is slow, so it is used only where ``lower`` would differ."""
    plain = (F.octet_length(text) == F.length(text)) | ~text.rlike(_OTHER_CASE)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named input columns under the operator's own names, whatever else ``df`` carries."""
    return df.select(*[df[old].alias(new) for new, old in columns.items()])


def join_unique(left: DataFrame, right: DataFrame, key: list[str], how: str = "inner") -> DataFrame:
    """``left`` joined with ``right``, whose keys are unique; a key of many rows of ``left`` meets its row by broadcast.

    Both sides are read twice, so they should be stored tables. A hot key has more than a ten-thousandth of the rows of
    ``left``, so there are at most 10,000 of them; the rest is shuffled.
    """
    n = left.count()
    hot = left.groupBy(*key).agg(F.count("*").alias("__n")).where(F.col("__n") > max(1000, n // 10_000)).select(*key)
    if how not in ("inner", "left"):
        raise ValueError(how)
    near = left.join(F.broadcast(hot), key, "left_semi").join(F.broadcast(right.join(F.broadcast(hot), key, "left_semi")), key, how)
    far = left.join(F.broadcast(hot), key, "left_anti").join(right, key, how)
    return near.unionByName(far)
