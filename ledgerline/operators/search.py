"""Search tables: words and trigrams of texts as postings, landed by word, and lookups that read only the asked postings.

Landed in buckets of the word and sorted by it, a table answers a search from the buckets and row groups of the asked words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import tokens
from ledgerline.operators.filters import name_contains
from ledgerline.operators.scale import lookup

GRAM = 3
#: Posting lists of a substring search that are intersected; the others could only repeat what the check of the text decides.
RAREST = 3


def grams(text: Column) -> Column:
    """Distinct runs of three characters of the lower-cased text; none for a shorter one."""
    low = F.lower(text)
    return F.when(F.length(low) >= GRAM, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(low) - (GRAM - 1)), lambda i: F.substr(low, i, F.lit(GRAM)))))


def postings(rows: DataFrame, key: str, words: Column) -> DataFrame:
    """``(word, key)`` of all words, each once; to be landed by ``word``. Rows without a key are left out."""
    return rows.where(F.col(key).isNotNull()).select(F.explode(words).alias("word"), key).distinct()


def token_table(rows: DataFrame, key: str, text: str) -> DataFrame:
    return postings(rows, key, tokens(F.col(text)))


def gram_table(rows: DataFrame, key: str, text: str) -> DataFrame:
    return postings(rows, key, grams(F.col(text)))


def gram_counts(table: DataFrame) -> DataFrame:
    """``(word, n)``: length of each posting list."""
    return table.groupBy("word").agg(F.count("*").alias("n"))


def _asked(table: DataFrame, words: Column) -> list[str]:
    """Words of a search text, by the same functions as those of the table."""
    return [w for w in table.sparkSession.range(1).select(words).first()[0] or [] if w is not None]


def keys_with_any(table: DataFrame, key: str, text: str) -> DataFrame:
    """Keys with at least one word of the search text."""
    return table.where(F.col("word").isin(_asked(table, tokens(F.lit(text))))).select(key).distinct()


def containing(table: DataFrame, counts: DataFrame, rows: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """Keys of ``rows`` whose ``text`` holds ``part``, upper and lower case alike.

    The shortest posting lists of the part's trigrams are intersected, then the texts of these candidates are compared. A part
    of fewer than three characters has no trigram: all texts are compared.
    """
    asked = _asked(table, grams(F.lit(part)))
    if asked:
        known = {r["word"]: r["n"] for r in counts.where(F.col("word").isin(asked)).collect()}  # at most one row for each character of the part
        few = sorted(asked, key=lambda w: (known.get(w, 0), w))[:RAREST]
        found = table.where(F.col("word").isin(few)).groupBy(key).agg(F.count("*").alias("hits")).where(F.col("hits") == len(few))
        rows = lookup(rows, found.select(key), [key], "left_semi")
    return rows.where(name_contains(F.col(text), part)).select(key).distinct()
