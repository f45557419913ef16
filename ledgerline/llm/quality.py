"""Quality rules, line first: lines are judged one by one, documents by what is left. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import WHITE, WORD, narrow, whole, words

#: A document is rejected when its failing lines hold more than this share of its words.
MAX_LOST = 0.5
WINDOW = 5

#: What may end a line of some length: closing or terminal punctuation of any script, by its Unicode class ..
ENDS = r"[\p{Pe}\p{Pf}\p{Pi}\p{Po}]\z"
#: .. but for these, which are of the same class and end nothing.
NO_ENDS = "#%&*@/\\"
#: Symbols or doubled marks on words.
MARKED = r"[#*$%&<>]{2,}|!{2,}|[?]{2,}"
#: A line without any of these has neither marks nor separators.
ODD = r"[#*$%&|<>!?»•·]"
#: Separators between menu entries.
SEPARATOR = r"[\x20\x09-\x0D][|>»•·]+"
MENU = r"(?i)^[\x20\x09-\x0D]*(?:home|menu|login|log in|sign in|sign up|register|search|next|previous|back to top|share|contact us|about us|site ?map)[\x20\x09-\x0D.!]*\z"
BOILERPLATE = r"(?i)(?:enable javascript|javascript is (?:disabled|required)|(?:uses|use of|accept(?: all)?) cookies|cookie policy|privacy policy|terms of (?:use|service)|all rights reserved|lorem ipsum|subscribe to our newsletter|click here)"


def line_fails(line: Column, n: Column) -> Column:
    """True for a line of ``n`` words that breaks the punctuation, navigation or boilerplate rule."""
    last = F.substring(F.rtrim(line, F.lit(WHITE)), -1, 1)
    no_end = (n >= 12) & (~last.rlike(ENDS) | F.lit(NO_ENDS).contains(last))
    odd = line.rlike(ODD)
    marked = odd & (F.regexp_count(line, F.lit(MARKED)) * 10 > n * 3)
    navigation = (odd & (F.regexp_count(line, F.lit(SEPARATOR)) * 5 > n)) | ((n <= 4) & line.rlike(MENU))
    return no_end | marked | navigation | ((n <= 40) & line.rlike(BOILERPLATE))


def _with_repeats(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words covered by windows that come up twice in ``words`` (``n`` of them).

    Where window hashes repeat, they are sorted by (hash, place); those next to an equal one are repeated, and the places
    they cover are added up. Each step is a column of its own: inside a lambda an expression would be evaluated per element.
    """
    window = lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)])
    df = df.withColumn("grams", F.when(F.col("n") >= WINDOW, F.transform(F.sequence(F.lit(0), F.greatest(F.col("n"), F.lit(WINDOW)) - WINDOW), window)))
    some = F.size(F.array_distinct("grams")) < F.size("grams")
    df = df.withColumn("ranked", F.when(some, F.sort_array(F.transform("grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    near = lambda x, k: F.coalesce(F.get("ranked", k)["h"] == x["h"], F.lit(False))
    twice = F.transform("ranked", lambda x, k: F.when(((k > 0) & near(x, F.greatest(k - 1, F.lit(0)))) | near(x, k + 1), x["i"]))
    df = df.withColumn("places", F.sort_array(F.filter(twice, lambda i: i.isNotNull())))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate(
        "places", start,
        lambda s, i: F.struct((s["n"] + F.least(F.lit(WINDOW), i - s["last"]).cast("long")).alias("n"), i.alias("last")), lambda s: s["n"])
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))


def _judged(df: DataFrame, carried: list[str], max_lost: float) -> DataFrame:
    """``carried`` columns and all measures of the rows ``(text, carried..)``."""
    df = df.withColumn("text", whole("text"))
    df = df.withColumn("words", words(F.col("text"))).withColumn("lines", F.split("text", "\n", -1))
    df = df.withColumn("n", F.size("words")).withColumn("full", F.filter("lines", lambda x: x.rlike(WORD)))
    df = _with_repeats(df)
    counted = F.transform("lines", lambda x: F.struct(x.alias("line"), F.regexp_count(x, F.lit(WORD)).alias("n")))
    df = df.withColumn("marks", F.transform(counted, lambda m: F.struct(m["line"].alias("line"), m["n"].alias("n"), line_fails(m["line"], m["n"]).alias("bad"))))
    lost = F.aggregate("marks", F.lit(0).cast("long"), lambda s, m: s + F.when(m["bad"], m["n"]).otherwise(0).cast("long"))
    df = df.withColumn("lost_words", lost)
    df = df.select(
        *carried,
        F.col("n").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("full") - F.size(F.array_distinct("full"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.filter("marks", lambda m: m["bad"])).cast("long").alias("n_bad_lines"),
        "lost_words",
        F.array_join(F.transform(F.filter("marks", lambda m: ~m["bad"]), lambda m: m["line"]), "\n").alias("clean_text"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    df = df.withColumn("base_failed", failed)
    return df.withColumn("kept", ~F.col("base_failed") & (F.col("lost_words") <= max_lost * F.col("n_words")))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """One row per input row: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_bad_lines,
    lost_words, clean_text, base_failed, kept``.

    clean_text holds the lines that pass, joined by newlines. Null and empty texts have no words and fail, and their clean_text
    is empty. Windows of five words are compared by 64-bit hashes within a document. The punctuation rule knows every script's
    closing marks; the navigation and boilerplate lists are English, so such lines of other languages pass them.
    Rows with the same id are judged each on its own; other columns of ``docs`` are ignored.
    """
    return _judged(narrow(docs, doc_id=id_col, text=text_col), ["doc_id"], max_lost)


def keep_good(docs: DataFrame, text_col: str = "text", max_lost: float = MAX_LOST, length_col: str = "n_chars") -> DataFrame:
    """The rows of ``docs`` that pass, without their failing lines; a text without such lines is unchanged.

    ``length_col``, where ``docs`` has it, follows a changed text; all other columns are unchanged, whatever their names. A
    row that passes loses at most ``max_lost`` of its words, so some are left. The row is carried along as one struct, so
    nothing is shuffled; its number keeps the optimiser from evaluating the verdict a second time inside the filter.
    """
    others = [docs[c] for c in docs.columns if c != text_col]
    rows = docs.select(docs[text_col].alias("text"), F.struct(*(others or [F.lit(0).alias("none")])).alias("row"))
    judged = _judged(rows, ["row"], max_lost).select("row", "clean_text", "n_bad_lines", "kept", F.monotonically_increasing_id().alias("at"))
    new = {c: F.col("row").getField(c) for c in docs.columns if c != text_col} | {text_col: F.col("clean_text")}
    if length_col in new and length_col != text_col:
        new[length_col] = F.when(F.col("n_bad_lines") > 0, F.length("clean_text").cast(docs.schema[length_col].dataType)).otherwise(new[length_col])
    return judged.where("kept AND at >= 0").select(*[new[c].alias(c) for c in docs.columns])
