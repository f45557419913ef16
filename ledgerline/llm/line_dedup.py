"""Line dedup: explode normalised lines, count documents per hash, drop frequent lines, reassemble by position. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import WHITE, ascii_lower, narrow, whole
from ledgerline.session import stored

MIN_CHARS = 20
MIN_DOCS = 3


def keyed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Adds ``keys``: for each line the 128-bit hash of its key, null where the key is too short to count.

    Two differently seeded 64-bit hashes make up the 128 bits. Outer explodes spare the optimiser's extra filter on the array,
    which would compute all keys twice.
    """
    pair = lambda k: F.when(F.length(k) >= min_chars, F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(7), k).alias("h2")))
    lines = docs.withColumn("lines", F.split("text", "\n", -1))
    bare = F.transform("lines", lambda line: F.btrim(line, F.lit(WHITE)))
    return lines.withColumn("keys", F.transform(F.transform(bare, ascii_lower), pair))


def frequent_lines(keyed: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(h1, h2, owner)`` of the ``keys`` found in at least ``min_docs`` documents; owner is the largest id holding it.

    An id counts a key once, however many rows repeat it: (key, id) is made distinct first. Both steps combine map-side, and
    the first is dealt by key and id, so a very common line is spread over all tasks.
    """
    each = keyed.select("doc_id", F.explode_outer(F.array_distinct("keys")).alias("key")).where("key IS NOT NULL")
    each = each.select(F.col("key.h1").alias("h1"), F.col("key.h2").alias("h2"), "doc_id").distinct()
    found = each.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("doc_id").alias("owner"))
    return found.where(F.col("n") >= min_docs).select("h1", "h2", "owner")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per input row: all its columns, plus ``n_lines, n_dropped, kept_text``.

    A line's key is the line stripped of ASCII white space with A-Z lower-cased. Keys of ``min_chars`` code points or more
    that are in ``min_docs`` documents or more lose all their lines except in the largest id holding it. Null and empty
    texts are one empty line. An id is one document: rows that repeat it count once, and rows that share the largest id all
    keep the line. A row without an id neither counts nor loses lines. Columns named like the new ones are replaced; all
    other names are free, as columns are carried along in one struct.
    """
    extra = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "kept_text")]
    others = [docs[c] for c in extra if c not in (id_col, text_col)]
    rows = narrow(docs, doc_id=id_col, text=text_col).withColumn("text", whole("text"))
    keyed = stored(keyed_lines(rows, min_chars).where("doc_id IS NOT NULL").select("doc_id", F.xxhash64("text").alias("row"), "keys"), "keys")
    frequent = stored(frequent_lines(keyed, min_docs), "lines")  # read back with its true size: small ones are broadcast
    places = keyed.select("doc_id", "row", F.posexplode_outer("keys").alias("pos", "key")).where("key IS NOT NULL")
    places = places.select("doc_id", "row", "pos", F.col("key.h1").alias("h1"), F.col("key.h2").alias("h2"))
    lost = places.join(frequent, ["h1", "h2"]).where(F.col("doc_id") != F.col("owner"))
    lost = lost.groupBy(F.col("doc_id").alias("of"), F.col("row").alias("hash")).agg(F.collect_set("pos").alias("lost"))
    given = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), *([F.struct(*others).alias("row")] if others else []))
    whole_text = whole("text")
    same = (given["id"] == lost["of"]) & (F.xxhash64(whole(given["text"])) == lost["hash"])
    out = given.join(lost.hint("shuffle_hash"), same, "left").withColumn("lines", F.when(F.col("lost").isNotNull(), F.split(whole_text, "\n", -1)))
    n = F.regexp_count(whole_text, F.lit("\n")) + 1
    places_left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "lost")
    kept = F.when(F.col("lost").isNull(), whole_text).otherwise(F.array_join(F.transform(places_left, lambda i: F.get("lines", i)), "\n"))
    own = {id_col: F.col("id"), text_col: F.col("text")}
    out = out.select(
        *given.columns, n.cast("long").alias("n_lines"),
        F.coalesce(F.when(F.col("lost").isNotNull(), F.size("lost")), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept_text"))
    return out.select(*[(own[c] if c in own else F.col("row").getField(c)).alias(c) for c in extra], "n_lines", "n_dropped", "kept_text")
