"""Mixing sources to target weights by hash thresholds: histograms, one boundary bucket refined, no sorting. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import narrow, whole, words
from ledgerline.session import stored

MAX_COPIES = 3
#: Bits of the hash per histogram level. Three levels tell 2**36 hash values apart.
LEVEL_BITS, LEVELS = 12, 3


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``(doc_id, source, size, spot)``: words of the text and the row's place in hash order."""
    rows = narrow(docs, doc_id=id_col, text=text_col, source=source_col)
    size = F.size(words(whole("text"))).cast("long")
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    spot = F.conv(F.substring(digest, 1, LEVEL_BITS * LEVELS // 4), 16, 10).cast("long")
    return rows.select("doc_id", "source", size.alias("size"), spot.alias("spot"))


def targets(sizes: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, one row per source.

    Sources by code point, null last, weigh 1, 2, 3, repeating. A target stops at ``max_copies`` times the source; the
    excess is shared again by weight. With sources in order of size per weight the full ones come first; what is left per
    weight after the first k rises while source k is full and falls after, so the largest is the share.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    rows = sizes.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("long"))
    rows = rows.withColumn("top", F.col("source_size") * max_copies)
    fill = Window.orderBy(F.col("top").cast("double") / F.col("weight"), F.col("source").isNull(), F.encode("source", "utf-8"))
    before, every = fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("top").over(before), F.lit(0))
    weights = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    rows = rows.withColumn("share", left.cast("double") / weights)
    goal = F.least(F.col("top").cast("double"), F.max("share").over(every) * F.col("weight"))
    return rows.select("source", "source_size", goal.alias("target"))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def thresholds(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """``(source, source_size, target, copies, edge)``: every row is taken ``copies`` times, rows below ``edge`` once more.

    Thresholds are nested: a larger target takes the same rows and more. Each level adds up the sizes of the buckets inside
    the bucket where the level above crossed the budget, and finds the crossing with running sums over at most 4,096 buckets.
    The last bucket is taken whole where that comes nearer to the budget.
    """
    whole_times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    state = goals.withColumn("copies", whole_times)
    state = state.withColumn("need", F.col("target") - F.col("copies") * F.col("source_size")).withColumn("prefix", F.lit(0).cast("long"))
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        state = stored(state, "mix")  # read back with its true size: a few sources are broadcast
        at = state.select(F.col("source").alias("s"), F.col("prefix").alias("p"))
        inside = rows.join(at, _same(F.col("source"), F.col("s")) & (F.shiftright("spot", shift + LEVEL_BITS) == F.col("p"))) if level else rows
        sums = inside.groupBy("source", F.shiftright("spot", shift).alias("bucket")).agg(F.sum("size").alias("words"))
        running = Window.partitionBy("source").orderBy("bucket")
        sums = sums.select(F.col("source").alias("s"), "bucket", "words", (F.sum("words").over(running) - F.col("words")).alias("below"))
        crossed = state.join(sums, _same(F.col("source"), F.col("s")) & (F.col("below") <= F.col("need")), "left")
        best = crossed.groupBy(*[F.col(c) for c in state.columns]).agg(F.max(F.struct("bucket", "below", "words")).alias("b"))
        state = best.select(
            *[c for c in state.columns if c not in ("need", "prefix")],
            (F.col("need") - F.coalesce(F.col("b.below"), F.lit(0))).alias("need"),
            F.coalesce(F.col("b.bucket"), F.col("prefix") * (1 << LEVEL_BITS)).alias("prefix"), F.col("b.words").alias("last"))
        state = state if level == LEVELS - 1 else state.drop("last")
    take = F.coalesce(F.col("last") > 0, F.lit(False)) & (2 * F.col("need") >= F.col("last")) & (F.col("copies") < MAX_COPIES)
    edge = F.col("prefix") + F.when(take, 1).otherwise(0)
    return state.select("source", "source_size", "target", "copies", edge.alias("edge"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per input row: ``doc_id, source, size, source_size, target, copies, taken``; taken = size times copies.

    Null texts have size 0, null sources are a source of their own (the last). Rows with the same id share a place in hash
    order and are taken together; reruns agree. A source without words has target 0. An empty table gives no rows.
    """
    rows = stored(sized(docs, id_col, text_col, source_col), "sizes")
    goals = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    plan = stored(thresholds(rows, goals), "mix").withColumnRenamed("source", "s")
    out = rows.join(plan, _same(F.col("source"), F.col("s")))
    copies = (F.col("copies") + F.when(F.col("spot") < F.col("edge"), 1).otherwise(0)).cast("int")
    return out.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))
