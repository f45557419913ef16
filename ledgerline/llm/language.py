"""Language ID: expectation-maximisation over n-gram likelihoods gives each document's mix of languages."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import narrow

BUCKETS = 1 << 15
#: Each language is learned from about this many labelled rows, picked by a hash of id and text; from all where it has fewer.
SAMPLE_ROWS = 40_000
ROUNDS = 8
#: A further language must gain this many times half the logarithm of the number of n-grams.
PENALTY = 4.0
#: Proportions count as settled when no others have a log-likelihood higher by more than this (in a text of over 10 million n-grams, by
#: a thousand-millionth of their number). The penalty is always more.
SETTLED = 0.01
#: Rounds that settling takes at most, and halvings in a shift.
MAX_STEPS, HALVINGS = 100, 50

_NO_LETTER = re.compile(r"[\W\d_]+")


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the letter trigrams (words padded by a space), and how often each occurs; empty without a letter."""
    norm = f" {_NO_LETTER.sub(' ', text.lower()).strip()} "
    if not any(map(str.isalpha, set(norm))):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    c = np.frombuffer(norm.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    h = (c[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (c[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (c[2:] * np.uint64(0x165667B19E3779F9))
    h = ((h * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(49)).astype(np.int32)
    if len(h) > BUCKETS:
        counts = np.bincount(h, minlength=BUCKETS)
        found = np.flatnonzero(counts)
        return found, counts[found]
    return np.unique(h, return_counts=True)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for the fold that is never learned from; false without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


class Model:
    """Log-probabilities per bucket and language."""

    def __init__(self, names: list[str], counts: np.ndarray):
        self.names = names
        smooth = counts + 0.5
        self.prob = (smooth / smooth.sum(axis=0)).astype(np.float64) if names else np.zeros((BUCKETS, 0))

    @staticmethod
    def settle(p: np.ndarray, weight: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, float]:
        """Proportions settled by expectation and maximisation, and their log-likelihood.

        The likelihood is concave, so no proportions exceed it by more than the largest slope less the number of n-grams.
        Every round is followed by a shift, between the languages of the largest and the smallest slope, of the share that
        raises the likelihood most, found by halving. So a few rounds settle two languages that are nearly alike, too, which
        would take very many without. After ``MAX_STEPS`` the proportions reached are returned.
        """
        total = weight.sum()
        for _ in range(MAX_STEPS):
            mixed = p @ share
            slope = (weight / mixed) @ p
            if slope.max() - total <= max(SETTLED, 1e-9 * total):
                break
            share = share * slope / total
            mixed = p @ share
            slope = (weight / mixed) @ p
            up = int(slope.argmax())
            down = int(np.where(share > 0, slope, np.inf).argmin())
            along = p[:, up] - p[:, down]
            low, high = 0.0, float(share[down])
            for _ in range(HALVINGS):
                middle = (low + high) / 2
                low, high = (middle, high) if ((weight * along) / (mixed + middle * along)).sum() > 0 else (low, middle)
            share[up] += low
            share[down] = share[down] - low if high < share[down] else 0.0
            share /= share.sum()
        return share, float(weight @ np.log(p @ share))

    def mixture(self, found: np.ndarray, weight: np.ndarray, rounds: int = ROUNDS, penalty: float = PENALTY) -> tuple[list[int], np.ndarray]:
        """Languages of a text and their proportions, largest first.

        All languages are mixed for some rounds, which gives the first one and the order of trial. Then any further one is
        added that raises the penalised likelihood, whatever its share, until none does. A language whose slope shows that
        it cannot gain as much as it costs is not fitted.
        """
        p = self.prob[found]
        k, total = p.shape[1], weight.sum()
        share = np.full(k, 1 / k)
        for _ in range(rounds):
            share = share * ((weight / (p @ share)) @ p) / total
        order = np.argsort(-share, kind="stable").tolist()
        cost = penalty * 0.5 * np.log(total + 1)
        chosen, part, fit = order[:1], np.ones(1), float(weight @ np.log(p[:, order[0]]))
        grown = True
        while grown and len(chosen) < k:
            grown = False
            gain = (weight / (p[:, chosen] @ part)) @ p - total
            for other in [i for i in order if i not in chosen and gain[i] > cost]:
                size = len(chosen) + 1
                new, better = self.settle(p[:, [*chosen, other]], weight, np.append(part * (size - 1), 1) / size)
                if better - cost > fit:
                    chosen, part, fit, grown = [*chosen, other], new, better, True
                    break
        rank = np.argsort(-part, kind="stable")
        return [chosen[i] for i in rank], part[rank]


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Model of the rows ``(text, lang)``: n-gram counts per language, added up by Spark; the size is languages times buckets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1), strict=True):
                found, n = grams(text.as_py())
                into = sums.setdefault(lang.as_py(), np.zeros(BUCKETS, np.int64))
                into[found] += n
        for lang, counts in sums.items():
            found = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found.astype(np.int32)), pa.array(counts[found])], names=["lang", "bucket", "n"])

    rows = narrow(labelled, text=text_col, lang=lang_col).where("text IS NOT NULL AND lang IS NOT NULL")
    sums = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(sums["lang"].to_pylist()))
    counts = np.zeros((BUCKETS, len(names)))
    if names:
        column = pc.index_in(sums["lang"], pa.array(names)).to_numpy()
        counts[sums["bucket"].to_numpy(), column] = sums["n"].to_numpy()
    return Model(names, counts)


def fit_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = SAMPLE_ROWS) -> Model:
    """Model from the labelled rows outside the held-out fold: all rows of a language, about ``rows`` where it has more.

    Each language has its own rate, so a rare one is learned whole however many rows the others have. The row lowest in
    hash order is always in, so no language is lost to chance either.
    """
    usable = narrow(docs, doc_id=id_col, text=text_col, lang=lang_col).where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    usable = usable.where(~held_out(F.col("doc_id"))).withColumn("spot", F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(3)), 11))
    below = F.greatest((F.lit(float(rows)) / F.count("*") * (1 << 53)).cast("long"), F.min("spot") + 1)
    bounds = usable.groupBy(F.col("lang").alias("__lang")).agg(F.when(F.count("*") > rows, below).alias("below"))
    bounds = F.broadcast(bounds)  # a row per language, as the model has a column per language
    return fit(usable.join(bounds, F.col("lang") == F.col("__lang")).where("below IS NULL OR spot < below"))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, lang_pred, score, langs, shares``.

    lang_pred is the language with the largest share, score its share; langs and shares list the whole set. A text that is
    null or has no letter is ``und`` with score 0, and so is every text if nothing was learned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            langs, shares = [], []
            for text in batch.column(1):
                found, weight = grams(text.as_py() or "")
                if not len(found) or not model.names:
                    langs.append([])
                    shares.append([])
                    continue
                which, part = model.mixture(found, weight)
                langs.append([model.names[i] for i in which])
                shares.append([min(1.0, float(x)) for x in part])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] if x else "und" for x in langs]), pa.array([x[0] if x else 0.0 for x in shares], pa.float64()),
                 pa.array(langs, pa.list_(pa.string())), pa.array(shares, pa.list_(pa.float64()))], names=["doc_id", "lang_pred", "score", "langs", "shares"])

    rows = narrow(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, langs array<string>, shares array<double>")
