"""Phrase collocations: Rabin-Karp fingerprints of all short word sequences, counted over the corpus; only frequent ones are spelled out.

Texts are laid down once as blocks of one language. Each block hands on the fingerprints of its word sequences; a shuffle adds
them up and answers each block with pointers, one bit for each of its fingerprints that is frequent in the whole corpus. The
block spells out what the pointers show, told apart by their words, and the final counts are of these texts, so a collision of
fingerprints only lets some rare sequences through to that step, where their own count drops them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import join_unique, narrow, whole
from ledgerline.session import stored

PIECE_ENDS = ".,;:!?\n\v\f\r"
BLOCK_BYTES = 4_500_000
#: Fingerprints that one task adds up, on average.
BUCKET_PRINTS = 2_000_000
MAX_WORDS = 3
#: Width of the bands in which scores (up to a million) are counted before ranking.
SCORE_BAND = 500
_BASE = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2^64
_WORD_BASE = 0xAF251AF3B0F025B5

_PLAIN = bytes.maketrans(bytes(range(65, 91)) + PIECE_ENDS.encode() + b"\t", bytes(range(97, 123)) + b"\n" * len(PIECE_ENDS) + b" ")


def blocks(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``block, lang, words, text``: texts of one language, lower-cased, pieces ended by line feeds, compressed; some megabytes in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 31
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def block(lang: str) -> pa.RecordBatch:
            nonlocal number
            number += 1
            del size[lang]
            text = b"\n".join(held.pop(lang))
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([lang]), pa.array([len(text.split())]), pa.array([zlib.compress(text, 1)], pa.binary())], names=["block", "lang", "words", "text"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.setdefault(lang, []).append(text.as_py().translate(_PLAIN))
                size[lang] = size.get(lang, 0) + len(held[lang][-1]) + 1
                if size[lang] > BLOCK_BYTES:
                    yield block(lang)
            while sum(size.values()) > 2 * BLOCK_BYTES:
                yield block(max(size, key=size.__getitem__))
        for lang in list(held):
            yield block(lang)

    rows = narrow(docs, lang=lang_col, text=text_col).select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), whole("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "block long, lang string, words long, text binary")


@cache
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2^64."""
    inverse = pow(base, -1, 1 << 64)
    return tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)]), dtype=np.uint64) for b in (base, inverse))


def _spans(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Polynomial fingerprint of each span, from the sums of a prefix polynomial at its ends."""
    up, down = _powers(base, 1 << max(10, int(len(values)).bit_length()))
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[:len(values)], dtype=np.uint64)])
    return (prefix[end] - prefix[start]) * down[start]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(sums: np.ndarray, lang: int, n: int) -> np.ndarray:
    """Languages and lengths count apart."""
    return _mixed(sums ^ np.uint64(lang << 3 | n))


class Block:
    """Words of a block's text and the fingerprints of its word sequences."""

    def __init__(self, text: bytes, lang: str):
        self.text, self.lang = text, zlib.crc32(lang.encode())
        letters = np.frombuffer(text, np.uint8)
        inside = np.zeros(len(letters) + 2, bool)
        inside[1:-1] = (letters != 32) & (letters != 10)
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edge[::2], edge[1::2]
        # How many words follow in the same piece, up to what a phrase needs.
        piece = np.searchsorted(np.flatnonzero(letters == 10), self.start)
        self.piece = piece.astype(np.int32)
        hashes = [np.zeros(0, np.uint64)]
        step = max(1, 1 << 20)
        cuts = np.unique(np.append(np.searchsorted(self.start, np.arange(0, len(letters), step)), len(self.start)))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):  # prefix sums of a part of the text at a time
            low = self.start[a]
            values = _mixed(letters[low:self.end[b - 1]].astype(np.uint64) + np.uint64(1))
            hashes.append(_spans(values, self.start[a:b] - low, self.end[a:b] - low, _BASE))
        self.words = _mixed(np.concatenate(hashes))

    def prints(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints of all sequences of ``n`` words within pieces, and the number of their first words."""
        first = np.arange(max(0, len(self.words) - n + 1))
        if n > 1:
            first = first[self.piece[first] == self.piece[first + n - 1]]
        return fingerprint(_spans(self.words, first, first + n, _WORD_BASE), self.lang, n), first

    def distinct(self, exact: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints in order, their counts, first occurrences and lengths in words.

        With ``exact``, occurrences of a fingerprint are compared word by word, and each of its texts is an entry.
        """
        names = self._names() if exact else None
        parts = []
        for n in range(1, MAX_WORDS + 1):
            x, first = self.prints(n)
            order = np.argsort(x, kind="stable")
            new = np.append(True, x[order[1:]] != x[order[:-1]])[:len(x)]
            if exact and len(x):
                def other(order: np.ndarray, first: np.ndarray = first, n: int = n) -> np.ndarray:
                    a, b = first[order[1:]], first[order[:-1]]
                    return np.append(True, np.any([names[a + k] != names[b + k] for k in range(n)], axis=0))

                if (other(order) & ~new).any():  # a collision: its texts are told apart
                    order = np.lexsort((*(names[first + k] for k in range(n)), x))
                    new = np.append(True, x[order[1:]] != x[order[:-1]]) | other(order)
            begin = np.flatnonzero(new)
            parts.append((x[order[begin]], np.diff(np.append(begin, len(x))), first[order[begin]].astype(np.int32), np.full(len(begin), n, np.int8)))
        x, count, first, n = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.argsort(x, kind="stable")
        return x[order], count[order], first[order], n[order]

    def _names(self) -> np.ndarray:
        """A number for each word of the text, equal for equal words."""
        known: dict[bytes, int] = {}
        return np.fromiter((known.setdefault(w, len(known)) for w in self.text.split()), np.int32, len(self.words))


def _counted(prints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted fingerprints without repeats, and their counts."""
    begin = np.flatnonzero(np.append(True, prints[1:] != prints[:-1])[:len(prints)])
    return prints[begin], np.add.reduceat(counts, begin) if len(begin) else counts


def _buckets(prints: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket (leading bits) begins among sorted fingerprints."""
    if not bits:
        return np.array([0, len(prints)])
    return np.append(np.searchsorted(prints, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)), len(prints))


def _pack(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, so that the shuffle's compression finds the zeros."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _unpack(data: bytes, kind: type, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(-1, n).T).view(kind).reshape(n)


def frequent_phrases(docs: DataFrame, least: int = 10, text_col: str = "text", lang_col: str = "lang", bucket_prints: int = BUCKET_PRINTS) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, n_words, f`` of all sequences of one to three words found ``least`` times in a language, and ``lang, n``."""
    laid = stored(blocks(docs, text_col, lang_col), "blocks")

    n_words = laid.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    bits = (MAX_WORDS * n_words // bucket_prints).bit_length()
    fields = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("n", pa.int64()), ("prints", pa.binary()), ("counts", pa.binary())])

    def prints_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                prints, counts = _counted(*Block(zlib.decompress(text), lang).distinct()[:2])
                at = _buckets(prints, bits)
                rows = []
                for bucket in np.flatnonzero(np.diff(at)).tolist():
                    part = slice(at[bucket], at[bucket + 1])
                    rows.append((bucket, number, len(prints[part]), _pack(np.diff(prints[part], prepend=np.uint64(0))), _pack(counts[part].astype(np.uint32))))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)] if rows else [pa.array([], f.type) for f in fields], schema=fields)

    def add_up(table: pa.Table) -> pa.Table:
        n = table["n"].to_numpy()
        x = np.concatenate([np.cumsum(_unpack(d, np.uint64, k), dtype=np.uint64) for d, k in zip(table["prints"].to_pylist(), n, strict=True)])
        c = np.concatenate([_unpack(d, np.uint32, k) for d, k in zip(table["counts"].to_pylist(), n, strict=True)]).astype(np.int64)
        order = np.argsort(x, kind="stable")
        x = x[order]
        begin = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
        often = np.add.reduceat(c[order], begin) >= least
        mark = np.empty(len(x), bool)
        mark[order] = np.repeat(often, np.diff(np.append(begin, len(x))))
        shown = [np.packbits(m).tobytes() if m.any() else None for m in np.split(mark, np.cumsum(n)[:-1])]
        return pa.table({"block": table["block"], "bucket": table["bucket"], "shown": pa.array(shown, pa.binary())})

    prints = laid.select("block", "lang", "text").mapInArrow(prints_of, "bucket long, block long, n long, prints binary, counts binary")
    pointers = prints.groupBy("bucket").applyInArrow(add_up, "block long, bucket long, shown binary")

    def spell(text: pa.Table, pointer: pa.Table) -> pa.Table:
        found: list[bytes] = []
        count, words, lang = np.zeros(0, np.int64), np.zeros(0, np.int8), ""
        if text.num_rows and pointer.num_rows:
            lang = text["lang"][0].as_py()
            block = Block(zlib.decompress(text["text"][0].as_py()), lang)
            entries, counts, first, n = block.distinct(exact=True)
            prints = np.unique(entries)
            at = _buckets(prints, bits)
            mark = np.zeros(len(prints), bool)
            for bucket, shown in zip(pointer["bucket"].to_pylist(), pointer["shown"].to_pylist(), strict=True):
                part = slice(at[bucket], at[bucket + 1])
                mark[part] = np.unpackbits(np.frombuffer(shown, np.uint8))[:at[bucket + 1] - at[bucket]]
            mark = np.flatnonzero(mark[np.searchsorted(prints, entries)])
            count, words = counts[mark].astype(np.int64), n[mark]
            found = _phrases(block, first[mark], words)
        return pa.table({"lang": pa.array([lang] * len(found), pa.string()), "phrase": pa.array(found, pa.binary()).cast(pa.string()), "n_words": pa.array(words.astype(np.int32)), "f": pa.array(count)})

    by_block = laid.groupBy("block").cogroup(pointers.where(F.col("shown").isNotNull()).groupBy("block"))
    spelled = by_block.applyInArrow(spell, "lang string, phrase string, n_words int, f long")
    phrases = spelled.groupBy("lang", "phrase", "n_words").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return stored(phrases, "phrases"), laid.groupBy("lang").agg(F.sum("words").alias("n"))


def _phrases(block: Block, first: np.ndarray, n: np.ndarray) -> list[bytes]:
    """Texts of the sequences, words joined by one space."""
    text, start, end = block.text, block.start, block.end
    out = []
    for a, b, k in zip(start[first].tolist(), end[first + n - 1].tolist(), n.tolist(), strict=True):
        phrase = text[a:b]
        out.append(phrase if phrase.count(b" ") == k - 1 else b" ".join(phrase.split()))
    return out


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, text_col: str = "text", lang_col: str = "lang", bucket_prints: int = BUCKET_PRINTS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of two or three words of each language.

    A null language is ``und``; null and empty texts have no words; repeated rows count as often as they come; texts of any
    length are read whole (a block holds the longest one at least); an empty table gives an empty result; other columns are
    ignored, whatever their names. Of equal cuts the one after fewer words counts. Ties of the score go to the larger ``a``, then to the smaller phrase.
    """
    phrases, totals = frequent_phrases(docs, least, text_col, lang_col, bucket_prints)
    words = F.split("phrase", " ")

    def part(begin: int, n: int):
        return F.array_join(F.slice(words, begin, n), " ")

    candidates = phrases.where("n_words > 1").select("lang", "phrase", "n_words", F.col("f").alias("a"))
    cuts = candidates.select(
        "lang", "phrase", "n_words", "a", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k")).withColumns({"first": part(1, F.col("k")), "rest": part(F.col("k") + 1, F.col("n_words") - F.col("k"))})
    known = phrases.select("lang", F.col("phrase"), "f")
    one = join_unique(stored(cuts, "cuts"), known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    both = join_unique(stored(one, "cuts"), known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr("CAST((CAST(1000000 * CAST(a AS DECIMAL(15,0)) AS DECIMAL(21,0)) * CAST(a AS DECIMAL(15,0))) DIV (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0))) AS BIGINT)")
    scored = both.withColumn("score", score)
    best = scored.groupBy("lang", "phrase", "n_words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # A phrase of two words goes where one of three words holds it and has half its occurrences. Longer phrases are never inside another.
    longer = candidates.where("n_words = 3").select("lang", F.explode(F.array(part(1, 2), part(2, 2))).alias("phrase"), F.col("a").alias("f"))
    covered = longer.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    left = best.join(covered.withColumn("n_words", F.lit(2)), ["lang", "phrase", "n_words"], "left").where(F.coalesce(100 * F.col("longer") < 50 * F.col("a"), F.lit(True)))
    rows = left.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    rows = stored(rows.withColumn("band", F.floor(F.col("score") / SCORE_BAND)), "scored_phrases")
    # Bands of scores, from the top, until they hold enough: most phrases of a language go before anything is sorted.
    bands = rows.groupBy("lang", "band").agg(F.count("*").alias("size"))
    above = F.sum("size").over(Window.partitionBy("lang").orderBy(F.desc("band"))) - F.col("size")
    lowest = bands.withColumn("above", above).where(F.col("above") < top).groupBy("lang").agg(F.min("band").alias("lowest"))
    rows = join_unique(rows, lowest, ["lang"]).where(F.col("band") >= F.col("lowest"))
    # Then the best of each part of what is left, as a band may hold any number of ties.
    parts = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(256)))
    parts = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
