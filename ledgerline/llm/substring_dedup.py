"""Substring dedup: a word-level de Bruijn graph, its unbranched paths compacted, long repeats verified at their source.

Windows of ``width`` consecutive words are the edges of the graph. A run of windows with the same smallest k-mer (its
anchor) is a path that is compacted on the spot, before any shuffle: one row instead of some twenty. Runs with the same
anchor and the same words are the same path. If an anchor has only one run, its path does not branch, and the first document
that holds it is the source of all the others. Where it branches, the windows of one copy of each run are spelled out and
joined one by one. All counts and joins are Spark's; a window always meets every other window of the same words, as equal
windows have equal anchors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import narrow
from ledgerline.session import stored

WIDTH = 50
ANCHOR = 8
SEED = 11
REMEMBERED = 500_000


def _mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring stretches from theirs."""
    return _mix(a * np.uint64(0x9E3779B97F4A7C15) + b)


class Windows:
    """Hashes of all windows of a text and of their anchors, from the hashes of its words."""

    def __init__(self, words: np.ndarray, width: int, anchor: int):
        n = len(words) - width + 1
        kmers = self.stretches(words, anchor)
        self.hashes = self.stretches(words, width)[:n]
        self.anchors = self.lowest(kmers, width - anchor + 1)[:n]
        self.starts = np.flatnonzero(np.concatenate([[True], self.anchors[1:] != self.anchors[:-1]]))
        self.sizes = np.diff(np.append(self.starts, n))

    @staticmethod
    def stretches(words: np.ndarray, width: int) -> np.ndarray:
        """Hash of every stretch of ``width`` words, by doubling."""
        power, size, out, done = words, 1, None, 0
        while True:
            if width & size:
                if out is None:
                    out = power
                else:
                    n = len(words) - done - size + 1
                    out = _join(out[:n], power[done:done + n])
                done += size
            if done == width:
                return out
            power = _join(power[:-size], power[size:])
            size *= 2

    @staticmethod
    def lowest(values: np.ndarray, width: int) -> np.ndarray:
        """Smallest of every ``width`` neighbours, by doubling."""
        size = 1
        while size * 2 <= width:
            values = np.minimum(values[:-size], values[size:])
            size *= 2
        rest = width - size
        return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values

    def runs(self) -> np.ndarray:
        """Hash of the words of each run: of its windows in order."""
        n = len(self.hashes)
        place = np.arange(n) - np.repeat(self.starts, self.sizes)
        return np.add.reduceat(_mix(self.hashes + place.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), self.starts)


def _hasher():
    """Hash of each word of a list, remembering words."""
    from xxhash import xxh64_intdigest

    class Known(dict):
        def __missing__(self, word):
            self[word] = found = xxh64_intdigest(word, SEED)
            return found

    known = Known()

    def hashes(tokens: list[bytes]) -> np.ndarray:
        if len(known) > REMEMBERED:
            known.clear()
        return np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))

    return hashes


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, row, text)``; row tells texts apart that share an id."""
    rows = narrow(docs, doc_id=id_col, text=text_col)
    return rows.select("doc_id", F.hash("text").alias("row"), F.col("text").cast("binary").alias("text"))


def paths(texts: DataFrame, width: int, anchor: int) -> DataFrame:
    """``(anchor, run, doc_id, row, pos, n)``: every run of windows with one anchor, from window ``pos`` on, ``n`` windows."""
    kind = texts.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _hasher()
        for batch in batches:
            cols: list[list[np.ndarray]] = [[], [], [], [], []]
            for i, text in enumerate(pc.fill_null(batch.column(2), b"")):
                tokens = text.as_py().split()
                if len(tokens) >= width:
                    w = Windows(hashes(tokens), width, anchor)
                    for col, values in zip(cols, (w.anchors[w.starts], w.runs(), np.full(len(w.starts), i), w.starts, w.sizes), strict=True):
                        col.append(values)
            if cols[0]:
                a, r, at, pos, n = (np.concatenate(c) for c in cols)
                ids = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(r.view(np.int64)), batch.column(0).take(ids), batch.column(1).take(ids), pa.array(pos.astype(np.int32)),
                     pa.array(n.astype(np.int32))], names=["anchor", "run", "doc_id", "row", "pos", "n"])

    return texts.where("doc_id IS NOT NULL").mapInArrow(cut, f"anchor long, run long, doc_id {kind}, row int, pos int, n int")


def spelled(texts: DataFrame, wanted: DataFrame, width: int, anchor: int) -> DataFrame:
    """``(anchor, window, doc_id, row, pos)``: the windows of the ``wanted`` runs ``(doc_id, row, pos, n)``."""
    kind = texts.schema["doc_id"].dataType.simpleString()
    per_text = wanted.groupBy(F.col("doc_id").alias("__id"), F.col("row").alias("__row")).agg(
        F.collect_list("pos").alias("starts"), F.collect_list("n").alias("sizes"))
    joined = texts.join(per_text.hint("shuffle_hash"), (F.col("doc_id") == F.col("__id")) & (F.col("row") == F.col("__row")))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _hasher()
        for batch in batches:
            for i in range(batch.num_rows):
                w = Windows(hashes(batch["text"][i].as_py().split()), width, anchor)
                starts, sizes = (np.array(batch[c][i].as_py(), np.int64) for c in ("starts", "sizes"))
                pos = np.unique(np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum()))
                at = pa.array(np.full(len(pos), i))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w.anchors[pos].view(np.int64)), pa.array(w.hashes[pos].view(np.int64)), batch["doc_id"].take(at), batch["row"].take(at),
                     pa.array(pos.astype(np.int32))], names=["anchor", "window", "doc_id", "row", "pos"])

    return joined.select("doc_id", "row", "text", "starts", "sizes").mapInArrow(spell, f"anchor long, window long, doc_id {kind}, row int, pos int")


def repeats(texts: DataFrame, width: int = WIDTH, anchor: int = ANCHOR) -> DataFrame:
    """``(doc_id, row, pos, n, source)``: runs of ``n`` windows from ``pos`` on that start in a document of smaller id, ``source``."""
    runs = stored(paths(texts, width, anchor), "paths")
    shared = runs.groupBy("anchor").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), (F.min("run") < F.max("run")).alias("branched")).where("low < high").select("anchor", "branched")
    met = stored(runs.join(shared, "anchor"), "met")
    firsts = met.groupBy("anchor", "run").agg(F.min("doc_id").alias("source"))
    met = stored(met.join(firsts, ["anchor", "run"]), "sources")
    plain = met.where("doc_id > source").select("doc_id", "row", "pos", "n", "source")
    # of each path that branches, the windows of its source stand for all copies
    windows = stored(spelled(texts, met.where("branched AND doc_id = source"), width, anchor), "windows")
    first = windows.groupBy("anchor", "window").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("high")).where("source < high").drop("high")
    single = windows.join(first, ["anchor", "window"]).where("doc_id > source")
    return plain.unionByName(single.select("doc_id", "row", "pos", F.lit(1).alias("n"), "source"))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, anchor: int = ANCHOR) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, kept_text`` (kept words joined by one space).

    A word goes if a window of ``width`` words that covers it also starts in a document of smaller id. Windows are told
    apart by 128 bits (window and anchor), judged on the input. Null texts have no words. Repeated ids: rows of equal id are no
    source for each other. Rows without an id neither lose words nor are a source.
    """
    texts = _texts(docs, id_col, text_col)
    found = repeats(texts, width, anchor)
    spans = found.groupBy(F.col("doc_id").alias("__id"), F.col("row").alias("__row")).agg(F.collect_list("pos").alias("starts"), F.collect_list("n").alias("sizes"))
    joined = texts.join(spans.hint("shuffle_hash"), (F.col("doc_id") == F.col("__id")) & (F.col("row") == F.col("__row")), "left")
    kind = texts.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, gone, kept = [], [], []
            for text, starts, sizes in zip(pc.fill_null(batch["text"], b""), batch["starts"], batch["sizes"], strict=True):
                tokens = text.as_py().split()
                totals.append(len(tokens))
                if starts.is_valid:
                    change = np.zeros(len(tokens) + 1, np.int64)
                    begin = np.array(starts.as_py())
                    np.add.at(change, begin, 1)
                    np.add.at(change, begin + np.array(sizes.as_py()) + width - 1, -1)
                    tokens = [tokens[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
                gone.append(totals[-1] - len(tokens))
                kept.append(b" ".join(tokens))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(totals, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())], names=["doc_id", "n_words", "n_removed", "kept"])

    out = joined.select("doc_id", "text", "starts", "sizes").mapInArrow(cut, f"doc_id {kind}, n_words long, n_removed long, kept binary")
    return out.select("doc_id", "n_words", "n_removed", F.col("kept").cast("string").alias("kept_text"))


def digest(words: list[str]) -> str:
    return hashlib.sha256(" ".join(words).encode()).hexdigest()
