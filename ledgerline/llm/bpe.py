"""Byte-level BPE: merges replayed over the distinct pieces of a batch of texts through an inverted index of token pairs."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerline.llm.common import narrow, whole

#: Distinct pieces that a task remembers; past that it starts afresh. Bounds memory, not results.
REMEMBERED = 200_000
#: Characters of the texts whose new pieces are encoded together.
CORPUS_CHARS = 4_000_000
NONE = np.iinfo(np.int32).max


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a rank file. Read on the driver; its size is that of the vocabulary."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys ``left << 32 | right`` of all pairs of tokens that make a token, its rank, and the token of each byte."""
    pairs = [
        (ranks[token[:i]] << 32 | ranks[token[i:]], rank)
        for token, rank in ranks.items() for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
    table = np.array(sorted(pairs), np.int64).reshape(-1, 2)
    return table[:, 0].copy(), table[:, 1].astype(np.int32), np.array([ranks[bytes((b,))] for b in range(256)], np.int32)


def one_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Tokens of one piece: always the merge of lowest rank, from the left."""
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, i = min((ranks.get(parts[i] + parts[i + 1], NONE), i) for i in range(len(parts) - 1))
        if rank == NONE:
            break
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


class Replay:
    """Applies every merge to many pieces at once, in rank order.

    All pieces lie in one row of tokens with links to the left and right neighbour. ``index`` lists by merge rank the places
    where that merge applies; ranks are taken from a heap, and all places of a rank are merged together. Only the two pairs
    around a merged place are looked up again and entered in the index.
    """

    def __init__(self, ranks: dict[bytes, int], table: tuple[np.ndarray, np.ndarray, np.ndarray]):
        self.ranks = ranks
        self.keys, self.found, self.bytes = table

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair of tokens; NONE where there is none or no token."""
        keys = (a.astype(np.int64) << 32) | b
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((a >= 0) & (b >= 0) & (self.keys[at] == keys), self.found[at], NONE)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all pieces one after the other, and their number per piece.

        If a merge brings up a pair that ranks no higher than itself, the order inside the piece could matter; such a piece
        is encoded again on its own.
        """
        ids = np.array([self.ranks.get(p, -1) for p in pieces], np.int64)
        todo = np.flatnonzero(ids < 0)
        todo = todo[[len(pieces[i]) > 0 for i in todo]] if len(todo) else todo
        sizes = np.array([len(pieces[i]) for i in todo], np.int64)
        token = np.append(self.bytes[np.frombuffer(b"".join([pieces[i] for i in todo]), np.uint8)], np.int32(-1))
        n = len(token) - 1  # the place of the mark beyond all ends
        owner = np.repeat(np.arange(len(todo)), sizes)
        left, right = np.arange(-1, n), np.arange(1, n + 2)
        ends = np.cumsum(sizes)
        left[ends - sizes], right[ends - 1] = n, n
        left[n] = right[n] = n
        now_rank = np.append(self.rank(token[:-1], token[right[:-1]]), NONE)
        order = np.argsort(now_rank[:n], kind="stable")
        order = order[now_rank[order] < NONE]
        index: dict[int, list] = {}
        if len(order):
            cuts = np.flatnonzero(np.diff(now_rank[order])) + 1
            for part in np.split(order, cuts):
                index[int(now_rank[part[0]])] = part.tolist()
        heap = list(index)
        heapq.heapify(heap)
        odd: set[int] = set()
        while heap:
            rank = heapq.heappop(heap)
            places = np.unique(np.array(index.pop(rank, ()), np.int64))
            places = places[now_rank[places] == rank]
            if not len(places):
                continue
            if len(places) > 1:  # of overlapping places every other one is merged, from the left
                chained = np.append(False, right[places[:-1]] == places[1:])
                if chained.any():
                    run = np.arange(len(places))
                    begin = np.maximum.accumulate(np.where(chained, 0, run))
                    places = places[(run - begin) % 2 == 0]
            second = right[places]
            after = right[second]
            beside = np.isin(after, places)  # the next place is merged too; before that, its left part met the new token
            if beside.any():
                met = self.rank(np.full(beside.sum(), rank, np.int32), token[after[beside]])
                odd.update(owner[places[beside][met <= rank]].tolist())
            token[places], token[second], now_rank[second] = rank, -1, NONE
            right[places] = after
            left[after] = places
            left[n] = n
            before = left[places]
            near = np.concatenate([places, before])
            fresh = self.rank(token[near], token[right[near]])
            now_rank[near] = fresh
            now_rank[n] = NONE
            some = (fresh < NONE) & (near < n)
            if (fresh[some] <= rank).any():
                odd.update(owner[near[some][fresh[some] <= rank]].tolist())
            for r, place in zip(fresh[some].tolist(), near[some].tolist(), strict=True):
                if r in index:
                    index[r].append(place)
                else:
                    index[r] = [place]
                    heapq.heappush(heap, r)
        live = np.flatnonzero(token[:n] >= 0)
        counts = np.where(ids >= 0, 1, 0)
        counts[todo] = np.bincount(owner[live], minlength=len(todo)) if len(todo) else 0
        out = np.empty(counts.sum(), np.int64)
        start = np.cumsum(counts) - counts
        out[start[ids >= 0]] = ids[ids >= 0]
        if len(todo):
            first = np.cumsum(counts[todo]) - counts[todo]
            out[np.repeat(start[todo] - first, counts[todo]) + np.arange(len(live))] = token[live]
        if odd:
            parts = np.split(out, np.cumsum(counts)[:-1])
            for i in todo[sorted(odd)]:
                parts[i] = np.array(one_piece(pieces[i], self.ranks), np.int64)
            out, counts = np.concatenate(parts), np.array([len(p) for p in parts])
        return out.astype("<u4"), counts


class Encoder:
    """Encodes texts one after the other, remembering pieces; the new pieces of some million characters are replayed together."""

    def __init__(self, ranks: dict[bytes, int], table: tuple[np.ndarray, np.ndarray, np.ndarray], pattern: str):
        import regex

        self.find = regex.compile(pattern).findall
        self.replay = Replay(ranks, table)
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}  # number of each piece; its ids are ids[start:start + count]
        self.ids, self.start, self.count = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.texts: list[np.ndarray] = []
        self.new: list[str] = []

    def finish(self) -> list[bytes]:
        """Ids of the texts read since the last call."""
        if self.new:
            more, sizes = self.replay.encode([p.encode() for p in self.new])
            self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(sizes) - sizes])
            self.count, self.ids = np.concatenate([self.count, sizes]), np.concatenate([self.ids, more])
            self.new = []
        out = []
        for at in self.texts:
            n = self.count[at]
            first = np.cumsum(n) - n
            out.append(self.ids[np.repeat(self.start[at] - first, n) + np.arange(n.sum())].tobytes())
        self.texts = []
        if len(self.known) > REMEMBERED:
            self.clear()
        return out

    def __call__(self, texts: Iterator[str]) -> Iterator[list[bytes]]:
        """Lists of ids (as bytes), in the order of the texts."""
        chars = 0
        for text in texts:
            pieces = self.find(text)
            fresh = set(pieces).difference(self.known)
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh)), strict=True))
            self.new.extend(fresh)
            self.texts.append(np.fromiter(map(self.known.__getitem__, pieces), np.int32, len(pieces)))
            chars += len(text)
            if chars > CORPUS_CHARS:
                yield self.finish()
                chars = 0
        yield self.finish()


def _encoded(batches: Iterator[pa.RecordBatch], encoder: Encoder) -> Iterator[pa.RecordBatch]:
    """``(doc_id, ids)`` batches of ``(doc_id, text)`` batches."""
    for batch in batches:
        at = 0
        for ids in encoder(text.as_py() for text in batch.column(1)):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(ids)), pa.array(ids, pa.binary())], names=["doc_id", "ids"])
            at += len(ids)


def _texts(ids: pa.Array, token: dict[int, bytes]) -> Iterator[bytes]:
    for x in ids:
        yield b"".join(map(token.__getitem__, np.frombuffer(x.as_py(), "<u4").tolist()))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    rows = narrow(docs, doc_id=id_col, text=text_col).withColumn("text", whole("text"))
    return rows, rows.schema["doc_id"].dataType.simpleString()


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, ids`` with the token ids of the whole text as little-endian unsigned 32-bit integers.

    The text is split by ``pattern``; each match is encoded on its own, without special tokens. A null or empty text has no
    ids. A task takes texts of some million characters as its corpus and replays the merges over the pieces that are new
    in it; no text is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast((ranks, merge_table(ranks)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _encoded(batches, Encoder(*shared.value, pattern))

    rows, kind = _rows(docs, id_col, text_col)
    return rows.mapInArrow(run, f"doc_id {kind}, ids binary")


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``doc_id, decoded`` of ``doc_id, ids``: the bytes of the ids."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: token for token, rank in shared.value.items()}
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(_texts(part.column(1), token), pa.binary())], names=["doc_id", "decoded"])

    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, decoded binary")


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row, encoded and decoded again in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast((ranks, merge_table(ranks)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*shared.value, pattern)
        token = {rank: token for token, rank in shared.value[0].items()}
        for batch in _encoded(batches, encoder):
            ids = batch.column(1)
            sizes = [len(x.as_py()) // 4 for x in ids]
            digests = [hashlib.sha256(x.as_py()).hexdigest() for x in ids]
            back = [hashlib.sha256(x).hexdigest() for x in _texts(ids, token)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(back, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows, kind = _rows(docs, id_col, text_col)
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
