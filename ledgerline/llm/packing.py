"""Best-fit packing: pieces of token sequences packed per group, improved by swaps, then the bins left open packed on in larger company."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import narrow, whole
from ledgerline.session import stored

#: Pieces that one task packs together. Bounds the memory of a task, whatever the number of documents.
GROUP = 16_000
#: Passes in a row that exchange without emptying a bin, after which a group is left as it is.
IDLE_PASSES = 8
#: Distinct words that a task remembers; past that it starts afresh. Bounds memory, not results.
REMEMBERED = 1_000_000
TEXT_BYTES = 4_000_000
#: Latin letters that no normalisation parts or joins, with marks before and behind them; an apostrophe before letters may be part of their piece.
MARKED_LETTERS = re.compile(r"(?:([!-&(-/:-@\[-`{-~]*)([A-Za-zÀ-ÖØ-öø-ÿ]+))?([!-/:-@\[-`{-~]*)").fullmatch
#: Characters that byte-level merges use for the bytes that have no printable character: from 256 on, in order.
BYTE_CHARS = {b: 256 + i for i, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))}
PIECES = "piece int, start long, length long, ids_crc32 long"


class Words(dict):
    """Token ids of texts; maps each blank-separated word to its number.

    The tokenizer drops white space before its merges, so a text's ids are those of its words. Marks around letters are
    pieces of their own, and capital letters count as small ones, so such words share the ids of their stem. A stem is one
    piece that the normaliser leaves alone: it goes straight to the merges, as the characters that stand for its bytes; all
    other words take the whole way. Ids are kept as bytes.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.merge = self.tokenizer.model.tokenize
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.stems: dict[str, bytes] = {}
        self.new: list[bytes] = []
        self.ids, self.start, self.count = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number

    def _whole_way(self, word: bytes) -> bytes:
        return array("I", self.tokenizer.encode(word.decode(), add_special_tokens=False).ids).tobytes()

    def _stem(self, stem: str) -> bytes:
        if stem not in self.stems:
            letters = stem if stem.isascii() else stem.encode().decode("latin-1").translate(BYTE_CHARS)
            self.stems[stem] = array("I", [t.id for t in self.merge(letters)]).tobytes()
        return self.stems[stem]

    def _ids(self, word: bytes) -> bytes:
        found = MARKED_LETTERS(word.decode())
        if not found or b"<|" in word:  # or a special token in it
            return self._whole_way(word)
        before, letters, behind = found.groups()
        ids = self._stem(letters.lower()) if letters else b""
        if before:
            ids = self._stem(before) + ids
        return ids + self._stem(behind) if behind else ids

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        if len(self) > REMEMBERED:
            self.forget()
        numbers = [np.fromiter(map(self.__getitem__, words), np.int64, len(words)) for words in map(bytes.split, texts)]
        if self.new:
            found = [self._ids(w) for w in self.new]
            sizes = np.array([len(x) // 4 for x in found], np.int64)
            self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(sizes) - sizes])
            self.count = np.concatenate([self.count, sizes])
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(found), np.uint32)])
            self.new = []
        for at in numbers:
            n = self.count[at]
            yield self.ids[np.repeat(self.start[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def pieces(docs: DataFrame, spec: str, end_id: int = 1, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: the whole text's token ids (null: empty text) and ``end_id``, cut at ``capacity``."""
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(shared.value)
        last = np.array([end_id], "<u4")
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sizes = np.cumsum([len(t) for t in texts]) // TEXT_BYTES
            for part in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(sizes)) + 1):
                out = []
                for row, ids in zip(part.tolist(), words.encode([texts[i] for i in part]), strict=True):
                    ids = np.concatenate([ids, last])
                    out += [(row, i, at, min(capacity, len(ids) - at), zlib.crc32(ids[at:at + capacity].tobytes())) for i, at in enumerate(range(0, len(ids), capacity))]
                cols = np.array(out, np.int64).reshape(-1, 5)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(cols[:, 0])), pa.array(cols[:, 1].astype(np.int32)), *[pa.array(cols[:, c].copy()) for c in (2, 3, 4)]],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = narrow(docs, doc_id=id_col, text=text_col).withColumn("text", whole("text").cast("binary"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {PIECES}")


def best_fit(sizes: list[int], capacity: int) -> tuple[list[list[int]], list[int]]:
    """Bins of item numbers and their fills: each item, larger ones first, goes to the bin that it fills best."""
    bins: list[list[int]] = []
    fills: list[int] = []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by free space
    mask = 0  # which of these lists are not empty
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        free = mask >> sizes[i]
        if free:
            space = sizes[i] + (free & -free).bit_length() - 1
            b = room[space].pop()
            if not room[space]:
                mask ^= 1 << space
            bins[b].append(i)
            fills[b] += sizes[i]
        else:
            b = len(bins)
            bins.append([i])
            fills.append(sizes[i])
        space = capacity - fills[b]
        if space:
            room[space].append(b)
            mask |= 1 << space
    return bins, fills


class Pool:
    """Documents of the bins that may still give some away, by size; those of the emptiest bins come first."""

    def __init__(self, capacity: int):
        self.at: list[dict[int, int]] = [{} for _ in range(capacity + 1)]  # document to bin
        self.mask = 0

    def add(self, size: int, item: int, owner: int) -> None:
        self.at[size][item] = owner
        self.mask |= 1 << size

    def remove(self, size: int, item: int) -> None:
        del self.at[size][item]
        if not self.at[size]:
            self.mask ^= 1 << size

    def largest(self, top: int) -> int:
        """Largest size up to ``top``, 0 if there is none."""
        found = self.mask & ((1 << (top + 1)) - 1)
        return found.bit_length() - 1 if found else 0


def _singles_and_pairs(items: list[int], sizes: list[int]) -> tuple[dict[int, tuple[int, ...]], dict[int, tuple[int, ...]]]:
    """One choice for each size of one document and for each size of two."""
    by_size: dict[int, list[int]] = {}
    for i in items:
        by_size.setdefault(sizes[i], []).append(i)
    pairs = {2 * s: tuple(same[:2]) for s, same in by_size.items() if len(same) > 1}
    each = list(by_size.items())
    for x, (s, same) in enumerate(each):
        for t, other in each[x + 1:]:
            pairs.setdefault(s + t, (same[0], other[0]))
    return {s: (same[0],) for s, same in by_size.items()}, pairs


def _best_exchange(mine: list[int], emptiest: list[int], gap: int, sizes: list[int], pool: Pool) -> tuple[int, tuple[int, ...], tuple[int, ...], int] | None:
    """``(gain, documents given, documents taken from the emptiest bin, or size of the one taken from anywhere)`` that fills most of ``gap``."""
    size = pool.largest(gap)
    best = (size, (), (), size) if size else None  # a move
    ones, twos = _singles_and_pairs(mine, sizes)
    for given, items in [*ones.items(), *twos.items()]:  # one for one, one for two
        if best and best[0] == gap:
            return best
        size = pool.largest(given + gap)
        if size > given and (best is None or size - given > best[0]):
            best = (size - given, items, (), size)
    for two, items in _singles_and_pairs(emptiest, sizes)[1].items():  # two for one
        for given, one in ones.items():
            if 0 < two - given <= gap and (best is None or two - given > best[0]):
                best = (two - given, one, items, 0)
    return best


def local_search(bins: list[list[int]], fills: list[int], sizes: list[int], capacity: int) -> None:
    """Exchange documents between underfull bins in place; every exchange makes the fuller bin fuller, so the sum of squared fills grows.

    From the fullest underfull bin on, each takes from the bins that are no fuller than it. Ends when no bin can be spared,
    when a pass finds nothing, or after some passes in which no bin fell empty.
    """
    idle = 0
    while idle < IDLE_PASSES:
        open_bins = sorted((b for b in range(len(bins)) if 0 < fills[b] < capacity), key=lambda b: (-fills[b], b))
        if len(open_bins) <= -(-sum(fills[b] for b in open_bins) // capacity):
            return  # as few as their tokens need
        pool = Pool(capacity)
        for b in reversed(open_bins):
            for i in bins[b]:
                pool.add(sizes[i], i, b)
        changed, emptied, last = 0, 0, len(open_bins) - 1
        for at, b in enumerate(open_bins):
            if not fills[b]:
                continue
            for i in bins[b]:
                pool.remove(sizes[i], i)
            while fills[b] < capacity:
                while last > at and not fills[open_bins[last]]:
                    last -= 1
                if last <= at:
                    break
                found = _best_exchange(bins[b], bins[open_bins[last]], capacity - fills[b], sizes, pool)
                if found is None:
                    break
                gain, given, items, size = found
                giver = open_bins[last]
                if not items:
                    item, giver = next(iter(pool.at[size].items()))
                    items = (item,)
                for i in items:
                    pool.remove(sizes[i], i)
                    bins[giver].remove(i)
                for i in given:
                    bins[b].remove(i)
                    bins[giver].append(i)
                    pool.add(sizes[i], i, giver)
                bins[b].extend(items)
                fills[b] += gain
                fills[giver] -= gain
                changed += 1
                emptied += not fills[giver]
        if not changed:
            return
        idle = 0 if emptied else idle + 1


def _packer(capacity: int, base: int) -> Callable[[pa.Table], pa.Table]:
    """Packs one group; ``base`` sets the names of this round's bins apart from those of other rounds."""

    def packed(table: pa.Table) -> pa.Table:
        # The smallest number in a bin names it, and numbers are unique: so are the names, in every round apart.
        order = np.argsort(table["number"].to_numpy(), kind="stable")
        number = table["number"].to_numpy()[order]
        sizes = table["size"].to_numpy()[order].tolist()
        bins, fills = best_fit(sizes, capacity)
        local_search(bins, fills, sizes, capacity)
        name, offset, fill = (np.zeros(len(sizes), np.int64) for _ in range(3))
        for items, total in zip(bins, fills, strict=True):
            items.sort()
            lengths = np.array([sizes[i] for i in items], np.int64)
            if items:
                name[items], fill[items], offset[items] = base + number[items[0]], total, np.cumsum(lengths) - lengths
        t = table.take(pa.array(order))
        return pa.table({"row": t["row"], "bin": pa.array(name), "size": t["size"], "number": t["number"], "offset": pa.array(offset), "fill": pa.array(fill)})

    return packed


def pack(rows: DataFrame, capacity: int = 4096, group: int = GROUP) -> DataFrame:
    """``rows`` (a ``length`` column, 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    Pieces of full length are a sequence each. The others are dealt at random into groups of some ``group`` pieces, packed by
    best fit and improved by local search. The bins of a group that are still open meet bins of other groups in the next
    round, whole, and are unpacked there; rounds end when there was one group, when the open bins are as few as their tokens
    need, or when a round spared less than one in a thousand of them. No group holds more than its share of the pieces.
    """
    spark = rows.sparkSession
    names = rows.columns
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    rows = stored(rows.select(F.struct(*[rows[c] for c in names]).alias("row"), F.monotonically_increasing_id().alias("bin"), rows["length"].alias("size")), "pieces")
    rows = rows.withColumn("number", F.col("bin"))
    full = rows.where(F.col("size") == capacity).select("row", F.col("bin").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    done, left = [full], rows.where(F.col("size") < capacity)
    n, bins = left.agg(F.count("*"), F.count("*")).first()
    salt = 0
    row_type = rows.schema["row"].dataType.simpleString()
    while n:
        groups = -(-n // group)
        dealt = left.withColumn("group", F.pmod(F.xxhash64("bin", F.lit(salt)), F.lit(groups)))
        out = stored(
            dealt.groupBy("group").applyInArrow(_packer(capacity, (salt + 1) << 55), f"row {row_type}, bin long, size long, number long, offset long, fill long"), "packed")
        still = out.where(F.col("fill") < capacity)
        count, now, tokens, total_bins = out.agg(
            F.count(F.when(F.col("fill") < capacity, 1)), F.count(F.when((F.col("fill") < capacity) & (F.col("offset") == 0), 1)),
            F.coalesce(F.sum(F.when(F.col("fill") < capacity, F.col("size"))), F.lit(0)), F.count(F.when(F.col("offset") == 0, 1))).first()
        more = groups > 1 and now > -(-tokens // capacity) and (salt == 0 or (bins - total_bins) * 1000 >= bins)
        keep = out.where(F.col("fill") == capacity) if more else out
        done.append(keep.select("row", F.col("bin").alias("sequence_id"), "offset"))
        if not more:
            break
        left, n, bins, salt = still.select("row", "bin", "size", "number"), count, now, salt + 1
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result.select(*[F.col("row")[c].alias(c) for c in names], "sequence_id", "offset")


def pack_documents(docs: DataFrame, spec: str, end_id: int = 1, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    ``spec`` is the text of a tokenizer file. A null or empty text is the end token alone. Rows that repeat an id, or have
    none, are documents like any other. Only documents longer than ``capacity`` are cut, into pieces that are full but the
    last. Pieces of equal length are told apart by their number, so a rerun over the same files packs them alike. An empty
    table gives an empty result; other columns are ignored, whatever their names.
    """
    return pack(pieces(docs, spec, end_id, capacity, id_col, text_col), capacity, group)
