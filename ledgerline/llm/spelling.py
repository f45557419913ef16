"""Spelling variants: words one edit apart, found by depth-first search of a trie of letter-group counts."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import join_unique, narrow, whole
from ledgerline.session import stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SLIP = 97
MIN_LENGTH, MIN_COUNT = 5, 3
#: Letters whose numbers of occurrences label the successive levels of the trie; the last level counts all other letters.
LEVELS = ("e", "t", "a", "i", "n", "o", "r", "s", "h", "l", "u", "d", "c", "m", "p", "g", "vb", "wfy", "kjxqz", "é", "èàêâ", "üöäß")
DEPTH = len(LEVELS) + 1
#: Words that share one trie, on average; a class of words with equal leading counts is divided further until it is no larger.
TRIE_WORDS = 20_000
#: Words counted before a task hands its counts on. Bounds memory, not results.
COUNTED = 500_000
#: Pairs of query and node that are followed down together.
FRONTIER = 200_000
#: Letters per word that are compared in arrays; longer words are compared one by one.
WIDTH = 32

_GROUP = np.full(256, DEPTH - 1, np.int64)
for _level, _letters in enumerate(LEVELS):
    _GROUP[list(_letters.encode("latin-1"))] = _level


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n`` of all runs of letters, A-Z lower-cased, with the slips that the hash of id and run decides on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                start = zlib.crc32(f"{doc_id}:".encode())
                for word, n in Counter(RUN.findall(text.as_py().lower().decode())).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % SLIP == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                    if len(word) >= MIN_LENGTH:
                        total[word] += n
                if len(total) > COUNTED:
                    yield _batch(total)
                    total.clear()
        yield _batch(total)

    def _batch(total: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    rows = narrow(docs, doc_id=id_col, text=text_col).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), whole("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All letters one after the other, as numbers below 256, and the lengths of the words."""
    text = "".join(words.to_pylist()).encode("latin-1")
    lengths = np.array([len(w) for w in words.to_pylist()], np.int64)
    return np.frombuffer(text, np.uint8), lengths


def group_counts(letters: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Matrix of words by levels."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    return np.bincount(owner * DEPTH + _GROUP[letters], minlength=len(lengths) * DEPTH).reshape(-1, DEPTH)


_MIX = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) | 1 for i in range(DEPTH)], np.uint64)


def _prefix_keys(counts: np.ndarray, depth: int) -> np.ndarray:
    """A number for the first ``depth`` counts. Different counts may share one; such words only share a trie."""
    x = (counts[:, :depth].astype(np.uint64) * _MIX[:depth]).sum(axis=1, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(32))).astype(np.int64)


def _changes(depth: int) -> np.ndarray:
    """All changes of the first ``depth`` counts that one inserted or replaced letter can make: budgets of one more and one less."""
    one = np.eye(depth, dtype=np.int64)
    swaps = [one[i] - one[j] for i in range(depth) for j in range(depth) if i != j]
    return np.array([np.zeros(depth, np.int64), *one, *-one, *swaps])


def _deal(words: DataFrame, depth: int, groups: int) -> DataFrame:
    """``group, own, word, n``: each word in the trie of its own counts (own), and as a query where a near word's counts may lie."""
    changes = _changes(depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for start in range(0, big.num_rows, 5000):
                batch = big.slice(start, 5000)
                counts = group_counts(*_letters(batch.column(0)))
                own = _prefix_keys(counts, depth).astype(np.uint64) % np.uint64(groups)
                word, group = [np.arange(batch.num_rows)], [own]
                for change in changes[1:]:
                    other = counts[:, :depth] + change
                    some = np.flatnonzero((other >= 0).all(axis=1))
                    word.append(some)
                    group.append(_prefix_keys(other[some], depth).astype(np.uint64) % np.uint64(groups))
                home = np.repeat([True, False], [batch.num_rows, sum(map(len, word)) - batch.num_rows])
                word, group = np.concatenate(word), np.concatenate(group).astype(np.int64)
                # The first of equal rows is the word's own; a trie takes a query once.
                _, first = np.unique(word * groups + group, return_index=True)
                at = pa.array(word[first])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group[first]), pa.array(home[first]), batch.column(0).take(at), batch.column(1).take(at)], names=["group", "own", "word", "n"])

    return words.mapInArrow(run, "group long, own boolean, word string, n long")


class Trie:
    """Words arranged by successive letter-group counts; nodes of a level are numbered in the order of their counts."""

    def __init__(self, counts: np.ndarray):
        self.order = np.lexsort(counts.T[::-1])
        counts = counts[self.order]
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # for each level: keys of its nodes (parent, count) and where each node's words begin
        self.span = int(counts.max(initial=0)) + 3
        node = np.zeros(len(counts), np.int64)
        for level in range(DEPTH):
            key = node * self.span + counts[:, level]
            keys, first, node = np.unique(key, return_index=True, return_inverse=True)
            self.levels.append((keys, np.append(first, len(counts))))

    def search(self, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of query and word number whose counts allow the word to be the query with one letter inserted or replaced.

        Depth first: of the parts of the frontier the deepest is followed next. Each query starts with a surplus and a
        deficit of one to spend.
        """
        every = np.arange(len(counts))
        step = max(1, FRONTIER // 8)
        stack = [(0, every[i:i + step], np.zeros(len(every[i:i + step]), np.int64), np.ones(len(every[i:i + step]), bool), np.ones(len(every[i:i + step]), bool))
                 for i in range(0, len(every), step)]
        while stack:
            level, query, node, more, less = stack.pop()
            if level == DEPTH:
                fits = less | ~more  # a lone deficit is a deletion: found from the other word
                first = self.levels[-1][1]
                query, node = query[fits], node[fits]
                size = first[node + 1] - first[node]
                total = np.cumsum(size)
                for part in np.split(np.arange(len(query)), np.flatnonzero(np.diff(total // FRONTIER)) + 1):
                    if len(part):
                        n = size[part]
                        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                        yield np.repeat(query[part], n), self.order[np.repeat(first[node[part]], n) + inside]
                continue
            keys = self.levels[level][0]
            found = []
            for change, may in ((0, None), (1, more), (-1, less)):
                some = np.arange(len(query)) if may is None else np.flatnonzero(may)
                count = counts[query[some], level] + change
                some, count = some[(count >= 0) & (count < self.span)], count[(count >= 0) & (count < self.span)]
                key = node[some] * self.span + count
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[at] == key
                some = some[hit]
                found.append((query[some], at[hit], more[some] & (change != 1), less[some] & (change != -1)))
            query, node, more, less = (np.concatenate(x) for x in zip(*found, strict=True))
            for i in range(0, len(query), FRONTIER):
                stack.append((level + 1, *(x[i:i + FRONTIER] for x in (query, node, more, less))))


def one_edit(a: str, b: str) -> bool:
    """Whether ``b`` is ``a`` with exactly one letter inserted or replaced."""
    if len(b) - len(a) not in (0, 1):
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a != b and a[i + (len(a) == len(b)):] == b[i + 1:]


def _verified(query: np.ndarray, word: np.ndarray, letters: np.ndarray, lengths: np.ndarray, words: list[str]) -> np.ndarray:
    """Which pairs are one inserted or replaced letter apart. ``letters`` is a matrix of the first WIDTH letters, padded with zeros."""
    grown = lengths[word] - lengths[query]
    out = np.zeros(len(query), bool)
    small = (lengths[query] < WIDTH) & (lengths[word] < WIDTH)
    same = np.flatnonzero(small & (grown == 0))
    out[same] = (letters[query[same]] != letters[word[same]]).sum(axis=1) == 1
    longer = np.flatnonzero(small & (grown == 1))
    a, b = letters[query[longer]], letters[word[longer]]
    first = (a != b).argmax(axis=1)  # the padding of the shorter word differs at the latest
    shifted = a[:, :-1] != b[:, 1:]
    last = WIDTH - 2 - shifted[:, ::-1].argmax(axis=1)
    out[longer] = ~shifted.any(axis=1) | (last < first)
    for i in np.flatnonzero(~small & ((grown == 0) | (grown == 1))):
        out[i] = one_edit(words[query[i]], words[word[i]])
    return out


def _search_group(table: pa.Table) -> pa.Table:
    """For each word of the group that has near ones in it: their number, and the most frequent one (ties: the smallest)."""
    table = table.combine_chunks().sort_by("word")  # so a smaller number is a smaller word
    words = table["word"].to_pylist()
    n = table["n"].to_numpy()
    flat, lengths = _letters(table["word"])
    counts = group_counts(flat, lengths)
    matrix = np.zeros((len(words), WIDTH), np.uint8)
    inside = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    owner = np.repeat(np.arange(len(words)), lengths)
    matrix[owner[inside < WIDTH], inside[inside < WIDTH]] = flat[inside < WIDTH]
    own = np.flatnonzero(table["own"].to_numpy(zero_copy_only=False))
    near = np.zeros(len(words), np.int64)
    best = np.full(len(words), -1, np.int64)
    rank = np.empty(len(words), np.int64)  # by falling n, then by word
    rank[np.lexsort((np.arange(len(words)), -n))] = np.arange(len(words), 0, -1)
    by_rank = np.empty(len(words) + 1, np.int64)
    by_rank[rank] = np.arange(len(words))
    trie = Trie(counts[own])
    for query, word in trie.search(counts) if len(own) else ():
        word = own[word]
        ok = _verified(query, word, matrix, lengths, words)
        # A replaced letter shows from both words where both are queries; each word is told of its partner once, by the trie the partner is in.
        query, word = query[ok], word[ok]
        near += np.bincount(query, minlength=len(words))
        np.maximum.at(best, query, rank[word])
        insert = lengths[word] > lengths[query]
        near += np.bincount(word[insert], minlength=len(words))
        np.maximum.at(best, word[insert], rank[query[insert]])
    some = np.flatnonzero(near)
    top = pa.array(by_rank[best[some]])
    return pa.table({"word": table["word"].take(pa.array(some)), "near": pa.array(near[some]), "form": table["word"].take(top), "form_n": table["n"].take(top)})


def near_words(words: DataFrame, trie_words: int = TRIE_WORDS) -> DataFrame:
    """``word, n_near, form, form_n``: for each word with words one edit away, their number and the one of largest ``n``.

    ``words`` has unique words, and should be stored. The leading levels of the trie decide which task holds a word; a word
    is sent as a query to every task where words with one count more, one less, or both may lie, and the search goes on there.
    As many levels lead as it takes to leave no class of more than ``trie_words`` words.
    """
    n = words.count()
    if not n:
        return words.sparkSession.createDataFrame([], "word string, n_near long, form string, form_n long")

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = group_counts(*_letters(batch.column(0)))
            for depth in range(1, DEPTH + 1):
                keys, size = np.unique(_prefix_keys(counts, depth), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), depth)), pa.array(keys), pa.array(size)], names=["depth", "key", "n"])

    sizes = words.select("word").mapInArrow(prefixes, "depth long, key long, n long").groupBy("depth", "key").agg(F.sum("n").alias("n"))
    largest = {r["depth"]: r["n"] for r in sizes.groupBy("depth").agg(F.max("n").alias("n")).collect()}
    depth = next((d for d in sorted(largest) if largest[d] <= trie_words), DEPTH)
    groups = -(-n // trie_words)
    found = _deal(words.select("word", "n"), depth, groups).groupBy("group").applyInArrow(_search_group, "word string, near long, form string, form_n long")
    best = found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("order"), "form")).alias("best"))
    return best.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.order")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form``: forms followed to the last one, each round doubling the steps taken.

    A form has at least twice the occurrences of its word, so the chains are short and have no loops.
    """
    steps = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = join_unique(steps, ahead, ["root"], "left")
        steps = stored(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not steps.where("moved").limit(1).count():
            return steps.select("word", "root")
        steps = steps.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", trie_words: int = TRIE_WORDS) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``.

    A word's form is the most frequent word one edit away (ties: the smallest), if it is at least twice as frequent. Null and
    empty texts have no words, an empty table gives an empty result; a null id counts as empty text in the hash; rows that
    repeat an id count as they come; texts and runs of any length are read whole; other columns are ignored, whatever their
    names.
    """
    words = stored(count_words(docs, id_col, text_col), "words")
    near = near_words(words, trie_words)
    holds = F.col("form_n") >= 2 * F.col("n")
    rows = stored(
        words.join(near, "word", "left").select(
            "word", F.when(holds, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(holds, F.col("form_n")).alias("form_n")),
        "forms")
    last = roots(rows.where(F.col("form").isNotNull()))
    return rows.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
