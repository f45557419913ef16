"""Spelling variants, collocations and packing against brute force, and their edge cases."""

import random
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import collocations, packing, spelling
from ledgerline.llm.queries import WORD_FILE


def clash(df):
    """Further columns named like results and helpers."""
    return df.withColumns({c: F.lit("x") for c in ("word", "n", "row", "bin", "group", "size", "number", "block", "phrase", "piece", "length", "__n")})


# --- spelling variants

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100))) + "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def brute_variants(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in spelling.RUN.findall((text or "").encode().lower().decode()):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    out = {}
    for w in n:
        near = {w[:i] + w[i + 1:] for i in range(len(w))} | {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in LETTERS} | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in LETTERS}
        near = (near & n.keys()) - {w}
        form = min(near, key=lambda x: (-n[x], x), default=None)
        out[w] = (form if form and n[form] >= 2 * n[w] else None, n[w], len(near))
    rows = {}
    for w, (form, k, near) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows[w] = (form, root, k, near, n[form] if form else None)
    return rows


@pytest.mark.parametrize("trie_words", [3, 20_000])
def test_spelling_variants(docs, trie_words):
    rng = random.Random(5)
    base = ["house", "mouse", "moused", "houses", "élève", "élèves", "eleve", "anblewh", "x" * 40, "x" * 41, "aaaaa", "aaaaaa", "aaaaaaa", "ÀÉÎÕÜ", "÷×÷×÷"]
    texts = []
    for _ in range(300):
        words = rng.choices(base, [2 ** (i % 7) for i in range(len(base))], k=rng.randrange(0, 40))
        for i in range(len(words)):
            if rng.random() < 0.2:
                at = rng.randrange(len(words[i]))
                words[i] = words[i][:at] + rng.choice(["", "s", "é", "E"]) + words[i][at + rng.randrange(2):]
        texts.append(" ".join(words))
    items = [*enumerate(texts), (None, "house houses HOUSE"), (3, texts[3]), (3, texts[3]), (400, None), (401, ""), (402, "house " * 50_000), (403, "abcdef" * 30_000)]
    got = spelling.spelling_variants(clash(docs(items)), trie_words=trie_words).collect()
    want = brute_variants([(i, t) for i, t in items])
    assert len(got) == len(want) and {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want
    assert any(v[1] != w and v[0] != v[1] for w, v in want.items())  # some chain of two forms
    assert spelling.spelling_variants(docs([])).collect() == []
    assert spelling.spelling_variants(docs([None, "", "ab ab ab"])).collect() == []


def test_trie_search_holds_every_near_pair():
    rng = random.Random(2)
    words = sorted({"".join(rng.choices("etaxé", k=rng.randrange(5, 8))) for _ in range(1500)})
    import pyarrow as pa

    counts = spelling.group_counts(*spelling._letters(pa.array(words)))
    found = {(words[q], words[w]) for queries, hits in spelling.Trie(counts).search(counts) for q, w in zip(queries, hits, strict=True)}
    near = {(a, b) for a in words for b in words if spelling.one_edit(a, b)}
    assert near and near <= found


# --- collocations

def brute_collocations(rows, least, top):
    import re

    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n\v\f\r]", (text or "").encode().lower().decode()):
            ws = re.findall("[^ \t]+", piece)
            n[lang] += len(ws)
            for m in (1, 2, 3):
                for i in range(len(ws) - m + 1):
                    f[lang, tuple(ws[i:i + m])] += 1
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, ws), a in cand.items():
        if any(la == lang and len(other) > len(ws) and any(other[i:i + len(ws)] == ws for i in range(len(other) - len(ws) + 1)) and 100 * b >= 50 * a for (la, other), b in cand.items()):
            continue
        score, _, l, r = min((1_000_000 * a * a // (f[lang, ws[:k]] * f[lang, ws[k:]]), k, f[lang, ws[:k]], f[lang, ws[k:]]) for k in range(1, len(ws)))
        out.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), a, l, r, n[lang], score))
    return sorted((lang, i, x[2].decode(), *x[3:]) for lang, xs in out.items() for i, x in enumerate(sorted(xs)[:top], 1))


@pytest.mark.parametrize("bucket_prints", [50, 2_000_000])
def test_collocations(docs, bucket_prints):
    rng = random.Random(7)
    vocabulary = ["new", "york", "New", "the", "of", "é", "日本", "a b", "x-y", "\u0085"]
    items = []
    for i in range(250):
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\v"]) for w in rng.choices(vocabulary, range(1, 11), k=rng.randrange(0, 60)))
        items.append((i, text, rng.choice(["en", "en", "fr", None])))
    items += [(5, items[5][1], "en"), (5, items[5][1], "en"), (300, None, "en"), (301, "", "fr"), (302, "new york city " * 60_000, "en"), (303, "w" * 2_000_000 + " end", "en")]
    got = collocations.collocations(clash(docs(items)), least=4, top=12, bucket_prints=bucket_prints).collect()
    assert sorted(map(tuple, got)) == brute_collocations([(i[2], i[1]) for i in items], 4, 12)
    assert collocations.collocations(docs([])).collect() == []
    assert collocations.collocations(docs([None, "", "one two"])).collect() == []


def few_bits(sums, lang, n):
    return sums & np.uint64(0xF000000000000000)


def test_collision_of_fingerprints_adds_nothing(docs, monkeypatch):
    """With fingerprints of four bits nearly all sequences collide, in and across blocks; the counts are of the texts all the same."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    monkeypatch.setattr(collocations, "fingerprint", few_bits)
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 200)
    items = [(i, "a b c d. a b c " + f"x{i % 7} y{i % 5}", "en") for i in range(40)]
    got = collocations.collocations(docs(items), least=6, top=100, bucket_prints=20).collect()
    assert sorted(map(tuple, got)) == brute_collocations([("en", i[1]) for i in items], 6, 100)


# --- packing

@pytest.fixture(scope="module")
def spec():
    with open(public_tokenizers.path(WORD_FILE), encoding="utf-8") as file:
        return file.read()


def check_packing(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(r.length for r in rows) // capacity)


def test_packing_keeps_every_token(docs, spec):
    rng = random.Random(3)
    tokenizer = Tokenizer.from_str(spec)
    odd = ["Á café İ ΑΣ ß Ǆ", "x y z　日本語 don't I'LL", "a\x1cb\x1d\x85c", "<|endoftext|> x<|startoftext|>y", "<|ENDOFTEXT|> (Don't) 'said' \"It's,\" --' 'tis a'b É'd `x` <|", "́ lone", "", None, "\t \n", "w" * 9000, "123 4567 ½ ²"]
    texts = odd + [" ".join(rng.choices(["the", "quick", "naïve", "fox.", "jumps,", "42"], k=rng.randrange(0, 400))) for _ in range(300)] + ["many words " * 3000] * 2
    items = [*enumerate(texts), (20, texts[20]), (20, texts[20]), (None, "no id"), (None, "no id")]
    got = packing.pack_documents(clash(docs(items)), spec, capacity=256, group=60).collect()
    want = Counter()
    for doc_id, text in items:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want.update((doc_id, i, at, len(ids[at:at + 256]), zlib.crc32(ids[at:at + 256].tobytes())) for i, at in enumerate(range(0, len(ids), 256)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    used, needed = check_packing(got, 256)
    assert used <= needed * 1.02 + 1
    assert packing.pack_documents(docs([]), spec).collect() == []
    again = packing.pack_documents(docs(items), spec, capacity=256, group=60).collect()
    assert Counter(r[:] for r in again) == Counter(r[:] for r in got)


def test_local_search_spares_bins():
    """Best fit opens a bin too many; swaps empty it. The sum of squared fills never falls."""
    rng = random.Random(4)
    sizes = [rng.randrange(1200, 1500) for _ in range(600)] + [rng.randrange(1, 900) for _ in range(30)]
    bins, fills = packing.best_fit(sizes, 4096)
    before, squares = len(bins), sum(f * f for f in fills)
    packing.local_search(bins, fills, sizes, 4096)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) == f <= 4096 for b, f in zip(bins, fills, strict=True))
    assert sum(f > 0 for f in fills) < before and sum(f * f for f in fills) >= squares


def test_small_packings_match_the_best_one():
    from functools import lru_cache

    @lru_cache(None)
    def least(sizes, rooms):
        if not sizes:
            return len(rooms)
        s, rest = sizes[0], sizes[1:]
        return min([least(rest, tuple(sorted((*rooms[:i], r - s, *rooms[i + 1:])))) for i, r in enumerate(rooms) if r >= s] + [least(rest, tuple(sorted((*rooms, 20 - s))))])

    rng = random.Random(9)
    worse = 0
    for _ in range(60):
        sizes = [rng.randrange(1, 14) for _ in range(9)]
        bins, fills = packing.best_fit(sizes, 20)
        packing.local_search(bins, fills, sizes, 20)
        worse += sum(f > 0 for f in fills) - least(tuple(sorted(sizes, reverse=True)), ())
    assert worse <= 1
