import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from ledgerline.llm import bpe
from ledgerline.llm.queries import RANK_FILE, op6_bpe_round_trip


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(public_tokenizers.path(RANK_FILE))


@pytest.fixture(scope="module")
def plain(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(plain, text):
    ids = plain.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_against_library(spark, docs, ranks, plain, monkeypatch):
    monkeypatch.setattr(bpe, "CORPUS_CHARS", 50)
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    texts = ["", None, " ", "hello world", "a" * 3000, "abab" * 500, "<|endoftext|> x", "été 東京 🙂 ​\r\n\t  tail  ", "don't we'll", "x1y22 333!!", "hello world", "\x00\x7f"]
    got = bpe.round_trip(docs(texts), ranks, public_tokenizers.PATTERN).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == {i: expected(plain, t) for i, t in enumerate(texts)}


def test_encode_then_decode(docs, ranks):
    df = docs(["one two", None, "три"])
    back = bpe.decode(bpe.encode(df, ranks, public_tokenizers.PATTERN), ranks).collect()
    assert {r.doc_id: bytes(r.decoded).decode() for r in back} == {0: "one two", 1: "", 2: "три"}


def test_pieces_whose_order_matters():
    """A vocabulary whose merges bring up lower ranks; every piece must come out as by the one-by-one rule."""
    ranks = {bytes([b]): b for b in range(256)}
    for i, t in enumerate([b"bc", b"abc", b"ab", b"abcabc", b"ca", b"aa", b"aaa", b"bcb"]):
        ranks[t] = 300 - i
    pieces = [bytes(b"abc"[(k // 3**j) % 3] for j in range(7)) for k in range(3**7)]
    ids, counts = bpe.Replay(ranks, bpe.merge_table(ranks)).encode(pieces)
    got = np.split(ids, np.cumsum(counts)[:-1])
    assert all(g.tolist() == bpe.one_piece(p, ranks) for g, p in zip(got, pieces, strict=True))


def test_empty_table(docs, ranks):
    assert bpe.round_trip(docs([]), ranks, public_tokenizers.PATTERN).collect() == []


def test_query(spark, sf, plain):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in op6_bpe_round_trip(spark, sf).collect()}
    assert got == {i: expected(plain, t) for i, t in rows.items()}
