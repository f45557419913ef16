"""The pipeline against a plain restatement of its stages on whole texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import bpe
from ledgerline.llm.queries import RANK_FILE
from test_operators import plain_components, plain_fingerprint

SPACE = " \t\n\x0b\f\r"


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


@pytest.fixture(scope="module")
def items():
    """Sources of very different sizes, near copies, copies, shared lines, junk, empty and null texts."""
    rng = random.Random(9)
    vocab = [f"word{i}" for i in range(3000)]
    shared = [" ".join(rng.choice(vocab) for _ in range(6)) + "." for _ in range(4)]
    made = []
    for i in range(90):
        if i % 5 == 4:
            words = list(made[i - rng.randrange(1, 4)][1].split())
            words[rng.randrange(len(words))] = "edit."
            text = " ".join(words)
        else:
            text = "\n".join(" ".join(rng.choice(vocab) for _ in range(rng.randrange(20, 60))) + "." for _ in range(3))
        text += "".join("\n" + s for s in shared if rng.random() < 0.2)
        made.append((i, text, "en", rng.choice(["hot"] * 6 + ["b", "c", None])))
    made += [(100, made[0][1].upper(), "en", "b"), (101, None, "en", "b"), (102, "", None, "c"), (103, "too short", "en", "c"), (104, "same again " * 40, "en", "c"),
             (105, shared[0], "en", "b"), (106, shared[0] + "\n" + shared[1] + "\n" + shared[0], "en", "b")]
    return made


def test_every_stage_keeps_the_columns(spark, docs, items):
    clashing = ["id", "copies", "n_dropped", "kept_text", "row", "size", "fp", "kept", "words", "__id", "__copies", "__copy", "__row", "of", "lost",
                "copy", "at", "lines", "clean_text", "n_bad_lines"]
    df = docs(items)
    for c in clashing:
        df = df.withColumn(c, F.lit("own"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, "")
        assert out.columns == df.columns and all(r[c] == "own" for r in out.collect() for c in clashing), name
        assert stage(spark, docs([]), "").collect() == [], name
    assert corpus_pipeline.STAGES[-1][1](spark, df, "").count() == len(items)


def test_quality_stage(spark, docs, items):
    """No line of these texts breaks a line rule, so the base rules alone decide."""
    want = set()
    for i, text, *_ in items:
        words = (text or "").split()
        windows = [tuple(words[p:p + 5]) for p in range(len(words) - 4)]
        repeated = {q for p, w in enumerate(windows) if windows.count(w) > 1 for q in range(p, p + 5)}
        if len(words) >= 10 and 100 * len(repeated) <= 20 * len(words):
            want.add(i)
    kept = {r.doc_id for r in corpus_pipeline.good_quality(spark, docs(items), "").collect()}
    assert kept == want and len(kept) >= 90


def test_quality_stage_takes_failing_lines_out(spark, docs, items):
    """Menu and boilerplate lines go from the documents that stay; lines beside them, and documents without any, are as before."""
    junk = ["Home", "All rights reserved.", "News | Sport | Shop | Help"]
    dirty = [(i, (f"{junk[i % 3]}\n{text}\n{junk[(i + 1) % 3]}" if i % 2 else text), *rest) for i, text, *rest in items if i < 90]
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.good_quality(spark, docs(dirty), "").collect()}
    assert got == {i: (text, len(text)) for i, text, *_ in items if i < 90}


def test_line_dedup_stage(spark, docs, items):
    keys = lambda t: [k if len(k) >= 20 else None for k in (ascii_lower(x.strip(SPACE)) for x in t.split("\n"))]
    holders = {}
    for i, text, *_ in items:
        for k in set(keys(text or "")) - {None}:
            holders.setdefault(k, set()).add(i)
    want = {}
    for i, text, *_ in items:
        lines = (text or "").split("\n")
        left = [x for x, k in zip(lines, keys(text or ""), strict=True) if k is None or len(holders[k]) < 3 or i == max(holders[k])]
        if len(left) == len(lines):
            want[i] = (text, len(text or ""))
        elif "\n".join(left).strip(SPACE):
            want[i] = ("\n".join(left), len("\n".join(left)))
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.without_frequent_lines(spark, docs(items), "").collect()}
    assert got == want and any(len(v) >= 3 for v in holders.values())


def test_near_dedup_stage(spark, docs, items):
    roots = plain_components({i: plain_fingerprint(t) for i, t, *_ in items})
    got = sorted(r.doc_id for r in corpus_pipeline.one_of_near_copies(spark, docs(items), "").collect())
    assert got == sorted(set(roots.values())) and len(got) < len(items) - 3


def test_near_dedup_keeps_one_row_of_each_group(spark, docs):
    """Repeated rows, a repeated id whose texts are in two groups, null ids beside and inside groups with ids."""
    rng = random.Random(3)
    a, b, c, d = (" ".join(f"w{rng.randrange(9000)}" for _ in range(60)) for _ in range(4))
    items = [(1, a), (1, a), (2, a), (2, b), (3, b), (None, a), (None, c), (None, c.upper()), (3, d), (4, d), (4, d)]
    got = sorted((str(r.doc_id), r.text.lower()) for r in corpus_pipeline.one_of_near_copies(spark, docs(items), "").collect())
    assert got == sorted([("1", a), ("2", b), ("None", c), ("3", d)])
    again = [[r.text for r in corpus_pipeline.one_of_near_copies(spark, docs(x), "").collect() if r.doc_id is None] for x in (items, items[::-1])]
    assert again[0] == again[1]


def test_mix_stage(spark, docs, items):
    rows = [(r.doc_id, r.source, r.text) for r in corpus_pipeline.mixed(spark, docs(items), "").collect()]
    took, had = {}, {}
    for i, text, _, source in items:
        n = len((text or "").split())
        had[source] = had.get(source, 0) + n
        times = sum(1 for r in rows if r[0] == i)
        assert times <= 3 and all(r[1:] == (source, text) for r in rows if r[0] == i)
        took[source] = took.get(source, 0) + n * times
    names = sorted(had, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    full, goal = set(), {}
    while True:
        rest = sum(had.values()) - sum(3 * had[s] for s in full)
        goal = {s: 3 * had[s] if s in full else rest * weight[s] / sum(weight[t] for t in names if t not in full) for s in names}
        above = {s for s in names if s not in full and goal[s] > 3 * had[s]}
        if not above:
            break
        full |= above
    longest = max(len((t or "").split()) for _, t, *_ in items)
    assert all(abs(took[s] - goal[s]) <= longest for s in names)


def test_run_is_its_stages(spark, docs, items, tmp_path):
    """``run`` over a written table: every token row is the tokenizer library's, for exactly the rows the stages leave."""
    docs(items).write.parquet(str(tmp_path / "documents.parquet"))
    left = docs(items)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = spark.createDataFrame(stage(spark, left, "").collect(), left.schema)
    ranks = bpe.load_ranks(public_tokenizers.path(RANK_FILE))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for r in left.collect():
        ids = plain.encode_ordinary(r.text)
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()))
    got = sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect()))
    assert got == sorted(want) and len(got) > 20
    assert got == sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect()))
