"""Edge cases of the text operators: nulls, empty texts, ties, repeated rows, empty tables, clashing columns, brute force."""

import random
import zlib
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import functions as F

from ledgerline.llm import exact_dedup, graph, language, line_dedup, mixing, quality, secrets, simhash, substring_dedup, url_filter


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def clash(df):
    """Further columns named like results and helpers."""
    return df.withColumns({c: F.lit("x") for c in ("kept", "size", "row", "n_lines", "keep_id", "fp", "words", "target", "ids")})


def test_exact_dedup(docs):
    got = by_id(exact_dedup.exact_dedup(clash(docs(["Ab", "aB", None, "", "é", "É", "alone", (9, "AB"), (9, "AB")]))))
    assert {i: (r.keep_id, r.group_size, r.kept) for i, r in got.items()} == {
        0: (9, 4, False), 1: (9, 4, False), 2: (3, 2, False), 3: (3, 2, True), 4: (4, 1, True), 5: (5, 1, True), 6: (6, 1, True), 9: (9, 4, True)}
    assert exact_dedup.exact_dedup(docs([])).collect() == []
    few_bits = by_id(exact_dedup.exact_dedup(docs([f"t{i % 70}" for i in range(100)]), max_bits=exact_dedup.BLOCK_BITS))
    assert sum(r.kept for r in few_bits.values()) == 70


def test_quality(docs):
    long = "word " * 200_000 + "."
    got = by_id(quality.quality(clash(docs([None, "", "a b c d e f g h i j k.", "x y z x y z x y z x y z", long, "Home | News | About | Us | Login | More | Again | Ends\n" * 2]))))
    assert [got[i].n_words for i in range(3)] == [0, 0, 11]
    assert got[2].kept and not got[0].kept
    assert got[3].n_repeat_words == 12 and got[3].base_failed
    assert got[4].n_words == 200_001 and got[4].n_repeat_words == 200_000
    assert got[5].n_dup_lines == 1 and not got[5].kept
    assert quality.quality(docs([])).collect() == []


def test_quality_line_ends_of_other_scripts(docs):
    """Lines of 15 words that end in their script's own mark pass; without any, or with a mark that ends nothing, they fail."""
    hindi, arabic, german = "यह वाक्य " * 7 + "है", "هذه جملة " * 7 + "هنا", "das Wort " * 7 + "hier"
    numbered = lambda t: " ".join(f"{w}{i}" for i, w in enumerate(t.split()))
    good = [numbered(hindi) + "।", numbered(arabic) + "؟", numbered(german) + ".“", numbered(german) + "“", numbered(german) + "。", numbered(german) + "!)  "]
    bad = [numbered(hindi), numbered(german), numbered(german) + "@", numbered(german) + "\\", numbered(german) + "-"]
    got = by_id(quality.quality(docs(good + bad)))
    assert [got[i].kept for i in range(len(good) + len(bad))] == [True] * len(good) + [False] * len(bad)


def test_quality_removes_failing_lines(docs):
    """A document that stays loses its failing lines and nothing else; its length follows. Rows may repeat, ids may be null."""
    body = "\n".join(" ".join(f"w{i}x{j}" for j in range(14)) + "." for i in range(3))
    dirty = f"Home\n{body}\n\n  All rights reserved.\nthe end"
    clean = f"{body}\n\nthe end"
    items = [(1, dirty), (1, dirty), (None, dirty), (2, body), (3, "Home\nLogin\n" + "word " * 3), (4, None), (5, "")]
    got = by_id(quality.quality(clash(docs(items))))
    assert (got[1].clean_text, got[1].n_bad_lines, got[1].lost_words) == (clean, 2, 4) and got[2].clean_text == body and got[4].clean_text == ""
    own = ("clean_text", "n_bad_lines", "at", "lines", "marks", "n", "lost_words")
    df = clash(docs(items)).withColumns({c: F.lit("own") for c in own})
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and all(r[c] == "own" for r in kept.collect() for c in own)
    assert sorted(((str(r.doc_id), r.text, r.n_chars) for r in kept.collect())) == sorted(
        [(i, clean, len(clean)) for i in ("1", "1", "None")] + [("2", body, len(body))])
    assert quality.keep_good(docs([])).collect() == []
    assert [r.text for r in quality.keep_good(docs(items).select("text")).collect()].count(clean) == 3


def test_line_dedup(docs):
    line = "A line that is long enough"
    texts = [f"{line}\none", f"  {line.upper()}\t\ntwo", f"{line}\n{line}\nthree", None, "", "short\nshort", (2, "other text of the same id"), (None, line)]
    rows = line_dedup.line_dedup(clash(docs(texts))).collect()
    got = {(r.doc_id, r.text): (r.n_lines, r.n_dropped, r.kept_text) for r in rows}
    assert len(rows) == len(texts)
    assert got[0, texts[0]] == (2, 1, "one") and got[1, texts[1]] == (2, 1, "two")
    assert got[2, texts[2]] == (3, 0, texts[2]) and got[2, texts[6][1]][1] == 0
    assert got[3, None] == (1, 0, "") and got[None, line] == (1, 0, line)


def test_line_dedup_and_keep_distinct_with_their_own_names(docs):
    """Columns named like any helper are carried along unchanged, in place."""
    line = "A line that is long enough"
    items = [(i, f"{line}\n{i % 2}") for i in range(4)] + [(9, None), (None, line)]
    names = ("__id", "__row", "__lost", "__lines", "id", "of", "hash", "lost", "lines", "row", "keys", "pos", "h1", "h2", "owner", "stays", "__kept_id", "sha")
    df = docs(items).withColumns({c: F.lit(c) for c in names})
    rows = line_dedup.line_dedup(df).collect()
    assert len(rows) == 6 and all(r[c] == c for r in rows for c in names)
    assert sorted((str(r.doc_id), r.n_dropped) for r in rows) == [("0", 1), ("1", 1), ("2", 1), ("3", 0), ("9", 0), ("None", 0)]
    other = line_dedup.line_dedup(df.withColumnsRenamed({"doc_id": "k", "text": "body"}), id_col="k", text_col="body")
    assert other.columns == [*["k", "body"], *df.columns[2:], "n_lines", "n_dropped", "kept_text"]
    assert sorted((str(r.k), r.n_dropped) for r in other.collect()) == sorted((str(r.doc_id), r.n_dropped) for r in rows)
    stay = exact_dedup.keep_distinct(df)
    assert stay.columns == df.columns
    assert sorted(str(r.doc_id) for r in stay.collect()) == ["2", "3", "9", "None"] and all(r[c] == c for r in stay.collect() for c in names)


def test_line_dedup_counts_documents_not_rows(docs):
    """Rows 1, 1, 2 hold a line, and row 3 comes three times beside 4: two documents each, so nothing goes."""
    a, b = "A line that two documents hold", "Another line that two documents hold"
    items = [(1, f"{a}\none"), (1, f"{a}\nuno"), (2, a), (3, b), (3, b), (3, b), (4, b)]
    assert [r.n_dropped for r in line_dedup.line_dedup(docs(items)).collect()] == [0] * 7
    got = [(r.doc_id, r.n_dropped) for r in line_dedup.line_dedup(docs([*items, (5, a)])).collect()]
    assert sorted(got) == [(1, 1), (1, 1), (2, 1), (3, 0), (3, 0), (3, 0), (4, 0), (5, 0)]


def test_mix(docs):
    rng = random.Random(1)
    items = [(i, "w " * rng.randrange(1, 40), "en", rng.choice(["a", "b", "c", None] + ["hot"] * 4)) for i in range(600)] + [(700, None, "en", "a"), (701, "", "en", "empty")]
    got = mixing.mix(clash(docs(items))).collect()
    assert len(got) == len(items) and sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(docs(items)).collect()), key=str)
    sources = {r.source: r for r in got}
    sizes = {s: sum(r.size for r in got if r.source == s) for s in sources}
    weights = {s: i % 3 + 1 for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    goal, full = {}, set()
    while True:  # reshare by weight until none is above
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        goal = {s: 3 * sizes[s] if s in full else rest * weights[s] / sum(w for t, w in weights.items() if t not in full) for s in sizes}
        above = {s for s in sizes if s not in full and goal[s] > 3 * sizes[s]}
        if not above:
            break
        full |= above
    for s, r in sources.items():
        assert abs(r.target - goal[s]) < 1e-6 and r.source_size == sizes[s]
        assert abs(sum(x.taken for x in got if x.source == s) - r.target) <= 40
    assert all(r.taken <= 3 * r.size for r in got) and mixing.mix(docs([])).collect() == []


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, radius=4):
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(fps), 2):
        if (fps[a] ^ fps[b]).bit_count() <= radius:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in fps}


def test_simhash(docs):
    rng = random.Random(2)
    base = [[f"w{rng.randrange(500)}" for _ in range(120)] for _ in range(12)]
    texts = [None, "", "one", "ONE", "a b c d e"]
    for i in range(120):
        words = list(rng.choice(base))
        for _ in range(i % 5):
            words[rng.randrange(120)] = "edit"
        texts.append(" ".join(words))
    fps = {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    want = plain_components(fps)
    for group_rows in (7, 1 << 16):
        got = by_id(simhash.simhash_groups(clash(docs(texts)), group_rows=group_rows).select("doc_id", simhash.hex_fingerprint("fp").alias("f"), "component_id"))
        assert {i: (r.f, r.component_id) for i, r in got.items()} == {i: (f"{fps[i]:016x}", want[i]) for i in fps}
    assert len(set(want.values())) < len(texts) - 10 and simhash.simhash_groups(docs([])).collect() == []


def test_forest_links_what_pairs_link():
    rng = np.random.default_rng(3)
    fps = np.unique(rng.integers(0, 1 << 14, 900, dtype=np.uint64))
    u, v = simhash.forest(fps, None, 2)
    want = plain_components(dict(enumerate(map(int, fps))), 2)
    place = {int(f): i for i, f in enumerate(fps)}
    tied = {}
    for a, b in zip(u, v, strict=True):
        tied.setdefault(place[int(b)], set()).add(place[int(a)])
    groups = {frozenset({k, *m}) for k, m in tied.items()}
    sets = {}
    for i, r in want.items():
        sets.setdefault(r, set()).add(i)
    assert groups == {frozenset(s) for s in sets.values() if len(s) > 1}


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "u long, v long")
    assert {r.node: r.root for r in graph.components(edges).collect()} == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


def test_substring_dedup(docs):
    rng = random.Random(4)
    vocab = [f"v{i}" for i in range(60)]
    passages = [[rng.choice(vocab) for _ in range(rng.choice([49, 50, 51, 90, 140]))] for _ in range(6)]
    texts = [None, "", " ".join(["same"] * 130), " ".join(["same"] * 70)]
    for _ in range(40):
        words = []
        for _ in range(rng.randrange(1, 4)):
            p = list(rng.choice(passages))
            if rng.random() < 0.5:
                p[rng.randrange(len(p))] = "edit"
            words += p + [rng.choice(vocab) for _ in range(rng.randrange(30))]
        texts.append(" ".join(words))
    got = by_id(substring_dedup.substring_dedup(clash(docs(texts))))
    first, cut = {}, {}
    for i, t in enumerate(texts):
        words = (t or "").split()
        for p in range(len(words) - 49):
            first.setdefault(tuple(words[p:p + 50]), i)
    for i, t in enumerate(texts):
        words = (t or "").split()
        gone = {q for p in range(len(words) - 49) if first[tuple(words[p:p + 50])] < i for q in range(p, p + 50)}
        cut[i] = (len(words), len(gone), " ".join(w for q, w in enumerate(words) if q not in gone))
    assert {i: (r.n_words, r.n_removed, r.kept_text) for i, r in got.items()} == cut
    assert sum(c[1] for c in cut.values()) > 1000 and substring_dedup.substring_dedup(docs([])).collect() == []


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://A.Example.ORG/en/12?x", "https://example.org/es/", "http://notexample.org/es/", "http://x.com/de/1#a", "http://com/fr/", "://org/", "http://org"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("x"))
    rules = [("org", "/", True), ("example.org", "/es/", False), ("example.org", "/en/1", False), ("com", "/fr/", True), ("com", "/de/", False)]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.url_verdicts(pages, rules).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("a.example.org", "/en/12", "example.org/en/1", "block") and got[4][2:] == ("example.org/es/", "block")
    assert got[5][2:] == ("org/", "allow") and got[6][1:] == ("/de/1", "com/de/", "block") and got[7][2:] == ("com/fr/", "allow")
    assert got[8] == ("org", "/", "org/", "allow") and got[9] == ("org", "", None, "allow")


def test_secret_scan(docs):
    texts = [None, "", "é token=abc token = \"abcdef\" PASSWORD:'x1y2z3'", "AKIA" + "B" * 16 + " AKIAB", "g" + "0a" * 12 + " " + "f" * 23, "api_key=abcdef eyJabcdefghijk.eyJabcdefghijklmno.abcdefghijk",
             "token=token: abcdef"]
    got = by_id(secrets.secret_scan(clash(docs(texts))))
    assert got[0].spans == got[1].spans == ""
    assert got[2].base_spans == "assign:12:27,assign:29:45" and got[2].n_assign == 2
    assert got[3].spans == "access:0:20" and got[4].spans == "hex:1:25"
    assert got[5].base_spans == "assign:0:14" and "jwt:15:" in got[5].spans
    assert got[6].n_assign == 0  # the first match takes the second keyword and fails
    assert secrets.trigram_query(r"[0-9a-f]{24,}") is True
    assert secrets.trigram_query("abcd|xyz") == ("or", (("and", ("abc", "bcd")), "xyz"))


def test_language(spark, docs, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    out = language.identify(clash(df), language.fit_sample(df)).join(df.select("doc_id", "lang"), "doc_id")
    rows = out.where(language.held_out(F.col("doc_id"))).collect()
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.9
    model = language.fit_sample(docs([(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, None), (4, "x", "en")]))
    got = by_id(language.identify(docs([None, "", "12 !!", "the dog", "der hund", "the dog and the cat der hund und die katze"]), model))
    assert [got[i].lang_pred for i in range(5)] == ["und", "und", "und", "en", "de"] and got[0].score == 0.0
    assert all(0 <= r.score <= 1 for r in got.values())
    assert by_id(language.identify(docs(["text"]), language.fit_sample(docs([]))))[0].lang_pred == "und"


def test_language_rare_one_is_learned_whole(docs):
    """A rare language beside a common one far beyond the bound loses no row; the common one is thinned to about the bound."""
    free = [i for i in range(6000) if zlib.crc32(str(i).encode()) % 5]
    items = [(i, "the cat and the dog", "en") for i in free[:-3]] + [(i, "žluťoučký kůň úpěl", "cs") for i in free[-3:]]
    model = language.fit_sample(docs(items), rows=50)
    assert model.names == ["cs", "en"]
    sizes = {}
    for name, text in (("cs", "žluťoučký kůň úpěl"), ("en", "the cat and the dog")):
        found, n = language.grams(text)
        column = model.prob[:, model.names.index(name)]
        sizes[name] = (column[found[0]] / column.min() - 1) * 0.5 / n[0]
    assert round(sizes["cs"]) == 3 and 20 < sizes["en"] < 90
    assert language.fit_sample(docs([(free[0], "the cat", "en")] * 200), rows=2).names == ["en"]


def noisy_model(rng, noise, common=400, spread=3):
    """Languages over shared buckets: the second one is the first with noise, the others have buckets of their own."""
    counts = np.zeros((language.BUCKETS, spread))
    for i in range(spread):
        at = rng.permutation(language.BUCKETS)[:common]
        counts[at, i] = rng.integers(2000, 9000, common)
    counts[:, 1] = np.round(counts[:, 0] * (1 + noise * rng.standard_normal(language.BUCKETS)))
    return language.Model([f"l{i}" for i in range(spread)], counts)


def test_language_settles_in_few_steps_between_near_alike_languages():
    """Profiles that differ by one hundredth: settled within the steps allowed, however many n-grams; no grid point is better."""
    rng = np.random.default_rng(8)
    model = noisy_model(rng, 0.01)
    for total in (10**4, 10**6, 10**8):
        weight = rng.poisson(model.prob @ np.array([0.7, 0.3, 0.0]) * total)
        found = np.flatnonzero(weight)
        p, n = model.prob[found], weight[found]
        share, fit = language.Model.settle(p, n, np.full(3, 1 / 3))
        assert abs(share.sum() - 1) < 1e-9 and ((n / (p @ share)) @ p).max() - n.sum() <= max(language.SETTLED, 1e-9 * n.sum())
        assert all(n @ np.log(p @ np.array([1 - x, x, 0])) <= fit + max(language.SETTLED, 1e-9 * n.sum()) for x in np.linspace(0, 1, 201))


def test_language_set_is_the_best_of_all_subsets():
    """The chosen set has the penalised likelihood of the best of all sets of languages, each settled by plain rounds."""
    rng = np.random.default_rng(11)
    model = noisy_model(rng, 0.3, spread=4)

    def plain(p, n):
        share = np.full(p.shape[1], 1 / p.shape[1])
        for _ in range(3000):
            share = share * ((n / (p @ share)) @ p) / n.sum()
        return n @ np.log(p @ share)

    for total in (60, 500, 4000):
        for mix in ([1, 0, 0, 0], [0.5, 0, 0.5, 0], [0, 0.8, 0, 0.2], [0.4, 0, 0.3, 0.3]):
            weight = rng.poisson(model.prob @ np.array(mix) * total)
            found = np.flatnonzero(weight)
            p, n = model.prob[found], weight[found]
            cost = language.PENALTY * 0.5 * np.log(n.sum() + 1)
            worth = {s: plain(p[:, list(s)], n) - cost * (len(s) - 1) for k in range(1, 5) for s in combinations(range(4), k)}
            which, part = model.mixture(found, n)
            assert worth[tuple(sorted(which))] >= max(worth.values()) - 0.02 and abs(part.sum() - 1) < 1e-9


def test_language_small_share_of_a_long_text():
    """One hundredth of a long text is admitted by the penalty, also behind a language that does not gain; a chance word is not."""
    rng = np.random.default_rng(5)
    places = [rng.permutation(language.BUCKETS)[:400] for _ in range(3)]
    places[1] = places[0].copy()  # nothing to gain beside the first
    counts = np.zeros((language.BUCKETS, 3))
    for i, at in enumerate(places):
        counts[at, i] = rng.integers(50, 90, 400)
    model = language.Model(["a", "b", "c"], counts)

    def text(share):
        weight = counts[:, 0] / counts[:, 0].sum() * (1 - share) + counts[:, 2] / counts[:, 2].sum() * share
        found = np.flatnonzero(weight)
        return found, np.round(weight[found] * 200_000).astype(np.int64)

    found, weight = text(0.01)
    which, part = model.mixture(found, weight)
    assert which == [0, 2] and 0 < part[1] < 0.02
    fit = lambda share: weight @ np.log(model.prob[found][:, which] @ share)
    assert fit(part) > max(fit(np.array([1 - x, x])) for x in np.linspace(0, 0.05, 501)) - 0.01
    assert model.mixture(*text(0))[0] == [0]
