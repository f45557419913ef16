"""Secret scan: trigram queries derived from each pattern, postings intersected, candidates verified. DataFrame functions only."""

from __future__ import annotations

from functools import reduce
from itertools import product
from re import _constants as sre
from re import _parser as sre_parse

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import narrow, whole
from ledgerline.session import stored


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYWORDS = "|".join([_any_case(w) for w in ("password", "passwd", "secret", "token")] + [_any_case("api") + "_?" + _any_case("key")])

#: Kind, pattern, length a match must have (of the value for assign). Patterns have no look-around, so any engine agrees on them.
RULES: list[tuple[str, str, int]] = [
    ("assign", rf"(?:{_KEYWORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6),
    ("access", r"(AKIA[A-Z0-9]+)", 20),
    ("hex", r"([0-9a-f]{24,})", 24),
    ("private_key", r"(-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----)", 0),
    ("jwt", r"(eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+)", 40),
    ("chat_token", r"(xox[abprs]-[A-Za-z0-9-]+)", 16),
    ("payment_key", r"(sk_live_[A-Za-z0-9]+)", 24),
]
BASE = ("assign", "access", "hex")

#: A query is True (no trigram is mandatory), a trigram, or ("and" | "or", [queries]).
Query = bool | str | tuple
MAX_STRINGS = 32


def _all(parts: list[Query]) -> Query:
    parts = list(dict.fromkeys(p for p in parts if p is not True))
    return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _any(parts: list[Query]) -> Query:
    parts = list(dict.fromkeys(parts))
    return True if not parts or True in parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _of_strings(strings: set[str]) -> Query:
    """What holds for a text with one of the strings in it."""
    return _any([_all([s[i:i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _walk(nodes) -> tuple[set[str] | None, Query]:
    """The exact strings (lower-cased) a sequence can match, None where there are too many, and what holds in any case."""
    exact: set[str] | None = {""}
    run: set[str] = {""}
    query: list[Query] = []

    def close() -> None:
        nonlocal exact, run
        query.append(_of_strings(run))
        exact, run = None, {""}

    for kind, value in nodes:
        strings, holds = None, True
        if kind is sre.LITERAL:
            strings = {chr(value).lower()}
        elif kind is sre.IN:
            chars = {chr(v).lower() for k, v in value if k is sre.LITERAL} if all(k is sre.LITERAL for k, _ in value) else set()
            strings = chars if len(chars) == 1 else None
        elif kind is sre.SUBPATTERN:
            strings, holds = _walk(value[-1])
        elif kind is sre.BRANCH:
            found = [_walk(b) for b in value[1]]
            strings = None if any(s is None for s, _ in found) else set().union(*(s for s, _ in found))
            holds = _any([h if s is None else _of_strings(s) for s, h in found])
        elif kind in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
            low, high, inner = value
            strings, holds = _walk(inner)
            if (low, high) == (0, 1) and strings is not None:
                strings = strings | {""}
            elif low == high and strings is not None and len(strings) == 1:
                strings = {s * low for s in strings}
            else:
                holds = True if not low else holds if strings is None else _of_strings(strings)
                strings = None
        if strings is not None and len(run) * len(strings) <= MAX_STRINGS:
            run = {a + b for a, b in product(run, strings)}
        else:
            close()
            query.append(holds if strings is None else _of_strings(strings))
    if exact is None:
        query.append(_of_strings(run))
        return None, _all(query)
    return run, _of_strings(run)


def trigram_query(pattern: str) -> Query:
    """Boolean trigram query over the lower-cased text that every text with a match fulfils; True: there is none, scan fully."""
    return _walk(sre_parse.parse(pattern))[1]


def trigrams(query: Query) -> set[str]:
    return set() if query is True else {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


def _holds(query: Query, found: Column) -> Column:
    if query is True:
        return F.lit(True)
    if isinstance(query, str):
        return F.array_contains(found, query)
    parts = [_holds(q, found) for q in query[1]]
    return reduce((lambda a, b: a & b) if query[0] == "and" else (lambda a, b: a | b), parts)


def postings(rows: DataFrame, wanted: list[str]) -> DataFrame:
    """Inverted index ``(trigram, doc_id)`` of the trigrams that the queries use, case ignored."""
    low = rows.select("doc_id", F.lower("text").alias("low"))
    found = F.filter(F.array(*map(F.lit, wanted)), lambda t: F.col("low").contains(t)) if wanted else F.array().cast("array<string>")
    return low.select("doc_id", F.explode_outer(found).alias("trigram")).where("trigram IS NOT NULL")


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """``(doc_id, kinds)``: the rules whose query the postings of a document fulfil, of the rules that have one."""
    per_doc = index.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.collect_set("trigram").alias("found"))
    kinds = F.array_compact(F.array(*[F.when(_holds(q, F.col("found")), F.lit(k)) for k, q in queries.items() if q is not True]))
    return per_doc.select("doc_id", kinds.alias("kinds")).where(F.size("kinds") > 0)


def _spans(text: Column, kind: str, order: int, pattern: str, least: int) -> Column:
    """``[(start, order, end)]`` in code points of the leftmost non-overlapping matches that are long enough.

    Each step of the extraction takes the gap before a match and the match, from where the last one ended.
    """
    steps = rf"\G(?s:(.*?))({pattern})"
    gaps, hits, values = (F.regexp_extract_all(text, F.lit(steps), F.lit(g)) for g in (1, 2, 3))
    each = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), values.alias("value"))
    span = "struct<start:bigint,rule:int,end:bigint>"
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{span}>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        start = s["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        one = F.struct(start.alias("start"), F.lit(order).alias("rule"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(F.length(x["value"]) >= least, F.array_append(s["out"], one)).otherwise(s["out"]).alias("out"))

    return F.aggregate(each, begin, step, lambda s: s["out"])


def _listed(spans: Column, names: list[str]) -> Column:
    """``kind:start:end`` by start, then by kind as listed."""
    kind = F.array(*map(F.lit, names))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(kind, s["rule"]), s["start"], s["end"])), ",")


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[tuple[str, str, int]] = RULES,
                base: tuple[str, ...] = BASE) -> DataFrame:
    """One row per input row: ``doc_id, n_<base kind>.., base_spans, spans``; spans are ``kind:start:end`` texts in code points.

    A rule runs on the documents that its trigram query leaves over; rules without mandatory trigrams run on all. Null texts
    count as empty. Rows of one id share their postings, which only adds candidates. Rows without an id are scanned by all rules.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col).withColumn("text", whole("text"))
    queries = {kind: trigram_query(pattern) for kind, pattern, _ in rules}
    index = stored(postings(rows, sorted(set().union(*map(trigrams, queries.values())))), "postings")
    found = stored(candidates(index, queries), "candidates").withColumnRenamed("doc_id", "__id")  # broadcast if its files are small
    rows = rows.join(found, F.col("doc_id") == F.col("__id"), "left")
    names = [kind for kind, _, _ in rules]
    for order, (kind, pattern, least) in enumerate(rules):
        due = F.lit(True) if queries[kind] is True else F.col("doc_id").isNull() | F.coalesce(F.array_contains("kinds", kind), F.lit(False))
        due = due & F.col("text").rlike(pattern)
        empty = F.array().cast("array<struct<start:bigint,rule:int,end:bigint>>")
        rows = rows.withColumn(f"__{kind}", F.when(due, _spans(F.col("text"), kind, order, pattern, least)).otherwise(empty))
    known = F.concat(*[F.col(f"__{k}") for k in names if k in base])
    every = F.concat(*[F.col(f"__{k}") for k in names])
    return rows.select(
        "doc_id", *[F.size(f"__{k}").cast("long").alias(f"n_{k}") for k in names if k in base],
        _listed(known, names).alias("base_spans"), _listed(every, names).alias("spans"))
