"""Search tables against plain scans; key inventory from data."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import filters, nest, search
from ledgerline.plans import reports
from ledgerline.sources.landing import land

NAMES = ["Café de la Gare", "CAFE central", "ab", "a", "", None, "abcabcabc", "aaaa", "Été 2020", "x%y_z", "bcd abc", "日本語テキスト", "Straße"]


@pytest.fixture(scope="module")
def rows(spark):
    data = [(f"k{i % 9}", n, i) for i, n in enumerate(NAMES)] + [(None, "abc", 99)]
    return spark.createDataFrame(data, "num string, valeur string, pos int")


@pytest.fixture(scope="module")
def tables(spark, rows):
    grams = land(search.gram_table(rows, "num", "valeur"), "grams", "word", 8).read(spark)
    return grams, search.gram_counts(grams)


@pytest.mark.parametrize("part", ["abc", "ABCAB", "café", "caf", "ab", "a", "", "été", "zzz", "aaa", "aaaaa", "本語テ", "x%y", "y_z", "STRASSE", "straße", "e c"])
def test_substring_search_equals_a_scan(spark, rows, tables, part):
    want = {r["num"] for r in rows.where(filters.name_contains(F.col("valeur"), part)).collect()} - {None}
    got = {r["num"] for r in search.containing(*tables, rows, "num", "valeur", part).collect()} - {None}
    assert got == want


def test_a_search_reads_the_buckets_of_its_words(spark, tables):
    plan = tables[0].where(F.col("word").isin("abc"))._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 1 out of 8" in plan and "In(word" in plan or "EqualTo(word" in plan
    text = search.keys_with_any(tables[0], "num", "abc bcd")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(word, [abc,bcd])]" in text


def test_token_search_equals_a_scan(spark, rows):
    table = search.token_table(rows, "num", "valeur")
    for text in ("gare CENTRAL", "été", "", "nothing here", "abc"):
        want = {r["num"] for r in rows.where(filters.any_token(F.col("valeur"), text)).collect()} - {None}
        assert {r["num"] for r in search.keys_with_any(table, "num", text).collect()} == want


def test_grams_of_odd_texts(spark):
    df = spark.createDataFrame([(t,) for t in ("abcd", "ab", "", None, "aaaa", "Éé́x")], "t string")
    got = [r["g"] for r in df.select(search.grams(F.col("t")).alias("g")).collect()]
    assert got[:5] == [["abc", "bcd"], None, None, None, ["aaa"]] and len(got[5]) == 2


def test_keys_in_use_lists_only_fields_with_values(spark):
    base = spark.createDataFrame(
        [("1", ("a", None), [("x", None)], None), ("2", None, [], None), ("3", ("b", None), None, None)],
        "num string, card struct<name:string,mail:string>, tags array<struct<k:string,v:string>>, never string")
    child = spark.createDataFrame([("1", 0, "c", None), ("1", 1, None, None), ("9", 0, "not in a record", "z")], "num string, pos int, code string, other string")
    record = nest.record(base, {"acts": (child, ["code", "other"])})
    got = {r["key"]: r["n"] for r in reports.keys_in_use(record).collect()}
    assert got == {"num": 3, "card": 2, "card.name": 2, "tags": 1, "tags.k": 1, "acts": 2, "acts.code": 1}
    assert reports.keys_in_use(nest.record(base.where("num = '0'"), {"acts": (child, ["code"])})).collect() == []
