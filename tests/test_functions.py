"""Edge values of the scalar functions on inline rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import dates, keys, numbers, text


def values(spark, fn, items, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r["o"] for r in rows.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


@pytest.mark.parametrize("raw, expected", [
    ("1234.5", 1234.5), ("1234,5", 1234.5), ("1.234,5", 1234.5), ("1.234", 1.234), ("1.234.567", None), ("1,234,567", None),
    ("(12)", -12.0), ("-12", -12.0), (" 1 234 ", 1234.0), ("-", None), (".", None), ("", None), ("abc", None), ("1d", None),
    ("5f", None), ("1e3", 1000.0), (None, None), ("1 234,5", 1234.5), ("(-5)", 5.0), ("--5", -5.0), ("(1.234,5)", -1234.5), ("+7", 7.0),
])
def test_parse_amount(spark, raw, expected):
    assert values(spark, numbers.parse_amount, [raw]) == [expected]


def test_company_number(spark):
    got = values(spark, keys.company_number, ["0400.000.001", "400000003", "Dupont , Jean", None, "12345678901", "BE 0400 000 001"])
    assert got == ["0400000001", "0400000003", None, None, None, "0400000001"]


def test_iso_date(spark):
    got = values(spark, dates.iso_date, ["09-03-2020", "2020-03-09", "1-2-2020", "31-02-2020", None, "x"])
    assert got == ["2020-03-09", "2020-03-09", "1-2-2020", "31-02-2020", None, "x"]
    assert values(spark, lambda c: dates.iso_from(c, "date"), [dt.date(2020, 3, 9), None], "date") == ["2020-03-09", None]


def test_fiscal_and_filing_year(spark):
    rows = spark.createDataFrame(
        [(0, "2021-12-31", "2022-001"), (1, "n/a", "2022-001"), (2, None, "X22"), (3, None, "20223-1"), (4, "31/12/1999", None)], "i int, e string, r string")
    got = rows.select("i", dates.fiscal_year(F.col("e"), F.col("r")).alias("o")).orderBy("i").collect()
    assert [r["o"] for r in got] == ["2021", "2022", "?", "?", "1999"]
    dep = spark.createDataFrame([(0, "2022-1", "2021-05-05", 2020), (1, "X1", "2021-05-05", 2020), (2, "X1", None, 2020), (3, None, None, None)], "i int, r string, d string, y int")
    got = dep.select("i", dates.filing_year(F.col("r"), F.col("d"), F.col("y")).alias("o")).orderBy("i").collect()
    assert [r["o"] for r in got] == ["2022", "2021", "2020", ""]


def test_path_allowed(spark):
    got = values(spark, text.path_allowed, ["/documents/a.pdf", "/documents/../x", "documents/a", "/tmp/a", "/123/hbb/r.csv", "/12a/hbb/r.csv", "/123/hbb/x/r.csv"])
    assert got == [True, False, False, False, True, False, False]


def test_ratios(spark):
    rows = spark.createDataFrame([(0, 1.0, 3.0), (1, 1.0, 0.0), (2, None, 1.0), (3, 1.0, None)], "i int, n double, d double")
    got = rows.select("i", numbers.ratio(F.col("n"), F.col("d"), 100).alias("r"), numbers.percent(F.col("n"), F.col("d")).alias("p")).orderBy("i").collect()
    assert [(r["r"], r["p"]) for r in got] == [(33.3333, 33.33), (None, None), (None, None), (None, None)]


def test_shard_is_a_partition(spark):
    nums = [f"{n:010d}" for n in range(50)] + ["abc", "x-1", ""]
    shards = [values(spark, lambda c, i=i: keys.in_shard(c, 4, i), nums) for i in range(4)]
    assert all(sum(s[k] for s in shards) == 1 for k in range(len(nums)))


def test_display_formats(spark):
    assert values(spark, text.thousands, [1234567.0, None], "double") == ["1,234,567", "-"]
    assert values(spark, text.percent_text, [12.34, None], "double") == ["12.3%", "-"]
    assert values(spark, text.euro_text, [2500000.0, 1234.0], "double") == ["2.5M €", "1,234 €"]


def test_postal_and_bilingual(spark):
    rows = spark.createDataFrame([("Rue A", "1", "1000", "Ville"), (None, "", None, ""), (None, None, "1000", "Ville")], "a string, b string, c string, d string")
    cols = [F.col(c) for c in "abcd"]
    assert [r[0] for r in rows.select(text.postal_line(*cols)).collect()] == ["Rue A 1, 1000 Ville", None, "1000 Ville"]
    assert [r[0] for r in rows.select(text.bilingual_line(*cols)).collect()] == ["Rue A 1, 1000 Ville", "", "1000 Ville"]
