"""Seek paging against plain paging."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import paging


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rows = spark.range(5000).select(F.format_string("%06d", F.col("id") * 37 % 5003).alias("num"), F.col("id").alias("v")).unionByName(
        spark.createDataFrame([(None, -1)], "num string, v long"))
    return rows, paging.in_order(rows, "num", str(tmp_path_factory.mktemp("ordered")), 20)


@pytest.mark.parametrize(("skip", "limit"), [(0, 50), (0, 0), (1, 1), (249, 2), (2500, 200), (4990, 50), (4999, 1), (5000, 10), (10**6, 10)])
def test_a_page_found_by_ranges_is_the_page(table, skip, limit):
    rows, ordered = table
    want = [r["num"] for r in rows.where("num IS NOT NULL").orderBy("num").offset(skip).limit(limit).collect()]
    assert [r["num"] for r in paging.seek(ordered, skip, limit).collect()] == want


def test_a_deep_page_reads_one_range(table):
    plan = paging.seek(table[1], 4600, 20)
    plan.collect()
    assert table[1].ranges.count() == 20
    scanned = [r for r in table[1].ranges.collect() if r["rows"] > 0]
    text = plan._jdf.queryExecution().executedPlan().toString()
    lo = next(r["lo"] for r in sorted(scanned, key=lambda r: r["lo"]) if f"GreaterThanOrEqual(num,{r['lo']})" in text)
    hi = next(r["hi"] for r in scanned if f"LessThanOrEqual(num,{r['hi']})" in text)
    assert table[1].rows.where((F.col("num") >= lo) & (F.col("num") <= hi)).count() < 2 * 5000 / 20 + 100


def test_bounds_and_empty_tables(spark, tmp_path):
    empty = paging.in_order(spark.createDataFrame([], "num string"), "num", str(tmp_path / "none"), 4)
    assert paging.seek(empty, 0, 10).collect() == []
    with pytest.raises(ValueError):
        paging.seek(empty, 0, paging.MAX_PAGE + 1)
    with pytest.raises(ValueError):
        paging.in_order(empty.rows, "num", str(tmp_path / "many"), paging.MAX_RANGES + 1)
