"""Order-dependent rules against plain restatements on inline rows."""

import random

from pyspark.sql import functions as F

from ledgerline.operators import filters, merge, picks, rollups
from ledgerline.plans import finance as fin


def test_deposits_by_year(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        rows.append((i, f"{rng.randrange(8)}", f"r{i}", 2000 + rng.randrange(4), rng.choice(["FR", "NL", None, "fr"]), rng.choice(["m02", "mc-1", None]), rng.choice([True, False, None]), i))
    df = spark.createDataFrame(rows, "id int, num string, reference string, period_year int, language string, model_code string, migration boolean, pos int")
    kept = {}
    for r in rows:
        if (r[5] or "").startswith("mc"):
            continue
        key = (r[1], r[3])
        if key not in kept or (r[4] or "").upper() == "FR":
            kept[key] = r
    got = {(r["num"], r["period_year"]): r["id"] for r in picks.deposits_by_year(df).collect()}
    assert got == {k: v[0] for k, v in kept.items()}
    usable = {}
    for (num, year), r in kept.items():
        if not r[6] and (num not in usable or year > usable[num][0]):
            usable[num] = (year, r[0])
    assert {r["num"]: (r["period_year"], r["id"]) for r in picks.latest_usable_deposit(df).collect()} == usable


def test_dedup_array_and_rows(spark):
    items = [("55100", "MAIN", "a"), ("55100", "SECO", "b"), ("55100", "MAIN", "c"), (None, None, "d"), ("", None, "e")]
    df = spark.createDataFrame([(items,), (None,)], "a array<struct<nace_code: string, classification: string, x: string>>")
    got = [r["o"] for r in df.select(picks.dedup_array(F.col("a"), "nace_code", "classification").alias("o")).collect()]
    assert [x["x"] for x in got[0]] == ["a", "b", "d"] and got[1] == []
    long = spark.createDataFrame([("n", *x, i) for i, x in enumerate(items)], "num string, nace_code string, classification string, x string, pos int")
    assert sorted(r["x"] for r in picks.dedup_activities(long).collect()) == ["a", "b", "d"]


def test_growth_gaps_and_zero(spark):
    rows = [("e", "2018", 100.0), ("e", "2019", None), ("e", "2020", 150.0), ("e", "2021", 0.0), ("e", "2022", 50.0), ("e", "2023", 75.0)]
    df = spark.createDataFrame(rows, "num string, year string, ca double")
    got = {r["year"]: r["croissance_ca"] for r in fin.with_growth(df).collect()}
    assert got == {"2018": None, "2019": None, "2020": 0.5, "2021": -1.0, "2022": None, "2023": 0.5}


def test_filing_amounts_last_value_and_empty(spark):
    rows = [("e", "2020-1", "70", "1", 1), ("e", "2020-1", "70", "x", 2), ("e", "2020-1", "60", "5", 3), ("e", "2020-1", "60", "", 4), ("e", "2020-1", "99", "5", 5)]
    df = spark.createDataFrame(rows, "num string, reference string, code string, val string, pos long")
    row = fin.filing_amounts(fin.usable_lines(df)).first()
    assert row["70"] is None and row["60"] == 5.0


def test_unreadable_used_code_drops_the_filing(spark):
    text = 'h\n"70","10"\n"17","{}"\n'
    df = spark.createDataFrame([(1, text.format("n/a")), (2, text.format("")), (3, text.format("4"))], "deposit_id int, raw_csv string")
    got = {r["deposit_id"]: (r["dettes_fin"], r["chiffre_affaires"]) for r in fin.with_kpis(fin.code_table(df, ["deposit_id"]), ["deposit_id"]).collect()}
    assert got == {2: (0.0, 10.0), 3: (4.0, 10.0)}


def test_flow_loss_variant(spark):
    rows = [("a", "2020", 100.0, None, None, -20.0, None), ("b", "2020", None, None, None, -20.0, None), ("c", "2020", 100.0, 30.0, 25.0, 20.0, 5.0)]
    df = spark.createDataFrame(rows, "num string, year string, ca double, ebit double, resultat_avant_impots double, resultat_net double, impots double")
    graph = {r["num"]: r for r in fin.flow_graph(df).collect()}
    assert [(e["source"], e["value"]) for e in graph["a"]["links"]] == [("Chiffre d'affaires", 100.0), ("Perte de l'exercice", 20.0)]
    assert graph["b"]["links"] == [] and graph["b"]["nodes"] == [] and graph["b"]["deficit"]
    assert graph["c"]["nodes"] == fin.PROFIT_NODES and len(graph["c"]["links"]) == 5


def test_main_code_on_one_element(spark):
    df = spark.createDataFrame([(1, [("MAIN", "1"), ("SECO", "55100")]), (2, [("MAIN", "55100")]), (3, None)], "i int, a array<struct<classification: string, nace_code: string>>")
    got = {r["i"] for r in df.where(filters.has_main_code(F.col("a"), ["55100"])).collect()}
    assert got == {2}


def test_merges_are_repeatable(spark):
    old = spark.createDataFrame([("1", "done", 1, "a"), ("2", None, 1, "b"), ("3", "pending", None, "c"), ("4", "pending", 1, "d")], "num string, status string, updated_run int, denomination string")
    new = spark.createDataFrame([("4", 2, None), ("5", 2, "e")], "num string, updated_run int, denomination string")
    once = merge.purge(merge.upsert_targets(old, new, {"status": F.lit("pending")}), F.lit(2))
    twice = merge.purge(merge.upsert_targets(once, new, {"status": F.lit("pending")}), F.lit(2))
    rows = sorted((r["num"], r["status"], r["updated_run"], r["denomination"]) for r in once.collect())
    assert rows == [("1", "done", 1, "a"), ("3", "pending", None, "c"), ("4", "pending", 2, None), ("5", "pending", 2, "e")]
    assert sorted((r["num"], r["status"], r["updated_run"], r["denomination"]) for r in twice.collect()) == rows


def test_a_page_beyond_the_bound_is_refused(spark):
    import pytest

    from ledgerline.operators import paging

    with pytest.raises(ValueError):
        paging.page(spark.range(3), "id", limit=paging.MAX_PAGE + 1)


def test_both_csv_readers_agree_on_quotes(spark):
    text = 'h\n"Entity name","A ""B"", C"\n70, 10 ,x\n"17",""\n'
    df = spark.createDataFrame([(1, text)], "id int, raw_csv string")
    got = {r["code"]: r["val"] for r in fin.csv_codes(df, ["id"]).collect()}
    assert got == {"Entity name": 'A "B", C', "70": "10", "17": None}
    last = fin.last_values(df, ["id"], list(got)).drop("id").first().asDict()
    assert last == got


def test_year_columns_take_all_years(spark):
    long = spark.createDataFrame([("1", "ca", "2001", 1.0), ("1", "ca", "?", 2.0)], "num string, indicator string, year string, value double")
    assert fin.year_columns(long).first().asDict() == {"num": "1", "indicator": "ca", "2001": 1.0, "?": 2.0}


def test_sum_of_squares_is_exact_beyond_a_bigint(spark):
    big = rollups.sum_of_squares(spark.createDataFrame([(4_000_000_000,), (3,), (None,)], "k long"), "k")
    assert tuple(big.first()) == (3, 4_000_000_000**2 + 9)
    small = rollups.sum_of_squares(spark.createDataFrame([(3,), (None,)], "k long"), "k")
    assert tuple(small.first()) == (2, 9) and dict(small.dtypes) == {"n": "bigint", "total": "bigint"}
    assert tuple(rollups.sum_of_squares(spark.createDataFrame([], "k long"), "k").first()) == (0, None)
