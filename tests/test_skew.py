"""Hot keys: results stay whole, groups stay bounded."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import nest, rollups
from ledgerline.operators.scale import fits, lookup


def hot_rows(spark, n=3000):
    """A third of all rows on one key."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))).alias("num"),
        F.col("id").alias("pos"), (F.col("id") * 7 % 11).alias("v"))


def test_fits(spark):
    assert fits(spark.range(10), 10) and not fits(spark.range(11), 10) and fits(spark.range(0), 0) and not fits(spark.range(1), 0)


def record_of(spark, n):
    rows = spark.range(n).select(F.lit("hot").alias("num"), F.col("id").alias("pos"), (F.col("id") * 7 % 11).alias("v"))
    rows = rows.unionByName(spark.createDataFrame([("orphan", 1, 1), (None, 2, 2), ("k", 0, 5)], "num string, pos long, v long"))
    parent = spark.createDataFrame([("hot", "HOT"), ("alone", "ALONE"), ("k", "K")], "num string, name string")
    return nest.record(parent, {"a": (rows, ["v"]), "b": (rows.limit(0), ["v"])})


@pytest.mark.parametrize("n", [3, 200_000])
def test_records_have_one_shape_at_every_size(spark, n):
    rec = record_of(spark, n)
    assert {r["num"]: (r["name"], r["a"], r["b"]) for r in rec.counts().collect()} == {"hot": ("HOT", n, 0), "alone": ("ALONE", 0, 0), "k": ("K", 1, 0)}
    every = rec.rows("a", "name", every=True).orderBy("num", "pos").collect()
    assert [(r["num"], r["pos"], r["v"]) for r in every] == [("alone", None, None)] + [("hot", i, i * 7 % 11) for i in range(n)] + [("k", 0, 5)]
    assert rec.rows("a").count() == n + 1 and rec.rows("b").count() == 0
    page = {r["num"]: r for r in rec.nested(["hot", "alone"]).collect()}
    assert set(page) == {"hot", "alone"} and [x["v"] for x in page["hot"]["a"]] == [i * 7 % 11 for i in range(n)]
    assert page["alone"]["a"] == page["hot"]["b"] == []


def test_lookup_under_skew_equals_a_plain_join(spark):
    facts = hot_rows(spark).unionByName(spark.createDataFrame([(None, 1, 1)] * 500, "num string, pos long, v long"))
    dim = facts.where("num is not null").select("num").distinct().where("num != 'k5'").withColumn("label", F.concat(F.lit("L"), "num"))
    for how in ("left", "inner", "left_semi", "left_anti"):
        plain = facts.join(dim, "num", how)
        safe = lookup(facts, dim, ["num"], how, bound=10)
        key = lambda r: tuple(map(str, r))
        assert sorted(map(key, safe.select(plain.columns).collect())) == sorted(map(key, plain.collect())), how


def test_lookup_beyond_the_bound_reads_the_facts_once_and_splits_a_hot_key(spark, tmp_path):
    facts = hot_rows(spark, 200_000)
    facts.write.parquet(str(tmp_path / "facts"))
    dim = facts.select("num").distinct().withColumn("label", F.lit("x"))
    dim.write.parquet(str(tmp_path / "dim"))
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    old = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        out = lookup(spark.read.parquet(str(tmp_path / "facts")), spark.read.parquet(str(tmp_path / "dim")), ["num"], bound=10)
        assert len(out.collect()) == 200_000
        plan = out._jdf.queryExecution().executedPlan()
        final = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
        scans = [line for line in final.treeString().splitlines() if "FileScan" in line or "Scan parquet" in line]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "skew=true" in plan.toString() and len(scans) == 2  # the facts and the table beside them, once each


def test_semi_lookup_with_repeated_keys(spark):
    facts = hot_rows(spark)
    keys = facts.select("num").where("num in ('hot', 'k1')")
    assert lookup(facts, keys, ["num"], "left_semi", bound=10).count() == facts.where("num in ('hot', 'k1')").count()


def test_numbered_is_a_rank(spark):
    rows = spark.range(1000).select((F.col("id") * 37 % 5003).cast("string").alias("num"))
    got = {r["num"]: r["rank"] for r in rollups.numbered(rows, "num").collect()}
    assert len(got) == 1000 and got == {n: i + 1 for i, n in enumerate(sorted(got))}
    words = spark.createDataFrame([("b",), ("a",), ("10",), ("9",)], "num string")
    assert {r["num"]: r["rank"] for r in rollups.numbered(words, "num").collect()} == {"10": 1, "9": 2, "a": 3, "b": 4}
