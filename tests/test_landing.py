"""Landed tables: file layout, co-partitioned plans, hot buckets."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import extract
from ledgerline.registry import QUERIES, q_archive
from ledgerline.registry.book import Data
from ledgerline.sources import landing


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", ["jn03_one_to_many", "jn05_denormalise", "ent01_silver", "fin02_filing_metrics", "prj04_entity_record"])
def test_record_joins_need_no_exchange(spark, sf, no_broadcast, name):
    text = plan(QUERIES[name](spark, sf))
    assert "Exchange hashpartitioning" not in text and "Bucketed: true" in text


def test_decoded_records_shuffle_the_dictionary_only(spark, sf):
    text = plan(QUERIES["ent02_rich"](spark, sf))
    assert "hashpartitioning(num" not in text and "Bucketed: true" in text


def test_layout(spark, sf):
    landed = Data(spark, sf).fx_activity
    files = landing.bucket_sizes(spark, landed.select(F.regexp_replace(F.input_file_name(), "/[^/]*$", "").alias("p")).first()["p"])
    n = landing.LEAST
    assert files.agg(F.countDistinct("bucket")).first()[0] == n
    rows = landed.select("num", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"))
    # one bucket is one hash class, and sorted inside its file
    classes = rows.select("file", F.pmod(F.hash("num"), F.lit(n)).alias("bucket")).distinct()
    assert classes.groupBy("file").count().where("count > 1").count() == 0
    later = rows.alias("a").join(rows.alias("b"), (F.col("a.file") == F.col("b.file")) & (F.col("a.at") + 1 == F.col("b.at")) & (F.col("a.num") > F.col("b.num")))
    assert later.count() == 0
    assert landed.rdd.getNumPartitions() > 1


def test_landed_once_per_session_and_folder(spark, sf):
    from ledgerline.registry import inputs

    d = Data(spark, sf)
    d.fx_enterprise  # noqa: B018
    before = dict(inputs._LANDED)
    assert d.fx_enterprise.count() == d.customer.count() and inputs._LANDED == before


@pytest.mark.parametrize(("size", "buckets"), [(0, 8), (1, 8), (9 * landing.TARGET_BYTES, 16), (10**15, 16_384), (8 * landing.TARGET_BYTES, 8)])
def test_bucket_number(size, buckets):
    assert landing.bucket_number(size) == buckets


def test_a_hot_bucket_is_written_by_several_tasks_and_read_by_files(spark, monkeypatch):
    monkeypatch.setattr(landing, "HOT_BYTES", 1000)
    rows = spark.range(0, 200_000, 1, 8).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("num"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    landed = landing.land(rows, "skewed", "num", 8, 1 << 20)
    sizes = {r["bucket"]: r["files"] for r in landing.bucket_sizes(spark, landed.path).collect()}
    assert landed.hot and max(sizes.values()) > 1
    back = landed.read(spark)
    assert back.count() == 200_000 and back.where("num = 'hot'").count() == rows.where("num = 'hot'").count()
    assert "Bucketed: true" not in plan(back.groupBy("num").count())
    # the same rows without the hot key keep their buckets
    even = landing.land(rows.where("num <> 'hot'"), "even", "num", 8, 1 << 20)
    assert not even.hot and "hashpartitioning" not in plan(even.read(spark).groupBy("num").count())


def test_null_keys_and_empty_tables(spark):
    rows = spark.createDataFrame([(None, 1), ("a", 2), (None, 3), ("b", 4)], "num string, v long")
    landed = landing.land(rows, "nulls", "num", 8).read(spark)
    assert sorted(map(tuple, landed.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    assert {r["num"]: r["count"] for r in landed.groupBy("num").count().collect()} == {None: 2, "a": 1, "b": 1}
    empty = landing.land(rows.where("v > 9"), "none", "num", 8)
    assert not empty.hot and empty.read(spark).count() == 0
    plain = landing.land(rows, "plain", None, 3)
    assert plain.read(spark).count() == 4


def test_settings_are_restored(spark):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    with pytest.raises(RuntimeError):
        with landing.settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="1234"):
            assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "1234"
            raise RuntimeError
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before


def test_intermediates_of_a_run_can_be_dropped(spark, sf):
    import os

    from ledgerline.registry import inputs
    from ledgerline.session import run_folder, stored

    d = Data(spark, sf)
    rows, other = d.fx_branch.count(), stored(d.region, "other")
    assert other.count() == 5
    folder = run_folder(spark).removeprefix("file:").replace("//", "/")
    beside = os.path.join(os.path.dirname(folder), "another-run")
    os.makedirs(beside, exist_ok=True)
    assert os.path.isdir(folder)
    inputs.forget(spark)
    assert not os.path.isdir(folder) and os.path.isdir(beside)
    os.rmdir(beside)
    assert not any(k[0] == spark.sparkContext.applicationId for k in inputs._LANDED)
    assert Data(spark, sf).fx_branch.count() == rows  # landed anew
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("landed_fx_") and "fx_branch" not in t.name]


def test_a_gigabyte_of_source_has_buckets_that_one_task_can_sort():
    assert landing.bucket_number(1 << 30) >= 128 and landing.bucket_number(6 << 30) >= 768


def test_a_global_sort_reads_the_view_without_landing_it(spark, sf):
    text = plan(QUERIES["srt06_activity_order"](spark, sf))
    assert "lineitem.parquet" in text and "Bucketed: true" not in text


def test_bronze_rows_are_counted_by_key_in_hash_buffers(spark, sf):
    import re

    assert re.search(r"HashAggregate\(keys=\[name#\d+, file#\d+, num#\d+\]", plan(QUERIES["src02_bronze_load"](spark, sf)))


def test_cards_of_two_landed_tables_are_joined_and_come_once(spark, no_broadcast):
    """Buckets that are read one table after the other must neither be joined as if they were one layout nor repeat a key."""
    def table(name, keys):
        rows = spark.createDataFrame([(k, 1, "<p>x</p>") for k in keys], "num string, page int, html string")
        return landing.land(rows, name, "num", 8).read(spark)

    d = SimpleNamespace(fx_card_page=table("cards", ["1", "2", None, "2"]), fx_web_page=table("web", ["w1", "2", None]))
    labels = spark.createDataFrame([("1", "Statut", "Actif"), ("2", "Statut", "Clos"), ("4", "Statut", "Actif")], "num string, label string, val string")
    labels = landing.land(labels, "labels", "num", 8).read(spark)
    got = [(r["num"], r["statut"]) for r in extract.card_fields(labels, q_archive.card_pages(d)).collect()]
    assert sorted(got, key=str) == [("1", "Actif"), ("2", "Clos"), ("w1", None), (None, None)]


@pytest.mark.parametrize("name", ["htm02_card_fields", "htm14_page_record"])
def test_card_records_run_without_broadcast(spark, sf, no_broadcast, name):
    cards = spark.read.parquet(f"{sf}/customer.parquet").count() + spark.read.parquet(f"{sf}/pages.parquet").count()
    assert len(QUERIES[name](spark, sf).collect()) == cards
