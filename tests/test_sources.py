"""File sources and sinks, in fresh folders."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ledgerline.constants import REGISTER_FILES
from ledgerline.operators import rollups
from ledgerline.plans import finance as fin
from ledgerline.registry import q_archive
from ledgerline.registry.inputs import view
from ledgerline.sources import archive, register


def test_raw_csv_bom_quotes_and_zeros(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('﻿"Num","Name"\n"0001","a ""b"" c"\n"0002","x,y"\n"0003",""\n'.encode())
    df = register.read_raw_csv(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["Num", "Name"] and all(t == "string" for _, t in df.dtypes)
    assert [tuple(r) for r in df.collect()] == [("0001", 'a "b" c'), ("0002", "x,y"), ("0003", None)]


def test_load_bronze_and_counts(spark, tmp_path):
    for name, file in REGISTER_FILES.items():
        (tmp_path / file).write_text('"A","B"\n' + "".join(f'"{name}{i}","{i}"\n' for i in range(3)))
    (tmp_path / "meta.csv").write_text('"Variable","Value"\n"SnapshotDate","01-02-2026"\n"Version","1"\n')
    counts = register.load_bronze(spark, str(tmp_path), str(tmp_path / "out"))
    assert counts == {**{f"kbo_{n}": 3 for n in REGISTER_FILES}, "kbo_meta": 2}
    row = spark.read.parquet(str(tmp_path / "out/kbo_branch")).first()
    assert row["_snapshot_date"] == "01-02-2026" and row["_source_file"] == "branch.csv" and row["_ingested_at"] is not None
    tables = {n: spark.read.parquet(str(tmp_path / f"out/{n}")) for n in counts}
    assert rollups.check_not_empty(rollups.table_counts(tables)) == counts
    with pytest.raises(AssertionError):
        rollups.check_not_empty(rollups.table_counts({"none": tables["kbo_meta"].limit(0)}))


def test_unreadable_meta_gives_none(spark, tmp_path):
    assert register.read_snapshot_date(spark, str(tmp_path)) is None


def test_position_follows_the_file(spark, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f"{i}\n" for i in range(5000)))
    lines = spark.read.text(str(tmp_path / "a.txt")).withColumn("pos", register.line_position())
    assert [r["value"] for r in lines.orderBy("pos").collect()] == [str(i) for i in range(5000)]


def test_gold_from_filing_files(spark, tmp_path):
    for num, ref, body in [
        ("0001", "2021-1", 'h;v\n"70","100"\n60;40\n"9904","10"\n'), ("0001", "2022-1", "h;v\n70;150\n70;200\n"),
        ("0002", "2020-5", 'h;v\n"70","-"\n"Accounting period end date","2019-12-31"\n"10/15","5"\n'),
    ]:
        folder = tmp_path / num / "hbb"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{ref}.csv").write_text(body)
    lines = archive.filing_lines(archive.text_lines(spark, f"{tmp_path}/*/hbb/*.csv"))
    targets = spark.createDataFrame([("0001", "A", "55100"), ("0002", "B", "55100"), ("0003", "C", "55100")], "num string, denomination string, nace_codes string")
    gold = {r["num"]: r for r in fin.gold(fin.yearly_metrics(lines, targets), targets).collect()}
    assert set(gold) == {"0001", "0002"}
    assert [(y["year"], y["ca"], y["ratios"]["croissance_ca"]) for y in gold["0001"]["years"]] == [("2021", 100.0, None), ("2022", 200.0, 1.0)]
    assert gold["0002"]["schema_type"] == "abrege" and gold["0002"]["years"][0]["year"] == "2019"


def test_export_writes_one_file_per_filing(spark, sf, tmp_path):
    accounts = view(spark, sf, "fx_account").where("deposit_id < 60")
    archive.export_accounts(accounts, str(tmp_path / "out"))
    written = archive.export_counts(accounts).first()["written"]
    assert len(list((tmp_path / "out").glob("enterprise=*/reference=*/*.txt"))) == written
    back = spark.read.text(str(tmp_path / "out/*/*/*.txt"), wholetext=True).select(F.trim("value").alias("v"))
    want = accounts.where(archive.exportable(accounts)).select(F.trim("raw_csv").alias("v"))
    assert sorted(r["v"].strip() for r in back.collect()) == sorted(r["v"].strip() for r in want.collect())


def test_whole_pages_drop_bad_bytes(spark, tmp_path):
    (tmp_path / "p.html").write_bytes(b"<p>caf\xc3\xa9 \xff!</p>")
    assert archive.whole_pages(spark, str(tmp_path)).first()["html"] == "<p>café !</p>"


def test_folder_stats(spark, tmp_path):
    for d, n in (("a", 2), ("b", 3)):
        (tmp_path / d).mkdir()
        for i in range(n):
            (tmp_path / d / f"{i}.bin").write_bytes(b"x" * 10)
    assert tuple(archive.folder_stats(spark, str(tmp_path)).first()) == (5, 50, 2)


def test_first_filled(spark, tmp_path):
    broken = lambda: spark.read.parquet(str(tmp_path / "none"))
    assert archive.first_filled(broken, lambda: spark.range(0), lambda: spark.range(3)).count() == 3
    assert archive.first_filled(lambda: spark.range(2), broken).count() == 2


def test_lines_keep_their_order_when_a_file_is_split(spark, tmp_path):
    """A filing of many scan splits: the last line of a code wins, and positions rise with the lines."""
    folder = tmp_path / "0400000001" / "hbb"
    folder.mkdir(parents=True)
    rows = [f'"{i % 5}","{i}"' for i in range(5000)]
    (folder / "2020-1.csv").write_text("\n".join(rows) + "\n")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k, v in zip(old, ("4096", "1"), strict=True):
            spark.conf.set(k, v)
        read = archive.text_lines(spark, str(folder / "*.csv"))
        assert read.rdd.getNumPartitions() > 4
        lines = archive.filing_lines(read)
        got = [r["val"] for r in lines.orderBy("pos").collect()]
        last = {r["code"]: r["val"] for r in fin.last_code_values(lines).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == [str(i) for i in range(5000)]
    assert last == {str(k): str(4995 + k) for k in range(5)}
    assert lines.schema["pos"].dataType.typeName() == "decimal"  # of fixed width: no sort for the last line of a code


def test_export_keeps_odd_names_and_texts(spark, tmp_path):
    """Names as they are after a round trip, rows of one filing in one file, an earlier export gone; no partition per file."""
    rows = [("0001", "2020-1", "a,1\n"), ("0001", "a/b=c%2F d+é", "x\r\ny"), ("0 #2", "2020-1", "é"), ("0 #2", "2020-1", "é")]
    odd = spark.createDataFrame(rows, "num string, reference string, raw_csv string")
    folder = f"file://{tmp_path}/a b"
    archive.export_accounts(odd.withColumn("reference", F.lit("old")), folder)
    archive.export_accounts(odd.repartition(4), folder)
    got = sorted((r["num"], r["reference"], r["value"]) for r in archive.exported_texts(spark, folder).collect())
    assert got == [("0 #2", "2020-1", "é\né\n"), ("0001", "2020-1", "a,1\n\n"), ("0001", "a/b=c%2F d+é", "x\r\ny\n")]
    assert sorted(r["value"] for r in spark.read.schema("value string, enterprise string, reference string").text(folder, wholetext=True).where("reference = 'a/b=c%2F d+é'").collect()) == ["x\r\ny\n"]
    assert not list((tmp_path / "a b").glob("enterprise=*/reference=*/*.crc"))


def test_no_file_of_an_export_is_a_partition(spark, tmp_path):
    archive.export_accounts(spark.createDataFrame([("1", "r", "70,1")], "num string, reference string, raw_csv string"), str(tmp_path / "out"))
    read = archive.text_lines(spark, str(tmp_path / "out"))
    assert read.select("value").count() == 1 and "PartitionFilters: []" in read._jdf.queryExecution().executedPlan().toString()
    assert "enterprise" not in read._jdf.queryExecution().analyzed().toString().split("LogicalRelation")[-1]


ODD_FILINGS = [
    ("0001", "2020-1", "a,1\nb,2\na,3\n"), ("0001", "a/b=c%2F d+é", "x,1\r\ny,2"), ("0 #2", "<|>~`\u00a0$", "é,1"), ("0 #2", "<|>~`\u00a0$", "é,1"),
    ("a:b?*", "r{1}[2]^\"'", "\ufeffk,v\r\rk,w\n\n"), ("_h", ".x", "  \n"), ("0003", "2020-1", "a,9\n")]


def two_tables(spark):
    """Filings of some targets, and one of an enterprise that is none."""
    targets = [(n, "done" if n == "0003" else None) for n in sorted({r[0] for r in ODD_FILINGS})]
    return SimpleNamespace(
        spark=spark, fx_account=spark.createDataFrame(ODD_FILINGS, "num string, reference string, raw_csv string"),
        fx_target=spark.createDataFrame(targets, "num string, status string"))


def test_lines_of_an_export_are_those_of_its_files(spark, tmp_path):
    """Line ends, marks and names as Spark reads them, hidden and empty files left out; lines of a file in order."""
    archive.export_accounts(two_tables(spark).fx_account, str(tmp_path / "a b"))
    for name, text in (("_hidden", b"h,1\n"), (".tmp/f", b"h,1\n"), ("_temporary/f", b"h,1\n"), ("enterprise=9/reference=e/f.txt", b""), ("enterprise=9/reference=bad/f.txt", b"\xff,1\n\n\xc3")):
        file = tmp_path / "a b" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(text)
    read = [lines.select("path", "value", "pos.block", "pos.row").collect() for lines in (archive.text_lines(spark, str(tmp_path / "a b")), archive.exported_lines(spark, str(tmp_path / "a b")))]
    want, got = ([(p, v) for p, _, _, v in sorted((r["path"], r["block"], r["row"], r["value"]) for r in rows)] for rows in read)
    assert got == want and len(got) == 20


def test_filings_read_back_are_not_listed_on_the_driver(spark):
    got = q_archive.src06b(two_tables(spark))
    assert not got.inputFiles()
    rows = {(r["num"], r["reference"], r["code"]): r["val"] for r in got.collect()}
    assert {k[2]: v for k, v in rows.items() if k[:2] == ("0001", "2020-1")} == {"a": "3", "b": "2"}
    assert len(rows) == 6 and "0003" not in {k[0] for k in rows}


def test_files_of_an_export_are_not_listed_on_the_driver(spark):
    from hashlib import md5

    got = q_archive.src15b(two_tables(spark))
    assert not got.inputFiles()
    texts = {(n, r): "".join(t + "\n" for m, q, t in ODD_FILINGS if (m, q) == (n, r)) for n, r, _ in ODD_FILINGS if n != "0003"}
    assert {(r["num"], r["reference"]): r["digest"] for r in got.collect()} == {k: md5(t.encode()).hexdigest() for k, t in texts.items()}


def test_files_of_one_large_enterprise_are_read_by_many_tasks(spark, tmp_path):
    rows = [("1", str(i), "a,1") for i in range(300)]
    archive.export_accounts(spark.createDataFrame(rows, "num string, reference string, raw_csv string"), str(tmp_path / "out"))
    files = archive.exported_files(spark, str(tmp_path / "out"))
    assert files.count() == 300 and files.select(F.spark_partition_id()).distinct().count() > 8
