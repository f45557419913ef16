"""Streams resume where they stopped and add nothing on a second run."""

import threading

import pytest
from pyspark.sql import functions as F

from ledgerline.streaming import refresh, tail


def write(spark, path, ids):
    spark.createDataFrame([(i, i % 3, i * 10) for i in ids], "id int, k int, at int").coalesce(1).write.mode("append").parquet(path)


def test_drain_resumes(spark, tmp_path):
    source, target, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    schema = "id int, k int, at int"
    write(spark, source, range(5))
    tail.drain(tail.follow(spark, source, schema), target, ck)
    write(spark, source, range(5, 8))
    for _ in range(2):
        tail.drain(tail.follow(spark, source, schema), target, ck)
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == list(range(8))


def test_following_a_snapshot_loses_nothing(spark, tmp_path):
    source, state, target, ck = (str(tmp_path / n) for n in ("in", "newest", "out", "ck"))
    schema = "id int, k int, at int"
    write(spark, source, [1, 2])
    assert [r["id"] for r in tail.snapshot(spark, source, schema, "at", "id", state, ck, 1).collect()] == [2]
    tail.deliver(tail.follow(spark, source, schema), target, ck)
    assert tail.delivered(spark, target, schema).count() == 0
    for i in (2, 0, 3):  # a tie, a late row, a newer one
        write(spark, source, [i])
    for _ in range(2):
        tail.deliver(tail.follow(spark, source, schema), target, ck)
    assert sorted(r["id"] for r in tail.delivered(spark, target, schema).collect()) == [0, 2, 3]


SCHEMA = "id int, k int, at int"


def files_of(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_latest_rows_are_kept_by_the_stream(spark, tmp_path):
    source, changes, ck = (str(tmp_path / n) for n in ("in", "changes", "ck"))
    run = lambda: refresh.keep_latest(tail.follow(spark, source, SCHEMA, 1), ["k"], ["at", "id"], changes, ck)
    state = lambda: sorted((r["k"], r["id"]) for r in refresh.latest_rows(spark, changes, SCHEMA, ["k"]).collect())
    spark.createDataFrame([], SCHEMA).write.parquet(source)
    assert refresh.latest_rows(spark, changes, SCHEMA, ["k"]).count() == 0
    write(spark, source, range(6))
    write(spark, source, range(6, 9))
    assert run() >= 1 and run() == -1
    assert state() == [(0, 6), (1, 7), (2, 8)]
    before = files_of(tmp_path / "changes")
    write(spark, source, [20, 1])  # a newer row for one key, an old one for another
    last = run()
    assert state() == [(0, 6), (1, 7), (2, 20)]
    after = files_of(tmp_path / "changes")
    assert before.items() <= after.items()  # nothing that was there is written again
    new = spark.read.parquet(f"{changes}/batch={last}")
    assert {r["k"] for r in new.collect()} <= {1, 2} and new.where("k = 2").first()["id"] == 20
    compacted = refresh.compact(spark, changes, SCHEMA, ["k"], str(tmp_path / "compact"))
    assert sorted((r["k"], r["id"]) for r in refresh.latest_rows(spark, compacted, SCHEMA, ["k"]).collect()) == state()


def test_a_batch_repeated_after_a_crash_gives_the_same_state(spark, tmp_path):
    source, changes, ck = (str(tmp_path / n) for n in ("in", "changes", "ck"))
    write(spark, source, range(6))
    stream = lambda: tail.follow(spark, source, SCHEMA, 1)
    refresh.keep_latest(stream(), ["k"], ["at"], changes, ck)
    write(spark, source, range(6, 9))
    refresh.keep_latest(stream(), ["k"], ["at"], changes, ck)
    want = sorted(map(tuple, refresh.latest_rows(spark, changes, SCHEMA, ["k"]).collect()))
    commit = max((tmp_path / "ck" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for mark in (commit, commit.parent / f".{commit.name}.crc"):  # as if the job had ended between the write and its commit
        mark.unlink(missing_ok=True)
    refresh.keep_latest(stream(), ["k"], ["at"], changes, ck)
    assert sorted(map(tuple, refresh.latest_rows(spark, changes, SCHEMA, ["k"]).collect())) == want


def test_following_ends_when_idle_and_not_before(spark, tmp_path):
    """A file that comes between two empty triggers is delivered, and the count starts again."""
    source, target, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    write(spark, source, range(3))
    late = threading.Timer(5, lambda: write(spark, source, [7]))
    late.start()
    query = tail.follow_until_idle(tail.follow(spark, source, SCHEMA), target, ck, triggers=8)
    late.join()
    assert not query.isActive
    assert sorted(r["id"] for r in tail.delivered(spark, target, SCHEMA).collect()) == [0, 1, 2, 7]
    again = tail.follow_until_idle(tail.follow(spark, source, SCHEMA), target, ck, triggers=2)
    assert not again.isActive and tail.delivered(spark, target, SCHEMA).count() == 4


def lines(spark, rows):
    return spark.createDataFrame(rows, "num string, reference string, code string, val string, pos long")


FILED = [
    ("1", "2020-1", "70", "100", 1), ("1", "2020-1", "9904", "10", 2), ("1", "2021-1", "70", "150", 1), ("1", "2022-1", "70", "300", 1), ("1", "2022-1", "10/15", "50", 2),
    ("2", "2020-1", "70", "40", 1), ("2", "2021-1", "70", "80", 1), ("3", "2021-1", "10/15", "5", 1)]


def books_rows(books):
    columns = sorted(books.yearly.columns)
    return sorted(map(str, books.yearly.select(columns).collect()))


@pytest.mark.parametrize("change", [
    [("1", "2021-1", "70", "200", 9)],  # a value of a year in the middle: growth of that and the next year
    [("1", "2019-5", "70", "1", 1)],  # an earlier year
    [("1", "2020-9", "70", "7", 1)],  # a higher reference takes the year over
    [("1", "2022-1", "Accounting period end date", "2030-12-31", 9)],  # a filing moves to another year
    [("4", "2020-1", "70", "9", 1), ("2", "2021-1", "60", "3", 9)],  # a new enterprise
    [("1", "2020-1", "unused", "1", 9)], []])
def test_carrying_a_change_on_equals_a_rebuild(spark, change):
    now = lines(spark, FILED + change)
    books, changed = refresh.carry_on(refresh.open_books(lines(spark, FILED)), now, lines(spark, change))
    assert books_rows(books) == books_rows(refresh.open_books(now))
    assert {r["num"] for r in changed.collect()} == {c[0] for c in change}


def test_a_deleted_filing_leaves_its_year(spark):
    now = lines(spark, [r for r in FILED if r[1] != "2021-1"])
    books, _ = refresh.carry_on(refresh.open_books(lines(spark, FILED)), now, lines(spark, [("1", "2021-1", "70", "150", 1), ("2", "2021-1", "70", "80", 1), ("3", "2021-1", "10/15", "5", 1)]))
    assert books_rows(books) == books_rows(refresh.open_books(now))


def test_unchanged_enterprises_and_earlier_years_are_not_computed(spark):
    """Marked metrics of other enterprises, and of years before the change, come out as they went in."""
    old = refresh.open_books(lines(spark, FILED))
    marked = refresh.Books(old.filings, old.yearly.withColumn("ebit", F.lit(-12345.0)).withColumn("croissance_ca", F.lit(9.0)))
    books, _ = refresh.carry_on(marked, lines(spark, [*FILED, ("1", "2021-1", "70", "200", 9)]), lines(spark, [("1", "2021-1", "70", "200", 9)]))
    got = {(r["num"], r["year"]): (r["ebit"], r["croissance_ca"]) for r in books.yearly.collect()}
    assert {k for k, v in got.items() if v == (-12345.0, 9.0)} == {("1", "2020"), ("2", "2020"), ("2", "2021"), ("3", "2021")}
    assert got["1", "2021"] == (None, 1.0) and got["1", "2022"] == (-12345.0, 0.5)  # the later year keeps its metrics, its growth is new
