"""Archived files: filing lines, pages, catalogues, exports."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterator
from itertools import groupby, islice
from urllib.parse import quote, urlsplit
from zlib import crc32

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.text import line_code, line_value, path_enterprise, path_reference
from ledgerline.operators.scale import fits, lookup
from ledgerline.sources.landing import settings
from ledgerline.sources.register import line_position


def few_listing_tasks(spark: SparkSession):
    """Setting under which a folder of very many folders is listed by a few tasks per core, not by one for each folder."""
    return settings(spark, spark__sql__sources__parallelPartitionDiscovery__parallelism=str(4 * spark.sparkContext.defaultParallelism))


def text_lines(spark: SparkSession, glob: str) -> DataFrame:
    """Lines of many small files with their path and place."""
    with few_listing_tasks(spark):
        raw = spark.read.option("recursiveFileLookup", True).text(glob)  # folder names are read from the path, not as partitions
    return raw.select("value", F.col("_metadata.file_path").alias("path"), line_position().alias("pos"))


def filing_lines(lines: DataFrame) -> DataFrame:
    """Code and value of each line; enterprise and reference come from the path ``../{num}/hbb/{ref}.csv``.

    Lines keep their order in the file where they carry a position (``text_lines``), also when a scan splits the file.
    """
    pos = place_in_file(F.col("pos")) if "pos" in lines.columns else F.monotonically_increasing_id()
    parsed = lines.select(
        path_enterprise(F.col("path")).alias("num"), path_reference(F.col("path")).alias("reference"),
        line_code(F.col("value")).alias("code"), line_value(F.col("value")).alias("val"), pos.alias("pos"),
    )
    return parsed.where(F.col("code") != "")


def place_in_file(pos: Column) -> Column:
    """Line position as one number of fixed width: split of the file, then row of its task."""
    row = pos["row"].bitwiseAND(F.lit((1 << 33) - 1))  # the upper bits number the task
    return pos["block"].cast("decimal(19,0)") * F.lit(1 << 33).cast("decimal(11,0)") + row


def account_lines(accounts: DataFrame) -> DataFrame:
    """Lines of the filing texts stored with the accounts, under the path each has in the archive."""
    path = F.concat(F.lit("/"), "num", F.lit("/hbb/"), "reference", F.lit(".csv"))
    return accounts.where(exportable(accounts)).select(path.alias("path"), F.explode(F.split("raw_csv", "\r?\n")).alias("value"))


def of_keys(table: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """The asked columns of a stored table, for a set of enterprises."""
    return lookup(table.select("num", *columns), keys.select("num"), ["num"], "left_semi")


def first_filled(*sources: Callable[[], DataFrame]) -> DataFrame:
    """The first source that can be read and has rows; the last one is returned as it is."""
    for source in sources[:-1]:
        try:
            df = source()
            if not fits(df, 0):
                return df
        except PySparkException:
            continue
    return sources[-1]()


def whole_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Archived pages as text; bytes that are not UTF-8 are dropped."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    text = F.replace(F.make_valid_utf8(F.col("content").cast("string")), F.lit("�"), F.lit(""))
    return raw.select("path", text.alias("html"))


def catalogue(files: DataFrame, source: str) -> DataFrame:
    """File catalogue with a fixed id ``source:enterprise:filename``, size and checksum."""
    name = F.substring_index("path", "/", -1)
    return files.select(
        F.concat_ws(":", F.lit(source), "enterprise", name).alias("id"), F.lit(source).alias("source"), "enterprise",
        name.alias("filename"), "path", F.length("content").cast("long").alias("size_bytes"),
        F.sha2("content", 256).alias("sha256"),
    )


def folder_stats(spark: SparkSession, folder: str, pattern: str | None = None) -> DataFrame:
    """Number of files, total size and number of folders; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return stats_of(reader.load(folder).select("path", "length"))


def stats_of(files: DataFrame) -> DataFrame:
    """The same numbers from a catalogue of files ``(path, length)``."""
    return files.agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"),
        F.countDistinct(F.regexp_replace("path", "/[^/]+$", "")).alias("folders"),
    )


def exportable(accounts: DataFrame):
    """Whether enterprise, reference and text are all there."""
    return (
        (F.coalesce(F.col("num"), F.lit("")) != "") & (F.coalesce(F.col("reference"), F.lit("")) != "")
        & (F.coalesce(F.col("raw_csv"), F.lit("")) != "")
    )


def export_counts(accounts: DataFrame) -> DataFrame:
    ok = exportable(accounts)
    return accounts.agg(F.count_if(ok).alias("written"), F.count_if(~ok).alias("skipped"))


#: Characters that Spark escapes in the folder name of a partition.
_ESCAPED = r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]"""
#: Characters of a path that its URI has as escapes.
_QUOTED = r"""[\x00-\x20"#%<>?\[\\\]^`{|}\x7f-\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"""


def export_accounts(accounts: DataFrame, target: str, only: DataFrame | None = None) -> None:
    """One text file per (enterprise, reference), in place of what is there.

    In a mounted folder the tasks write the files themselves: Hadoop's local file system starts a process for the rights of
    each folder, file and checksum. Other stores go through Spark's writer.
    """
    kept = accounts.where(exportable(accounts))
    if only is not None:
        kept = lookup(kept, only.select("num"), ["num"], "left_semi")
    rows = kept.select(F.col("num").alias("enterprise"), "reference", F.col("raw_csv").alias("value"))
    if not (folder := _mounted(target)):
        rows.write.mode("overwrite").partitionBy("enterprise", "reference").option("lineSep", "\n").text(target)
        return
    rows.select("value").limit(0).write.mode("overwrite").text(target)
    dealt = rows.repartition("enterprise", "reference").sortWithinPartitions("enterprise", "reference", "value")
    dealt.withColumn("value", F.col("value").cast("binary")).foreachPartition(_file_writer(folder))


def _mounted(folder: str) -> str | None:
    """Path of a folder that the tasks can open themselves, None in other stores."""
    return re.sub("^file:(//[^/]*)?", "", folder) if urlsplit(folder).scheme in ("", "file") else None


def _file_writer(folder: str) -> Callable[[Iterator], None]:
    """Writes sorted rows as files named by their filing; a repeated task writes the same files again."""
    special = re.compile(_ESCAPED)

    def write(rows: Iterator) -> None:
        for names, texts in groupby(rows, key=lambda r: (r["enterprise"], r["reference"])):
            enterprise, reference = (special.sub(lambda m: f"%{ord(m[0]):02X}", n) for n in names)
            path = os.path.join(folder, f"enterprise={enterprise}", f"reference={reference}")
            os.makedirs(path, exist_ok=True)
            unfinished = os.path.join(path, f".{uuid.uuid4().hex}")
            with open(unfinished, "wb") as file:
                for row in texts:
                    file.write(bytes(row["value"]) + b"\n")
            os.replace(unfinished, os.path.join(path, "part-00000.txt"))

    return write


def exported_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, uri, content)`` of the files that ``export_accounts`` wrote, without empty ones.

    In a mounted folder the tasks list and read them: Spark's index of files holds every one on the driver. The names are dealt
    anew before the reading, so that the files of one large enterprise are read by many tasks. Other stores go through that index.
    """
    path = _mounted(folder)
    if not path:
        with few_listing_tasks(spark):
            return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", F.col("_metadata.file_path").alias("uri"), "content")
    tasks = 4 * spark.sparkContext.defaultParallelism
    names = spark.range(0, tasks, 1, tasks).mapInArrow(_file_lister(path, tasks), "name binary")
    return names.repartition(tasks, "name").mapInArrow(_file_reader(), "path string, uri string, content binary")


def _file_lister(folder: str, tasks: int, most: int = 10_000) -> Callable[[Iterator], Iterator]:
    """Names of the files that Spark would list; each task goes through its share of what lies in the folder."""

    def shown(name: bytes) -> bool:
        return not (name.startswith(b".") or (name.startswith(b"_") and b"=" not in name) or name.endswith(b"._COPYING_"))

    def below(entries: Iterator) -> Iterator[bytes]:
        for entry in entries:
            if not shown(entry.name):
                continue
            if entry.is_dir():
                with os.scandir(entry.path) as inside:
                    yield from below(inside)
            else:
                yield entry.path

    def listed(batches: Iterator) -> Iterator:
        for task in (k for batch in batches for k in batch.column(0).to_pylist()):
            with os.scandir(folder.encode()) as inside:
                found = below(x for x in inside if crc32(x.name) % tasks == task)
                while names := list(islice(found, most)):
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary())], ["name"])

    return listed


def _file_reader(most: int = 1_000, most_bytes: int = 4 << 20) -> Callable[[Iterator], Iterator]:
    """Paths, as they are and as Spark's ``file_path`` has them, and contents of the named files, a bounded number at a time."""
    quoted = re.compile(_QUOTED)

    def batch(paths: list[str], texts: list[bytes]) -> pa.RecordBatch:
        uris = [quoted.sub(lambda m: quote(m[0], safe=""), p) for p in paths]
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(uris, pa.string()), pa.array(texts, pa.binary())], ["path", "uri", "content"])

    def read(batches: Iterator) -> Iterator:
        paths, texts, size = [], [], 0
        for name in (x for batch in batches for x in batch.column(0).to_pylist()):
            with open(name, "rb") as file:
                text = file.read()
            if not text:
                continue
            paths.append("file:" + name.decode("utf-8", "replace"))
            texts.append(text)
            size += len(text)
            if len(paths) == most or size >= most_bytes:
                yield batch(paths, texts)
                paths, texts, size = [], [], 0
        if paths:
            yield batch(paths, texts)

    return read


def exported_texts(spark: SparkSession, folder: str) -> DataFrame:
    """``(num, reference, value)`` of the files that ``export_accounts`` wrote, each with its whole text."""

    def name(part: str) -> Column:
        return F.url_decode(F.replace(F.regexp_extract("path", f"/{part}=([^/]+)/[^/]+/?[^/]*$", 1), F.lit("+"), F.lit("%2B")))

    return exported_files(spark, folder).select(
        name("enterprise").alias("num"), name("reference").alias("reference"), F.col("content").cast("string").alias("value"))


def exported_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the files that ``export_accounts`` wrote with their path and place, as ``text_lines`` has them."""
    if not _mounted(folder):
        return text_lines(spark, folder)
    text = F.col("content").cast("string")
    whole = F.when(text.startswith("\ufeff"), F.substr(text, F.lit(2))).otherwise(text)
    split = exported_files(spark, folder).select(F.col("uri").alias("path"), F.split(whole, "\r\n|\r|\n").alias("lines"))
    ended = F.when(F.element_at("lines", -1) == "", F.slice("lines", F.lit(1), F.size("lines") - 1)).otherwise(F.col("lines"))
    lines = split.select("path", F.posexplode(ended).alias("row", "value"))
    place = F.struct(F.col("path").alias("file"), F.lit(0).cast("long").alias("block"), F.col("row").cast("long").alias("row"))
    return lines.select("value", "path", place.alias("pos"))


def archive_pages(pages: DataFrame) -> DataFrame:
    """Archive rows ``(num, page, html, scraped_at)``; the last page scraped under a key stays."""
    return pages.select("num", "page", "html", F.current_timestamp().alias("scraped_at"))
