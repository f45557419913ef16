"""Landed tables: written once, split into files of a target size, bucketed and sorted by the enterprise number.

Tables landed with the same number of buckets are co-partitioned: joins and groupings by the key need no exchange. The
rows are dealt by the key with a rebalance, so that adaptive execution gives a bucket with very many rows to several
tasks, as several files. A bucketed scan would gather them in one task again; a table with such a bucket is therefore
read by its files, and its joins are shuffled and split like any other.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import new_folder

#: Source bytes of a bucket, the least and the largest number of buckets; numbers are powers of two, so that one divides another.
#: A bucket is read by one task, and rows are many times larger in a sort than in their source.
TARGET_BYTES = 8 << 20
#: Shuffled bytes that a writing task should get where the caller names none.
TASK_BYTES = 32 << 20
LEAST, MOST = 8, 16_384
#: A bucket is hot when it has this many times the average and more than this many bytes.
HOT_FACTOR, HOT_BYTES = 4, 256 << 20
#: Row groups let a search for a few keys skip most of a sorted file.
ROW_GROUP_BYTES = 16 << 20


class Landed(NamedTuple):
    """A landed table; ``key`` is None for a table without buckets."""

    name: str
    path: str
    key: str | None
    buckets: int
    hot: bool

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path) if self.hot or self.key is None else spark.table(self.name)


def source_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of the files under the paths; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def bucket_number(size: int) -> int:
    """Power of two for ``size`` bytes, within the bounds."""
    wanted = min(MOST, max(LEAST, -(-size // TARGET_BYTES)))
    return 1 << (wanted - 1).bit_length()


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Session settings for the time of a write; dots are written as ``__``."""
    named = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in named}
    try:
        for k, v in named.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def bucket_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``(bucket, files, bytes)`` of a bucketed table, from the names and sizes of its files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path", "length")
    return files.groupBy(F.regexp_extract("path", r"_(\d+)\.c\d+[^/]*$", 1).cast("int").alias("bucket")).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"))


def land(df: DataFrame, purpose: str, key: str | None, buckets: int, advisory_bytes: int | None = None, path: str | None = None) -> Landed:
    """Write ``df`` to ``path``, in place of what is there, or to a new shared folder.

    Tasks get about ``advisory_bytes`` of shuffled rows; NULL keys are a bucket like any other.
    """
    spark = df.sparkSession
    path, name = path or new_folder(spark, purpose), f"landed_{purpose}_{uuid.uuid4().hex}"
    advisory = advisory_bytes or TASK_BYTES
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes=str(advisory)):
        if key is None:
            df.repartition(buckets).write.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
            return Landed(name, path, None, buckets, False)
        dealt = df.hint("rebalance", buckets, key)
        writer = dealt.write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(key)
        writer.option("parquet.block.size", ROW_GROUP_BYTES).option("path", path).saveAsTable(name)
    largest, total = bucket_sizes(spark, path).agg(F.coalesce(F.max("bytes"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    return Landed(name, path, key, buckets, largest > HOT_BYTES and largest * buckets > HOT_FACTOR * total)
