"""Progress and structure reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.nest import Record


def metric_rows(one_row: DataFrame) -> DataFrame:
    """Columns of a one-row aggregate as (metric, value) rows."""
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in one_row.columns]
    return one_row.select(F.explode(F.array(*pairs)).alias("m")).select("m.*")


def progress(targets: DataFrame, documents: DataFrame, accounts: DataFrame, records: DataFrame) -> DataFrame:
    """All progress figures; each table is read once."""
    status = F.col("status")
    done = status == "done"
    parts = [
        targets.agg(
            F.count("*").alias("cibles"), F.count_if(done).alias("done"), F.count_if(status == "pending").alias("pending"),
            F.count_if(status == "error").alias("error"),
            F.round(F.coalesce(F.try_divide(F.count_if(status.isin("done", "error")) * 100, F.count("*")), F.lit(0.0)), 1).alias("pct"),
            F.coalesce(F.sum(F.when(done, F.col("filings_count"))), F.lit(0)).alias("filings"),
            F.count_if(done & (F.col("filings_count") == 0)).alias("done_without_filing"),
        ),
        documents.agg(
            F.count("*").alias("documents"), F.count_if(F.col("source") == "nbb").alias("documents_nbb"),
            F.count_if(F.col("source") == "notaire").alias("documents_notaire"),
        ),
        accounts.agg(F.count("*").alias("comptes")),
        records.agg(F.count("*").alias("fiches")),
    ]
    return reduce(DataFrame.unionByName, [metric_rows(p) for p in parts])


def _in_items(items: Column, field: str) -> Column:
    """How many items of an array of structs have the field."""
    return F.coalesce(F.size(F.filter(items, lambda x: x[field].isNotNull())), F.lit(0)).cast("long")


def _values(kind: T.DataType, value: Column, path: str) -> list[tuple[str, Column]]:
    """Path and number of values in one row, of a field and the fields inside it; an empty array holds no value."""
    if isinstance(kind, T.ArrayType):
        inner = kind.elementType.names if isinstance(kind.elementType, T.StructType) else []
        return [(path, (F.coalesce(F.size(value), F.lit(0)) > 0).cast("long")), *[(f"{path}.{f}", _in_items(value, f)) for f in inner]]
    inside = kind.fields if isinstance(kind, T.StructType) else []
    return [(path, value.isNotNull().cast("long")), *[v for f in inside for v in _values(f.dataType, value[f.name], f"{path}.{f.name}")]]


def _counted(rows: DataFrame) -> DataFrame:
    """``(key, n)`` of every field, in one aggregate that combines map-side."""
    fields = [v for f in rows.schema.fields for v in _values(f.dataType, F.col(f"`{f.name}`"), f.name)]
    sums = rows.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(str(i)) for i, (_, n) in enumerate(fields)])
    pairs = F.array(*[F.struct(F.lit(path).alias("key"), F.col(str(i)).alias("n")) for i, (path, _) in enumerate(fields)])
    return sums.select(F.explode(pairs).alias("p")).select("p.*")


def keys_in_use(of: Record, order: str = "pos") -> DataFrame:
    """``(key, n)``: field paths of the records that hold a value somewhere, and how many.

    Base fields (inside structs and arrays of structs too), each child as its number of rows, and the child's fields. A field
    that is NULL in all records is not listed.
    """
    parts = [_counted(of.base)]
    for name, child in of.children.items():
        rows = of.rows(name)
        fields = rows.select(F.lit(1).alias(name), *[F.col(c).alias(f"{name}.{c}") for c in child.columns if c not in (of.key, order)])
        parts.append(_counted(fields))
    return reduce(DataFrame.unionByName, parts).where("n > 0")


def map_keys_seen(codes: DataFrame, prefix: str) -> DataFrame:
    """``(key, n)`` of a code map, from its long form."""
    return codes.groupBy(F.concat(F.lit(f"{prefix}."), "code").alias("key")).agg(F.count("*").alias("n"))
