"""Records with child tables: one base row per key, the children in long form.

Children are never gathered, so a key may have any number of child rows: results have the same shape and order at every
size. Arrays are built only for a page of keys that the caller names.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Record(NamedTuple):
    """``base`` has one row per key; ``children`` have the key, a position and their fields.

    ``raw`` names, for children that are costly to derive, the tables with the same keys that are cheaper to count; a child
    made of several sources has one for each.
    """

    base: DataFrame
    children: dict[str, DataFrame]
    key: str = "num"
    raw: dict[str, list[DataFrame]] = {}

    def where(self, of_key: Column) -> Record:
        """The record restricted by a condition on its key, before anything is joined."""
        return self._replace(
            base=self.base.where(of_key), children={n: c.where(of_key) for n, c in self.children.items()},
            raw={n: [t.where(of_key) for t in tables] for n, tables in self.raw.items()})

    def rows(self, child: str, *columns: str, every: bool = False) -> DataFrame:
        """Rows of one child beside base ``columns``; rows without a record go.

        ``every`` adds records without child rows (fields NULL). They come from an anti join, so that the inner join can
        still be split where one key has very many rows.
        """
        rows, base = self.children[child], self.base.select(self.key, *columns)
        found = rows.join(base, self.key)
        if not every:
            return found
        return found.unionByName(base.join(rows.select(self.key), self.key, "left_anti"), allowMissingColumns=True)

    def counts(self) -> DataFrame:
        """The base with the number of rows of each child.

        Each child is counted on its own, combined map-side: tables landed with one layout are counted and joined where they
        lie, others are shuffled as counts.
        """
        out, sums = self.base, {}
        for name, child in self.children.items():
            parts = self.raw.get(name, [child])
            for i, part in enumerate(parts):
                out = out.join(part.select(self.key).groupBy(self.key).agg(F.count("*").cast("int").alias(f"{name} {i}")), self.key, "left")
            sums[name] = reduce(lambda a, b: a + b, [F.coalesce(F.col(f"{name} {i}"), F.lit(0)) for i in range(len(parts))])
        return out.select(*self.base.columns, *[total.alias(name) for name, total in sums.items()])

    def nested(self, keys: list[str], order: str = "pos") -> DataFrame:
        """The records of a page of ``keys`` with their children as ordered arrays of structs."""
        part = self.where(F.col(self.key).isin(keys))
        out = part.base
        for name, rows in part.children.items():
            fields = [c for c in rows.columns if c not in (self.key, order)]
            item = F.struct(F.col(order).alias("at"), F.struct(*fields).alias("item"))
            lists = rows.groupBy(self.key).agg(F.sort_array(F.collect_list(item))["item"].alias(name))
            out = out.join(lists, self.key, "left").withColumn(name, F.coalesce(name, F.array()))
        return out


def record(parent: DataFrame, children: dict[str, tuple[DataFrame, list[str]]], key: str = "num", order: str = "pos",
           raw: dict[str, list[DataFrame]] | None = None) -> Record:
    """A record of ``parent`` (one row per key) and its ``children`` (rows, fields), each ordered by ``order``."""
    long = {n: rows.where(F.col(key).isNotNull()).select(key, order, *[f for f in fields if f != order]) for n, (rows, fields) in children.items()}
    return Record(parent, long, key, {n: [df.where(F.col(key).isNotNull()) for df in tables] for n, tables in (raw or {}).items()})
