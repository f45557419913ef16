"""URL filter: a memory-mapped sorted array of 64-bit digests, probed by binary search, confirmed by the stored strings."""

from __future__ import annotations

import io
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import LOWER, UPPER, narrow, whole
from ledgerline.session import new_folder

SEED = 0


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    rest = F.regexp_extract(whole(url), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


class DigestArray:
    """Rules ``(host, path, verdict)`` as files: sorted keys, string offsets, strings, verdicts, path lengths."""

    PARTS = ("keys", "offsets", "strings", "allows", "lengths")

    def __init__(self, folder: str, stem: str):
        self.keys, self.offsets, self.strings, self.allows, self.lengths = (
            np.load(os.path.join(folder, f"{stem}-{p}.npy"), mmap_mode="r") for p in self.PARTS)

    @classmethod
    def build(cls, rules: Iterable[tuple[str, str, bool]], seed: int = SEED) -> dict[str, bytes]:
        """The content of each part's file."""
        from xxhash import xxh64_intdigest

        found = {(host + path).encode(): (host, path, allow) for host, path, allow in rules}
        rows = sorted((xxh64_intdigest(text, seed), text, allow, len(path)) for text, (host, path, allow) in found.items())
        offsets = np.cumsum([0, *(len(r[1]) for r in rows)])
        arrays = {
            "keys": np.array([r[0] for r in rows], np.uint64), "offsets": offsets.astype(np.int64),
            "strings": np.frombuffer(b"".join(r[1] for r in rows) or b"\0", np.uint8), "allows": np.array([r[2] for r in rows], bool),
            "lengths": np.array(sorted({r[3] for r in rows}), np.int64)}
        files = {}
        for part in cls.PARTS:
            out = io.BytesIO()
            np.save(out, arrays[part])
            files[part] = out.getvalue()
        return files

    def find(self, texts: list[bytes], digests: np.ndarray) -> np.ndarray:
        """Place of each text in the array, -1 where it is not there: binary search, then the strings of equal keys."""
        place = np.full(len(texts), -1, np.int64)
        first = np.searchsorted(self.keys, digests, "left")
        last = np.searchsorted(self.keys, digests, "right")
        for i in np.flatnonzero(first < last):
            for k in range(first[i], last[i]):
                if self.strings[self.offsets[k]:self.offsets[k + 1]].tobytes() == texts[i]:
                    place[i] = k
        return place


def ship_rules(spark: SparkSession, rules: Iterable[tuple[str, str, bool]], seed: int = SEED) -> str:
    """Write the array to the shared folder and let every executor fetch the files from there; returns their common name.

    An executor that comes later fetches them too, so they stay for the life of the session.
    """
    folder = new_folder(spark, "urls")
    stem = folder.rsplit("/", 1)[1]
    for part, content in DigestArray.build(rules, seed).items():
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{stem}-{part}.npy")
        out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
        out.write(bytearray(content))
        out.close()
        spark.sparkContext.addFile(path.toString())
    return stem


def url_verdicts(pages: DataFrame, rules: Iterable[tuple[str, str, bool]], id_col: str = "page_id", url_col: str = "url",
                 default: bool = True, seed: int = SEED) -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, verdict``.

    ``rules`` are ``(host, path, allow)``. A rule fits its host and all subdomains where the path starts with the rule's; the
    longest rule (host and path together) wins. Urls that no rule fits get ``default``, null and broken urls included: their
    host and path are empty. Candidates of a url are its host's suffixes with the path prefixes of the lengths in the rules.
    """
    stem = ship_rules(pages.sparkSession, rules, seed)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        array = DigestArray(SparkFiles.getRootDirectory(), stem)
        lengths = array.lengths.tolist()
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            texts, rows, weights = [], [], []
            for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
                if not host:
                    continue
                labels = host.split(".")
                for k in range(len(labels)):
                    tail = ".".join(labels[k:])
                    for n in lengths:
                        if n <= len(path):
                            texts.append((tail + path[:n]).encode())
                            rows.append(i)
                            weights.append(len(tail) + n)
            digests = np.fromiter((xxh64_intdigest(t, seed) for t in texts), np.uint64, len(texts))
            place = array.find(texts, digests)
            best = [-1] * batch.num_rows
            weight = [-1] * batch.num_rows
            for k in np.flatnonzero(place >= 0):
                if weights[k] > weight[rows[k]]:
                    best[rows[k]], weight[rows[k]] = int(k), weights[k]
            rule = [texts[k].decode() if k >= 0 else None for k in best]
            allow = [bool(array.allows[place[k]]) if k >= 0 else default for k in best]
            verdict = ["allow" if a else "block" for a in allow]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=["page_id", "host", "path", "rule", "verdict"])

    rows = narrow(pages, page_id=id_col, url=url_col)
    host, path = split_url(F.col("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(judge, f"page_id {kind}, host string, path string, rule string, verdict string")
