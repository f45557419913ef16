"""Per-item work with captured failures."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def run_items(items: DataFrame, make_context: Callable[[], Any], handle: Callable[[Any, Any], str], key: str = "num") -> DataFrame:
    """``(key, outcome, error)`` of a handler called per row, with one context per task.

    A failing item gives an ``error`` row and never fails the job.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = make_context()
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                try:
                    out.append((getattr(row, key), handle(context, row), None))
                except Exception as exc:  # noqa: BLE001
                    out.append((getattr(row, key), "error", str(exc)))
            yield pd.DataFrame(out, columns=[key, "outcome", "error"])

    return items.mapInPandas(work, f"{key} string, outcome string, error string")
