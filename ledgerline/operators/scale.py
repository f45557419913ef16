"""Size checks and skew handling shared by the joins.

A side is broadcast only after a row-count check. Beyond it the join is shuffled, and the
partition of a hot key is split by adaptive execution (``spark.sql.adaptive.skewJoin``), which
can do so for the left side of inner, left, semi and anti joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def fits(df: DataFrame, rows: int) -> bool:
    """True when ``df`` has at most ``rows`` rows; scans no further than needed."""
    return not df.select(F.lit(1)).offset(rows).limit(1).collect()


def checked_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when the row count is within the bound."""
    return F.broadcast(df) if fits(df, rows) else df


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    keys: list[str],
    how: str = "left",
    size_of: DataFrame | None = None,
    bound: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join many facts to a table with one row per key (for semi and anti joins: any rows); the facts are read once.

    ``size_of`` is a cheaper table known to have at least as many rows as ``dim``, such as
    the one it is aggregated from; the size check then stops at the bound. Beyond the bound this is one
    shuffled join, in which adaptive execution splits the facts of a hot or missing key among tasks.
    """
    small = fits(dim if size_of is None else size_of, bound)
    return facts.join(F.broadcast(dim) if small else dim, keys, how)
