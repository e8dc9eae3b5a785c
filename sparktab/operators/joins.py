"""Joining fitted lookup tables back onto row tables.

A lookup (an encoder map, a price table, fit statistics) is usually tiny, but its size grows with
the number of categories, so it is broadcast only after its row count has been checked.  Beyond the
bound the join stays a shuffle join and AQE's skew-join split handles hot keys.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a lookup that may be shipped to every executor (a few MB at most).
MAX_BROADCAST_ROWS = 2_000_000


def checked_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Persist ``df`` and report whether it is small enough to broadcast.

    Fitted lookups are aggregates of the data, so counting them is cheap next to the data pass
    that produced them; the count runs once and leaves the lookup cached for the join.
    """
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    n = df.count()  # one job that also fills the cache the join will read
    return df, n <= max_rows


def attach(rows: DataFrame, lookup: DataFrame, on, how: str = "left",
           max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Join ``lookup`` onto ``rows``; broadcast hint only behind a checked row bound."""
    lookup, small = checked_small(lookup, max_rows)
    return rows.join(F.broadcast(lookup) if small else lookup, on=on, how=how)
