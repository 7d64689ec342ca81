"""Lookup tables: written once, counted, and broadcast only when small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchstats.session import work_table

#: Rows of a lookup table that may be broadcast (names and numbers: some 10 MB).
MOST_BROADCAST_ROWS = 200_000


def lookup_table(df: DataFrame, name: str, most: int = MOST_BROADCAST_ROWS) -> DataFrame:
    """``df``, an aggregate with few rows for the many that look into it,
    written once to the shared folder.  Of at most ``most`` rows it is marked
    for broadcast, so that a join leaves the large side where it is; beyond
    that the join is planned as usual (hot keys split by adaptive execution).
    """
    table = work_table(df, name)
    return F.broadcast(table) if table.count() <= most else table
