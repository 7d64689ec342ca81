"""Bucketed match tables.

Results, goals and shootouts with resolved names are stored in buckets of the
match key, sorted within.  New rows are appended to the same buckets, and a
rebuild of master then joins and aggregates bucket by bucket: no table is
exchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchstats.operators.master import join_master

#: Buckets of a table; at 100 TB some thousands, so that a bucket fits a task.
BUCKETS = 16
TABLES = ("results", "goalscorers", "shootouts")


def append_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int = BUCKETS) -> None:
    """Add rows to a bucketed table, which the first call makes at ``path``.
    Rows go to their bucket before the write, so that each append leaves one
    file per bucket."""
    (df.repartition(buckets, *keys).write.mode("append").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).saveAsTable(table))


def append_matches(results: DataFrame, goals: DataFrame, shootouts: DataFrame, name: str, path: str, keys: list[str],
                   buckets: int = BUCKETS) -> None:
    """Add rows (names resolved) to the three tables of store ``name``."""
    for table, df in zip(TABLES, (results, goals, shootouts)):
        append_bucketed(df, f"{name}_{table}", f"{path}/{table}", keys, buckets)


def bucketed_master(spark: SparkSession, name: str, keys: list[str]) -> DataFrame:
    """Master from the store's buckets."""
    return join_master(*(spark.table(f"{name}_{t}") for t in TABLES), keys)
