"""Readers and writers.

CSV inputs are read with explicit schemas and FAILFAST, so a malformed row
or a missing file fails the job instead of silently producing NULLs.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstats.sources.schemas import (
    FORMER_NAMES_SCHEMA, GOALSCORERS_SCHEMA, RESULTS_SCHEMA, SHOOTOUTS_SCHEMA,
)

RAW_FILES = {
    "results": ("results.csv", RESULTS_SCHEMA),
    "goalscorers": ("goalscorers.csv", GOALSCORERS_SCHEMA),
    "shootouts": ("shootouts.csv", SHOOTOUTS_SCHEMA),
    "former_names": ("former_names.csv", FORMER_NAMES_SCHEMA),
}


def read_raw_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Typed CSV scan. ``NA`` and empty fields are NULL; ``TRUE``/``True``
    parse as booleans.  A missing path raises PATH_NOT_FOUND (S2)."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("nullValue", "NA")
        .option("mode", "FAILFAST")
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )


def load_raw_tables(spark: SparkSession, data_dir: str) -> dict[str, DataFrame]:
    """S1 + S2: the four inputs as typed DataFrames; all four must exist."""
    # Spark resolves the file listing when the relation is created, so a
    # missing source raises PATH_NOT_FOUND right here.
    return {
        name: read_raw_csv(spark, f"{data_dir.rstrip('/')}/{fname}", schema)
        for name, (fname, schema) in RAW_FILES.items()
    }


def write_master_parquet(master: DataFrame, path: str, partition_by_decade: bool = True) -> None:
    """S3: master sink, partitioned by decade so date filters prune files."""
    out = master
    if partition_by_decade:
        out = master.withColumn("decade", (F.floor(F.year("date") / 10) * 10).cast("int"))
        out.write.mode("overwrite").partitionBy("decade").parquet(path)
    else:
        out.write.mode("overwrite").parquet(path)


def write_master_csv(master: DataFrame, path: str) -> None:
    """CSV sink with header (written by the executors, never collected)."""
    master.write.mode("overwrite").option("header", True).option("nullValue", "NA").csv(path)


def append_jsonl(records: DataFrame, path: str) -> None:
    """JSON-lines append sink."""
    records.write.mode("append").json(path)


def read_scorer_source(spark: SparkSession, goal_csv: str | None, goals: DataFrame) -> DataFrame:
    """Optional pre-aggregated scorer file; falls back to raw goal rows.

    The fallback is folded into the top-scorers operator, which aggregates
    raw goal rows itself, so here we only pick the input.
    """
    if goal_csv:
        try:
            return spark.read.option("header", True).option("inferSchema", True).csv(goal_csv)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":  # only an absent file is optional
                raise
    return goals
