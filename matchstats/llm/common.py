"""Helpers shared by the operators: inputs, shared work tables, code shipping
and a fixed-size membership bitmap."""

from __future__ import annotations

import os
import uuid
import zipfile
from tempfile import mkdtemp

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstats.session import ensure_checkpoint_dir

#: Bits of a membership bitmap: its size never depends on the data.
BITMAP_BITS = 1 << 23


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` once as Parquet to the shared folder and
    read it back, so that a lost executor costs a re-read, not a recompute."""
    path = work_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._work_path = path
    return out


def dropped(df: DataFrame) -> None:
    """Remove the work table that ``written`` made for ``df``; nothing may read
    it any more."""
    spark, path = df.sparkSession, df._work_path
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers (like ``--py-files``), once per
    application; their working folder need not be the repository."""
    sc = spark.sparkContext
    if getattr(sc, "_matchstats_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(mkdtemp(prefix="matchstats-code-"), "matchstats_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _dirs, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(target)
    sc._matchstats_shipped = True


def text_key() -> F.Column:
    """With doc_id, names a row: rows equal in both share their results."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("tkey")


def bitmap_of(df: DataFrame, column: str, bits: int = BITMAP_BITS) -> bytes:
    """Bitmap of the positions ``column mod bits``.  At most ``bits`` distinct
    positions reach the driver (grouped on the executors first), whatever the
    size of ``df``; a full bitmap only lets more rows through to the exact
    join behind it."""
    pos = df.select(F.pmod(F.col(column), F.lit(bits)).alias("p"))
    words = pos.groupBy(F.expr("shiftright(p, 6)").alias("w")).agg(
        F.expr("bit_or(shiftleft(1L, cast(p % 64 AS int)))").alias("v"))
    out = np.zeros(bits // 64, dtype=np.int64)
    table = words.toArrow()
    out[table["w"].to_numpy()] = table["v"].to_numpy()
    return out.tobytes()


def in_bitmap(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    """bitmap: uint64 words; values: uint64 hashes."""
    bits = np.uint64(len(bitmap) * 64)
    p = values % bits
    return (bitmap[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) == 1
