"""Feature-matrix statistics.

All of them are single-pass aggregates over the feature matrix, or a long
(feature, value) form made with ``unpivot`` and aggregated per feature.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchstats.functions import scalar as S
from matchstats.session import ship_code

#: Rows whose products a task adds up at a time.
CORR_ROWS = 16384


def feature_group(name: str) -> str:
    if name.startswith("h2h_"):
        return "C_head_to_head"
    if name in ("is_neutral", "tournament_tier", "is_knockout"):
        return "D_context"
    if name.endswith("_diff"):
        return "differential"
    if "form_" in name or "_last" in name or "momentum" in name or "days_since" in name:
        return "B_recent_form"
    return "A_career"


def feature_corr(fm: DataFrame, feats: list[str]) -> DataFrame:
    """Pearson correlation of every feature pair, long format.

    The features are computed and read once: each partition gives its rows,
    means and centred products (a len(feats) x len(feats) array, a bounded
    object), which are put together.  A null makes its feature's correlations
    NaN, as does a feature that doesn't vary."""
    ship_code(fm.sparkSession)
    k = len(feats)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, CORR_ROWS):
                columns = batch.slice(at, CORR_ROWS).columns
                x = np.stack([c.fill_null(np.nan).to_numpy(zero_copy_only=False) for c in columns])
                mean = x.mean(axis=1)
                x = x - mean[:, None]
                total = merged_moments(total, (x.shape[1], mean, x @ x.T))
        if total is not None:
            n, mean, products = total
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([mean.tobytes()], pa.binary()),
                                              pa.array([products.tobytes()], pa.binary())], ["n", "mean", "products"])

    parts = fm.select(*[F.col(f).cast("double").alias(f) for f in feats]).mapInArrow(run, "n long, mean binary, products binary")
    total = None
    for r in parts.collect():  # one small row of each partition
        total = merged_moments(total, (r["n"], np.frombuffer(r["mean"]), np.frombuffer(r["products"]).reshape(k, k)))
    if total is None or total[0] < 2:
        raise ValueError("a correlation needs two rows")
    spread = np.sqrt(np.diag(total[2]))
    spread = np.where(spread / math.sqrt(total[0] - 1) > 1e-12, spread, np.nan)
    mat = total[2] / spread[:, None] / spread
    rows = [(f"{a}|{b}", float(mat[i][j])) for i, a in enumerate(feats) for j, b in enumerate(feats) if j > i]
    return fm.sparkSession.createDataFrame(rows, "pair string, corr double")


def merged_moments(a: tuple | None, b: tuple) -> tuple:
    """(rows, means, centred products) of two sets of rows together."""
    if a is None:
        return b
    n, gap = a[0] + b[0], b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)


def feature_label_corr(fm: DataFrame, feats: list[str], top: int = 15) -> DataFrame:
    """A23 + T10: |corr(feature, label 0/1/2)|, top ``top``."""
    y = S.encode_result("result").cast("double")
    row = fm.agg(*[F.abs(F.corr(F.col(f).cast("double"), y)).alias(f) for f in feats])
    long = row.unpivot([], feats, "feature", "abs_corr")
    return long.orderBy(F.col("abs_corr").desc(), "feature").limit(top)


def _long(fm: DataFrame, feats: list[str]) -> DataFrame:
    cast = fm.select(*[F.col(f).cast("double").alias(f) for f in feats])
    return cast.unpivot([], feats, "feature", "v")


def feature_histogram(fm: DataFrame, feats: list[str], bins: int = 30) -> DataFrame:
    """Features with <= 3 distinct values -> value counts; others ->
    ``bins`` equal-width bins between min and max (last bin closed).

    Two readings: one row of bounds, then one aggregate by (feature, bin).
    A feature has at most three values when all of its values strictly
    between the bounds are equal, which the least and greatest of them tell;
    no distinct count is needed.  Nulls are a row of their own (null bounds)."""
    cast = fm.select(*[F.col(f).cast("double").alias(f) for f in feats])
    bounds = cast.agg(*[F.struct(F.min(f).alias("lo"), F.max(f).alias("hi")).alias(f) for f in feats])
    st = bounds.unpivot([], feats, "feature", "r").select("feature", "r.lo", "r.hi")  # a row per feature
    v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
    span = hi - lo
    binned = F.when(v.isNull(), F.lit(None)).when(hi == lo, F.lit(0)).otherwise(  # least() alone would skip the null
        F.least(F.floor((v - lo) * bins / span), F.lit(bins - 1))).cast("int")
    inner = F.when((v > lo) & (v < hi), v)
    per = _long(fm, feats).join(F.broadcast(st), "feature").groupBy("feature", "lo", "hi", binned.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(v == lo, 1)).alias("n_lo"), F.count(F.when(v == hi, 1)).alias("n_hi"),
        F.min(inner).alias("mid"), F.max(inner).alias("mid_2"), F.count(inner).alias("n_mid"))
    tot = per.groupBy("feature", "lo", "hi").agg(
        F.collect_list(F.struct("bin", "n")).alias("b"),  # at most bins + 1
        F.sum("n_lo").alias("n_lo"), F.sum("n_hi").alias("n_hi"), F.min("mid").alias("mid"), F.max("mid_2").alias("mid_2"),
        F.sum("n_mid").alias("n_mid"), F.sum(F.when(F.col("bin").isNull(), F.col("n")).otherwise(0)).alias("n_none"))

    def row(kind, b, lower, upper, n):
        return F.struct(F.lit(kind).alias("kind"), b.cast("int").alias("bin"), lower.cast("double").alias("lower"),
                        upper.cast("double").alias("upper"), n.cast("long").alias("n"))

    none = F.lit(None)
    values = F.filter(F.array(
        row("value", none, lo, lo, F.col("n_lo")), row("value", none, hi, hi, F.when(hi > lo, F.col("n_hi")).otherwise(0)),
        row("value", none, F.col("mid"), F.col("mid"), F.col("n_mid")), row("value", none, none, none, F.col("n_none"))),
        lambda x: x["n"] > 0)
    in_bins = F.transform("b", lambda x: row("bin", x["bin"], lo + x["bin"] * span / bins, lo + (x["bin"] + 1) * span / bins, x["n"]))
    few = F.coalesce(F.col("mid") == F.col("mid_2"), F.lit(True))
    return tot.select("feature", F.explode(F.when(few, values).otherwise(in_bins)).alias("r")).select("feature", "r.*")


def feature_summary(fm: DataFrame, feats: list[str]) -> DataFrame:
    """Mean and sample std per feature."""
    groups = F.create_map(*[x for f in feats for x in (F.lit(f), F.lit(feature_group(f)))])
    return (_long(fm, feats).groupBy("feature").agg(F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"))
            .withColumn("feature_group", groups[F.col("feature")]))


def standardise(fm: DataFrame, feats: list[str], id_cols: list[str]) -> DataFrame:
    """M1: Spark ML StandardScaler (mean and sample std), back to columns."""
    va = VectorAssembler(inputCols=feats, outputCol="__x")
    x = va.transform(fm.select(*id_cols, *[F.col(f).cast("double").alias(f) for f in feats]))
    model = StandardScaler(inputCol="__x", outputCol="__z", withMean=True, withStd=True).fit(x)
    z = model.transform(x).select(*id_cols, vector_to_array("__z").alias("__z"))
    return z.select(*id_cols, *[F.col("__z")[i].alias(f"z_{f}") for i, f in enumerate(feats)])


def class_weights(fm: DataFrame, id_cols: list[str]) -> DataFrame:
    """M6: balanced weight n / (k * n_c) per class (row counts), times
    match_weight for LR / RF / extra trees; boosting uses match_weight.

    Two readings of ``fm``: the class counts, which give n and k too (one row
    with a map of at most a few classes), and the rows."""
    lab = fm.select(*id_cols, "match_weight", S.encode_result("result").alias("label"))
    counts = lab.groupBy("label").agg(F.count(F.lit(1)).alias("nc"))
    entry = F.struct("label", F.col("nc"))
    found = counts.agg(F.struct(F.sum("nc").alias("n"), F.count(F.lit(1)).alias("k"), F.map_from_entries(
        F.collect_list(F.when(F.col("label").isNotNull(), entry))).alias("nc"))).scalar()
    j = lab.filter(F.col("label").isNotNull()).withColumn("__c", found)
    weight = F.col("__c.n") / (F.col("__c.k") * F.element_at("__c.nc", F.col("label")))
    return j.select(*id_cols, "label", weight.alias("class_weight"), (weight * F.col("match_weight")).alias("sample_weight"),
                    F.col("match_weight").cast("double").alias("boost_weight"))
