"""Distributed building blocks against plain pandas."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from matchstats.operators import rownum as R
from matchstats.operators.asof import asof_strict
from matchstats.operators.rownum import global_row_number, prefix_sums


def _frame(spark, n=5000, days=7, seed=1):
    rng = random.Random(seed)
    ids = rng.sample(range(10 * n), n)
    rows = [(i, dt.date(2000, 1, 1) + dt.timedelta(days=rng.randrange(days)), rng.randrange(3)) for i in ids]
    return spark.createDataFrame(rows, "id long, date date, g int").repartition(13)


def test_global_row_number_many_partitions_hot_dates(spark):
    df = _frame(spark)
    got = global_row_number(df, ["date", "id"], num_partitions=11).toPandas()
    exp = got.sort_values(["date", "id"]).reset_index(drop=True)
    assert list(exp.row_idx) == list(range(len(exp)))


def test_prefix_sums_match_pandas(spark):
    df = _frame(spark).withColumn("v", (F.col("id") % 7).cast("long"))
    got = prefix_sums(df, ["g"], [F.col("date").desc(), F.col("id").desc()], ["v"], num_partitions=9).toPandas()
    pdf = got.sort_values(["g", "date", "id"], ascending=[True, False, False])
    exp = pdf.groupby("g")["v"].cumsum()
    assert (pdf["cum_v"].values == exp.values).all()


def test_asof_strict_same_day_and_ties(spark):
    D = dt.date
    states = spark.createDataFrame([
        ("A", D(2000, 1, 1), 1, "s1"), ("A", D(2000, 1, 1), 2, "s2"),  # same day: last by id wins
        ("A", D(2000, 1, 3), 3, "s3"), ("B", D(2000, 1, 2), 4, "b1")],
        "k string, date date, id int, s string")
    queries = spark.createDataFrame([
        (1, "A", D(2000, 1, 1)), (2, "A", D(2000, 1, 2)), (3, "A", D(2000, 1, 3)), (4, "A", D(2000, 1, 9)),
        (5, "B", D(2000, 1, 2)), (6, "C", D(2000, 1, 5))], "q int, k string, date date")
    out = {r["q"]: r["s"] for r in asof_strict(queries, states, ["k"], "date", ["s"], order_cols=["id"]).collect()}
    assert out == {1: None, 2: "s2", 3: "s2", 4: "s3", 5: None, 6: None}


def _ordered(df, order):
    """Rows as a sort with nulls first puts them."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(r[i] is not None, r[i] if r[i] is not None else 0) for i in order])


@pytest.mark.parametrize("max_days,max_day_rows", [(1 << 17, 1 << 20), (1 << 17, 10), (3, 1 << 20)])
def test_rank_cuts_folds_and_splits(spark, monkeypatch, max_days, max_day_rows):
    """Positions by counts per day, with a hot day, null days, days too large for a task and too many days."""
    monkeypatch.setattr(R, "MAX_DAYS", max_days)
    monkeypatch.setattr(R, "MAX_DAY_ROWS", max_day_rows)
    day = F.when(F.col("id") % 3 == 0, F.lit(dt.date(2000, 1, 4))).when(F.col("id") % 50 != 0, F.col("date"))
    df = _frame(spark, n=900).withColumn("date", day).persist()
    rows, order = _ordered(df, (1, 0)), ["date", "id"]
    n = len(rows)
    wanted = [0, 1, 299, 450, n - 1, n, n + 7, -1]
    assert R.rank_cuts(df, order, wanted) == [(rows[p][1], rows[p][0]) if 0 <= p < n else None for p in wanted]
    assert {r["id"]: r["row_idx"] for r in R.row_numbers(df, order).collect()} == {r[0]: i for i, r in enumerate(rows)}
    got = {r["id"]: r["split"] for r in R.temporal_split(df, order, 0.77).collect()}
    assert got == {r[0]: "train" if i < int(n * 0.77) else "test" for i, r in enumerate(rows)}
    size = n // 6
    got = {r["id"]: r["test_fold"] for r in R.cv_folds(df, order).collect()}
    assert got == {r[0]: -1 if i < n - 5 * size else (i - (n - 5 * size)) // size for i, r in enumerate(rows)}


def test_split_of_small_and_empty_tables(spark):
    df = _frame(spark, n=4)
    assert R.temporal_split(df.limit(0), ["date", "id"]).count() == 0
    assert {r["test_fold"] for r in R.cv_folds(df, ["date", "id"]).collect()} == {-1}
    assert [r["split"] for r in R.temporal_split(df, ["date", "id"], 1.0).collect()] == ["train"] * 4


def test_feature_rows_are_not_exchanged(spark):
    df = _frame(spark).withColumn("feature", F.rand(1))
    base = df._jdf.queryExecution().executedPlan().toString().count("Exchange")
    for out in (R.temporal_split(df, ["date", "id"]), R.cv_folds(df, ["date", "id"])):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == base and "rangepartitioning" not in plan
