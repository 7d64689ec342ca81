"""The stateful rolling accuracy equals the batch one: any order, restarts, replays, late rows."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from matchstats.operators.evaluation import rolling_accuracy
from matchstats.streaming import rolling as R

SCHEMA = "model string, date date, match_id long, label int, p_home double, p_draw double, p_away double"


def scored(n, model, seed):
    rng = random.Random(seed)
    return [(model, dt.date(2000, 1, 1) + dt.timedelta(days=rng.randrange(60)), i, rng.randrange(3), rng.random(), rng.random(),
             rng.random()) for i in range(n)]


@pytest.mark.parametrize("window", [20, 100])
def test_equals_the_batch_after_restart_and_replay(spark, scratch, window):
    rows = scored(150, "a", 1) + scored(30, "b", 2)
    random.Random(3).shuffle(rows)
    feed = f"{scratch}/feed"

    def arrive(part):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(feed)

    def check(part):
        got = {r["model"]: (round(r["rolling_accuracy"], 9), r["n"]) for r in R.current_accuracy(spark, scratch, window).collect()}
        df = spark.createDataFrame(part, SCHEMA)
        for m in {r[0] for r in part}:
            want = rolling_accuracy(df.filter(F.col("model") == m), ["date", "match_id"], window).first()
            assert got[m] == (round(want["rolling_accuracy"], 9), want["n"])

    arrive(rows[:60])
    arrive(rows[60:110])
    R.run_rolling_stream(spark, feed, SCHEMA, scratch, ["match_id"], window)
    check(rows[:110])
    arrive(rows[110:])
    arrive(rows[40:90])  # delivered twice
    R.run_rolling_stream(spark, feed, SCHEMA, scratch, ["match_id"], window)  # a restart from the state
    check(rows)
    # an epoch that was done but not committed runs again
    commits = sorted((int(n) for n in os.listdir(f"{scratch}/_checkpoint/commits") if n.isdigit()))
    for name in (f"{commits[-1]}", f".{commits[-1]}.crc"):
        os.remove(f"{scratch}/_checkpoint/commits/{name}")
    R.run_rolling_stream(spark, feed, SCHEMA, scratch, ["match_id"], window)
    check(rows)
