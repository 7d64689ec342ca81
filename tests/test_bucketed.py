"""Bucketed match tables: appended rows, repeated shootouts, no exchange in the rebuild."""

import uuid

from pyspark.sql import functions as F

from matchstats.operators.master import build_master, join_master, resolved_inputs
from matchstats.plans.pipeline import fixture_inputs
from matchstats.sources.bucketed import append_matches, bucketed_master
from tests.conftest import SF0001

KEYS = ["match_id"]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_rebuild_from_buckets(spark, scratch):
    inp = fixture_inputs(spark, SF0001)
    tables = resolved_inputs(inp.results, inp.goals, inp.shootouts, inp.former_names)
    name = f"m_{uuid.uuid4().hex}"
    for part in (F.col("match_id") < 500, (F.col("match_id") >= 500) & (F.col("match_id") < 900), F.col("match_id") >= 900):
        append_matches(*(t.filter(part) for t in tables), name, f"{scratch}/store", KEYS, buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        master = bucketed_master(spark, name, KEYS)
        got = rows_of(master)
        plan = master._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == rows_of(build_master(inp.results, inp.goals, inp.shootouts, inp.former_names, KEYS))
    assert "Exchange" not in plan and plan.count("Bucketed: true") >= 3


def test_repeated_shootouts_do_not_fan_out(spark):
    inp = fixture_inputs(spark, SF0001)
    twice = inp.shootouts.union(inp.shootouts)
    assert rows_of(join_master(inp.results, inp.goals, twice, KEYS)) == rows_of(
        join_master(inp.results, inp.goals, inp.shootouts, KEYS))


def test_unused_joins_are_left_out(spark):
    inp = fixture_inputs(spark, SF0001)
    plan = inp.master.select("match_id", "result")._jdf.queryExecution().optimizedPlan().toString()
    assert "first_shooter" not in plan and "own_goal" not in plan
