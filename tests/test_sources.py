"""Sources and sinks (S1-S7) and the streaming hook."""

import os

import pytest
from pyspark.sql import functions as F

from matchstats.plans.pipeline import csv_inputs, fixture_inputs
from matchstats.sources.io import (
    append_jsonl, load_raw_tables, read_scorer_source, write_master_csv, write_master_parquet,
)
from tests.conftest import SF0001

RESULTS_CSV = """date,home_team,away_team,home_score,away_score,tournament,city,country,neutral
1998-06-10,OLD,B,2,1,FIFA World Cup,Paris,France,TRUE
1998-06-11,B,C,NA,NA,Friendly,,France,False
"""
GOALS_CSV = """date,home_team,away_team,team,scorer,minute,own_goal,penalty
1998-06-10,OLD,B,OLD,X,10,FALSE,FALSE
1998-06-10,OLD,B,B,NA,NA,TRUE,FALSE
"""
SHOOT_CSV = """date,home_team,away_team,winner,first_shooter
1998-06-11,B,C,B,NA
"""
NAMES_CSV = """current,former,start_date,end_date
NEW,OLD,1990-01-01,1999-12-31
"""


def _write_raw(d):
    for name, txt in [("results.csv", RESULTS_CSV), ("goalscorers.csv", GOALS_CSV), ("shootouts.csv", SHOOT_CSV),
                      ("former_names.csv", NAMES_CSV)]:
        with open(os.path.join(d, name), "w") as f:
            f.write(txt)


def test_csv_scan_and_master(spark, scratch):
    _write_raw(scratch)
    inp = csv_inputs(spark, scratch)
    rows = {r["home_team"]: r for r in inp.master.collect()}
    assert set(rows) == {"NEW", "B"}
    new = rows["NEW"]
    assert new["result"] == "home_win" and new["tournament_tier"] == 1 and new["match_weight"] == 3
    assert new["home_goal_count"] == 1 and new["away_own_goals"] == 0 and new["home_own_goals"] == 1
    assert new["neutral"] is True
    inc = rows["B"]
    assert inc["is_incomplete"] and inc["result"] is None and inc["shootout_winner"] == "B"
    assert inc["city"] is None  # empty field -> NULL


def test_missing_source_fails(spark, scratch):
    _write_raw(scratch)
    os.remove(os.path.join(scratch, "shootouts.csv"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        load_raw_tables(spark, scratch)


def test_parquet_csv_json_sinks_round_trip(spark, scratch):
    m = fixture_inputs(spark, SF0001).master
    n = m.count()
    write_master_parquet(m, f"{scratch}/master_pq")
    back = spark.read.parquet(f"{scratch}/master_pq")
    assert back.count() == n and "decade" in back.columns
    assert back.filter(F.col("decade") == 1990).count() == m.filter(F.year("date") < 2000).count()
    write_master_csv(m.select("match_id", "date", "result"), f"{scratch}/master_csv")
    assert spark.read.option("header", True).csv(f"{scratch}/master_csv").count() == n
    rec = spark.createDataFrame([("t", 0.5)], "timestamp string, rolling_accuracy double")
    append_jsonl(rec, f"{scratch}/log")
    append_jsonl(rec, f"{scratch}/log")
    assert spark.read.json(f"{scratch}/log").count() == 2


def test_scorer_source_fallback(spark):
    goals = fixture_inputs(spark, SF0001).goals
    assert read_scorer_source(spark, None, goals) is goals
    assert read_scorer_source(spark, "/nonexistent/goal.csv", goals) is goals


def test_scorer_source_preaggregated(spark, scratch):
    from matchstats.operators.analytics import top_scorers_from_source
    path = os.path.join(scratch, "goal.csv")
    with open(path, "w") as f:
        f.write("scorer,goals,penalties,team\nX,10,2,A\nY,12,0,B\n")
    src = read_scorer_source(spark, path, None)
    out = [(r["scorer"], r["goals"]) for r in top_scorers_from_source(src).collect()]
    assert out == [("Y", 12), ("X", 10)]
    goals = fixture_inputs(spark, SF0001).goals
    assert top_scorers_from_source(goals).count() == 20
