"""A hot key: one team plays in more than a third of all matches, many of
them on the same day.  Features must still equal the per-row brute force,
and the plan must limit the per-(team, day) top-k before its shuffle."""

import datetime as dt
import random

import pandas as pd
import pytest

from matchstats.operators.features import build_features
from tests.helpers import master_of
from tests.test_brute_force import _brute


def _hot_rows(n=600, seed=7):
    rng = random.Random(seed)
    teams = [f"T{i}" for i in range(12)]
    rows = []
    for i in range(n):
        day = dt.date(2000, 1, 1) + dt.timedelta(days=rng.randrange(40))
        if i % 5 < 2:  # 40% of matches involve HOT
            a, b = ("HOT", rng.choice(teams)) if rng.random() < 0.5 else (rng.choice(teams), "HOT")
        else:
            a, b = rng.sample(teams, 2)
        hs = None if i % 53 == 0 else rng.randrange(4)
        rows.append((i, day, a, b, hs, None if hs is None else rng.randrange(4)))
    return rows


def test_hot_team_matches_brute_force(spark):
    m = master_of(spark, _hot_rows())
    feats = build_features(m).toPandas().set_index("match_id")
    master = m.select("match_id", "date", "home_team", "away_team", "result").toPandas()
    complete = master[master.result.notna()]
    assert (complete.home_team.eq("HOT") | complete.away_team.eq("HOT")).mean() > 1 / 3
    for row in complete.itertuples():
        for k, v in _brute(master, row).items():
            assert feats.loc[row.match_id][k] == pytest.approx(v), (row.match_id, k)


def test_top_k_is_limited_before_the_shuffle(spark):
    m = master_of(spark, _hot_rows(60))
    plan = build_features(m, materialize=False)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
