"""Per-row Python brute force (the reference's semantics, row by row) vs
the window plan, on the whole sf0.001 master."""

import pandas as pd
import pytest

from matchstats.operators.features import build_features
from matchstats.plans.pipeline import fixture_inputs
from tests.conftest import SF0001


def _brute(master: pd.DataFrame, row) -> dict:
    out = {}
    for side, team in (("home", row.home_team), ("away", row.away_team)):
        h = master[((master.home_team == team) | (master.away_team == team)) & (master.date < row.date)]
        is_home = h.home_team == team
        res = h.result
        tr = pd.Series(None, index=h.index, dtype=object)
        tr[(res == "draw")] = "draw"
        tr[((res == "home_win") & is_home) | ((res == "away_win") & ~is_home)] = "win"
        tr[((res == "away_win") & is_home) | ((res == "home_win") & ~is_home)] = "loss"
        h = h.assign(team_result=tr).sort_values(["date", "match_id"])
        done = h[h.team_result.notna()]
        n = len(done)
        out[f"{side}_win_pct"] = (done.team_result == "win").sum() / n if n else 0.0
        last5 = done.tail(5)
        pts = last5.team_result.map({"win": 3, "draw": 1, "loss": 0}).sum()
        out[f"{side}_form_5"] = pts / (3 * len(last5)) if len(last5) else 0.0
        streak = 0
        for r in reversed(last5.team_result.tolist()):
            if r != "win":
                break
            streak += 1
        out[f"{side}_momentum"] = streak
        out[f"days_since_last_match_{side}"] = int((row.date - h.date.max()).days) if len(h) else 365
    return out


def test_brute_force_sample_of_every_team(spark):
    inp = fixture_inputs(spark, SF0001)
    master = inp.master.select("match_id", "date", "home_team", "away_team", "result").toPandas()
    feats = build_features(inp.master, inp.shootouts).toPandas().set_index("match_id")
    complete = master[master.result.notna()]
    checked = 0
    for row in complete.itertuples():
        exp = _brute(master, row)
        got = feats.loc[row.match_id]
        for k, v in exp.items():
            assert got[k] == pytest.approx(v), (row.match_id, k)
        checked += 1
    assert checked == len(feats)
