"""Properties of the look-back features on sf0.001."""

import pytest
from pyspark.sql import functions as F

from matchstats.operators import analytics as A
from matchstats.operators.features import build_features, leak_audit
from matchstats.plans.pipeline import fixture_inputs
from tests.conftest import SF0001


@pytest.fixture(scope="module")
def inp(spark):
    return fixture_inputs(spark, SF0001)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_leak_audit_zero(inp):
    r = leak_audit(inp.master).first()
    assert r["violations"] == 0 and r["audited_team_days"] > 0


def test_shuffled_input_same_output(spark, inp):
    m = inp.master
    shuffled = m.repartition(7, F.rand(3))
    a = build_features(m, inp.shootouts)
    b = build_features(shuffled, inp.shootouts)
    assert _rows(a) == _rows(b)


def test_future_matches_do_not_change_past(spark, inp):
    m = inp.master
    cut = "1999-01-01"
    early = build_features(m.filter(F.col("date") < cut), inp.shootouts.filter(F.col("date") < cut))
    full = build_features(m, inp.shootouts).filter(F.col("date") < cut)
    assert _rows(early) == _rows(full)


def test_h2h_shares_sum(inp):
    f = build_features(inp.master, inp.shootouts)
    s = f.select((F.col("h2h_home_win_pct") + F.col("h2h_draw_pct") + F.col("h2h_away_win_pct")).alias("s"))
    vals = {round(r["s"], 9) for r in s.distinct().collect()}
    assert vals <= {1.0, 0.99}


def test_record_identity(inp):
    r = A.team_records(inp.master, ["match_id"])
    assert r.filter(F.col("wins") + F.col("draws") + F.col("losses") != F.col("played")).count() == 0
