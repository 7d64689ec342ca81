"""Edge cases from hand-made micro tables (expected values by hand)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from matchstats.functions import scalar as S
from matchstats.operators.features import build_features
from matchstats.operators.goals import aggregate_goals
from matchstats.operators.names import resolve_names
from matchstats.operators import analytics as A
from matchstats.streaming.ingest import validate_feed
from tests.helpers import D, master_of, shootouts_of


def feats(spark, rows, shoot=None):
    m = master_of(spark, rows)
    so = shootouts_of(spark, shoot) if shoot else None
    return {r["match_id"]: r.asDict() for r in build_features(m, so).collect()}


def test_same_day_double_is_invisible(spark):
    f = feats(spark, [(1, D(2000, 1, 1), "A", "B", 1, 0), (2, D(2000, 1, 1), "A", "C", 2, 0)])
    for mid in (1, 2):
        assert f[mid]["home_win_pct"] == 0.0
        assert f[mid]["days_since_last_match_home"] == 365


def test_no_history_defaults(spark):
    f = feats(spark, [(1, D(2000, 1, 1), "A", "B", 1, 0)])[1]
    assert f["home_win_pct"] == 0.0 and f["away_form_5"] == 0.0
    assert f["days_since_last_match_home"] == 365
    assert f["home_team_experience"] == 0.0 and f["home_momentum"] == 0
    assert (f["h2h_home_win_pct"], f["h2h_draw_pct"], f["h2h_away_win_pct"]) == (0.33, 0.33, 0.33)
    assert f["h2h_matches_played"] == 0 and f["h2h_avg_goals"] == 2.5


def test_fewer_than_n_form(spark):
    rows = [(1, D(2000, 1, 1), "A", "B", 1, 0), (2, D(2000, 1, 2), "A", "C", 1, 1),
            (3, D(2000, 1, 3), "A", "D", 0, 0)]
    f = feats(spark, rows)[3]
    assert f["home_form_5"] == pytest.approx(4 / 6)
    assert f["home_form_10"] == pytest.approx(4 / 6)


def test_streak_cap(spark):
    rows = [(i, D(2000, 1, i), "A", f"T{i}", 2, 0) for i in range(1, 9)]
    f = feats(spark, rows)[8]
    assert f["home_momentum"] == 5
    assert f["home_win_pct"] == 1.0


def test_incomplete_in_history(spark):
    rows = [(1, D(2000, 1, 1), "A", "B", 1, 0), (2, D(2000, 1, 5), "A", "C", None, None),
            (3, D(2000, 1, 9), "A", "D", 0, 0)]
    f = feats(spark, rows)[3]
    assert f["home_win_pct"] == 1.0            # incomplete ignored in rates
    assert f["days_since_last_match_home"] == 4  # but counted for rest days
    assert f["home_team_experience"] == pytest.approx(0.6931471805599453)


def test_h2h_reversed(spark):
    rows = [(1, D(2000, 1, 1), "B", "A", 2, 0), (2, D(2000, 2, 1), "A", "B", 1, 1)]
    f = feats(spark, rows)[2]
    assert f["h2h_away_win_pct"] == 1.0 and f["h2h_home_win_pct"] == 0.0
    assert f["h2h_matches_played"] == 1 and f["h2h_avg_goals"] == 2.0


def test_shootout_asof(spark):
    rows = [(1, D(2000, 1, 1), "A", "B", 1, 1), (2, D(2000, 2, 1), "A", "B", 0, 0)]
    shoot = [(1, D(2000, 1, 1), "A", "B", "A", None)]
    f = feats(spark, rows, shoot)
    assert f[1]["home_shootout_win_pct"] == 0.0
    assert f[2]["home_shootout_win_pct"] == 1.0 and f[2]["away_shootout_win_pct"] == 0.0


def test_interval_ends(spark):
    dim = spark.createDataFrame([("NEW", "OLD", D(2000, 1, 1), D(2000, 12, 31))],
                                "current string, former string, start_date date, end_date date")
    df = spark.createDataFrame([(1, D(2000, 1, 1), "OLD"), (2, D(2000, 12, 31), "OLD"), (3, D(2001, 1, 1), "OLD"),
                                (4, None, "OLD")], "id int, date date, team string")
    out = {r["id"]: r["team"] for r in resolve_names(df, dim, ["team"]).collect()}
    assert out == {1: "NEW", 2: "NEW", 3: "OLD", 4: "OLD"}


def test_own_goal_and_null_scorer(spark):
    g = spark.createDataFrame([
        (1, "H", "A", "A", None, True, False),   # own goal by away player -> home_own_goals
        (1, "H", "A", "H", None, False, True),   # NULL scorer: not counted, penalty still summed
        (1, "H", "A", "H", "x", False, False),
    ], "match_id long, home_team string, away_team string, team string, scorer string, own_goal boolean, penalty boolean")
    r = aggregate_goals(g, ["match_id"]).first()
    assert r["home_own_goals"] == 1 and r["away_own_goals"] == 0
    assert r["home_goal_count"] == 1 and r["home_penalty_count"] == 1
    assert r["total_goals"] == 2


def test_tier_rules(spark):
    df = spark.createDataFrame([("FIFA World Cup qualification",), ("Copa América",), (None,), ("FIFA World Cup",),
                                ("UEFA Nations League",)], "tournament string")
    out = [r[0] for r in df.select(S.tournament_tier("tournament")).collect()]
    assert out == [2, 3, 3, 1, 2]


def test_probability_tie(spark):
    df = spark.createDataFrame([(0.4, 0.2, 0.4, "H", "A")], "p_home double, p_draw double, p_away double, "
                                                            "home_team string, away_team string")
    f = S.format_prediction()
    r = df.select(*[v.alias(k) for k, v in f.items()]).first()
    assert r["predicted_outcome"] == "home_win" and r["confidence"] == "Medium" and r["predicted_winner"] == "H"
    assert r["summary"] == "H vs A → H Win: 40.0% | Draw: 20.0% | A Win: 40.0% [Medium confidence]"


def test_feed_rejects(spark):
    df = spark.createDataFrame([
        (1, D(2001, 1, 1), "A", "B", -1, 0, None), (2, D(2001, 1, 1), "A", "A", 1, 0, None),
        (3, D(2001, 1, 1), "A", "B", 2, 1, "A"), (4, D(2001, 1, 1), "A", "B", 1, 1, "A"),
        (5, None, "A", "B", 1, 1, "A"), (6, D(2001, 1, 1), None, "B", 1, 1, "A"), (7, D(2001, 1, 1), "A", "B", None, 1, None),
    ], "match_id long, date date, home_team string, away_team string, home_score int, away_score int, shootout_winner string")
    out = {r["match_id"]: (r["accepted"], r["reason"]) for r in validate_feed(df).collect()}
    assert out == {1: (False, "negative_score"), 2: (False, "same_team"), 3: (False, "winner_without_draw"), 4: (True, None),
                   5: (False, "missing_key"), 6: (False, "missing_key"), 7: (False, "missing_score")}


def test_trend_gap_rows_frame(spark):
    rows = [(1, D(1950, 1, 1), "A", "B", 1, 0), (2, D(1951, 1, 1), "A", "B", 0, 1), (3, D(1954, 1, 1), "A", "B", 1, 0)]
    m = master_of(spark, rows)
    t = {r["year"]: r["rolling_win_pct"] for r in A.win_pct_trend(m, ["match_id"], 1950, 3)
         .filter(F.col("team") == "A").collect()}
    assert t[1954] == pytest.approx((100 + 0 + 100) / 3)


def test_encode_decode(spark):
    df = spark.createDataFrame([("home_win",), ("draw",), ("away_win",)], "result string")
    r = df.select(S.encode_result("result").alias("l")).select(S.decode_result("l")).collect()
    assert [x[0] for x in r] == ["home_win", "draw", "away_win"]
    bad = spark.createDataFrame([("x",)], "result string")
    with pytest.raises(Exception):
        bad.select(S.encode_result("result")).collect()


def test_decade_and_days(spark):
    df = spark.createDataFrame([(dt.date(1999, 5, 1), dt.date(1999, 4, 1))], "a date, b date")
    r = df.select(S.decade_label("a"), S.days_between("a", "b")).first()
    assert r[0] == "1990s" and r[1] == 30


def test_external_fixtures_use_history_only(spark):
    from tests.helpers import matches
    m = master_of(spark, [(1, D(2000, 1, 1), "A", "B", 2, 0), (2, D(2000, 1, 5), "B", "A", 1, 1)])
    fx = (matches(spark, [(10, D(2000, 2, 1), "A", "B", None, None), (11, D(2000, 2, 1), "A", "C", None, None),
                          (12, D(2000, 3, 1), "A", "B", None, None)])
          .withColumn("tournament_tier", F.lit(3)))
    f = {r["match_id"]: r.asDict() for r in build_features(m, None, queries=fx, keep_cols=[]).collect()}
    assert f[10]["home_win_pct"] == 0.5 and f[10]["h2h_matches_played"] == 2
    assert f[10]["h2h_home_win_pct"] == 0.5 and f[10]["h2h_draw_pct"] == 0.5
    assert f[10]["days_since_last_match_home"] == 27
    # fixtures add no history: the later fixture sees the same past
    assert f[12]["days_since_last_match_home"] == 56 and f[12]["h2h_matches_played"] == 2
    assert f[11]["away_win_pct"] == 0.0 and f[11]["days_since_last_match_away"] == 365


def test_tier_accent_folding_option(spark):
    df = spark.createDataFrame([("Copa América",), ("Copa America",)], "tournament string")
    plain = [r[0] for r in df.select(S.tournament_tier("tournament")).collect()]
    folded = [r[0] for r in df.select(S.tournament_tier("tournament", fold_accents=True)).collect()]
    assert plain == [3, 1] and folded == [1, 1]


def test_names_applied_in_file_order(spark):
    """Equal rows, overlaps and chains resolve as row-by-row renaming does."""
    import datetime as dt
    d = dt.date
    rows = [("B", "A", d(2000, 1, 1), d(2000, 12, 31)), ("B", "A", d(2000, 1, 1), d(2000, 12, 31)),
            ("X", "A", d(2000, 6, 1), d(2001, 6, 30)), ("C", "B", d(2000, 3, 1), d(2000, 9, 30)),
            ("A", "Z", d(2000, 1, 1), d(2002, 1, 1))]
    dim = spark.createDataFrame(rows, "current string, former string, start_date date, end_date date")
    days = [d(1999, 12, 31), d(2000, 1, 1), d(2000, 3, 1), d(2000, 7, 1), d(2000, 10, 1), d(2001, 1, 1), d(2001, 7, 1)]
    facts = [(i, n, day) for i, (n, day) in enumerate((n, day) for n in "ABZQ" for day in days)]

    def one(name, day):
        for current, former, start, end in rows:
            if name == former and start <= day <= end:
                name = current
        return name

    got = resolve_names(spark.createDataFrame(facts, "i int, team string, date date"), dim, ["team"]).collect()
    assert sorted((r["i"], r["team"]) for r in got) == [(i, one(n, day)) for i, n, day in facts]


def test_natural_key_from_csv_to_outputs(spark, scratch):
    """Features and head-to-head tables with the natural key can be written."""
    from matchstats.operators.analytics import h2h_last_n
    from matchstats.operators.features import build_features
    from matchstats.plans.pipeline import csv_inputs
    files = {
        "results.csv": "date,home_team,away_team,home_score,away_score,tournament,city,country,neutral\n"
                       "2001-01-01,A,B,1,0,Friendly,x,y,FALSE\n2001-02-01,B,A,2,2,Friendly,x,y,TRUE\n"
                       "2001-03-01,A,B,0,3,Friendly,x,y,FALSE\n",
        "goalscorers.csv": "date,home_team,away_team,team,scorer,minute,own_goal,penalty\n2001-01-01,A,B,A,p,3,FALSE,FALSE\n",
        "shootouts.csv": "date,home_team,away_team,winner,first_shooter\n2001-02-01,B,A,B,NA\n",
        "former_names.csv": "current,former,start_date,end_date\nC,D,1990-01-01,1991-01-01\n"}
    import os
    os.makedirs(f"{scratch}/csv")
    for name, text in files.items():
        with open(f"{scratch}/csv/{name}", "w") as f:
            f.write(text)
    inp = csv_inputs(spark, f"{scratch}/csv")
    features = build_features(inp.master, inp.shootouts, keys=inp.keys)
    features.write.parquet(f"{scratch}/features")
    h2h_last_n(inp.master, keys=inp.keys).write.parquet(f"{scratch}/h2h")
    assert spark.read.parquet(f"{scratch}/features").count() == 3
    assert len(set(features.columns)) == len(features.columns) == 3 + 2 + 45
    assert spark.read.parquet(f"{scratch}/h2h").count() == 3
