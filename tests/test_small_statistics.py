"""Statistics that read the fact side once, on tables with hot keys, nulls and ties."""

import random
from statistics import median

import numpy as np
import pytest

from matchstats.operators import analytics as A
from matchstats.operators import featstats as FS
from matchstats.operators import lookup
from matchstats.operators.goals import impute_minute


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _goals(spark, n=400):
    rng = random.Random(5)
    rows = [("A" if i % 5 < 2 else rng.choice(["B", "C", None]), None if rng.random() < 0.3 else float(rng.randrange(90)))
            for i in range(n)] + [("none known", None)] * 7
    return rows, spark.createDataFrame(rows, "tournament string, minute double").repartition(6)


@pytest.mark.parametrize("most", [0, 200_000])
def test_minutes_by_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(lookup.lookup_table, "__defaults__", (most,))
    rows, g = _goals(spark)
    med = {t: median([m for x, m in rows if x == t and m is not None]) for t in {t for t, m in rows if m is not None}}
    filled = [(t, m if m is not None else med.get(t)) for t, m in rows]
    whole = median([m for _, m in filled if m is not None])
    want = sorted((t or "", whole if m is None else m) for t, m in filled)
    assert sorted((r.tournament or "", r.minute) for r in impute_minute(g).collect()) == want


def test_goals_keep_their_partitions(spark):
    plan = _plan(impute_minute(_goals(spark)[1].select("*", "tournament")))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_no_minutes_at_all(spark):
    g = spark.createDataFrame([("A", None), (None, None)], "tournament string, minute double")
    assert [r.minute for r in impute_minute(g).collect()] == [None, None]
    assert impute_minute(g.filter("false")).count() == 0


def test_top_scorers_by_brute_force(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["p", "q", "r", None]), rng.choice(["X", "Y", None]), rng.random() < 0.1, rng.random() < 0.2) for _ in range(300)]
    df = spark.createDataFrame(rows, "scorer string, team string, own_goal boolean, penalty boolean")
    want = []
    for s in "pqr":
        mine = [(t, p) for x, t, o, p in rows if x == s and not o]
        teams = {t for t, _ in mine}
        best = min(teams, key=lambda t: (-sum(x == t for x, _ in mine), t is not None, t or ""))
        want.append((s, len(mine), sum(p for _, p in mine), best))
    want.sort(key=lambda r: (-r[1], r[0]))
    out = A.top_scorers(df)
    assert _plan(out).count("Scan ExistingRDD") == 1  # before it runs: one plan
    assert [(r.scorer, r.goals, r.penalties, r.team) for r in out.collect()] == want


def test_histogram_of_few_and_many_values(spark):
    cols = {"one": [5.0] * 12, "two": [0.0, 1.0] * 6, "three": [0.0, 1.0, 2.0] * 4, "four": [0.0, 1.0, 2.0, 3.0] * 3,
            "many": [float(i * i) for i in range(11)] + [None], "few_null": [1.0, None, 3.0] * 4, "nothing": [None] * 12}
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} double" for c in cols))
    want = []
    for c, vs in cols.items():
        known = [v for v in vs if v is not None]
        if len(set(known)) <= 3:
            want += [(c, "value", None, v, v, vs.count(v)) for v in set(vs)]
            continue
        lo, hi = min(known), max(known)
        at = [None if v is None else min(int((v - lo) * 30 / (hi - lo)), 29) for v in vs]
        want += [(c, "bin", b, None if b is None else lo + b * (hi - lo) / 30, None if b is None else lo + (b + 1) * (hi - lo) / 30,
                  at.count(b)) for b in set(at)]
    got = [(r.feature, r.kind, r.bin, r.lower, r.upper, r.n) for r in FS.feature_histogram(df, list(cols)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_class_weights_two_readings(spark):
    rows = [(i, "home_win" if i % 3 else "draw", 2.0) for i in range(9)]
    df = spark.createDataFrame(rows, "match_id int, result string, match_weight double")
    out = FS.class_weights(df, ["match_id"])
    got = {r.match_id: (r.class_weight, r.sample_weight, r.boost_weight) for r in out.collect()}
    assert got == {i: (w, 2 * w, 2.0) for i, r, _ in rows for w in [9 / (2 * (3 if r == "draw" else 6))]}


def test_predictions_keep_fixture_partitions(spark):
    fx = spark.createDataFrame([("HOT", f"T{i % 4}", i % 2 == 0) for i in range(40)], "home_team string, away_team string, neutral boolean")
    rec = spark.createDataFrame([("HOT", 4, 3), ("T0", 2, 1), ("T1", 0, 0)], "team string, played int, wins int")
    out = A.heuristic_predict(fx, rec)
    assert "SortMergeJoin" not in _plan(out)
    for r in out.collect():
        wh = 0.75 * (1 if r.neutral else 1.15)
        wa = 0.5 if r.away_team == "T0" else 0.0
        t = wh + wa + 0.25
        assert r.p_home == pytest.approx(wh / t) and r.p_away == pytest.approx(wa / t)


def test_correlations_from_one_reading(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4, 500)) * [[1], [1e3], [1e-3], [0]] + [[0], [1e6], [0], [5]]
    x[1] += 700 * x[0]
    read = spark.sparkContext.accumulator(0)

    def row(r):
        read.add(1)
        return r

    cells = [(*map(float, r), None if i == 7 else 1.0 * i) for i, r in enumerate(x.T)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(cells, 3).map(row), "a double, b double, c double, d double, e double")
    got = {r["pair"]: r["corr"] for r in FS.feature_corr(df, list("abcde")).collect()}
    assert read.value == 500
    want = np.corrcoef(x[:3])
    assert len(got) == 10 and np.allclose([got["a|b"], got["a|c"], got["b|c"]], [want[0, 1], want[0, 2], want[1, 2]])
    assert all(np.isnan(got[p]) for p in got if "d" in p or "e" in p)
