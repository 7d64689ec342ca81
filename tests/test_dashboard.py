"""The dashboard batch plan writes the same tables as the registered queries."""

from matchstats.plans.dashboard import build_dashboard
from matchstats.plans.pipeline import fixture_inputs
from matchstats.plans.registry import all_queries
from tests.conftest import SF0001


def test_dashboard_tables_equal_queries(spark, scratch):
    paths = build_dashboard(fixture_inputs(spark, SF0001), scratch)
    reg = all_queries()
    for name in ["team_records", "nation_leaderboard", "last5_form", "top_scorers", "goal_trend", "team_by_tier"]:
        written = spark.read.parquet(paths[name])
        expected = reg[name][0](spark, SF0001)
        cols = sorted(expected.columns)
        a = sorted(tuple(r) for r in written.select(*cols).collect())
        b = sorted(tuple(r) for r in expected.select(*cols).collect())
        assert len(a) == len(b)
        for x, y in zip(a, b):
            for u, v in zip(x, y):
                assert (u == v) or (isinstance(u, float) and abs(u - v) < 1e-6), (name, x, y)
