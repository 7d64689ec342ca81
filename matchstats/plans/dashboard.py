"""Batch plan behind the dashboard (data loading + every tab's tables).

The master is computed once, checkpointed (lineage cut in the shared
checkpoint directory) and written partitioned by decade; every table the
dashboard reads is then an aggregate over that one materialization,
written as Parquet.  Nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from matchstats.operators import analytics as A
from matchstats.operators.master import master_summary, tier_distribution
from matchstats.plans.pipeline import Inputs
from matchstats.session import cut_lineage
from matchstats.sources.io import write_master_parquet


def dashboard_tables(master: DataFrame, goals: DataFrame, shootouts: DataFrame, keys: list[str]) -> dict:
    records = A.team_records(master, keys)
    return {
        "master_summary": master_summary(master),
        "tier_distribution": tier_distribution(master),
        "team_records": records,
        "team_ratings": A.team_ratings(records),
        "nation_leaderboard": A.nation_leaderboard(master, keys),
        "last5_form": A.last5_form(master, keys),
        "h2h_last_n": A.h2h_last_n(master, keys),
        "win_pct_trend": A.win_pct_trend(master, keys),
        "team_goals_by_year": A.team_goals_by_year(master, keys),
        "top_opponents": A.top_opponents(master, keys),
        "team_by_tier": A.team_by_tier(master, keys),
        "goal_trend": A.goal_trend(master),
        "home_advantage_trend": A.home_advantage_trend(master),
        "result_distribution": A.result_distribution(master),
        "top_scorers": A.top_scorers(goals),
        "shootout_specialists": A.shootout_specialists(shootouts),
    }


def build_dashboard(inputs: Inputs, out_dir: str) -> dict[str, str]:
    """Materialize master once, then write every dashboard table."""
    master = cut_lineage(inputs.master)
    write_master_parquet(master, f"{out_dir}/master")
    paths = {}
    for name, df in dashboard_tables(master, inputs.goals, inputs.shootouts, inputs.keys).items():
        path = f"{out_dir}/{name}"
        df.write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths
