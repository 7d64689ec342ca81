"""Two-sided event log (P7, U1, U2, P8) and team/day state tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchstats.functions import scalar as S


def team_log(master: DataFrame, keys: list[str] | None = None, extra_cols: list[str] | None = None) -> DataFrame:
    """P7 + U1: every match seen from both sides, as one narrow scan.

    ``explode(array(struct(home side), struct(away side)))`` emits two rows
    per match without a union (one read of master, no shuffle).  Columns:
    team, opponent, is_home, goals_scored, goals_conceded, team_result
    (win/draw/loss, NULL if incomplete), points, plus the match columns.
    """
    keys = keys or []
    extra = [c for c in (extra_cols or []) if c in master.columns]
    base = ["date", "result", "is_incomplete", "tournament", "tournament_tier", "neutral", "total_goals"]
    base = [c for c in base if c in master.columns]
    carry = list(dict.fromkeys(keys + base + extra))
    home = F.struct(F.col("home_team").alias("team"), F.col("away_team").alias("opponent"),
                    F.lit(True).alias("is_home"), F.col("home_goals").alias("goals_scored"),
                    F.col("away_goals").alias("goals_conceded"))
    away = F.struct(F.col("away_team").alias("team"), F.col("home_team").alias("opponent"),
                    F.lit(False).alias("is_home"), F.col("away_goals").alias("goals_scored"),
                    F.col("home_goals").alias("goals_conceded"))
    out = master.select(*carry, F.explode(F.array(home, away)).alias("__side")).select(*carry, "__side.*")
    return (out.withColumn("team_result", S.team_result("result", "is_home"))
            .withColumn("points", S.points("result", "is_home")))


def all_teams(master: DataFrame) -> DataFrame:
    """Distinct union of home and away names, NULL dropped, sorted."""
    return (master.select(F.explode(F.array("home_team", "away_team")).alias("team"))
            .filter(F.col("team").isNotNull()).distinct().orderBy("team"))


def opponent(is_home="is_home", home_team="home_team", away_team="away_team"):
    """The other side of a match."""
    return F.when(F.col(is_home), F.col(away_team)).otherwise(F.col(home_team))
