"""Master table: P1-P6, J2, J3, A2, A29."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchstats.functions import scalar as S
from matchstats.operators.goals import aggregate_goals
from matchstats.operators.names import name_resolver

NATURAL_KEYS = ["date", "home_team", "away_team"]

MASTER_COLUMNS = [
    "date", "home_team", "away_team", "home_score", "away_score", "tournament", "city", "country",
    "neutral", "shootout_winner", "first_shooter", "home_goal_count", "away_goal_count",
    "home_penalty_count", "away_penalty_count", "home_own_goals", "away_own_goals", "total_goals",
    "is_incomplete", "home_goals", "away_goals", "result", "tournament_tier", "match_weight",
]


def add_labels(df: DataFrame) -> DataFrame:
    """P1 + P2 + P3 + P4 as one projection."""
    return (df
            .withColumn("is_incomplete", S.is_incomplete())
            .withColumn("home_goals", F.col("home_score").cast("int"))
            .withColumn("away_goals", F.col("away_score").cast("int"))
            .withColumn("result", F.when(~F.col("is_incomplete"), S.result_label()))
            .withColumn("tournament_tier", S.tournament_tier())
            .withColumn("match_weight", S.match_weight()))


def build_master(results: DataFrame, goals: DataFrame, shootouts: DataFrame, former_names: DataFrame,
                 keys: list[str] | None = None, resolve_shootouts: bool = True) -> DataFrame:
    """Raw tables -> one master row per result row.

    Plan: broadcast range joins for names (J1) -> one conditional
    aggregate of goals (A1) -> two left joins on the match key (J2, J3) ->
    projections (P1-P4).  The goal aggregate and the results side are both
    hash-partitioned on the key, so J3 reuses that partitioning.
    """
    return join_master(*resolved_inputs(results, goals, shootouts, former_names, resolve_shootouts), keys)


def resolved_inputs(results: DataFrame, goals: DataFrame, shootouts: DataFrame, former_names: DataFrame,
                    resolve_shootouts: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """J1 over the three tables."""
    resolve = name_resolver(former_names)  # one match per row: no fan-out in J1
    if resolve_shootouts:
        shootouts = resolve(shootouts, ["home_team", "away_team", "winner"])
    return resolve(results, ["home_team", "away_team"]), resolve(goals, ["home_team", "away_team", "team"]), shootouts


def join_master(res: DataFrame, gs: DataFrame, sht: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """J2, J3, A1 and P1-P6 over tables with resolved names."""
    keys = keys or NATURAL_KEYS
    extra = [k for k in keys if k not in NATURAL_KEYS]
    # Rename + prune to the join key and two payload columns.  One row per
    # key (of repeated ones the least): no fan-out, and queries that use
    # neither column don't join at all.
    sht = sht.groupBy(*keys).agg(F.min(F.struct(F.col("winner").alias("shootout_winner"), "first_shooter")).alias("__s")) \
        .select(*keys, "__s.*")
    gagg = aggregate_goals(gs, keys)
    master = (res.join(sht, keys, "left")
              .join(gagg, keys, "left"))
    master = add_labels(master)
    return master.select(*extra, *MASTER_COLUMNS)


def complete_matches(master: DataFrame) -> DataFrame:
    """P5: complete matches only."""
    return master.filter(~F.col("is_incomplete") & F.col("result").isNotNull())


def master_summary(master: DataFrame) -> DataFrame:
    """One-row summary of the master table.

    Team count = distinct teams over home and away (explode of two names per
    row, then one distinct aggregate).  Result distribution is a separate
    operator (A7), so the summary stays one row.
    """
    teams = master.select(F.explode(F.array("home_team", "away_team")).alias("team")).filter(
        F.col("team").isNotNull()).agg(F.count_distinct("team")).scalar()
    return master.agg(
        F.count(F.lit(1)).alias("n_matches"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.count_distinct("tournament").alias("n_tournaments"),
        F.count("shootout_winner").alias("n_shootouts"),
        F.count(F.when(F.col("is_incomplete"), F.lit(1))).alias("n_incomplete"),
        F.count(F.when(F.col("result") == "home_win", F.lit(1))).alias("n_home_win"),
        F.count(F.when(F.col("result") == "draw", F.lit(1))).alias("n_draw"),
        F.count(F.when(F.col("result") == "away_win", F.lit(1))).alias("n_away_win"),
    ).withColumn("n_teams", teams)


def tier_distribution(master: DataFrame) -> DataFrame:
    """Count and share (rounded to 3) per tournament tier."""
    total = master.agg(F.count(F.lit(1))).scalar()
    return (master.groupBy("tournament_tier").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("share", F.round(F.col("n") / total, 3)))
