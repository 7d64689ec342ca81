"""A1 goal-level -> match-level aggregation, A21 minute imputation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchstats.operators.lookup import lookup_table
from matchstats.session import work_table

GOAL_AGG_COLS = ["home_goal_count", "away_goal_count", "home_penalty_count",
                 "away_penalty_count", "home_own_goals", "away_own_goals", "total_goals"]


def aggregate_goals(goals: DataFrame, keys: list[str]) -> DataFrame:
    """A1 (+J4): one conditional aggregate instead of four group-bys and a
    four-way outer merge.

    * side goal count = regular goals of that side with a non-NULL scorer
    * side penalties  = sum(penalty) over regular goals of that side
    * home_own_goals  = own goals with team = away_team (and vice versa)
    * total_goals     = sum of the four counts
    * a match appears only if one of its goal rows belongs to a side;
      rows with NULL keys are dropped.

    Partial aggregation runs map-side, so a hot match key is combined
    before the shuffle.
    """
    own = F.col("own_goal")
    is_home = F.col("team") == F.col("home_team")
    is_away = F.col("team") == F.col("away_team")
    reg_home, reg_away = ~own & is_home, ~own & is_away
    g = goals
    for k in keys:
        g = g.filter(F.col(k).isNotNull())
    agg = g.groupBy(*keys).agg(
        F.count(F.when(reg_home, F.col("scorer"))).alias("home_goal_count"),
        F.count(F.when(reg_away, F.col("scorer"))).alias("away_goal_count"),
        F.coalesce(F.sum(F.when(reg_home, F.col("penalty").cast("long"))), F.lit(0)).cast("long").alias("home_penalty_count"),
        F.coalesce(F.sum(F.when(reg_away, F.col("penalty").cast("long"))), F.lit(0)).cast("long").alias("away_penalty_count"),
        F.count(F.when(own & is_away, F.lit(1))).alias("home_own_goals"),
        F.count(F.when(own & is_home, F.lit(1))).alias("away_own_goals"),
        F.max((is_home | is_away).cast("int")).alias("__has_side"),
    )
    return (agg.filter(F.col("__has_side") == 1).drop("__has_side")
            .withColumn("total_goals", F.col("home_goal_count") + F.col("away_goal_count")
                        + F.col("home_own_goals") + F.col("away_own_goals")))


def impute_minute(goals: DataFrame, matches: DataFrame | None = None, keys: list[str] | None = None,
                  group_col: str = "tournament") -> DataFrame:
    """Fill NULL minutes with the median of their ``group_col``, then
    with the global median of the result.

    One aggregate of the goals counts them by (group, minute): a row per
    group and distinct minute, combined before its shuffle.  Both medians
    follow from the counts, the global one after the group medians have taken
    the place of the missing minutes.  The goals keep their partitions: group
    medians come by a counted, broadcast lookup, however hot a group is.
    """
    g = goals
    if group_col not in g.columns and matches is not None:
        g = g.join(matches.select(*keys, group_col), keys, "left")
    minute = F.col("minute").cast("double")
    if group_col not in g.columns:
        return g.withColumn("minute", F.coalesce(minute, g.agg(F.median("minute")).scalar()))
    counts = work_table(g.groupBy(F.col(group_col).alias("__g"), minute.alias("__m")).agg(F.count(F.lit(1)).alias("__n")),
                        "minutes")
    known = counts.groupBy("__g").agg(F.percentile("__m", F.lit(0.5), F.col("__n")).alias("__med"),
                                      F.sum(F.when(F.col("__m").isNull(), F.col("__n")).otherwise(0)).alias("__none"))
    filled = counts.filter("__m IS NOT NULL").select("__m", "__n").unionByName(
        known.filter("__none > 0").select(F.col("__med").alias("__m"), F.col("__none").alias("__n")))
    glob = filled.agg(F.percentile("__m", F.lit(0.5), F.col("__n"))).scalar()
    med = lookup_table(known.select("__g", "__med"), "medians")
    return (g.join(med, g[group_col].eqNullSafe(med["__g"]), "left")
            .withColumn("minute", F.coalesce(minute, F.col("__med"), glob)).drop("__g", "__med"))
