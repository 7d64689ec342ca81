"""Hand-made micro tables for edge cases."""

import datetime as dt

from pyspark.sql import functions as F

from matchstats.operators.master import add_labels

D = dt.date

RESULTS_DDL = ("match_id long, date date, home_team string, away_team string, home_score int, away_score int, "
               "tournament string, city string, country string, neutral boolean")


def matches(spark, rows):
    """rows: (id, date, home, away, hs, as, tournament[, neutral])"""
    full = [(r[0], r[1], r[2], r[3], r[4], r[5], r[6] if len(r) > 6 else "Friendly", None, None,
             r[7] if len(r) > 7 else False) for r in rows]
    return spark.createDataFrame(full, RESULTS_DDL)


def master_of(spark, rows):
    m = matches(spark, rows)
    zero = F.lit(None).cast("long")
    m = (m.withColumn("shootout_winner", F.lit(None).cast("string"))
         .withColumn("first_shooter", F.lit(None).cast("string")))
    for c in ["home_goal_count", "away_goal_count", "home_penalty_count", "away_penalty_count",
              "home_own_goals", "away_own_goals"]:
        m = m.withColumn(c, zero)
    m = m.withColumn("total_goals", (F.col("home_score") + F.col("away_score")).cast("long"))
    return add_labels(m)


def shootouts_of(spark, rows):
    return spark.createDataFrame(rows, "match_id long, date date, home_team string, away_team string, "
                                       "winner string, first_shooter string")
