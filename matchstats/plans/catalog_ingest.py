"""Registered ingest queries (P14, U3, R1, R2): batch and streaming forms
over a feed derived from the results table (matches on or after the cut
date arrive as new results)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from matchstats.operators.feature_stage import SHOOTOUT_COLS
from matchstats.operators.features import MASTER_FEATURE_COLS
from matchstats.operators.master import MASTER_COLUMNS, complete_matches
from matchstats.plans.catalog import KEYS, _inp, query
from matchstats.plans.catalog_features import DOUBLE_FEATS
from matchstats.session import work_table
from matchstats.streaming.ingest import ingest_batch, run_ingest_stream, scratch_dir, validate_feed
from matchstats.streaming.states import build_states, repair_states, stored_features

CUT = dt.date(2001, 1, 1)
#: Files that the feed arrives in, one per micro-batch.
STREAM_FILES = 8
CUT_SQL = "DATE '2001-01-01'"

_FEED = f"""
feed AS (SELECT r.match_id, r.date, r.home_team, r.away_team, r.home_score, r.away_score, r.tournament,
           r.city, r.country, r.neutral, s.winner AS shootout_winner
         FROM raw_matches r LEFT JOIN raw_shootouts s ON s.match_id = r.match_id),
vfeed AS (SELECT *, CASE WHEN date IS NULL OR home_team IS NULL OR away_team IS NULL THEN 'missing_key'
                         WHEN home_score IS NULL OR away_score IS NULL THEN 'missing_score'
                         WHEN home_score < 0 OR away_score < 0 THEN 'negative_score'
                         WHEN home_team = away_team THEN 'same_team'
                         WHEN home_score <> away_score AND shootout_winner IS NOT NULL
                           THEN 'winner_without_draw' END AS reason FROM feed)"""

_NEW_ROWS = f"""
SELECT match_id, date, home_team, away_team, home_score, away_score, tournament, city, country,
  coalesce(neutral, FALSE) AS neutral, shootout_winner, CAST(NULL AS VARCHAR) AS first_shooter,
  CAST(home_score AS BIGINT) AS home_goal_count, CAST(away_score AS BIGINT) AS away_goal_count,
  CAST(0 AS BIGINT) AS home_penalty_count, CAST(0 AS BIGINT) AS away_penalty_count,
  CAST(0 AS BIGINT) AS home_own_goals, CAST(0 AS BIGINT) AS away_own_goals,
  CAST(home_score + away_score AS BIGINT) AS total_goals, FALSE AS is_incomplete,
  home_score AS home_goals, away_score AS away_goals,
  CASE WHEN home_score > away_score THEN 'home_win' WHEN home_score = away_score THEN 'draw' ELSE 'away_win' END
    AS result,
  __TIER__ AS tournament_tier, CASE __TIER__ WHEN 1 THEN 3 WHEN 2 THEN 2 ELSE 1 END AS match_weight
FROM vfeed WHERE reason IS NULL AND date >= {CUT_SQL}"""


def _feed(spark, sf):
    inp = _inp(spark, sf)
    so = inp.shootouts.select("match_id", F.col("winner").alias("shootout_winner"))
    return inp.results.join(so, "match_id", "left")


def _ingest_sql() -> str:
    from matchstats.plans.oracle_sql import tier_sql
    new_rows = _NEW_ROWS.replace("__TIER__", tier_sql("tournament"))
    cols = ", ".join(["match_id"] + MASTER_COLUMNS)
    return f"WITH {_FEED}\nSELECT {cols} FROM master_t WHERE date < {CUT_SQL}\nUNION ALL {new_rows}"


@query("validate_feed", f"WITH {_FEED}\nSELECT match_id, reason IS NULL AS accepted, reason FROM vfeed")
def q_validate_feed(spark, sf):
    """P14 over every result row presented as a feed record."""
    return validate_feed(_feed(spark, sf)).select("match_id", "accepted", "reason")


@query("ingest_batch", _ingest_sql())
def q_ingest_batch(spark, sf):
    """U3 + R1: master before the cut date plus validated new results."""
    inp = _inp(spark, sf)
    base = inp.master.filter(F.col("date") < F.lit(CUT))
    feed = _feed(spark, sf).filter(F.col("date") >= F.lit(CUT))
    new_master, _rej, _so = ingest_batch(base, feed, KEYS, inp.shootouts)
    return new_master


@query("stream_ingest", _ingest_sql())
def q_stream_ingest(spark, sf):
    """R1 + R2 + R4 on Structured Streaming: the new results arrive as JSON
    files in *reverse* date order (late data), each
    micro-batch is appended through foreachBatch; the final table must equal
    the batch ingest."""
    inp = _inp(spark, sf)
    work = scratch_dir(spark, "stream-ingest")
    master_path, feed_dir = f"{work}/master", f"{work}/feed"
    inp.master.filter(F.col("date") < F.lit(CUT)).write.mode("overwrite").parquet(master_path)
    feed = _feed(spark, sf).filter(F.col("date") >= F.lit(CUT))
    # One write, ranged by date with the latest first: files hold stretches of
    # days, and older matches arrive after newer ones.
    feed.repartitionByRange(STREAM_FILES, F.col("date").desc()).write.mode("overwrite").json(feed_dir)
    run_ingest_stream(spark, feed_dir, master_path, work, KEYS)
    return spark.read.parquet(master_path)


#: The matches of these days arrive after later ones.
LATE_FROM, LATE_TO = dt.date(1999, 1, 1), dt.date(2000, 7, 1)


@query("late_data_repair", "SELECT * FROM f_all", doubles=DOUBLE_FEATS, features=True)
def q_late_data_repair(spark, sf):
    """R2: feature states are built up to 1998, then the matches from July
    2000 on arrive, then the older ones in between; each batch rewrites only
    the (team, day) and (pair, day) ranges it touches.  The features read from
    the states equal a rebuild."""
    inp = _inp(spark, sf)
    path = scratch_dir(spark, "states")
    # every step reads both again: computed once, with the columns that states and features use
    master = work_table(inp.master.select(*KEYS, *MASTER_FEATURE_COLS), "master")
    shootouts = work_table(inp.shootouts.select(*SHOOTOUT_COLS), "shootouts")
    day = F.col("date")
    arrivals = [day < F.lit(LATE_FROM), day >= F.lit(LATE_TO), (day >= F.lit(LATE_FROM)) & (day < F.lit(LATE_TO))]
    here = arrivals[0]
    # the features read shootouts as given, all of them known from the start on
    build_states(master.filter(here), shootouts, path, KEYS)
    for more in arrivals[1:]:
        here = here | more
        repair_states(master.filter(here), shootouts, master.filter(more), path, KEYS)
    return stored_features(complete_matches(master), path, KEYS)
