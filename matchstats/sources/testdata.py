"""Adapter: derive the match, goal, shootout and name-history tables from the
TPC-H-like test tables (orders -> matches, lineitem -> goals).

The Spark side uses the DataFrame API; ``FIXTURE_CTES`` is the same
derivation as SQL text for the DuckDB oracles.  ``match_id`` (o_orderkey) is
the surrogate match key; the natural key (date, home, away) is not unique in
this data, so every operator takes its join keys as a parameter.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MATCH_KEYS = ["match_id"]

# FIXED VALUES: tournament per order priority, and the name-history rows.
PRIORITY_TOURNAMENT = [
    ("1-URGENT", "FIFA World Cup"),
    ("2-HIGH", "UEFA Euro qualification"),
    ("3-MEDIUM", "UEFA Nations League"),
    ("4-NOT SPECIFIED", "Friendly"),
]
OTHER_TOURNAMENT = "Copa América Finals"
FORMER_NAME_ROWS = [
    ("UNION_A", "NATION_3", dt.date(1996, 1, 1), dt.date(1998, 12, 31)),
    ("UNION_A", "NATION_7", dt.date(1999, 1, 1), dt.date(1999, 12, 31)),
    ("UNION_B", "NATION_11", dt.date(1995, 1, 1), dt.date(1995, 6, 30)),
]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def derive_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority", "o_orderstatus")
    customer = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # no hint: Spark broadcasts the dimension by the size of its files
    hn = nation.toDF("hn_key", "home_team")
    an = nation.toDF("an_key", "away_team")
    missing = F.col("o_orderkey") % 97 == 0
    tournament = F.lit(OTHER_TOURNAMENT)
    for prio, name in reversed(PRIORITY_TOURNAMENT):
        tournament = F.when(F.col("o_orderpriority") == prio, F.lit(name)).otherwise(tournament)
    # customer grows with the data: a plain (AQE-chosen) equi-join.
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(hn, F.col("c_nationkey") == F.col("hn_key"))
        .join(an, F.col("an_key") == (F.col("c_nationkey") + 1 + F.col("o_orderkey") % 24) % 25)
        .select(
            F.col("o_orderkey").alias("match_id"),
            F.col("o_orderdate").cast("date").alias("date"),
            "home_team",
            "away_team",
            F.when(missing, F.lit(None)).otherwise(
                (F.floor("o_totalprice") % 5).cast("int")).alias("home_score"),
            F.when(missing, F.lit(None)).otherwise(
                (F.floor(F.col("o_totalprice") / 7) % 4).cast("int")).alias("away_score"),
            tournament.alias("tournament"),
            F.lit(None).cast("string").alias("city"),
            F.lit(None).cast("string").alias("country"),
            (F.col("o_orderstatus") == "F").alias("neutral"),
        )
    )


def derive_goals(spark: SparkSession, sf_dir: str, matches: DataFrame) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    m = matches.select("match_id", "date", "home_team", "away_team")
    return li.join(m, li.l_orderkey == m.match_id).select(
        "match_id", "date", "home_team", "away_team",
        F.when(F.col("l_suppkey") % 2 == 0, F.col("home_team")).otherwise(F.col("away_team")).alias("team"),
        F.when(F.col("l_partkey") % 53 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("P"), F.col("l_partkey").cast("string"))).alias("scorer"),
        F.when(F.col("l_partkey") % 61 == 0, F.lit(None)).otherwise(
            F.col("l_quantity").cast("int")).alias("minute"),
        ((F.col("l_returnflag") == "R") & (F.col("l_partkey") % 10 == 0)).alias("own_goal"),
        ((F.col("l_returnflag") == "A") & (F.col("l_partkey") % 7 == 0)).alias("penalty"),
    )


def derive_shootouts(matches: DataFrame) -> DataFrame:
    mid = F.col("match_id")
    return matches.filter(F.col("home_score") == F.col("away_score")).select(
        "match_id", "date", "home_team", "away_team",
        F.when(mid % 2 == 0, F.col("home_team")).otherwise(F.col("away_team")).alias("winner"),
        F.when(mid % 5 < 2, F.col("home_team")).when(mid % 5 < 4, F.col("away_team")).alias("first_shooter"),
    )


def former_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        FORMER_NAME_ROWS, "current string, former string, start_date date, end_date date")


def load_fixture_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Raw-equivalent inputs: matches (results), goals, shootouts, former_names."""
    matches = derive_matches(spark, sf_dir)
    return {
        "results": matches,
        "goalscorers": derive_goals(spark, sf_dir, matches),
        "shootouts": derive_shootouts(matches),
        "former_names": former_names(spark),
    }


# ---------------------------------------------------------------------------
# The same derivation as SQL text for the DuckDB oracles (CTEs).
# ---------------------------------------------------------------------------

_RAW_MATCHES_SQL = """
raw_matches AS (
  SELECT o.o_orderkey AS match_id, CAST(o.o_orderdate AS DATE) AS date,
    hn.n_name AS home_team, an.n_name AS away_team,
    CASE WHEN o.o_orderkey % 97 = 0 THEN NULL
         ELSE CAST(CAST(floor(o.o_totalprice) AS BIGINT) % 5 AS INT) END AS home_score,
    CASE WHEN o.o_orderkey % 97 = 0 THEN NULL
         ELSE CAST(CAST(floor(o.o_totalprice / 7) AS BIGINT) % 4 AS INT) END AS away_score,
    CASE o.o_orderpriority WHEN '1-URGENT' THEN 'FIFA World Cup'
         WHEN '2-HIGH' THEN 'UEFA Euro qualification'
         WHEN '3-MEDIUM' THEN 'UEFA Nations League'
         WHEN '4-NOT SPECIFIED' THEN 'Friendly'
         ELSE 'Copa América Finals' END AS tournament,
    CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS country,
    (o.o_orderstatus = 'F') AS neutral
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation hn ON c.c_nationkey = hn.n_nationkey
  JOIN nation an ON an.n_nationkey = (c.c_nationkey + 1 + o.o_orderkey % 24) % 25
)"""

_RAW_GOALS_SQL = """
raw_goals AS (
  SELECT m.match_id, m.date, m.home_team, m.away_team,
    CASE WHEN l.l_suppkey % 2 = 0 THEN m.home_team ELSE m.away_team END AS team,
    CASE WHEN l.l_partkey % 53 = 0 THEN NULL ELSE concat('P', l.l_partkey) END AS scorer,
    CASE WHEN l.l_partkey % 61 = 0 THEN NULL ELSE CAST(l.l_quantity AS INT) END AS minute,
    (l.l_returnflag = 'R' AND l.l_partkey % 10 = 0) AS own_goal,
    (l.l_returnflag = 'A' AND l.l_partkey % 7 = 0) AS penalty
  FROM lineitem l JOIN raw_matches m ON l.l_orderkey = m.match_id
)"""

_RAW_SHOOTOUTS_SQL = """
raw_shootouts AS (
  SELECT match_id, date, home_team, away_team,
    CASE WHEN match_id % 2 = 0 THEN home_team ELSE away_team END AS winner,
    CASE WHEN match_id % 5 < 2 THEN home_team
         WHEN match_id % 5 < 4 THEN away_team ELSE NULL END AS first_shooter
  FROM raw_matches WHERE home_score = away_score
)"""

_FORMER_NAMES_SQL = """
former_names AS (
  SELECT * FROM (VALUES
   ('UNION_A','NATION_3', DATE '1996-01-01', DATE '1998-12-31'),
   ('UNION_A','NATION_7', DATE '1999-01-01', DATE '1999-12-31'),
   ('UNION_B','NATION_11',DATE '1995-01-01', DATE '1995-06-30')) AS t(current, former, start_date, end_date)
)"""

RAW_CTES = [_RAW_MATCHES_SQL, _RAW_GOALS_SQL, _RAW_SHOOTOUTS_SQL, _FORMER_NAMES_SQL]
