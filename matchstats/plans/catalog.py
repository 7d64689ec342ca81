"""Registered queries: name -> (Spark callable, DuckDB oracle SQL or None).

Every callable takes ``(spark, sf_dir)``, derives the match tables from the
raw test tables and returns a DataFrame over the whole input.  Doubles are
rounded to 6 places on both sides; every computed column is aliased to the
same name as in the oracle.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchstats import config as C
from matchstats.functions import scalar as S
from matchstats.operators import analytics as A
from matchstats.operators.goals import aggregate_goals, impute_minute
from matchstats.operators.master import complete_matches, master_summary, resolved_inputs, tier_distribution
from matchstats.operators.names import resolve_names, resolve_names_large
from matchstats.operators.teamlog import all_teams, team_log
from matchstats.plans.oracle_sql import knockout_sql, with_ctes
from matchstats.plans.pipeline import fixture_inputs
from matchstats.sources.bucketed import append_matches, bucketed_master
from matchstats.streaming.ingest import scratch_dir

KEYS = ["match_id"]
ORDER = ["date", "match_id"]

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def _round6(c):
    # Same IEEE operations as the SQL side (floor(x * 1e6 + 0.5) / 1e6), so
    # equal inputs round equally in both engines (no decimal tie rules).
    return F.when(F.isnan(c) | (F.abs(c) > 1e12), c).otherwise(F.floor(c * 1e6 + 0.5) / 1e6)


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*[_round6(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def _oracle(body: str, doubles: list[str], features: bool) -> str:
    rep = ", ".join(f"floor({c} * 1e6 + 0.5) / 1e6 AS {c}" for c in doubles)
    head = f"SELECT * REPLACE ({rep})" if doubles else "SELECT *"
    return with_ctes(f"{head} FROM (\n{body}\n) AS __q", features)


def query(name: str, sql: str | None = None, doubles: list[str] | None = None, features: bool = False):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = (run, None if sql is None else _oracle(sql, doubles or [], features))
        return fn
    return deco


def _inp(spark, sf_dir):
    return fixture_inputs(spark, sf_dir)


# =============================================================================
# Sources, names, master
# =============================================================================

@query("scan_matches", "SELECT * FROM raw_matches")
def q_scan_matches(spark, sf):
    """The typed results table."""
    return _inp(spark, sf).results


@query("resolve_names", "SELECT match_id, date, home_team, away_team FROM res_n")
def q_resolve_names(spark, sf):
    """Date-aware renames of home and away."""
    inp = _inp(spark, sf)
    return resolve_names(inp.results, inp.former_names, ["home_team", "away_team"]).select(
        "match_id", "date", "home_team", "away_team")


@query("goal_aggregates", "SELECT *, home_goal_count + away_goal_count + home_own_goals + away_own_goals AS total_goals FROM goal_agg")
def q_goal_aggregates(spark, sf):
    """A1 + J4: goal rows -> match-level counts in one conditional aggregate."""
    inp = _inp(spark, sf)
    g = resolve_names(inp.goals, inp.former_names, ["home_team", "away_team", "team"])
    return aggregate_goals(g, KEYS)


@query("build_master", "SELECT * FROM master_t")
def q_build_master(spark, sf):
    """J2 + J3 + P1-P6: the master table."""
    return _inp(spark, sf).master


@query("bucketed_master", "SELECT * FROM master_t")
def q_bucketed_master(spark, sf):
    """S3 + J2 + J3: the matches up to 2000 are stored in buckets, the later
    ones appended, and master is rebuilt without exchanging a table."""
    inp, name = _inp(spark, sf), f"matches_{uuid.uuid4().hex}"
    path = scratch_dir(spark, "bucketed")
    tables = resolved_inputs(inp.results, inp.goals, inp.shootouts, inp.former_names)
    later = F.coalesce(F.col("date") >= F.lit(dt.date(2001, 1, 1)), F.lit(False))
    for part in (~later, later):
        append_matches(*(t.filter(part) for t in tables), name, path, KEYS)
    return bucketed_master(spark, name, KEYS)


@query("flag_incomplete", "SELECT match_id, home_score, away_score, is_incomplete FROM master_t")
def q_flag_incomplete(spark, sf):
    """P1."""
    return _inp(spark, sf).master.select("match_id", "home_score", "away_score", "is_incomplete")


@query("result_label", "SELECT match_id, home_goals, away_goals, result FROM master_t")
def q_result_label(spark, sf):
    """P2."""
    return _inp(spark, sf).master.select("match_id", "home_goals", "away_goals", "result")


@query("tournament_tier",
       "SELECT tournament, tournament_tier, match_weight, count(*) AS n FROM master_t GROUP BY ALL")
def q_tournament_tier(spark, sf):
    """P3 + P4 + F14."""
    return (_inp(spark, sf).master.groupBy("tournament", "tournament_tier", "match_weight")
            .agg(F.count(F.lit(1)).alias("n")))


@query("knockout_flag",
       f"SELECT tournament, {knockout_sql('tournament')} AS is_knockout, count(*) AS n FROM master_t GROUP BY ALL")
def q_knockout_flag(spark, sf):
    """P12."""
    return (_inp(spark, sf).master.groupBy("tournament", S.is_knockout("tournament").alias("is_knockout"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("decade_labels",
       "SELECT match_id, CAST(floor(year(date) / 10) * 10 AS INT) AS decade, "
       "CAST(floor(year(date) / 10) * 10 AS INT) || 's' AS decade_label FROM master_t")
def q_decade_labels(spark, sf):
    """F1."""
    return _inp(spark, sf).master.select("match_id", S.decade("date").alias("decade"),
                                         S.decade_label("date").alias("decade_label"))


@query("master_summary",
       """SELECT count(*) AS n_matches, min(date) AS min_date, max(date) AS max_date,
          count(DISTINCT tournament) AS n_tournaments, count(shootout_winner) AS n_shootouts,
          count(CASE WHEN is_incomplete THEN 1 END) AS n_incomplete,
          count(CASE WHEN result = 'home_win' THEN 1 END) AS n_home_win,
          count(CASE WHEN result = 'draw' THEN 1 END) AS n_draw,
          count(CASE WHEN result = 'away_win' THEN 1 END) AS n_away_win,
          (SELECT count(DISTINCT t) FROM (SELECT home_team AS t FROM master_t UNION ALL
                                          SELECT away_team FROM master_t) WHERE t IS NOT NULL) AS n_teams
          FROM master_t""")
def q_master_summary(spark, sf):
    """A2 + A28."""
    return master_summary(_inp(spark, sf).master)


@query("tier_distribution",
       "SELECT tournament_tier, count(*) AS n, round(count(*) / (SELECT count(*) FROM master_t), 3) AS share "
       "FROM master_t GROUP BY tournament_tier", doubles=["share"])
def q_tier_distribution(spark, sf):
    """A29."""
    return tier_distribution(_inp(spark, sf).master)


@query("impute_minute",
       """WITH g AS (SELECT gn.*, m.tournament FROM goals_n gn LEFT JOIN master_t m ON gn.match_id = m.match_id),
          med AS (SELECT tournament, median(minute) AS mm FROM g GROUP BY tournament),
          g2 AS (SELECT g.match_id, g.team, g.scorer, g.own_goal, g.penalty, g.tournament,
                        coalesce(CAST(g.minute AS DOUBLE), med.mm) AS minute
                 FROM g LEFT JOIN med ON g.tournament IS NOT DISTINCT FROM med.tournament)
          SELECT match_id, team, scorer, own_goal, penalty, tournament,
                 coalesce(minute, (SELECT median(minute) FROM g2)) AS minute FROM g2""",
       doubles=["minute"])
def q_impute_minute(spark, sf):
    """Tournament median, then global median."""
    inp = _inp(spark, sf)
    g = resolve_names(inp.goals, inp.former_names, ["home_team", "away_team", "team"])
    out = impute_minute(g, inp.master, KEYS, "tournament")
    return out.select("match_id", "team", "scorer", "own_goal", "penalty", "tournament", "minute")


# =============================================================================
# Two-sided log and team tables
# =============================================================================

@query("team_log", "SELECT match_id, date, team, opponent, is_home, goals_scored, goals_conceded, "
                   "team_result, points FROM tlp")
def q_team_log(spark, sf):
    """P7 + U1."""
    return team_log(_inp(spark, sf).master, KEYS).select(
        "match_id", "date", "team", "opponent", "is_home", "goals_scored", "goals_conceded", "team_result", "points")


@query("all_teams", "SELECT DISTINCT t AS team FROM (SELECT home_team AS t FROM master_t UNION ALL "
                    "SELECT away_team FROM master_t) WHERE t IS NOT NULL")
def q_all_teams(spark, sf):
    """U2 + U4."""
    return all_teams(_inp(spark, sf).master)


@query("team_points", "SELECT team, CAST(sum(points) AS BIGINT) AS points, count(*) AS n FROM tlp GROUP BY team")
def q_team_points(spark, sf):
    """points per result summed by team."""
    return team_log(_inp(spark, sf).master, KEYS).groupBy("team").agg(
        F.sum("points").cast("long").alias("points"), F.count(F.lit(1)).alias("n"))


_RECORDS_SQL = ("SELECT team, played, wins, draws, gf, ga, played - wins - draws AS losses, gf - ga AS gd, "
                "wins / played * 100.0 AS win_pct FROM records")


@query("team_records", _RECORDS_SQL, doubles=["win_pct"])
def q_team_records(spark, sf):
    """A3 + A4."""
    return A.team_records(_inp(spark, sf).master, KEYS)


@query("top_teams_win_pct", f"SELECT * FROM ({_RECORDS_SQL}) WHERE played >= {C.EDA_MIN_MATCHES_FOR_WIN_PCT} "
                            f"ORDER BY win_pct DESC, team LIMIT {C.EDA_TOP_N_TEAMS}", doubles=["win_pct"])
def q_top_teams_win_pct(spark, sf):
    """T1 (the minimum slice: scan -> label -> two-sided log -> group -> top-k)."""
    return A.top_teams_win_pct(A.team_records(_inp(spark, sf).master, KEYS))


@query("top_teams_wins", f"SELECT * FROM ({_RECORDS_SQL}) ORDER BY wins DESC, team LIMIT {C.EDA_TOP_N_TEAMS}",
       doubles=["win_pct"])
def q_top_teams_wins(spark, sf):
    """T2."""
    return A.top_teams_wins(A.team_records(_inp(spark, sf).master, KEYS))


def _leaderboard_sql(where: str) -> str:
    return f"""SELECT team, count(*) AS played, count(CASE WHEN team_result = 'win' THEN 1 END) AS wins,
      count(CASE WHEN team_result = 'win' THEN 1 END) / count(*) * 100.0 AS win_pct
      FROM ctl WHERE {where} GROUP BY team HAVING count(*) >= {C.LEADERBOARD_MIN_PLAYED}
      ORDER BY win_pct DESC, team LIMIT {C.EDA_TOP_N_TEAMS}"""


@query("nation_leaderboard", _leaderboard_sql("TRUE"), doubles=["win_pct"])
def q_nation_leaderboard(spark, sf):
    """T3 (no filter)."""
    return A.nation_leaderboard(_inp(spark, sf).master, KEYS)


@query("nation_leaderboard_filtered",
       _leaderboard_sql("floor(year(date) / 10) * 10 = 1990 AND tournament_tier = 2"), doubles=["win_pct"])
def q_nation_leaderboard_filtered(spark, sf):
    """P9 + T3 with a decade and a tier filter."""
    return A.nation_leaderboard(_inp(spark, sf).master, KEYS, decade=1990, tier=2)


# =============================================================================
# Distributions and findings
# =============================================================================

_MASTER_COLS = ["date", "home_team", "away_team", "home_score", "away_score", "tournament", "city", "country",
                "neutral", "shootout_winner", "first_shooter", "home_goal_count", "away_goal_count",
                "home_penalty_count", "away_penalty_count", "home_own_goals", "away_own_goals", "total_goals",
                "is_incomplete", "home_goals", "away_goals", "result", "tournament_tier", "match_weight"]


@query("null_counts",
       "SELECT * FROM (UNPIVOT (SELECT " + ", ".join(
           f"count(*) - count({c}) AS {c}" for c in ["match_id"] + _MASTER_COLS)
       + " FROM master_t) ON COLUMNS(*) INTO NAME \"column\" VALUE null_count) WHERE null_count > 0")
def q_null_counts(spark, sf):
    """A5."""
    return A.null_counts(_inp(spark, sf).master)


@query("matches_per_year",
       """WITH y AS (SELECT CAST(year(date) AS INT) AS year, count(*) AS n_matches FROM master_t GROUP BY 1)
          SELECT year, n_matches, (SELECT max(n_matches) FROM y) AS max_per_year FROM y""")
def q_matches_per_year(spark, sf):
    """A6."""
    return A.matches_per_year(_inp(spark, sf).master)


@query("result_distribution",
       "SELECT result, count(*) AS n, count(*) / (SELECT count(*) FROM master_t WHERE result IS NOT NULL) * 100.0 "
       "AS pct FROM master_t WHERE result IS NOT NULL GROUP BY result", doubles=["pct"])
def q_result_distribution(spark, sf):
    """A7 + A20."""
    return A.result_distribution(_inp(spark, sf).master)


@query("result_by_venue",
       """SELECT neutral, result, count(*) AS n,
          count(*) / sum(count(*)) OVER (PARTITION BY neutral) * 100.0 AS pct
          FROM master_t WHERE result IS NOT NULL GROUP BY neutral, result""", doubles=["pct"])
def q_result_by_venue(spark, sf):
    """A8."""
    return A.result_by_venue(_inp(spark, sf).master)


@query("home_advantage_gap",
       """SELECT h AS home_venue_hw_pct, nv AS neutral_venue_hw_pct, h - nv AS gap_pct_points FROM (
          SELECT avg(CASE WHEN NOT neutral THEN CAST(result = 'home_win' AS DOUBLE) END) * 100.0 AS h,
                 avg(CASE WHEN neutral THEN CAST(result = 'home_win' AS DOUBLE) END) * 100.0 AS nv
          FROM master_t WHERE result IS NOT NULL)""",
       doubles=["home_venue_hw_pct", "neutral_venue_hw_pct", "gap_pct_points"])
def q_home_advantage_gap(spark, sf):
    """A9."""
    return A.home_advantage_gap(_inp(spark, sf).master)


@query("home_win_by_decade",
       "SELECT CAST(floor(year(date) / 10) * 10 AS INT) AS decade, "
       "avg(CAST(result = 'home_win' AS DOUBLE)) * 100.0 AS home_win_pct, count(*) AS n "
       "FROM master_t WHERE result IS NOT NULL GROUP BY 1", doubles=["home_win_pct"])
def q_home_win_by_decade(spark, sf):
    """A10."""
    return A.home_win_by_decade(_inp(spark, sf).master)


@query("home_advantage_ends", """
  WITH d AS (SELECT CAST(floor(year(date) / 10) * 10 AS INT) AS decade,
               avg(CAST(result = 'home_win' AS DOUBLE)) * 100.0 AS pct
             FROM master_t WHERE result IS NOT NULL AND NOT neutral GROUP BY 1),
  e AS (SELECT min(decade) AS first_decade, max(decade) AS last_decade, arg_min(pct, decade) AS first_pct,
          arg_max(pct, decade) AS last_pct FROM d)
  SELECT *, last_pct - first_pct AS change,
    CASE WHEN last_pct > first_pct THEN 'up' WHEN last_pct < first_pct THEN 'down' ELSE 'flat' END AS direction FROM e""",
       doubles=["first_pct", "last_pct", "change"])
def q_home_advantage_ends(spark, sf):
    """A10: first against last decade."""
    return A.home_advantage_ends(_inp(spark, sf).master)


@query("decades_present", "SELECT DISTINCT CAST(floor(year(date) / 10) * 10 AS INT) AS decade FROM master_t "
                          "WHERE date IS NOT NULL")
def q_decades_present(spark, sf):
    """U4: decades."""
    return A.decades_present(_inp(spark, sf).master)


@query("teams_with_goals", "SELECT DISTINCT team FROM raw_goals WHERE team IS NOT NULL")
def q_teams_with_goals(spark, sf):
    """U4: teams with goals (names as given)."""
    return A.teams_with_goals(_inp(spark, sf).goals)


@query("top5_win_pct_any", f"SELECT * FROM ({_RECORDS_SQL}) ORDER BY win_pct DESC, team LIMIT 5", doubles=["win_pct"])
def q_top5_win_pct_any(spark, sf):
    """Top five by win %, without a minimum of matches."""
    return A.team_records(_inp(spark, sf).master, KEYS).orderBy(F.col("win_pct").desc(), "team").limit(5)


#: A name dimension with an equal row, an overlap, an equal start and a chain.
_DIRTY_NAMES = [
    ("UNION_A", "NATION_3", "1996-01-01", "1998-12-31"), ("UNION_A", "NATION_3", "1996-01-01", "1998-12-31"),
    ("UNION_X", "NATION_3", "1998-06-01", "1999-12-31"), ("UNION_Y", "NATION_3", "1996-01-01", "1997-12-31"),
    ("MID_7", "NATION_7", "1996-01-01", "1999-12-31"), ("NEW_7", "MID_7", "1997-01-01", "1998-12-31"),
]


def _dirty_names_sql() -> str:
    """The rows one after the other, as nested projections."""
    sql = "SELECT match_id, date, home_team, away_team FROM raw_matches"
    for current, former, start, end in _DIRTY_NAMES:
        cases = ", ".join(f"CASE WHEN {c} = '{former}' AND date BETWEEN DATE '{start}' AND DATE '{end}' "
                          f"THEN '{current}' ELSE {c} END AS {c}" for c in ("home_team", "away_team"))
        sql = f"SELECT match_id, date, {cases} FROM ({sql})"
    return sql


@query("resolve_names_dirty", _dirty_names_sql())
def q_resolve_names_dirty(spark, sf):
    """J1 with a dimension that needs normalising."""
    dim = spark.createDataFrame(_DIRTY_NAMES, "current string, former string, start_date string, end_date string").select(
        "current", "former", F.col("start_date").cast("date").alias("start_date"),
        F.col("end_date").cast("date").alias("end_date"))
    return resolve_names(_inp(spark, sf).results, dim, ["home_team", "away_team"]).select(
        "match_id", "date", "home_team", "away_team")


_LARGE_NAMES = """names AS (
  SELECT *, row_number() OVER (ORDER BY o, n, former, current, start_date, end_date) - 1 AS pos FROM (
    SELECT l_orderkey AS o, l_linenumber AS n, 'P' || l_partkey AS former, 'S' || l_suppkey AS current,
      CAST(l_shipdate AS DATE) AS start_date, CAST(l_shipdate AS DATE) + CAST(l_quantity AS INT) AS end_date FROM lineitem
    UNION ALL
    SELECT l_orderkey, l_linenumber, 'S' || l_suppkey, 'C' || o_custkey, CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + 30
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    UNION ALL
    SELECT o_orderkey, 0, 'C' || o_custkey, o_orderpriority, CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + 365
    FROM orders) t)"""


def _large_names_sql() -> str:
    """At most three renames follow one another (P, S, C)."""
    sql = f"""WITH {_LARGE_NAMES},
h0 AS (SELECT DISTINCT 'P' || l_partkey AS given, CAST(l_shipdate AS DATE) AS date, 'P' || l_partkey AS name,
         CAST(-1 AS BIGINT) AS last FROM lineitem)"""
    for k in (1, 2, 3):
        sql += f""",
s{k} AS (SELECT h.given, h.date, arg_min(d.current, d.pos) AS name, min(d.pos) AS last FROM h{k - 1} h JOIN names d
        ON d.former = h.name AND h.date BETWEEN d.start_date AND d.end_date AND d.pos > h.last GROUP BY h.given, h.date),
h{k} AS (SELECT h.given, h.date, coalesce(s.name, h.name) AS name, coalesce(s.last, h.last) AS last
        FROM h{k - 1} h LEFT JOIN s{k} s ON s.given = h.given AND s.date = h.date)"""
    return sql + """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS date, h3.name AS part_name
FROM lineitem JOIN h3 ON h3.given = 'P' || l_partkey AND h3.date = CAST(l_shipdate AS DATE)"""


@query("resolve_names_large", _large_names_sql())
def q_resolve_names_large(spark, sf):
    """J1 with a dimension that grows with the data (two rows per line item and
    one per order, overlaps and chains)."""
    lines, orders = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("lineitem", "orders"))
    ship, placed = F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date")
    part, supplier, customer = (F.concat(F.lit(a), F.col(b).cast("string")) for a, b in (
        ("P", "l_partkey"), ("S", "l_suppkey"), ("C", "o_custkey")))
    cols = ["o", "n", "former", "current", "start_date", "end_date"]
    dim = (lines.select("l_orderkey", "l_linenumber", part, supplier, ship, F.date_add(ship, F.col("l_quantity").cast("int"))).toDF(*cols)
           .union(lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
                  .select("l_orderkey", "l_linenumber", supplier, customer, placed, F.date_add(placed, 30)).toDF(*cols))
           .union(orders.select("o_orderkey", F.lit(0), customer, "o_orderpriority", placed, F.date_add(placed, 365)).toDF(*cols)))
    facts = lines.select("l_orderkey", "l_linenumber", ship.alias("date"), part.alias("part_name"))
    return resolve_names_large(facts, dim, ["part_name"], "date", cols)


@query("avg_goals_by_decade",
       "SELECT CAST(floor(year(date) / 10) * 10 AS INT) AS decade, avg(total_goals) AS avg_goals, count(*) AS n "
       "FROM master_t WHERE result IS NOT NULL AND total_goals IS NOT NULL GROUP BY 1", doubles=["avg_goals"])
def q_avg_goals_by_decade(spark, sf):
    """A11 by decade."""
    return A.avg_goals_by(_inp(spark, sf).master, "decade")


@query("avg_goals_by_tier",
       "SELECT tournament_tier, avg(total_goals) AS avg_goals, count(*) AS n "
       "FROM master_t WHERE result IS NOT NULL AND total_goals IS NOT NULL GROUP BY 1", doubles=["avg_goals"])
def q_avg_goals_by_tier(spark, sf):
    """A11 by tier."""
    return A.avg_goals_by(_inp(spark, sf).master, "tournament_tier")


@query("avg_goals_overall",
       "SELECT avg(total_goals) AS avg_goals, count(*) AS n FROM master_t "
       "WHERE result IS NOT NULL AND total_goals IS NOT NULL", doubles=["avg_goals"])
def q_avg_goals_overall(spark, sf):
    """A11 overall."""
    return A.avg_goals_overall(_inp(spark, sf).master)


@query("score_matrix",
       f"""WITH c AS (SELECT least(home_goals, {C.SCORE_MATRIX_MAX}) AS hg, least(away_goals, {C.SCORE_MATRIX_MAX}) AS ag,
                      count(*) AS n FROM master_t WHERE result IS NOT NULL AND total_goals IS NOT NULL GROUP BY 1, 2)
          SELECT CAST(h.i AS INT) AS home_goals, CAST(a.i AS INT) AS away_goals, CAST(coalesce(c.n, 0) AS BIGINT) AS n
          FROM range({C.SCORE_MATRIX_MAX + 1}) h(i) JOIN range({C.SCORE_MATRIX_MAX + 1}) a(i) ON TRUE
          LEFT JOIN c ON c.hg = h.i AND c.ag = a.i""")
def q_score_matrix(spark, sf):
    """A12."""
    return A.score_matrix(_inp(spark, sf).master)


@query("modal_scoreline",
       "SELECT home_goals, away_goals, count(*) AS n FROM master_t WHERE result IS NOT NULL AND total_goals IS NOT NULL "
       "GROUP BY 1, 2 ORDER BY n DESC, home_goals, away_goals LIMIT 1")
def q_modal_scoreline(spark, sf):
    """A13."""
    return A.modal_scoreline(_inp(spark, sf).master)


@query("goals_histogram",
       f"SELECT CAST(least(total_goals, {C.GOALS_HIST_MAX - 1}) AS INT) AS bin, count(*) AS n FROM master_t "
       f"WHERE result IS NOT NULL AND total_goals BETWEEN 0 AND {C.GOALS_HIST_MAX} GROUP BY 1")
def q_goals_histogram(spark, sf):
    """A25."""
    return A.goals_histogram(_inp(spark, sf).master)


@query("top_scorers",
       """WITH g AS (SELECT * FROM raw_goals WHERE NOT own_goal AND scorer IS NOT NULL),
          per AS (SELECT scorer, count(*) AS goals, CAST(sum(CAST(penalty AS INT)) AS BIGINT) AS penalties
                  FROM g GROUP BY scorer),
          st AS (SELECT scorer, team, row_number() OVER (PARTITION BY scorer ORDER BY count(*) DESC, team) AS r
                 FROM g GROUP BY scorer, team)
          SELECT per.scorer, per.goals, per.penalties, st.team FROM per JOIN st ON per.scorer = st.scorer AND st.r = 1
          ORDER BY goals DESC, scorer LIMIT 20""")
def q_top_scorers(spark, sf):
    """A14 + T5 over the raw goal rows (the scorer table reads them before
    any name resolution)."""
    return A.top_scorers(_inp(spark, sf).goals)


_SHOOT_SIDES = ("(SELECT winner, home_team AS team FROM raw_shootouts UNION ALL "
                "SELECT winner, away_team FROM raw_shootouts)")


@query("shootout_specialists",
       f"""SELECT team, count(*) AS appearances, count(CASE WHEN winner = team THEN 1 END) AS wins,
           count(CASE WHEN winner = team THEN 1 END) / count(*) * 100.0 AS win_pct
           FROM {_SHOOT_SIDES} WHERE team IS NOT NULL GROUP BY team
           HAVING count(*) >= 2 AND count(*) >= {C.EDA_MIN_SHOOTOUTS_FOR_RATE}
           ORDER BY win_pct DESC, team LIMIT {C.EDA_TOP_N_TEAMS}""", doubles=["win_pct"])
def q_shootout_specialists(spark, sf):
    """A15 + T5 (raw shootouts, as the reference reads them)."""
    return A.shootout_specialists(_inp(spark, sf).shootouts)


@query("first_shooter_advantage",
       """SELECT n_with_first_shooter, first_wins_pct, n_missing, 100.0 - first_wins_pct AS second_wins_pct FROM (
          SELECT count(first_shooter) AS n_with_first_shooter,
                 avg(CASE WHEN first_shooter IS NOT NULL THEN CAST(first_shooter = winner AS DOUBLE) END) * 100.0
                   AS first_wins_pct,
                 count(CASE WHEN first_shooter IS NULL THEN 1 END) AS n_missing FROM raw_shootouts)""",
       doubles=["first_wins_pct", "second_wins_pct"])
def q_first_shooter_advantage(spark, sf):
    """A16."""
    return A.first_shooter_advantage(_inp(spark, sf).shootouts)


@query("key_findings",
       """SELECT
          avg(CASE WHEN NOT neutral THEN CAST(result = 'home_win' AS DOUBLE) END) * 100.0 AS home_venue_hw_pct,
          avg(CASE WHEN neutral THEN CAST(result = 'home_win' AS DOUBLE) END) * 100.0 AS neutral_venue_hw_pct,
          avg(CASE WHEN tournament_tier = 1 THEN CAST(result = 'draw' AS DOUBLE) END) * 100.0 AS elite_draw_pct,
          avg(CASE WHEN tournament_tier = 3 THEN CAST(result = 'draw' AS DOUBLE) END) * 100.0 AS friendly_draw_pct,
          avg(CASE WHEN tournament_tier = 1 THEN total_goals END) AS elite_avg_goals,
          avg(CASE WHEN tournament_tier = 3 THEN total_goals END) AS friendly_avg_goals,
          avg(CASE WHEN year(date) < 1970 THEN total_goals END) AS pre1970_avg_goals,
          avg(CASE WHEN year(date) >= 2010 THEN total_goals END) AS post2010_avg_goals
          FROM master_t WHERE result IS NOT NULL""",
       doubles=["home_venue_hw_pct", "neutral_venue_hw_pct", "elite_draw_pct", "friendly_draw_pct",
                "elite_avg_goals", "friendly_avg_goals", "pre1970_avg_goals", "post2010_avg_goals"])
def q_key_findings(spark, sf):
    """A17."""
    return A.key_findings(_inp(spark, sf).master)


# =============================================================================
# Per-team questions for all teams
# =============================================================================

@query("team_goals_by_year",
       "SELECT team, CAST(year(date) AS INT) AS year, avg(goals_scored) AS scored, avg(goals_conceded) AS conceded "
       "FROM ctl WHERE year(date) >= 1960 GROUP BY 1, 2", doubles=["scored", "conceded"])
def q_team_goals_by_year(spark, sf):
    """A18."""
    return A.team_goals_by_year(_inp(spark, sf).master, KEYS)


@query("team_by_tier",
       """WITH per AS (SELECT team, tournament_tier, avg(CAST(team_result = 'win' AS DOUBLE)) * 100.0 AS win_pct,
                       count(*) AS n FROM ctl GROUP BY 1, 2),
          grid AS (SELECT t.team, CAST(k.i AS INT) AS tournament_tier
                   FROM (SELECT DISTINCT team FROM ctl) t JOIN range(1, 4) k(i) ON TRUE)
          SELECT g.team, g.tournament_tier, coalesce(p.win_pct, 0.0) AS win_pct, CAST(coalesce(p.n, 0) AS BIGINT) AS n
          FROM grid g LEFT JOIN per p ON p.team = g.team AND p.tournament_tier = g.tournament_tier""",
       doubles=["win_pct"])
def q_team_by_tier(spark, sf):
    """A19."""
    return A.team_by_tier(_inp(spark, sf).master, KEYS)


@query("top_opponents",
       """SELECT * FROM (SELECT team, opponent, count(*) AS meetings,
            row_number() OVER (PARTITION BY team ORDER BY count(*) DESC, opponent) AS rank
          FROM ctl GROUP BY team, opponent) WHERE rank <= 10""")
def q_top_opponents(spark, sf):
    """T4 + P8."""
    return A.top_opponents(_inp(spark, sf).master, KEYS).withColumn("rank", F.col("rank").cast("long"))


@query("h2h_last_n",
       """SELECT * FROM (SELECT match_id, date, home_team, away_team, home_goals, away_goals, result, tournament,
            least(home_team, away_team) AS team_a, greatest(home_team, away_team) AS team_b,
            row_number() OVER (PARTITION BY least(home_team, away_team), greatest(home_team, away_team)
                               ORDER BY date DESC, match_id DESC) AS rank,
            strftime(date, '%d %b %Y') AS date_str, substring(tournament, 1, 28) AS tournament_short
          FROM complete_t) WHERE rank <= 5""")
def q_h2h_last_n(spark, sf):
    """T6 + P11 + F13."""
    return A.h2h_last_n(_inp(spark, sf).master, KEYS).withColumn("rank", F.col("rank").cast("long"))


@query("win_pct_trend",
       """SELECT team, year, win_pct, avg(win_pct) OVER (PARTITION BY team ORDER BY year
                 ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_win_pct
          FROM (SELECT team, CAST(year(date) AS INT) AS year, avg(CAST(team_result = 'win' AS DOUBLE)) * 100.0 AS win_pct
                FROM ctl WHERE year(date) >= 1950 GROUP BY 1, 2)""", doubles=["win_pct", "rolling_win_pct"])
def q_win_pct_trend(spark, sf):
    """Per-team 3-year rolling win %."""
    return A.win_pct_trend(_inp(spark, sf).master, KEYS)


@query("goal_trend",
       f"""SELECT year, avg_goals, avg(avg_goals) OVER (ORDER BY year ROWS BETWEEN {C.EDA_ROLLING_YEARS - 1} PRECEDING
                 AND CURRENT ROW) AS rolling_avg_goals
          FROM (SELECT CAST(year(date) AS INT) AS year, avg(total_goals) AS avg_goals FROM master_t
                WHERE result IS NOT NULL AND total_goals IS NOT NULL AND year(date) >= 1950 GROUP BY 1)""",
       doubles=["avg_goals", "rolling_avg_goals"])
def q_goal_trend(spark, sf):
    """P10 + W12."""
    return A.goal_trend(_inp(spark, sf).master)


@query("last5_form",
       """WITH r AS (SELECT *, row_number() OVER (PARTITION BY team ORDER BY date DESC, match_id DESC) AS rk FROM ctl)
          SELECT team,
            string_agg(upper(substring(team_result, 1, 1)), '' ORDER BY date, match_id) AS form,
            string_agg(opponent || ' ' || CAST(goals_scored AS VARCHAR) || '-' || CAST(goals_conceded AS VARCHAR),
                 '; ' ORDER BY date, match_id) AS details,
            CAST(sum(points) AS BIGINT) AS points, sum(points) / 15.0 AS points_share
          FROM r WHERE rk <= 5 GROUP BY team""", doubles=["points_share"])
def q_last5_form(spark, sf):
    """W13."""
    return A.last5_form(_inp(spark, sf).master, KEYS).withColumn("points", F.col("points").cast("long"))


@query("latest_n", "SELECT * FROM master_t ORDER BY date DESC, match_id DESC LIMIT 2000")
def q_latest_n(spark, sf):
    """The 2,000 most recent matches (the reference's recent-form slice)."""
    return A.latest_n(_inp(spark, sf).master, 2000, KEYS)


@query("home_advantage_trend",
       """WITH d AS (SELECT CAST(floor(year(date) / 10) * 10 AS INT) AS decade,
                       avg(CAST(result = 'home_win' AS DOUBLE)) * 100.0 AS home_win_pct
                     FROM master_t WHERE result IS NOT NULL AND NOT neutral GROUP BY 1),
          x AS (SELECT decade, home_win_pct, CAST(row_number() OVER (ORDER BY decade) - 1 AS DOUBLE) AS x FROM d),
          f AS (SELECT regr_slope(home_win_pct, x) AS slope, regr_intercept(home_win_pct, x) AS intercept FROM x)
          SELECT decade, home_win_pct, x, slope, intercept, intercept + slope * x AS fitted,
            CASE WHEN slope < 0 THEN 'shrinking' ELSE 'stable/growing' END AS trend FROM x, f""",
       doubles=["home_win_pct", "x", "slope", "intercept", "fitted"])
def q_home_advantage_trend(spark, sf):
    """A27."""
    return A.home_advantage_trend(_inp(spark, sf).master)


# =============================================================================
# Team strength and heuristic probabilities
# =============================================================================

@query("team_ratings",
       """SELECT team, played,
          least(greatest(gf / greatest(played, 1) / 2.0 * 100.0, 0.0), 100.0) AS attack_pct,
          least(greatest((1.0 - ga / greatest(played, 1) / 2.0) * 100.0, 0.0), 100.0) AS defence_pct,
          wins / greatest(played, 1) * 100.0 AS win_rate_pct, gf / greatest(played, 1) AS avg_goals,
          gf - ga AS gd, (1.0 - ga / greatest(played, 1) / 3.0) * 100.0 AS clean_sheet_proxy FROM records""",
       doubles=["attack_pct", "defence_pct", "win_rate_pct", "avg_goals", "clean_sheet_proxy"])
def q_team_ratings(spark, sf):
    """F10 + F11."""
    return A.team_ratings(A.team_records(_inp(spark, sf).master, KEYS))


@query("pairwise_strength",
       """WITH p AS (SELECT DISTINCT least(home_team, away_team) AS team_1, greatest(home_team, away_team) AS team_2
                     FROM master_t),
          r AS (SELECT team, wins / greatest(played, 1) AS w FROM records)
          SELECT p.team_2, p.team_1,
            CASE WHEN coalesce(a.w, 0) + coalesce(b.w, 0) = 0 THEN 0.5
                 ELSE coalesce(a.w, 0) / (coalesce(a.w, 0) + coalesce(b.w, 0)) END AS p_team_1
          FROM p LEFT JOIN r a ON a.team = p.team_1 LEFT JOIN r b ON b.team = p.team_2""",
       doubles=["p_team_1"])
def q_pairwise_strength(spark, sf):
    """J9 for every pair that has met."""
    m = _inp(spark, sf).master
    pairs = m.select(F.least("home_team", "away_team").alias("team_1"),
                     F.greatest("home_team", "away_team").alias("team_2")).distinct()
    return A.pairwise_strength(pairs, A.team_records(m, KEYS))


_HEUR_SQL = f"""
hr AS (SELECT team, wins / greatest(played, 1) AS rate FROM records),
hx AS (SELECT m.match_id, m.date, m.home_team, m.away_team, m.neutral, m.tournament_tier, m.result,
         CASE WHEN coalesce(m.neutral, FALSE) THEN coalesce(a.rate, 0.0) ELSE coalesce(a.rate, 0.0) * {C.HOME_BOOST} END AS wh,
         coalesce(b.rate, 0.0) AS wa
       FROM master_t m LEFT JOIN hr a ON a.team = m.home_team LEFT JOIN hr b ON b.team = m.away_team),
hy AS (SELECT *, wh / (wh + wa + {C.HEURISTIC_DRAW_MASS}) AS ph, wa / (wh + wa + {C.HEURISTIC_DRAW_MASS}) AS pa FROM hx),
hz AS (SELECT *, greatest(0.0, 1 - ph - pa) AS pdr FROM hy),
heur AS (SELECT match_id, date, home_team, away_team, neutral, tournament_tier, result,
           ph / (ph + pdr + pa) AS p_home, pdr / (ph + pdr + pa) AS p_draw, pa / (ph + pdr + pa) AS p_away FROM hz)"""


def _heuristic(spark, sf) -> DataFrame:
    m = _inp(spark, sf).master
    fx = m.select("match_id", "date", "home_team", "away_team", "neutral", "tournament_tier", "result")
    return A.heuristic_predict(fx, A.team_records(m, KEYS))


@query("heuristic_predict",
       f"""WITH {_HEUR_SQL}
          SELECT match_id, home_team, away_team, round(p_home, 4) AS home_win, round(p_draw, 4) AS draw,
            round(p_away, 4) AS away_win,
            CASE WHEN greatest(p_home, p_draw, p_away) = p_home THEN 'home_win'
                 WHEN greatest(p_home, p_draw, p_away) = p_away THEN 'away_win' ELSE 'draw' END AS predicted_outcome,
            CASE WHEN greatest(p_home, p_draw, p_away) = p_home THEN home_team
                 WHEN greatest(p_home, p_draw, p_away) = p_away THEN away_team ELSE 'Draw' END AS predicted_winner,
            CASE WHEN greatest(p_home, p_draw, p_away) >= {C.CONFIDENCE_HIGH} THEN 'High'
                 WHEN greatest(p_home, p_draw, p_away) >= {C.CONFIDENCE_MEDIUM} THEN 'Medium' ELSE 'Low' END AS confidence
          FROM heur""",
       doubles=["home_win", "draw", "away_win"])
def q_heuristic_predict(spark, sf):
    """F12 + F9 (without the free-text summary, which is checked in unit tests)."""
    h = _heuristic(spark, sf)
    f = S.format_prediction()
    return h.select("match_id", "home_team", "away_team",
                    *[f[k].alias(k) for k in ["home_win", "draw", "away_win", "predicted_outcome",
                                              "predicted_winner", "confidence"]])


@query("encode_labels",
       "SELECT result, CASE result WHEN 'home_win' THEN 0 WHEN 'draw' THEN 1 WHEN 'away_win' THEN 2 END AS label, "
       "result AS decoded, count(*) AS n FROM complete_t GROUP BY result")
def q_encode_labels(spark, sf):
    """F7 + F8 round trip over all complete matches."""
    c = complete_matches(_inp(spark, sf).master)
    return (c.select("result", S.encode_result("result").alias("label"))
            .withColumn("decoded", S.decode_result("label"))
            .groupBy("result", "label", "decoded").agg(F.count(F.lit(1)).alias("n")))
