"""DuckDB oracle SQL for the registered queries.

The oracle side inlines the fixture derivation and an independent SQL
rendering of the master table, the two-sided log and brute-force
(per-row history scans) versions of the look-back features.  Only the raw
test tables are visible to it.
"""

from __future__ import annotations

from matchstats import config as C
from matchstats.sources.testdata import RAW_CTES


def _like_any(col: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"lower({col}) LIKE '%{w}%'" for w in words) + ")"


def tier_sql(col: str = "tournament") -> str:
    return (f"CASE WHEN {col} IS NULL THEN 3 "
            f"WHEN {_like_any(col, C.TIER1_KEYWORDS)} AND lower({col}) NOT LIKE '%{C.TIER1_BLOCKER}%' THEN 1 "
            f"WHEN {_like_any(col, C.TIER2_KEYWORDS)} THEN 2 ELSE 3 END")


def knockout_sql(col: str = "tournament") -> str:
    return f"CASE WHEN {col} IS NULL THEN 0 WHEN {_like_any(col, C.KNOCKOUT_KEYWORDS)} THEN 1 ELSE 0 END"


_MASTER_CTES = [
    """
res_n AS (
  SELECT r.match_id, r.date,
    coalesce(f1.current, r.home_team) AS home_team,
    coalesce(f2.current, r.away_team) AS away_team,
    r.home_score, r.away_score, r.tournament, r.city, r.country, r.neutral
  FROM raw_matches r
  LEFT JOIN former_names f1 ON r.home_team = f1.former AND r.date BETWEEN f1.start_date AND f1.end_date
  LEFT JOIN former_names f2 ON r.away_team = f2.former AND r.date BETWEEN f2.start_date AND f2.end_date
)""",
    """
sht_n AS (
  SELECT s.match_id, coalesce(f.current, s.winner) AS shootout_winner, s.first_shooter
  FROM raw_shootouts s
  LEFT JOIN former_names f ON s.winner = f.former AND s.date BETWEEN f.start_date AND f.end_date
)""",
    """
goals_n AS (
  SELECT g.match_id, g.date,
    coalesce(a.current, g.home_team) AS home_team,
    coalesce(b.current, g.away_team) AS away_team,
    coalesce(c.current, g.team) AS team,
    g.scorer, g.minute, g.own_goal, g.penalty
  FROM raw_goals g
  LEFT JOIN former_names a ON g.home_team = a.former AND g.date BETWEEN a.start_date AND a.end_date
  LEFT JOIN former_names b ON g.away_team = b.former AND g.date BETWEEN b.start_date AND b.end_date
  LEFT JOIN former_names c ON g.team = c.former AND g.date BETWEEN c.start_date AND c.end_date
)""",
    """
goal_agg AS (
  SELECT match_id,
    CAST(count(CASE WHEN NOT own_goal AND team = home_team THEN scorer END) AS BIGINT) AS home_goal_count,
    CAST(count(CASE WHEN NOT own_goal AND team = away_team THEN scorer END) AS BIGINT) AS away_goal_count,
    CAST(coalesce(sum(CASE WHEN NOT own_goal AND team = home_team THEN CAST(penalty AS INT) END), 0) AS BIGINT) AS home_penalty_count,
    CAST(coalesce(sum(CASE WHEN NOT own_goal AND team = away_team THEN CAST(penalty AS INT) END), 0) AS BIGINT) AS away_penalty_count,
    CAST(count(CASE WHEN own_goal AND team = away_team THEN 1 END) AS BIGINT) AS home_own_goals,
    CAST(count(CASE WHEN own_goal AND team = home_team THEN 1 END) AS BIGINT) AS away_own_goals
  FROM goals_n WHERE match_id IS NOT NULL
  GROUP BY match_id
  HAVING max(CASE WHEN team = home_team OR team = away_team THEN 1 ELSE 0 END) = 1
)""",
    f"""
master_t AS (
  SELECT r.match_id, r.date, r.home_team, r.away_team, r.home_score, r.away_score, r.tournament,
    r.city, r.country, r.neutral, s.shootout_winner, s.first_shooter,
    g.home_goal_count, g.away_goal_count, g.home_penalty_count, g.away_penalty_count,
    g.home_own_goals, g.away_own_goals,
    g.home_goal_count + g.away_goal_count + g.home_own_goals + g.away_own_goals AS total_goals,
    (r.home_score IS NULL OR r.away_score IS NULL) AS is_incomplete,
    r.home_score AS home_goals, r.away_score AS away_goals,
    CASE WHEN r.home_score IS NULL OR r.away_score IS NULL THEN NULL
         WHEN r.home_score > r.away_score THEN 'home_win'
         WHEN r.home_score = r.away_score THEN 'draw' ELSE 'away_win' END AS result,
    {tier_sql('r.tournament')} AS tournament_tier,
    CASE {tier_sql('r.tournament')} WHEN 1 THEN 3 WHEN 2 THEN 2 ELSE 1 END AS match_weight
  FROM res_n r
  LEFT JOIN sht_n s ON r.match_id = s.match_id
  LEFT JOIN goal_agg g ON r.match_id = g.match_id
)""",
    """
complete_t AS (SELECT * FROM master_t WHERE NOT is_incomplete AND result IS NOT NULL)""",
    """
tl AS (
  SELECT match_id, date, home_team AS team, away_team AS opponent, TRUE AS is_home,
    home_goals AS goals_scored, away_goals AS goals_conceded, result, is_incomplete, tournament,
    tournament_tier, neutral, total_goals,
    CASE result WHEN 'home_win' THEN 'win' WHEN 'draw' THEN 'draw' WHEN 'away_win' THEN 'loss' END AS team_result
  FROM master_t
  UNION ALL
  SELECT match_id, date, away_team, home_team, FALSE, away_goals, home_goals, result, is_incomplete,
    tournament, tournament_tier, neutral, total_goals,
    CASE result WHEN 'away_win' THEN 'win' WHEN 'draw' THEN 'draw' WHEN 'home_win' THEN 'loss' END
  FROM master_t
)""",
    f"""
tlp AS (SELECT *, CASE team_result WHEN 'win' THEN {C.WIN_POINTS} WHEN 'draw' THEN {C.DRAW_POINTS}
                  ELSE {C.LOSS_POINTS} END AS points FROM tl)""",
    """
ctl AS (SELECT * FROM tlp WHERE NOT is_incomplete AND result IS NOT NULL
        AND team_result IS NOT NULL AND goals_scored IS NOT NULL AND goals_conceded IS NOT NULL)""",
    """
records AS (
  SELECT team, count(*) AS played,
    count(CASE WHEN team_result = 'win' THEN 1 END) AS wins,
    count(CASE WHEN team_result = 'draw' THEN 1 END) AS draws,
    CAST(sum(coalesce(goals_scored, 0)) AS BIGINT) AS gf,
    CAST(sum(coalesce(goals_conceded, 0)) AS BIGINT) AS ga
  FROM ctl GROUP BY team
)""",
]

# Brute-force look-back features: every query side scans its whole history.
_FEATURE_CTES = [
    """
fq AS (SELECT match_id, date, home_team, away_team, neutral, tournament, tournament_tier, result, match_weight
       FROM complete_t)""",
    """
fqs AS (SELECT match_id, date, home_team AS team, 'home' AS side FROM fq
        UNION ALL SELECT match_id, date, away_team, 'away' FROM fq)""",
    """
f_career AS (
  SELECT s.match_id, s.side, count(h.match_id) AS n,
    count(CASE WHEN h.team_result = 'win' THEN 1 END) AS w,
    count(CASE WHEN h.team_result = 'draw' THEN 1 END) AS d,
    coalesce(sum(h.goals_scored), 0) AS gs, coalesce(sum(h.goals_conceded), 0) AS gc,
    count(CASE WHEN h.goals_conceded = 0 THEN 1 END) AS clean
  FROM fqs s LEFT JOIN tlp h ON h.team = s.team AND h.date < s.date AND h.team_result IS NOT NULL
    AND h.goals_scored IS NOT NULL AND h.goals_conceded IS NOT NULL
  GROUP BY s.match_id, s.side
)""",
    """
f_rest AS (
  SELECT s.match_id, s.side, max(h.date) AS last_date
  FROM fqs s LEFT JOIN tlp h ON h.team = s.team AND h.date < s.date
  GROUP BY s.match_id, s.side
)""",
    """
f_shoot AS (
  SELECT s.match_id, s.side, count(x.match_id) AS app,
    count(CASE WHEN x.winner = s.team THEN 1 END) AS wins
  FROM fqs s LEFT JOIN (
      SELECT match_id, date, winner, home_team AS team FROM raw_shootouts
      UNION ALL SELECT match_id, date, winner, away_team FROM raw_shootouts) x
    ON x.team = s.team AND x.date < s.date
  GROUP BY s.match_id, s.side
)""",
    """
f_form_r AS (
  SELECT s.match_id, s.side, h.points, coalesce(h.goals_scored, 0) AS gs,
    coalesce(h.goals_conceded, 0) AS gc, h.team_result,
    row_number() OVER (PARTITION BY s.match_id, s.side ORDER BY h.date DESC, h.match_id DESC) AS rk
  FROM fqs s JOIN tlp h ON h.team = s.team AND h.date < s.date AND h.team_result IS NOT NULL
)""",
    f"""
f_form AS (
  SELECT match_id, side,
    sum(CASE WHEN rk <= 5 THEN points END) AS pts5, count(CASE WHEN rk <= 5 THEN 1 END) AS n5,
    sum(CASE WHEN rk <= 5 THEN gs END) AS gs5, sum(CASE WHEN rk <= 5 THEN gc END) AS gc5,
    sum(CASE WHEN rk <= 10 THEN points END) AS pts10, count(CASE WHEN rk <= 10 THEN 1 END) AS n10,
    sum(CASE WHEN rk <= 10 THEN gs END) AS gs10, sum(CASE WHEN rk <= 10 THEN gc END) AS gc10,
    least(coalesce(min(CASE WHEN team_result <> 'win' THEN rk END) - 1, count(*)), {C.MOMENTUM_WINDOW}) AS momentum
  FROM f_form_r GROUP BY match_id, side
)""",
    """
f_side AS (
  SELECT s.match_id, s.side,
    CASE WHEN c.n = 0 THEN 0.0 ELSE c.w / c.n END AS win_pct,
    CASE WHEN c.n = 0 THEN 0.0 ELSE c.d / c.n END AS draw_pct,
    CASE WHEN c.n = 0 THEN 0.0 ELSE c.gs / c.n END AS avg_goals_scored,
    CASE WHEN c.n = 0 THEN 0.0 ELSE c.gc / c.n END AS avg_goals_conceded,
    CASE WHEN c.n = 0 THEN 0.0 ELSE (c.gs - c.gc) / c.n END AS goal_diff_avg,
    CASE WHEN c.n = 0 THEN 0.0 ELSE c.clean / c.n END AS clean_sheet_pct,
    CASE WHEN x.app = 0 THEN 0.0 ELSE x.wins / x.app END AS shootout_win_pct,
    ln(c.n + 1) AS team_experience,
    CASE WHEN coalesce(f.n5, 0) = 0 THEN 0.0 ELSE f.pts5 / (3.0 * f.n5) END AS form_5,
    CASE WHEN coalesce(f.n5, 0) = 0 THEN 0.0 ELSE f.gs5 / f.n5 END AS goals_scored_last5,
    CASE WHEN coalesce(f.n5, 0) = 0 THEN 0.0 ELSE f.gc5 / f.n5 END AS goals_conceded_last5,
    CASE WHEN coalesce(f.n10, 0) = 0 THEN 0.0 ELSE f.pts10 / (3.0 * f.n10) END AS form_10,
    CASE WHEN coalesce(f.n10, 0) = 0 THEN 0.0 ELSE f.gs10 / f.n10 END AS goals_scored_last10,
    CASE WHEN coalesce(f.n10, 0) = 0 THEN 0.0 ELSE f.gc10 / f.n10 END AS goals_conceded_last10,
    CAST(coalesce(f.momentum, 0) AS INT) AS momentum,
    CAST(coalesce(s.date - r.last_date, 365) AS INT) AS days_since
  FROM fqs s
  JOIN f_career c ON c.match_id = s.match_id AND c.side = s.side
  JOIN f_rest r ON r.match_id = s.match_id AND r.side = s.side
  JOIN f_shoot x ON x.match_id = s.match_id AND x.side = s.side
  LEFT JOIN f_form f ON f.match_id = s.match_id AND f.side = s.side
)""",
    """
f_h2h AS (
  SELECT q.match_id, count(h.match_id) AS n,
    count(CASE WHEN (h.home_team = q.home_team AND h.result = 'home_win')
                 OR (h.home_team <> q.home_team AND h.result = 'away_win') THEN 1 END) AS hw,
    count(CASE WHEN h.result = 'draw' THEN 1 END) AS d,
    count(CASE WHEN (h.home_team = q.home_team AND h.result = 'away_win')
                 OR (h.home_team <> q.home_team AND h.result = 'home_win') THEN 1 END) AS aw,
    sum(coalesce(h.total_goals, 0)) AS goals
  FROM fq q LEFT JOIN master_t h
    ON least(h.home_team, h.away_team) = least(q.home_team, q.away_team)
   AND greatest(h.home_team, h.away_team) = greatest(q.home_team, q.away_team)
   AND h.date < q.date AND h.result IS NOT NULL
  GROUP BY q.match_id
)""",
    f"""
f_all AS (
  SELECT q.match_id, q.date, q.home_team, q.away_team, q.result, q.match_weight,
    hs.win_pct AS home_win_pct, hs.draw_pct AS home_draw_pct, hs.avg_goals_scored AS home_avg_goals_scored,
    hs.avg_goals_conceded AS home_avg_goals_conceded, hs.goal_diff_avg AS home_goal_diff_avg,
    hs.clean_sheet_pct AS home_clean_sheet_pct, hs.shootout_win_pct AS home_shootout_win_pct,
    hs.team_experience AS home_team_experience,
    aw.win_pct AS away_win_pct, aw.draw_pct AS away_draw_pct, aw.avg_goals_scored AS away_avg_goals_scored,
    aw.avg_goals_conceded AS away_avg_goals_conceded, aw.goal_diff_avg AS away_goal_diff_avg,
    aw.clean_sheet_pct AS away_clean_sheet_pct, aw.shootout_win_pct AS away_shootout_win_pct,
    aw.team_experience AS away_team_experience,
    hs.form_5 AS home_form_5, aw.form_5 AS away_form_5,
    hs.goals_scored_last5 AS home_goals_scored_last5, aw.goals_scored_last5 AS away_goals_scored_last5,
    hs.goals_conceded_last5 AS home_goals_conceded_last5, aw.goals_conceded_last5 AS away_goals_conceded_last5,
    hs.form_10 AS home_form_10, aw.form_10 AS away_form_10,
    hs.goals_scored_last10 AS home_goals_scored_last10, aw.goals_scored_last10 AS away_goals_scored_last10,
    hs.goals_conceded_last10 AS home_goals_conceded_last10, aw.goals_conceded_last10 AS away_goals_conceded_last10,
    hs.momentum AS home_momentum, aw.momentum AS away_momentum,
    hs.days_since AS days_since_last_match_home, aw.days_since AS days_since_last_match_away,
    CASE WHEN h.n >= {C.MIN_H2H_MATCHES} THEN h.hw / h.n ELSE {C.H2H_DEFAULT_PCT} END AS h2h_home_win_pct,
    CASE WHEN h.n >= {C.MIN_H2H_MATCHES} THEN h.d / h.n ELSE {C.H2H_DEFAULT_PCT} END AS h2h_draw_pct,
    CASE WHEN h.n >= {C.MIN_H2H_MATCHES} THEN h.aw / h.n ELSE {C.H2H_DEFAULT_PCT} END AS h2h_away_win_pct,
    CAST(h.n AS BIGINT) AS h2h_matches_played,
    CASE WHEN h.n >= {C.MIN_H2H_MATCHES} THEN h.goals / h.n ELSE {C.H2H_DEFAULT_GOALS} END AS h2h_avg_goals,
    CAST(coalesce(q.neutral, FALSE) AS INT) AS is_neutral,
    CAST(coalesce(q.tournament_tier, 3) AS INT) AS tournament_tier,
    {knockout_sql('q.tournament')} AS is_knockout,
    hs.win_pct - aw.win_pct AS win_pct_diff,
    hs.goal_diff_avg - aw.goal_diff_avg AS goal_diff_avg_diff,
    hs.form_5 - aw.form_5 AS form_5_diff,
    hs.form_10 - aw.form_10 AS form_10_diff,
    hs.team_experience - aw.team_experience AS experience_diff
  FROM fq q
  JOIN f_side hs ON hs.match_id = q.match_id AND hs.side = 'home'
  JOIN f_side aw ON aw.match_id = q.match_id AND aw.side = 'away'
  JOIN f_h2h h ON h.match_id = q.match_id
)""",
]


def with_ctes(body: str, features: bool = False) -> str:
    ctes = RAW_CTES + _MASTER_CTES + (_FEATURE_CTES if features else [])
    return "WITH " + ",".join(ctes) + "\n" + body
