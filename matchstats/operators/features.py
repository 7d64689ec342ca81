"""Leak-free look-back features.

Every feature of a match uses only matches on *strictly earlier dates*;
same-day matches are invisible to each other.  The plan never scans the
history per row (the reference is O(matches x history)); instead:

1. ``team_log`` explodes each match to its two sides (narrow).
2. Side rows, shootout sides and the query days collapse to one row per
   (team, date) with additive counters (partial aggregation map-side).
3. One window per team over that *daily* table, frame
   ``rows(unbounded preceding, -1)``, yields the state strictly before each
   day.  Per team the window holds at most one row per calendar day.
4. Last-N form needs match order, not sums: only the last ``max(N)``
   complete matches of each (team, day) can ever be inside an N-window, so
   they are kept (a per-group top-k that Spark limits map-side), a rows
   frame runs over that reduced sequence, and the state after each day is
   carried into step 3 with ``last(..., ignorenulls)``.
5. Head-to-head uses the same daily scheme keyed on the unordered pair
   ``(least(home, away), greatest(home, away))``.
6. The query rows pick their states with equi-joins on (team, date) and
   (pair, date); the daily tables are small and AQE broadcasts them when
   their measured size allows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchstats import config as C
from matchstats.functions import scalar as S
from matchstats.operators.master import complete_matches
from matchstats.operators.teamlog import team_log
from matchstats.session import work_table

SIDE_FEATURES = ["win_pct", "draw_pct", "avg_goals_scored", "avg_goals_conceded", "goal_diff_avg",
                 "clean_sheet_pct", "shootout_win_pct", "team_experience"]


def feature_names(windows: list[int] | None = None) -> list[str]:
    """The 45 feature columns in the reference order."""
    windows = windows or C.FORM_WINDOWS
    names = [f"home_{f}" for f in SIDE_FEATURES] + [f"away_{f}" for f in SIDE_FEATURES]
    for n in windows:
        names += [f"home_form_{n}", f"away_form_{n}", f"home_goals_scored_last{n}", f"away_goals_scored_last{n}",
                  f"home_goals_conceded_last{n}", f"away_goals_conceded_last{n}"]
    names += ["home_momentum", "away_momentum", "days_since_last_match_home", "days_since_last_match_away",
              "h2h_home_win_pct", "h2h_draw_pct", "h2h_away_win_pct", "h2h_matches_played", "h2h_avg_goals",
              "is_neutral", "tournament_tier", "is_knockout",
              "win_pct_diff", "goal_diff_avg_diff", "form_5_diff", "form_10_diff", "experience_diff"]
    return names


def _query_team_days(queries: DataFrame) -> DataFrame:
    return queries.select(F.explode(F.array("home_team", "away_team")).alias("team"), "date")


def form_states(tl: DataFrame, keys: list[str], windows: list[int] | None = None) -> DataFrame:
    """W4-W6 state *after* each (team, date): last-N points/goals and the
    win streak, over complete matches ordered by (date, keys)."""
    windows = windows or C.FORM_WINDOWS
    max_n = max(windows + [C.MOMENTUM_WINDOW])
    c = tl.filter(F.col("team_result").isNotNull()).select(
        "team", "date", *keys, "points", "team_result",
        F.coalesce(F.col("goals_scored"), F.lit(0)).alias("gs"),
        F.coalesce(F.col("goals_conceded"), F.lit(0)).alias("gc"))
    w_day = Window.partitionBy("team", "date").orderBy(*[F.col(k).desc() for k in keys])
    reduced = c.withColumn("__rn_day", F.row_number().over(w_day)).filter(F.col("__rn_day") <= max_n)
    w_seq = Window.partitionBy("team").orderBy("date", *keys)
    cols = []
    for n in windows:
        wn = w_seq.rowsBetween(-(n - 1), 0)
        cols += [F.sum("points").over(wn).alias(f"pts_{n}"), F.count(F.lit(1)).over(wn).alias(f"n_{n}"),
                 F.sum("gs").over(wn).alias(f"gs_{n}"), F.sum("gc").over(wn).alias(f"gc_{n}")]
    # Win streak (gaps and islands): position minus the position of the
    # latest non-win, capped at the momentum window.
    seq = reduced.withColumn("__rn", F.row_number().over(w_seq))
    last_nonwin = F.max(F.when(F.col("team_result") != "win", F.col("__rn"))).over(
        w_seq.rowsBetween(Window.unboundedPreceding, 0))
    streak = F.least(F.col("__rn") - F.coalesce(last_nonwin, F.lit(0)), F.lit(C.MOMENTUM_WINDOW))
    seq = seq.select("team", "date", "__rn_day", *cols, streak.cast("int").alias("momentum"))
    state_names = [c for n in windows for c in (f"pts_{n}", f"n_{n}", f"gs_{n}", f"gc_{n}")] + ["momentum"]
    return (seq.filter(F.col("__rn_day") == 1)
            .select("team", "date", F.struct(*state_names).alias("form_after")))


def team_day_states(master: DataFrame, shootouts: DataFrame | None, queries: DataFrame | None,
                    keys: list[str], windows: list[int] | None = None, only: DataFrame | None = None) -> DataFrame:
    """Per (team, date): career, shootout, rest-day and form state strictly
    before that date (W1-W7); ``only``: of the teams in this table."""
    tl = team_log(master, keys)
    if only is not None:
        tl = tl.join(only, "team", "left_semi")
    complete = F.col("team_result").isNotNull() & F.col("goals_scored").isNotNull() & F.col("goals_conceded").isNotNull()
    zero = F.lit(0).cast("long")
    events = tl.select(
        "team", "date",
        F.lit(1).cast("long").alias("n_all"),
        complete.cast("long").alias("n_c"),
        (complete & (F.col("team_result") == "win")).cast("long").alias("wins"),
        (complete & (F.col("team_result") == "draw")).cast("long").alias("draws"),
        F.when(complete, F.col("goals_scored")).otherwise(0).cast("long").alias("gs"),
        F.when(complete, F.col("goals_conceded")).otherwise(0).cast("long").alias("gc"),
        (complete & (F.col("goals_conceded") == 0)).cast("long").alias("clean"),
        zero.alias("so_app"), zero.alias("so_win"))
    parts = [events]
    if shootouts is not None:
        so = shootouts.select("date", "winner", F.explode(F.array("home_team", "away_team")).alias("team"))
        if only is not None:
            so = so.join(only, "team", "left_semi")
        parts.append(so.select("team", "date", zero.alias("n_all"), zero.alias("n_c"), zero.alias("wins"),
                               zero.alias("draws"), zero.alias("gs"), zero.alias("gc"), zero.alias("clean"),
                               F.lit(1).cast("long").alias("so_app"),
                               (F.col("winner") == F.col("team")).cast("long").alias("so_win")))
    if queries is not None:  # query days not already present as history events
        qd = _query_team_days(queries)
        parts.append(qd.select("team", "date", *[zero.alias(c) for c in
                                                  ["n_all", "n_c", "wins", "draws", "gs", "gc", "clean", "so_app",
                                                   "so_win"]]))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    counters = ["n_c", "wins", "draws", "gs", "gc", "clean", "so_app", "so_win"]
    daily = u.filter(F.col("team").isNotNull() & F.col("date").isNotNull()).groupBy("team", "date").agg(
        F.sum("n_all").alias("n_all"), *[F.sum(c).alias(c) for c in counters])
    daily = daily.join(form_states(tl, keys, windows), ["team", "date"], "left")
    w = Window.partitionBy("team").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    return daily.select(
        "team", "date",
        *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"cum_{c}") for c in counters],
        F.max(F.when(F.col("n_all") > 0, F.col("date"))).over(w).alias("last_match_date"),
        F.last("form_after", ignorenulls=True).over(w).alias("form_before"))


def side_features(states: DataFrame, windows: list[int] | None = None) -> DataFrame:
    """Turn cumulative daily state into the per-side feature values."""
    windows = windows or C.FORM_WINDOWS
    n = F.col("cum_n_c")
    cols = [
        S.safe_divide("cum_wins", n).alias("win_pct"),
        S.safe_divide("cum_draws", n).alias("draw_pct"),
        S.safe_divide("cum_gs", n).alias("avg_goals_scored"),
        S.safe_divide("cum_gc", n).alias("avg_goals_conceded"),
        S.safe_divide(F.col("cum_gs") - F.col("cum_gc"), n).alias("goal_diff_avg"),
        S.safe_divide("cum_clean", n).alias("clean_sheet_pct"),
        S.safe_divide("cum_so_win", "cum_so_app").alias("shootout_win_pct"),
        S.log_experience(n).alias("team_experience"),
        F.col("cum_n_c").alias("career_matches"),
        F.coalesce(F.datediff("date", "last_match_date"), F.lit(C.NO_HISTORY_REST_DAYS)).cast("int").alias("days_since_last_match"),
        F.coalesce(F.col("form_before.momentum"), F.lit(0)).cast("int").alias("momentum"),
    ]
    for w in windows:
        fn = F.coalesce(F.col(f"form_before.n_{w}"), F.lit(0))
        cols += [
            S.normalise_points(F.coalesce(F.col(f"form_before.pts_{w}"), F.lit(0)), fn).alias(f"form_{w}"),
            S.safe_divide(F.col(f"form_before.gs_{w}"), fn).alias(f"goals_scored_last{w}"),
            S.safe_divide(F.col(f"form_before.gc_{w}"), fn).alias(f"goals_conceded_last{w}"),
        ]
    return states.select("team", "date", *cols)


def h2h_day_states(master: DataFrame, queries: DataFrame | None, only: DataFrame | None = None) -> DataFrame:
    """W8 state per (unordered pair, date), strictly before the date; ``only``:
    of the pairs (lo, hi) in this table."""
    lo = F.least("home_team", "away_team")
    hi = F.greatest("home_team", "away_team")
    done = F.col("result").isNotNull()
    home_is_lo = F.col("home_team") == lo
    lo_win = ((F.col("result") == "home_win") & home_is_lo) | ((F.col("result") == "away_win") & ~home_is_lo)
    hi_win = ((F.col("result") == "away_win") & home_is_lo) | ((F.col("result") == "home_win") & ~home_is_lo)
    ev = master.select(
        lo.alias("lo"), hi.alias("hi"), "date",
        done.cast("long").alias("n"),
        (done & lo_win).cast("long").alias("lo_wins"),
        (done & (F.col("result") == "draw")).cast("long").alias("draws"),
        (done & hi_win).cast("long").alias("hi_wins"),
        F.when(done, F.coalesce(F.col("total_goals"), F.lit(0))).otherwise(0).cast("long").alias("goals"))
    if only is not None:
        ev = ev.join(only, ["lo", "hi"], "left_semi")
    zero = F.lit(0).cast("long")
    if queries is not None:  # query pair-days not already present as history events
        ev = ev.unionByName(queries.select(lo.alias("lo"), hi.alias("hi"), "date", *[
            zero.alias(c) for c in ["n", "lo_wins", "draws", "hi_wins", "goals"]]))
    daily = (ev.filter(F.col("lo").isNotNull() & F.col("date").isNotNull())
             .groupBy("lo", "hi", "date").agg(*[F.sum(c).alias(c) for c in ["n", "lo_wins", "draws", "hi_wins", "goals"]]))
    w = Window.partitionBy("lo", "hi").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    return daily.select("lo", "hi", "date", *[
        F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"h2h_{c}") for c in ["n", "lo_wins", "draws", "hi_wins", "goals"]])


def h2h_features(queries: DataFrame, h2h_states: DataFrame) -> DataFrame:
    """W8 from the current home side's perspective; defaults if no meeting."""
    q = queries.withColumn("lo", F.least("home_team", "away_team")).withColumn("hi", F.greatest("home_team", "away_team"))
    j = q.join(h2h_states, ["lo", "hi", "date"], "left")
    n = F.coalesce(F.col("h2h_n"), F.lit(0))
    home_is_lo = F.col("home_team") == F.col("lo")
    hw = F.when(home_is_lo, F.col("h2h_lo_wins")).otherwise(F.col("h2h_hi_wins"))
    aw = F.when(home_is_lo, F.col("h2h_hi_wins")).otherwise(F.col("h2h_lo_wins"))
    has = n >= C.MIN_H2H_MATCHES
    d = F.lit(C.H2H_DEFAULT_PCT)
    return j.select(
        *[c for c in q.columns if c not in ("lo", "hi")],
        F.when(has, hw / n).otherwise(d).alias("h2h_home_win_pct"),
        F.when(has, F.col("h2h_draws") / n).otherwise(d).alias("h2h_draw_pct"),
        F.when(has, aw / n).otherwise(d).alias("h2h_away_win_pct"),
        n.cast("long").alias("h2h_matches_played"),
        F.when(has, F.col("h2h_goals") / n).otherwise(F.lit(C.H2H_DEFAULT_GOALS)).alias("h2h_avg_goals"))


MASTER_FEATURE_COLS = ["date", "home_team", "away_team", "home_goals", "away_goals", "result", "is_incomplete",
                       "tournament", "tournament_tier", "neutral", "total_goals", "match_weight"]


def build_features(master: DataFrame, shootouts: DataFrame | None = None, queries: DataFrame | None = None,
                   keys: list[str] | None = None, windows: list[int] | None = None,
                   keep_cols: list[str] | None = None, materialize: bool = True) -> DataFrame:
    """The 45-column feature matrix for ``queries`` (default: complete
    matches of ``master``), looking back over the whole ``master``.

    Query rows that are not in ``master`` (fixtures to score) contribute no
    history: they only add their (team, date) to the daily tables.

    ``materialize``: compute the (derived) master once into the shared
    checkpoint folder; pass False for a persisted table, which every branch
    can simply read again.
    """
    keys = keys or ["match_id"]
    windows = windows or C.FORM_WINDOWS
    if materialize:
        # Every branch below (two-sided log, form states, pair states,
        # queries) reads master: compute it once, narrow, into a columnar
        # table in the shared checkpoint directory, of which each branch
        # reads its own columns.
        cols = [c for c in dict.fromkeys(keys + MASTER_FEATURE_COLS) if c in master.columns]
        master = work_table(master.select(*cols), "master")
        if shootouts is not None:
            shootouts = work_table(shootouts.select("date", "home_team", "away_team", "winner"), "shootouts")
    # Queries drawn from master itself already have their (team, day) and
    # (pair, day) rows among the history events; external fixtures add theirs.
    external = queries is not None
    if queries is None:
        queries = complete_matches(master)
    keep = [c for c in (keep_cols or ["result", "match_weight"]) if c in queries.columns]
    q = queries.select(*dict.fromkeys([*keys, "date", "home_team", "away_team", "neutral", "tournament", "tournament_tier",
                                       *keep]))
    qx = q if external else None
    return assemble(q, team_day_states(master, shootouts, qx, keys, windows), h2h_day_states(master, qx), keys, keep, windows)


def assemble(q: DataFrame, team_states: DataFrame, pair_states: DataFrame, keys: list[str], keep: list[str],
             windows: list[int] | None = None) -> DataFrame:
    """The feature matrix of the queries ``q`` from the daily states."""
    states = side_features(team_states, windows)
    side_cols = [c for c in states.columns if c not in ("team", "date")]
    home = states.select(F.col("team").alias("home_team"), "date", *[F.col(c).alias(f"home_{c}") for c in side_cols])
    away = states.select(F.col("team").alias("away_team"), "date", *[F.col(c).alias(f"away_{c}") for c in side_cols])
    j = q.join(home, ["home_team", "date"], "left").join(away, ["away_team", "date"], "left")
    j = h2h_features(j, pair_states)
    j = (j.withColumnRenamed("home_days_since_last_match", "days_since_last_match_home")
         .withColumnRenamed("away_days_since_last_match", "days_since_last_match_away")
         .withColumn("is_neutral", F.coalesce(F.col("neutral"), F.lit(False)).cast("int"))
         .withColumn("tournament_tier", F.coalesce(F.col("tournament_tier"), F.lit(3)).cast("int"))
         .withColumn("is_knockout", S.is_knockout("tournament"))
         .withColumn("win_pct_diff", F.col("home_win_pct") - F.col("away_win_pct"))
         .withColumn("goal_diff_avg_diff", F.col("home_goal_diff_avg") - F.col("away_goal_diff_avg"))
         .withColumn("form_5_diff", F.col("home_form_5") - F.col("away_form_5"))
         .withColumn("form_10_diff", F.col("home_form_10") - F.col("away_form_10"))
         .withColumn("experience_diff", F.col("home_team_experience") - F.col("away_team_experience")))
    return j.select(*dict.fromkeys([*keys, "date", "home_team", "away_team", *keep, *feature_names(windows)]))


def leak_audit(master: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """W14 as a whole-table property: for every (team, date) the latest
    history date used must be strictly earlier.  Returns the violation
    count (must be 0) and the number of audited team-days."""
    keys = keys or ["match_id"]
    q = complete_matches(master)
    st = team_day_states(master, None, q.select(*dict.fromkeys([*keys, "date", "home_team", "away_team"])), keys)
    return st.agg(
        F.count(F.when(F.col("last_match_date") >= F.col("date"), F.lit(1))).alias("violations"),
        F.count(F.lit(1)).alias("audited_team_days"))
