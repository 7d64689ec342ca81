"""Leaderboards, distributions, trends and per-team questions (A3-A29,
T1-T7, W12, W13, J9, F10-F12).

Each dashboard question that the reference answers for *one* team is
answered here for all teams at once (a ``groupBy`` / window partitioned by
team); a caller filters the team it wants, and Catalyst pushes that filter
down.  Top-k ties break on the name ascending.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchstats import config as C
from matchstats.functions import scalar as S
from matchstats.operators.lookup import lookup_table
from matchstats.operators.master import complete_matches
from matchstats.operators.teamlog import team_log


def _pct(num, den) -> F.Column:
    return F.col(num) / F.col(den) * 100.0 if isinstance(num, str) else num / den * 100.0


# --- team records (A3, A4, T1-T3) ---------------------------------------------

def team_records(master: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """A3 + A4: per-team record over complete matches."""
    tl = team_log(complete_matches(master), keys)
    return (tl.groupBy("team").agg(
        F.count(F.lit(1)).alias("played"),
        F.count(F.when(F.col("team_result") == "win", F.lit(1))).alias("wins"),
        F.count(F.when(F.col("team_result") == "draw", F.lit(1))).alias("draws"),
        F.sum(F.coalesce(F.col("goals_scored"), F.lit(0))).cast("long").alias("gf"),
        F.sum(F.coalesce(F.col("goals_conceded"), F.lit(0))).cast("long").alias("ga"))
        .withColumn("losses", F.col("played") - F.col("wins") - F.col("draws"))
        .withColumn("gd", F.col("gf") - F.col("ga"))
        .withColumn("win_pct", F.col("wins") / F.col("played") * 100.0))


def top_teams_win_pct(records: DataFrame, min_played: int = C.EDA_MIN_MATCHES_FOR_WIN_PCT,
                      n: int = C.EDA_TOP_N_TEAMS) -> DataFrame:
    """Top n by win_pct with played >= min_played (TakeOrdered)."""
    return (records.filter(F.col("played") >= min_played)
            .orderBy(F.col("win_pct").desc(), F.col("team").asc()).limit(n))


def top_teams_wins(records: DataFrame, n: int = C.EDA_TOP_N_TEAMS) -> DataFrame:
    """Top n by total wins."""
    return records.orderBy(F.col("wins").desc(), F.col("team").asc()).limit(n)


def nation_leaderboard(master: DataFrame, keys: list[str] | None = None, decade: int | None = None,
                       tier: int | None = None, min_played: int = C.LEADERBOARD_MIN_PLAYED,
                       n: int = C.EDA_TOP_N_TEAMS) -> DataFrame:
    """P9 + T3: optional decade / tier filter, played >= 10, top 20 by win %."""
    m = complete_matches(master)
    if decade is not None:
        m = m.filter(S.decade("date") == decade)
    if tier is not None:
        m = m.filter(F.col("tournament_tier") == tier)
    rec = team_records(m, keys).filter(F.col("played") >= min_played)
    return (rec.select("team", "played", "wins", "win_pct")
            .orderBy(F.col("win_pct").desc(), F.col("team").asc()).limit(n))


# --- simple distributions (A5-A13, A20, A25, A29) --------------------------------

def null_counts(master: DataFrame) -> DataFrame:
    """A5: NULL count per column, only > 0, descending.  One pass computes
    every count; ``unpivot`` turns the single row into (column, nulls)."""
    cols = master.columns
    row = master.agg(*[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in cols])
    return (row.unpivot([], cols, "column", "null_count")
            .filter(F.col("null_count") > 0)
            .orderBy(F.col("null_count").desc(), F.col("column")))


def matches_per_year(master: DataFrame) -> DataFrame:
    """Matches per calendar year, plus the max over years."""
    per = master.groupBy(F.year("date").alias("year")).agg(F.count(F.lit(1)).alias("n_matches"))
    mx = per.agg(F.max("n_matches")).scalar()
    return per.withColumn("max_per_year", mx)


def result_distribution(master: DataFrame) -> DataFrame:
    """Share (%) of each result among non-NULL results."""
    done = master.filter(F.col("result").isNotNull())
    total = done.agg(F.count(F.lit(1))).scalar()
    return (done.groupBy("result").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("pct", F.col("n") / total * 100.0))


def result_by_venue(master: DataFrame) -> DataFrame:
    """Result shares split by neutral venue; the per-venue total comes
    from a small grouped aggregate joined back (no window over all rows)."""
    done = master.filter(F.col("result").isNotNull())
    per = done.groupBy("neutral", "result").agg(F.count(F.lit(1)).alias("n"))
    tot = per.groupBy("neutral").agg(F.sum("n").alias("venue_n"))  # <= 3 rows (boolean domain)
    return per.join(F.broadcast(tot), per["neutral"].eqNullSafe(tot["neutral"])).drop(tot["neutral"]).withColumn("pct", F.col("n") / F.col("venue_n") * 100.0).drop("venue_n")


def home_advantage_gap(master: DataFrame) -> DataFrame:
    """Home-win % at home venues, at neutral venues, and the gap."""
    done = master.filter(F.col("result").isNotNull())
    hw = (F.col("result") == "home_win").cast("double")
    r = done.agg(
        (F.avg(F.when(~F.col("neutral"), hw)) * 100.0).alias("home_venue_hw_pct"),
        (F.avg(F.when(F.col("neutral"), hw)) * 100.0).alias("neutral_venue_hw_pct"))
    return r.withColumn("gap_pct_points", F.col("home_venue_hw_pct") - F.col("neutral_venue_hw_pct"))


def decades_present(master: DataFrame) -> DataFrame:
    """U4: the decades that hold a match."""
    return master.filter(F.col("date").isNotNull()).select(S.decade("date").alias("decade")).distinct()


def teams_with_goals(goals: DataFrame) -> DataFrame:
    """U4: teams that have at least one goal row."""
    return goals.filter(F.col("team").isNotNull()).select("team").distinct()


def home_win_by_decade(master: DataFrame, non_neutral_only: bool = False) -> DataFrame:
    """A10: home-win % by decade over matches with a result."""
    done = master.filter(F.col("result").isNotNull())
    if non_neutral_only:
        done = done.filter(~F.col("neutral"))
    return done.groupBy(S.decade("date").alias("decade")).agg(
        (F.avg((F.col("result") == "home_win").cast("double")) * 100.0).alias("home_win_pct"),
        F.count(F.lit(1)).alias("n"))


def home_advantage_ends(master: DataFrame) -> DataFrame:
    """A10: home-win % at non-neutral venues in the first and the last decade,
    and the direction of the change (one row, from one row per decade)."""
    d = home_win_by_decade(master, non_neutral_only=True)
    ends = d.agg(F.min("decade").alias("first_decade"), F.max("decade").alias("last_decade"),
                 F.min_by("home_win_pct", "decade").alias("first_pct"),
                 F.max_by("home_win_pct", "decade").alias("last_pct"))
    change = F.col("last_pct") - F.col("first_pct")
    return ends.withColumn("change", change).withColumn(
        "direction", F.when(change > 0, "up").when(change < 0, "down").otherwise("flat"))


def avg_goals_by(master: DataFrame, by: str) -> DataFrame:
    """Mean total_goals by decade / tier (complete, total known)."""
    comp = master.filter(F.col("result").isNotNull() & F.col("total_goals").isNotNull())
    key = S.decade("date").alias("decade") if by == "decade" else F.col(by)
    return comp.groupBy(key).agg(F.avg("total_goals").alias("avg_goals"), F.count(F.lit(1)).alias("n"))


def avg_goals_overall(master: DataFrame) -> DataFrame:
    """A11 overall: mean total goals per complete match with known goals."""
    comp = master.filter(F.col("result").isNotNull() & F.col("total_goals").isNotNull())
    return comp.agg(F.avg("total_goals").alias("avg_goals"), F.count(F.lit(1)).alias("n"))


def score_matrix(master: DataFrame, max_score: int = C.SCORE_MATRIX_MAX) -> DataFrame:
    """Dense (max+1) x (max+1) matrix of capped scorelines with zeros.

    The grid is generated from ``spark.range`` (a fixed 81-cell frame
    whose size depends only on ``max_score``) and left-joined with the
    grouped counts, so empty cells are 0.
    """
    spark = master.sparkSession
    comp = master.filter(F.col("result").isNotNull() & F.col("total_goals").isNotNull())
    cnt = comp.groupBy(F.least("home_goals", F.lit(max_score)).alias("home_goals"),
                       F.least("away_goals", F.lit(max_score)).alias("away_goals")).agg(
        F.count(F.lit(1)).alias("n"))
    k = max_score + 1
    grid = spark.range(k * k).select((F.col("id") / k).cast("int").alias("home_goals"),
                                     (F.col("id") % k).cast("int").alias("away_goals"))
    return grid.join(F.broadcast(cnt), ["home_goals", "away_goals"], "left").select(
        "home_goals", "away_goals", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))


def modal_scoreline(master: DataFrame) -> DataFrame:
    """The most frequent (home_goals, away_goals); ties -> smallest."""
    comp = master.filter(F.col("result").isNotNull() & F.col("total_goals").isNotNull())
    return (comp.groupBy("home_goals", "away_goals").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), "home_goals", "away_goals").limit(1))


def goals_histogram(master: DataFrame, max_goals: int = C.GOALS_HIST_MAX) -> DataFrame:
    """Unit bins [0,1) ... [14,15], last bin closed; > 15 dropped."""
    comp = master.filter(F.col("result").isNotNull() & F.col("total_goals").isNotNull())
    tg = F.col("total_goals")
    return (comp.filter((tg >= 0) & (tg <= max_goals))
            .groupBy(F.least(tg, F.lit(max_goals - 1)).cast("int").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n")))


# --- shootouts & scorers (A14-A16) ---------------------------------------------------

def top_scorers(goals: DataFrame, n: int = 20, team: str | None = None) -> DataFrame:
    """A14 + T5: exclude own goals and NULL scorers; goals = count,
    penalties = sum, team = most frequent team (ties -> smallest name).

    The goals are read and combined once, by (scorer, team); a scorer's
    goals, penalties and most frequent team follow from that small table.
    """
    g = goals.filter(~F.col("own_goal") & F.col("scorer").isNotNull())
    if team is not None:
        g = g.filter(F.col("team") == team)
    per_team = g.groupBy("scorer", "team").agg(F.count(F.lit(1)).alias("n"),
                                               F.sum(F.col("penalty").cast("long")).alias("pen"))
    most = F.min(F.struct((-F.col("n")).alias("n"), "team"))
    per = per_team.groupBy("scorer").agg(F.sum("n").alias("goals"), F.sum("pen").alias("penalties"),
                                         most["team"].alias("team"))
    return per.orderBy(F.col("goals").desc(), F.col("scorer").asc()).limit(n)


def top_scorers_from_source(scorers: DataFrame, n: int = 20) -> DataFrame:
    """S6 + A14: a pre-aggregated scorer table (columns scorer, goals,
    penalties, team: first row per scorer, as the dashboard reads it) or,
    when it lacks a ``goals`` column, raw goal rows through ``top_scorers``."""
    if "goals" not in scorers.columns:
        return top_scorers(scorers, n)
    per = scorers.filter(F.col("scorer").isNotNull()).groupBy("scorer").agg(
        F.first("goals").alias("goals"), F.first("penalties").alias("penalties"), F.first("team").alias("team"))
    return per.orderBy(F.col("goals").desc(), F.col("scorer").asc()).limit(n)


def shootout_specialists(shootouts: DataFrame, min_app: int = C.EDA_MIN_SHOOTOUTS_FOR_RATE,
                         n: int = C.EDA_TOP_N_TEAMS) -> DataFrame:
    """A15 + T5: appearances, wins, win % per team with appearances >= 2
    and >= min_app; top n by win %."""
    s = shootouts.select("winner", F.explode(F.array("home_team", "away_team")).alias("team")).filter(
        F.col("team").isNotNull())
    per = s.groupBy("team").agg(F.count(F.lit(1)).alias("appearances"),
                                F.count(F.when(F.col("winner") == F.col("team"), F.lit(1))).alias("wins"))
    return (per.filter((F.col("appearances") >= 2) & (F.col("appearances") >= min_app))
            .withColumn("win_pct", F.col("wins") / F.col("appearances") * 100.0)
            .orderBy(F.col("win_pct").desc(), F.col("team").asc()).limit(n))


def first_shooter_advantage(shootouts: DataFrame) -> DataFrame:
    """First-shooter win share among shootouts that record it."""
    fs = F.col("first_shooter")
    return shootouts.agg(
        F.count(fs).alias("n_with_first_shooter"),
        (F.avg(F.when(fs.isNotNull(), (fs == F.col("winner")).cast("double"))) * 100.0).alias("first_wins_pct"),
        F.count(F.when(fs.isNull(), F.lit(1))).alias("n_missing"),
    ).withColumn("second_wins_pct", 100.0 - F.col("first_wins_pct"))


def key_findings(master: DataFrame) -> DataFrame:
    """A17 (+A9): elite vs friendly draw % and goals, pre-1970 vs >= 2010
    goals, home-venue vs neutral home-win %, in one pass."""
    done = master.filter(F.col("result").isNotNull())
    yr = F.year("date")
    tier = F.col("tournament_tier")
    draw = (F.col("result") == "draw").cast("double")
    hw = (F.col("result") == "home_win").cast("double")
    return done.agg(
        (F.avg(F.when(~F.col("neutral"), hw)) * 100.0).alias("home_venue_hw_pct"),
        (F.avg(F.when(F.col("neutral"), hw)) * 100.0).alias("neutral_venue_hw_pct"),
        (F.avg(F.when(tier == 1, draw)) * 100.0).alias("elite_draw_pct"),
        (F.avg(F.when(tier == 3, draw)) * 100.0).alias("friendly_draw_pct"),
        F.avg(F.when(tier == 1, F.col("total_goals"))).alias("elite_avg_goals"),
        F.avg(F.when(tier == 3, F.col("total_goals"))).alias("friendly_avg_goals"),
        F.avg(F.when(yr < 1970, F.col("total_goals"))).alias("pre1970_avg_goals"),
        F.avg(F.when(yr >= 2010, F.col("total_goals"))).alias("post2010_avg_goals"))


# --- per-team questions for all teams (A18, A19, T4, W12, W13) -------------------------

def _complete_log(master: DataFrame, keys) -> DataFrame:
    tl = team_log(complete_matches(master), keys)
    return tl.filter(F.col("team_result").isNotNull() & F.col("goals_scored").isNotNull()
                     & F.col("goals_conceded").isNotNull())


def team_goals_by_year(master: DataFrame, keys=None, from_year: int = 1960) -> DataFrame:
    """Yearly mean scored / conceded per team, year >= from_year."""
    tl = _complete_log(master, keys).withColumn("year", F.year("date")).filter(F.col("year") >= from_year)
    return tl.groupBy("team", "year").agg(F.avg("goals_scored").alias("scored"),
                                          F.avg("goals_conceded").alias("conceded"))


def team_by_tier(master: DataFrame, keys=None) -> DataFrame:
    """Win % and count per team and tier; all three tiers present
    (0 when none) via a join with the team x {1,2,3} frame."""
    tl = _complete_log(master, keys)
    per = tl.groupBy("team", "tournament_tier").agg(
        (F.avg((F.col("team_result") == "win").cast("double")) * 100.0).alias("win_pct"),
        F.count(F.lit(1)).alias("n"))
    teams = tl.select("team").distinct()
    tiers = teams.select("team", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("tournament_tier"))
    return tiers.join(per, ["team", "tournament_tier"], "left").select(
        "team", "tournament_tier", F.coalesce("win_pct", F.lit(0.0)).alias("win_pct"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def top_opponents(master: DataFrame, keys=None, n: int = 10) -> DataFrame:
    """T4 + P8: per team, the n most frequent opponents (ties by name)."""
    tl = _complete_log(master, keys)
    cnt = tl.groupBy("team", "opponent").agg(F.count(F.lit(1)).alias("meetings"))
    w = Window.partitionBy("team").orderBy(F.col("meetings").desc(), F.col("opponent").asc())
    return cnt.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def win_pct_trend(master: DataFrame, keys=None, from_year: int = 1950, k: int = 3) -> DataFrame:
    """Per team, yearly win % and its mean over the last k *observed*
    years (rows frame: years without matches are skipped)."""
    tl = _complete_log(master, keys).withColumn("year", F.year("date")).filter(F.col("year") >= from_year)
    yearly = tl.groupBy("team", "year").agg(
        (F.avg((F.col("team_result") == "win").cast("double")) * 100.0).alias("win_pct"))
    w = Window.partitionBy("team").orderBy("year").rowsBetween(-(k - 1), 0)
    return yearly.withColumn("rolling_win_pct", F.avg("win_pct").over(w))


def goal_trend(master: DataFrame, from_year: int = 1950, k: int = C.EDA_ROLLING_YEARS) -> DataFrame:
    """P10 + W12: yearly mean total goals from ``from_year`` and its rolling
    mean over the last k observed years.  The yearly table has one row per
    year (bounded by the calendar), so the un-partitioned window runs on a
    tiny frame after the distributed aggregate."""
    comp = master.filter(F.col("result").isNotNull() & F.col("total_goals").isNotNull())
    yearly = (comp.filter(F.year("date") >= from_year)
              .groupBy(F.year("date").alias("year")).agg(F.avg("total_goals").alias("avg_goals")))
    w = Window.orderBy("year").rowsBetween(-(k - 1), 0)
    return yearly.coalesce(1).withColumn("rolling_avg_goals", F.avg("avg_goals").over(w))


def last5_form(master: DataFrame, keys=None, n: int = 5) -> DataFrame:
    """Each team's last n results (letters, opponent, score, oldest
    first) and points / (3n).  The per-team top-n is limited map-side."""
    keys = keys or ["match_id"]
    tl = _complete_log(master, keys)
    w = Window.partitionBy("team").orderBy(F.col("date").desc(), *[F.col(k).desc() for k in keys])
    last = tl.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= n)
    item = F.struct(F.col("date"), *[F.col(k) for k in keys],
                    F.upper(F.substring("team_result", 1, 1)).alias("letter"),
                    F.col("opponent"), F.col("goals_scored"), F.col("goals_conceded"))
    agg = last.groupBy("team").agg(F.sort_array(F.collect_list(item)).alias("__items"),
                                   F.sum("points").alias("points"), F.count(F.lit(1)).alias("n"))
    return agg.select(
        "team",
        F.concat_ws("", F.transform("__items", lambda x: x["letter"])).alias("form"),
        F.concat_ws("; ", F.transform("__items", lambda x: F.concat(
            x["opponent"], F.lit(" "), x["goals_scored"].cast("string"), F.lit("-"),
            x["goals_conceded"].cast("string")))).alias("details"),
        "points", (F.col("points") / F.lit(3 * n)).alias("points_share"))


def h2h_last_n(master: DataFrame, keys=None, n: int = 5) -> DataFrame:
    """T6 + P11 + F13: last n meetings of every unordered pair with date,
    score, tournament (first 28 chars) and formatted date."""
    keys = keys or ["match_id"]
    comp = complete_matches(master)
    lo, hi = F.least("home_team", "away_team"), F.greatest("home_team", "away_team")
    w = Window.partitionBy("team_a", "team_b").orderBy(F.col("date").desc(), *[F.col(k).desc() for k in keys])
    return (comp.select(*dict.fromkeys([*keys, "date", "home_team", "away_team", "home_goals", "away_goals", "result",
                                     "tournament"]), lo.alias("team_a"), hi.alias("team_b"))
            .withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
            .withColumn("date_str", S.display_date("date"))
            .withColumn("tournament_short", F.substring("tournament", 1, 28)))


def latest_n(master: DataFrame, n: int, keys=None) -> DataFrame:
    """The last n rows by (date, key) -- a global TakeOrdered, which
    keeps only n rows per task before merging."""
    keys = keys or ["match_id"]
    return master.orderBy(F.col("date").desc(), *[F.col(k).desc() for k in keys]).limit(n)


# --- trend fit (A27) -------------------------------------------------------------

def home_advantage_trend(master: DataFrame) -> DataFrame:
    """Least-squares line of non-neutral home-win % over the decade
    ordinal 0..n-1 (slope, intercept, fitted, trend word).  The decade
    table has one row per decade, so its un-partitioned window is tiny."""
    dec = home_win_by_decade(master, non_neutral_only=True).drop("n").coalesce(1)
    dec = dec.withColumn("x", (F.row_number().over(Window.orderBy("decade")) - 1).cast("double"))
    fit = dec.agg(F.regr_slope("home_win_pct", "x").alias("slope"),
                  F.regr_intercept("home_win_pct", "x").alias("intercept"))
    slope, intercept = fit.select("slope").scalar(), fit.select("intercept").scalar()
    return (dec.withColumn("slope", slope).withColumn("intercept", intercept)
            .withColumn("fitted", F.col("intercept") + F.col("slope") * F.col("x"))
            .withColumn("trend", F.when(F.col("slope") < 0, F.lit("shrinking")).otherwise(F.lit("stable/growing"))))


# --- team strength & heuristic probabilities (J9, F10-F12) -------------------------------

def team_ratings(records: DataFrame) -> DataFrame:
    """F10 + F11 per team."""
    n = F.greatest(F.col("played"), F.lit(1))
    return records.select(
        "team", "played",
        S.attack_pct("gf", "played").alias("attack_pct"),
        S.defence_pct("ga", "played").alias("defence_pct"),
        (F.col("wins") / n * 100.0).alias("win_rate_pct"),
        (F.col("gf") / n).alias("avg_goals"),
        F.col("gd"),
        S.clean_sheet_proxy("ga", "played").alias("clean_sheet_proxy"))


def pairwise_strength(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """p(team_1 beats team_2) = w1 / (w1 + w2), 0.5 when both are 0,
    for each requested pair (w = win rate; no record counts as 0).

    Pairs are given (fixtures, or the pairs that have met), never all
    team pairs; both lookups are equi-joins on the team name against the
    one-row-per-team records table.
    """
    r = records.select("team", (F.col("wins") / F.greatest("played", F.lit(1))).alias("w"))
    j = (pairs.join(r.toDF("team_1", "__w1"), "team_1", "left")
         .join(r.toDF("team_2", "__w2"), "team_2", "left"))
    w1, w2 = F.coalesce(F.col("__w1"), F.lit(0.0)), F.coalesce(F.col("__w2"), F.lit(0.0))
    tot = w1 + w2
    return j.withColumn("p_team_1", F.when(tot == 0, F.lit(0.5)).otherwise(w1 / tot)).drop("__w1", "__w2")


def heuristic_predict(fixtures: DataFrame, records: DataFrame) -> DataFrame:
    """F12 (+F9): three-way probabilities without a model.

    wh, wa = win rates (a team without a record counts played 1, wins 0);
    wh *= 1.15 unless neutral; t = wh + wa + 0.25; ph = wh/t, pa = wa/t,
    pd = max(0, 1 - ph - pa); renormalise.  Records are one row per team:
    a counted, broadcast lookup, so the fixtures of a hot team stay where
    they are.
    """
    r = lookup_table(records.select("team", (F.col("wins") / F.greatest("played", F.lit(1))).alias("rate")), "records")
    j = (fixtures.join(r.toDF("home_team", "__wh"), "home_team", "left")
         .join(r.toDF("away_team", "__wa"), "away_team", "left"))
    wh = F.coalesce(F.col("__wh"), F.lit(0.0))
    wh = F.when(F.coalesce(F.col("neutral"), F.lit(False)), wh).otherwise(wh * C.HOME_BOOST)
    wa = F.coalesce(F.col("__wa"), F.lit(0.0))
    t = wh + wa + C.HEURISTIC_DRAW_MASS
    ph, pa = wh / t, wa / t
    pdr = F.greatest(F.lit(0.0), 1 - ph - pa)
    t2 = ph + pdr + pa
    return j.withColumn("p_home", ph / t2).withColumn("p_draw", pdr / t2).withColumn("p_away", pa / t2) \
        .drop("__wh", "__wa")
