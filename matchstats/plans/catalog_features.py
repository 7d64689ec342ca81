"""Registered look-back feature queries (W1-W14, J5-J7), temporal splits
(T8, T11) and feature statistics (A22-A24, A26, M1, M6)."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from matchstats import config as C
from matchstats.operators import features as FE
from matchstats.operators import learn as L
from matchstats.operators.asof import asof_strict
from matchstats.operators.feature_stage import LookBackFeatures
from matchstats.operators.master import complete_matches
from matchstats.operators.rownum import cv_folds, rank_cuts, row_numbers, temporal_split
from matchstats.operators.teamlog import team_log
from matchstats.operators import featstats as FS
from matchstats.plans.catalog import KEYS, ORDER, _inp, query
from matchstats.session import work_table
from matchstats.streaming.ingest import scratch_dir

FEATS = FE.feature_names()
INT_FEATS = {"home_momentum", "away_momentum", "days_since_last_match_home", "days_since_last_match_away",
             "h2h_matches_played", "is_neutral", "tournament_tier", "is_knockout"}
DOUBLE_FEATS = [f for f in FEATS if f not in INT_FEATS]


def _features(spark, sf):
    inp = _inp(spark, sf)
    return FE.build_features(inp.master, inp.shootouts, keys=KEYS)


def _subset(cols):
    def fn(spark, sf):
        return _features(spark, sf).select("match_id", *cols)
    return fn


def _register_subset(name, cols, doc):
    fn = _subset(cols)
    fn.__doc__ = doc
    query(name, "SELECT match_id, " + ", ".join(cols) + " FROM f_all",
          doubles=[c for c in cols if c in DOUBLE_FEATS], features=True)(fn)


_CAREER = [f"{s}_{f}" for s in ("home", "away") for f in
           ["win_pct", "draw_pct", "avg_goals_scored", "avg_goals_conceded", "goal_diff_avg", "clean_sheet_pct",
            "team_experience"]]
_register_subset("career_features", _CAREER, "W1 + W2 + F5: career rates strictly before each match.")
_register_subset("shootout_asof", ["home_shootout_win_pct", "away_shootout_win_pct"],
                 "J6 + W3: shootout win share strictly before each match.")
_FORM = [f"{s}_{f}{n}" for n in C.FORM_WINDOWS for s in ("home", "away")
         for f in ("form_", "goals_scored_last", "goals_conceded_last")]
_register_subset("form_features", _FORM, "W4 + W5 + F6: last-N form over complete matches.")
_register_subset("momentum", ["home_momentum", "away_momentum"], "W6: win streak within the last 5.")
_register_subset("rest_days", ["days_since_last_match_home", "days_since_last_match_away"],
                 "W7 + F2: days since the latest earlier match, incomplete ones included.")
_register_subset("h2h_features", ["h2h_home_win_pct", "h2h_draw_pct", "h2h_away_win_pct", "h2h_matches_played",
                                  "h2h_avg_goals"], "J7 + W8: head-to-head strictly before each match.")
_register_subset("context_features", ["is_neutral", "tournament_tier", "is_knockout", "win_pct_diff",
                                      "goal_diff_avg_diff", "form_5_diff", "form_10_diff", "experience_diff"],
                 "W9 + W10: context flags and home-minus-away differentials.")


@query("full_features", "SELECT * FROM f_all", doubles=DOUBLE_FEATS, features=True)
def q_full_features(spark, sf):
    """The 45-column feature matrix with label and weight (flagship)."""
    return _features(spark, sf)


@query("asof_team_state",
       """SELECT match_id, team, prev_opponent, prev_team_result, prev_goals_scored, prev_goals_conceded FROM (
            SELECT q.match_id, q.team, h.opponent AS prev_opponent, h.team_result AS prev_team_result,
              h.goals_scored AS prev_goals_scored, h.goals_conceded AS prev_goals_conceded,
              row_number() OVER (PARTITION BY q.match_id, q.team ORDER BY h.date DESC, h.match_id DESC) AS rk
            FROM ctl q LEFT JOIN ctl h ON h.team = q.team AND h.date < q.date) WHERE rk = 1""")
def q_asof_team_state(spark, sf):
    """Each side's latest earlier complete match (generic strict as-of)."""
    tl = team_log(complete_matches(_inp(spark, sf).master), KEYS)
    states = tl.select("team", "date", "match_id", F.col("opponent").alias("prev_opponent"),
                       F.col("team_result").alias("prev_team_result"),
                       F.col("goals_scored").alias("prev_goals_scored"),
                       F.col("goals_conceded").alias("prev_goals_conceded"))
    q = tl.select("match_id", "team", "date")
    out = asof_strict(q, states, ["team"], "date",
                      ["prev_opponent", "prev_team_result", "prev_goals_scored", "prev_goals_conceded"],
                      order_cols=["match_id"])
    return out.drop("date")


@query("leak_audit",
       "SELECT CAST(0 AS BIGINT) AS violations, count(*) AS audited_team_days FROM "
       "(SELECT DISTINCT team, date FROM tl WHERE team IS NOT NULL AND date IS NOT NULL)")
def q_leak_audit(spark, sf):
    """Whole-table leak audit; violations must be 0."""
    return FE.leak_audit(_inp(spark, sf).master, KEYS)


@query("feature_pipeline", "SELECT * FROM f_all", doubles=DOUBLE_FEATS, features=True)
def q_feature_pipeline(spark, sf):
    """W11 as a Spark ML stage: a Pipeline with it is fitted, saved, loaded
    again, and adds the features of all complete matches."""
    inp, work = _inp(spark, sf), scratch_dir(spark, "feature-pipeline")
    inp.shootouts.write.parquet(f"{work}/shootouts")
    master = work_table(inp.master, "master")
    Pipeline(stages=[LookBackFeatures(KEYS, shootoutsPath=f"{work}/shootouts")]).fit(master).write().save(f"{work}/model")
    return PipelineModel.load(f"{work}/model").transform(complete_matches(master))


@query("temporal_split",
       """SELECT match_id, row_idx, CASE WHEN row_idx < floor(0.9 * n) THEN 'train' ELSE 'test' END AS split FROM (
            SELECT match_id, row_number() OVER (ORDER BY date, match_id) - 1 AS row_idx, count(*) OVER () AS n
            FROM complete_t)""")
def q_temporal_split(spark, sf):
    """90/10 temporal split of complete matches at row int(0.9 n)."""
    c = work_table(complete_matches(_inp(spark, sf).master).select("match_id", "date"), "keys")
    return temporal_split(row_numbers(c, ORDER), ORDER).select("match_id", "row_idx", "split")


@query("cv_folds",
       f"""SELECT match_id, row_idx, CAST(CASE WHEN row_idx < n - {C.N_CV_SPLITS} * s THEN -1
                 ELSE floor((row_idx - (n - {C.N_CV_SPLITS} * s)) / s) END AS INT) AS test_fold FROM (
            SELECT match_id, row_number() OVER (ORDER BY date, match_id) - 1 AS row_idx, count(*) OVER () AS n,
              floor(count(*) OVER () / {C.N_CV_SPLITS + 1}) AS s FROM complete_t)""")
def q_cv_folds(spark, sf):
    """Expanding-window CV fold of each complete match."""
    c = work_table(complete_matches(_inp(spark, sf).master).select("match_id", "date"), "keys")
    return cv_folds(row_numbers(c, ORDER), ORDER).select("match_id", "row_idx", "test_fold")


@query("cv_fold_plan",
       f"""WITH numbered AS (
             SELECT label, match_weight, CAST(CASE WHEN row_idx < n - {C.N_CV_SPLITS} * s THEN -1
                 ELSE floor((row_idx - (n - {C.N_CV_SPLITS} * s)) / s) END AS INT) AS test_fold FROM (
               SELECT CASE result WHEN 'home_win' THEN 0 WHEN 'draw' THEN 1 ELSE 2 END AS label, match_weight,
                 row_number() OVER (ORDER BY date, match_id) - 1 AS row_idx, count(*) OVER () AS n,
                 floor(count(*) OVER () / {C.N_CV_SPLITS + 1}) AS s FROM complete_t)),
           folds AS (SELECT unnest(range(0, {C.N_CV_SPLITS}))::INT AS fold)
           SELECT fold, label, count(*) FILTER (test_fold < fold) AS n_train, count(*) FILTER (test_fold = fold) AS n_test,
             (sum(match_weight) FILTER (test_fold < fold))::BIGINT AS train_weight,
             sum(count(*) FILTER (test_fold < fold)) OVER (PARTITION BY fold)
               / (3.0 * count(*) FILTER (test_fold < fold)) AS class_weight
           FROM numbered, folds GROUP BY fold, label""", doubles=["class_weight"])
def q_cv_fold_plan(spark, sf):
    """T11 + M6 + M7: rows, weights and balanced class weights of each fold's
    training slice and class, and its test rows: what the model queries fit on."""
    c = complete_matches(_inp(spark, sf).master).select("match_id", "date", "result", "match_weight")
    return L.fold_plan(cv_folds(work_table(c, "keys"), ORDER))


@query("rank_selection",
       f"""SELECT share, match_id, date FROM (
             SELECT match_id, date, row_number() OVER (ORDER BY date, match_id) - 1 AS row_idx, count(*) OVER () AS n
             FROM complete_t) JOIN (SELECT unnest([0.1, 0.25, 0.5, 0.75, 0.9]) AS share)
           ON row_idx = floor(CAST(share AS DOUBLE) * n)""", doubles=["share"])
def q_rank_selection(spark, sf):
    """T7 + T8: the complete match at given shares of the temporal order, found
    without sorting the table."""
    c = work_table(complete_matches(_inp(spark, sf).master).select("match_id", "date"), "keys")
    n, shares = c.count(), [0.1, 0.25, 0.5, 0.75, 0.9]
    keys = rank_cuts(c, ORDER, [math.floor(n * x) for x in shares])
    return spark.createDataFrame([(x, k[1], k[0]) for x, k in zip(shares, keys) if k is not None],
                                 "share double, match_id long, date date")


# --- feature statistics ---------------------------------------------------------

_PAIRS = [(a, b) for i, a in enumerate(FEATS) for b in FEATS[i + 1:]]


@query("feature_corr",
       "SELECT * FROM (UNPIVOT (SELECT " + ", ".join(
           f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS \"{a}|{b}\"" for a, b in _PAIRS)
       + " FROM f_all) ON COLUMNS(*) INTO NAME pair VALUE corr)", doubles=["corr"], features=True)
def q_feature_corr(spark, sf):
    """Pearson correlation of every feature pair (one pass)."""
    return FS.feature_corr(_features(spark, sf), FEATS)


@query("feature_label_corr",
       "SELECT feature, abs_corr FROM (UNPIVOT (SELECT " + ", ".join(
           f"abs(corr(CAST({a} AS DOUBLE), CAST(CASE result WHEN 'home_win' THEN 0 WHEN 'draw' THEN 1 ELSE 2 END "
           f"AS DOUBLE))) AS {a}" for a in FEATS)
       + " FROM f_all) ON COLUMNS(*) INTO NAME feature VALUE abs_corr) ORDER BY abs_corr DESC, feature LIMIT 15",
       doubles=["abs_corr"], features=True)
def q_feature_label_corr(spark, sf):
    """A23 + T10: top 15 features by |corr(feature, encoded label)|."""
    return FS.feature_label_corr(_features(spark, sf), FEATS, 15)


def _hist_sql() -> str:
    parts = []
    for f in FEATS:
        parts.append(f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS v FROM f_all")
    long = " UNION ALL ".join(parts)
    return f"""WITH lf AS ({long}),
      st AS (SELECT feature, min(v) AS lo, max(v) AS hi, count(DISTINCT v) AS nd FROM lf GROUP BY feature),
      b AS (SELECT lf.feature, st.nd, st.lo, st.hi, lf.v,
              CASE WHEN st.nd <= 3 THEN NULL WHEN st.hi = st.lo THEN 0
                   ELSE CAST(least(floor((lf.v - st.lo) * 30 / (st.hi - st.lo)), 29) AS INT) END AS bin
            FROM lf JOIN st ON lf.feature = st.feature)
      SELECT feature, CASE WHEN nd <= 3 THEN 'value' ELSE 'bin' END AS kind, bin,
        CASE WHEN nd <= 3 THEN v ELSE lo + bin * (hi - lo) / 30 END AS lower,
        CASE WHEN nd <= 3 THEN v ELSE lo + (bin + 1) * (hi - lo) / 30 END AS upper,
        count(*) AS n
      FROM b GROUP BY ALL"""


@query("feature_histogram", _hist_sql(), doubles=["lower", "upper"], features=True)
def q_feature_histogram(spark, sf):
    """Value counts (<= 3 distinct) or 30 equal-width bins per feature."""
    return FS.feature_histogram(_features(spark, sf), FEATS)


def _summary_sql() -> str:
    parts = [f"SELECT '{f}' AS feature, '{FS.feature_group(f)}' AS feature_group, CAST({f} AS DOUBLE) AS v FROM f_all"
             for f in FEATS]
    return ("SELECT feature, feature_group, avg(v) AS mean, stddev_samp(v) AS std FROM ("
            + " UNION ALL ".join(parts) + ") GROUP BY ALL")


@query("feature_summary", _summary_sql(), doubles=["mean", "std"], features=True)
def q_feature_summary(spark, sf):
    """Mean and sample std per feature with its group."""
    return FS.feature_summary(_features(spark, sf), FEATS)


@query("std_features",
       "SELECT match_id, " + ", ".join(
           f"CASE WHEN stddev_samp({f}) OVER () = 0 THEN 0.0 ELSE ({f} - avg({f}) OVER ()) / stddev_samp({f}) OVER () "
           f"END AS z_{f}" for f in FEATS) + " FROM f_all",
       doubles=[f"z_{f}" for f in FEATS], features=True)
def q_std_features(spark, sf):
    """M1: standardised features (Spark ML StandardScaler, sample std)."""
    return FS.standardise(_features(spark, sf), FEATS, ["match_id"])


@query("class_weights",
       """SELECT match_id, label, class_weight, class_weight * match_weight AS sample_weight,
            CAST(match_weight AS DOUBLE) AS boost_weight FROM (
          SELECT match_id, match_weight,
            CASE result WHEN 'home_win' THEN 0 WHEN 'draw' THEN 1 ELSE 2 END AS label,
            count(*) OVER () / (3.0 * count(*) OVER (PARTITION BY result)) AS class_weight FROM f_all)""",
       doubles=["class_weight", "sample_weight", "boost_weight"], features=True)
def q_class_weights(spark, sf):
    """M6: balanced class weight n / (k n_c) times the match weight."""
    return FS.class_weights(_features(spark, sf), ["match_id"])


_SAMPLE_KEY_SQL = "(match_id * 2654435761 + 42) % 4294967291"


@query("leak_audit_sample",
       f"""WITH s AS (SELECT match_id, date, home_team, away_team FROM complete_t
                      ORDER BY {_SAMPLE_KEY_SQL}, match_id LIMIT 3)
          SELECT s.match_id, s.date, s.home_team, s.away_team,
            (SELECT max(h.date) FROM tl h WHERE h.team = s.home_team AND h.date < s.date) AS home_last_date,
            (SELECT max(h.date) FROM tl h WHERE h.team = s.away_team AND h.date < s.date) AS away_last_date
          FROM s""")
def q_leak_audit_sample(spark, sf):
    """W14 + T12: three complete matches drawn with a deterministic seeded
    hash (seed 42) and the latest history date each side may use."""
    m = _inp(spark, sf).master
    key = (F.col("match_id") * F.lit(2654435761) + F.lit(42)) % F.lit(4294967291)
    s = complete_matches(m).select("match_id", "date", "home_team", "away_team") \
        .orderBy(key, "match_id").limit(3)
    tl = team_log(m, KEYS).select(F.col("team").alias("__t"), F.col("date").alias("__d"))
    s = F.broadcast(s)  # exactly three rows
    out = s
    for side in ("home", "away"):
        j = s.join(tl, (F.col("__t") == F.col(f"{side}_team")) & (F.col("__d") < F.col("date")), "left") \
            .groupBy("match_id").agg(F.max("__d").alias(f"{side}_last_date"))
        out = out.join(j, "match_id", "left")
    return out
