"""Registered evaluation queries (E1-E8) on deterministic heuristic
probabilities (F12): team records from the temporal train split score the
test split, so every table has an exact SQL oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchstats import config as C
from matchstats.functions import scalar as S
from matchstats.operators import analytics as A
from matchstats.operators import evaluation as E
from matchstats.operators.master import complete_matches
from matchstats.operators.rownum import temporal_split
from matchstats.plans.catalog import KEYS, ORDER, _inp, query
from matchstats.session import work_table
from matchstats.streaming.ingest import scratch_dir
from matchstats.streaming.rolling import current_accuracy, run_rolling_stream

#: Records of a feed file, and files of a micro-batch.
FEED_RECORDS, FEED_FILES = 100_000, 64


def scored_test_split(spark, sf):
    """Heuristic probabilities for the last 10% of complete matches, using
    team records from the first 90% only."""
    c = work_table(complete_matches(_inp(spark, sf).master).select(
        "match_id", "date", "home_team", "away_team", "neutral", "tournament_tier", "result", "home_goals", "away_goals",
        "is_incomplete"), "matches")
    c = temporal_split(c, ORDER)
    records = A.team_records(c.filter(F.col("split") == "train"), KEYS)
    fx = c.filter(F.col("split") == "test").select(
        "match_id", "date", "home_team", "away_team", "neutral", "tournament_tier", "result")
    h = A.heuristic_predict(fx, records)
    return h.withColumn("label", S.encode_result("result"))


_EV = f"""
sp AS (SELECT match_id, CASE WHEN row_number() OVER (ORDER BY date, match_id) - 1 < floor(0.9 * count(*) OVER ())
                         THEN 'train' ELSE 'test' END AS split FROM complete_t),
rtrain AS (SELECT team, count(*) AS played, count(CASE WHEN team_result = 'win' THEN 1 END) AS wins
           FROM ctl WHERE match_id IN (SELECT match_id FROM sp WHERE split = 'train') GROUP BY team),
hr AS (SELECT team, wins / greatest(played, 1) AS rate FROM rtrain),
hx AS (SELECT m.match_id, m.date, m.tournament_tier, m.result,
         CASE WHEN coalesce(m.neutral, FALSE) THEN coalesce(a.rate, 0.0) ELSE coalesce(a.rate, 0.0) * {C.HOME_BOOST} END AS wh,
         coalesce(b.rate, 0.0) AS wa
       FROM complete_t m LEFT JOIN hr a ON a.team = m.home_team LEFT JOIN hr b ON b.team = m.away_team
       WHERE m.match_id IN (SELECT match_id FROM sp WHERE split = 'test')),
hy AS (SELECT *, wh / (wh + wa + {C.HEURISTIC_DRAW_MASS}) AS ph, wa / (wh + wa + {C.HEURISTIC_DRAW_MASS}) AS pa FROM hx),
hz AS (SELECT *, greatest(0.0, 1 - ph - pa) AS pdr FROM hy),
ev0 AS (SELECT match_id, date, tournament_tier,
          CASE result WHEN 'home_win' THEN 0 WHEN 'draw' THEN 1 ELSE 2 END AS label,
          ph / (ph + pdr + pa) AS p_home, pdr / (ph + pdr + pa) AS p_draw, pa / (ph + pdr + pa) AS p_away FROM hz),
ev AS (SELECT *, CASE WHEN p_home >= p_draw AND p_home >= p_away THEN 0 WHEN p_draw >= p_away THEN 1 ELSE 2 END
          AS prediction FROM ev0),
evl AS (SELECT label, 0 AS cls, p_home AS p FROM ev UNION ALL SELECT label, 1, p_draw FROM ev
        UNION ALL SELECT label, 2, p_away FROM ev),
evl2 AS (SELECT cls, p, CAST(label = cls AS INT) AS y FROM evl)"""


def _ev(body: str) -> str:
    """Bodies that start with ',' add CTEs after the evaluation CTEs."""
    if body.lstrip().startswith(","):
        return f"WITH {_EV}{body}"
    return f"WITH {_EV}\n{body}"


@query("scored_predictions", _ev("SELECT match_id, label, p_home, p_draw, p_away, prediction FROM ev"),
       doubles=["p_home", "p_draw", "p_away"])
def q_scored_predictions(spark, sf):
    """F12 on the test split with argmax prediction (input of E1-E8)."""
    return E.with_prediction(scored_test_split(spark, sf)).select(
        "match_id", "label", "p_home", "p_draw", "p_away", "prediction")


@query("confusion_matrix", _ev(
    "SELECT label, " + ", ".join(f"count(CASE WHEN prediction = {i} THEN 1 END) AS pred_{i}" for i in range(3))
    + " FROM ev GROUP BY label"))
def q_confusion_matrix(spark, sf):
    """E1."""
    return E.confusion_matrix(scored_test_split(spark, sf))


_REPORT = """
pc AS (SELECT k.cls,
         count(CASE WHEN ev.label = k.cls AND ev.prediction = k.cls THEN 1 END) AS tp,
         count(CASE WHEN ev.prediction = k.cls THEN 1 END) AS pp,
         count(CASE WHEN ev.label = k.cls THEN 1 END) AS sup
       FROM (SELECT 0 AS cls UNION ALL SELECT 1 UNION ALL SELECT 2) k, ev GROUP BY k.cls),
pr AS (SELECT cls, CASE cls WHEN 0 THEN 'home_win' WHEN 1 THEN 'draw' ELSE 'away_win' END AS class,
         CASE WHEN pp > 0 THEN tp / pp ELSE 0.0 END AS precision,
         CASE WHEN sup > 0 THEN tp / sup ELSE 0.0 END AS recall, sup AS support FROM pc),
pf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END
         AS f1 FROM pr),
acc AS (SELECT avg(CAST(label = prediction AS DOUBLE)) AS a, count(*) AS n FROM ev)"""


@query("classification_report", _ev(f""", {_REPORT.strip()}
    SELECT class, precision, recall, f1, support FROM pf
    UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM pf
    UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                     sum(f1 * support) / sum(support), sum(support) FROM pf
    UNION ALL SELECT 'accuracy', a, a, a, n FROM acc"""),
       doubles=["precision", "recall", "f1"])
def q_classification_report(spark, sf):
    """E2."""
    return E.classification_report(scored_test_split(spark, sf))


@query("summary_metrics", _ev(f""", {_REPORT.strip()},
    ll AS (SELECT -avg(ln(least(greatest(CASE label WHEN 0 THEN p_home WHEN 1 THEN p_draw ELSE p_away END
                                          / (p_home + p_draw + p_away), 1e-15), 1 - 1e-15))) AS log_loss FROM ev)
    SELECT acc.a AS accuracy, ll.log_loss, acc.n,
      (SELECT sum(f1 * support) / sum(support) FROM pf) AS f1_weighted, (SELECT avg(f1) FROM pf) AS f1_macro
    FROM acc, ll"""), doubles=["accuracy", "log_loss", "f1_weighted", "f1_macro"])
def q_summary_metrics(spark, sf):
    """Accuracy, weighted / macro F1, log loss."""
    return E.summary_metrics(scored_test_split(spark, sf))


@query("calibration_bins", _ev(
    "SELECT cls, CAST(least(greatest(ceil(p * 10) - 1, 0), 9) AS INT) AS bin, avg(p) AS mean_predicted, "
    "avg(y) AS fraction_positive, count(*) AS n FROM evl2 GROUP BY 1, 2"),
       doubles=["mean_predicted", "fraction_positive"])
def q_calibration_bins(spark, sf):
    """E4."""
    return E.calibration_bins(scored_test_split(spark, sf))


@query("roc_auc", _ev(""",
    c AS (SELECT cls, p, CAST(sum(y) AS BIGINT) AS pos, CAST(sum(1 - y) AS BIGINT) AS neg FROM evl2 GROUP BY 1, 2),
    cc AS (SELECT *, sum(pos) OVER (PARTITION BY cls ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS cum_pos FROM c)
    SELECT cls, sum(neg * (cum_pos - pos / 2.0)) / (sum(pos) * sum(neg)) AS auc,
      CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM cc GROUP BY cls"""),
       doubles=["auc"])
def q_roc_auc(spark, sf):
    """E5: one-vs-rest AUC via distributed prefix sums."""
    return E.roc_auc(scored_test_split(spark, sf)).withColumn("n_pos", F.col("n_pos").cast("long")) \
        .withColumn("n_neg", F.col("n_neg").cast("long"))


@query("roc_curve", _ev(""",
    c AS (SELECT cls, p, CAST(sum(y) AS BIGINT) AS pos, CAST(sum(1 - y) AS BIGINT) AS neg FROM evl2 GROUP BY 1, 2),
    cc AS (SELECT *, sum(pos) OVER (PARTITION BY cls ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS cum_pos,
             sum(neg) OVER (PARTITION BY cls ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS cum_neg,
             sum(pos) OVER (PARTITION BY cls) AS tp_all, sum(neg) OVER (PARTITION BY cls) AS tn_all FROM c)
    SELECT cls, p AS threshold, cum_neg / tn_all AS fpr, cum_pos / tp_all AS tpr FROM cc"""),
       doubles=["threshold", "fpr", "tpr"])
def q_roc_curve(spark, sf):
    """E5: ROC points per class."""
    return E.roc_curve(scored_test_split(spark, sf))


@query("accuracy_by_tier", _ev(
    "SELECT tournament_tier, avg(CAST(label = prediction AS DOUBLE)) AS accuracy, count(*) AS n FROM ev GROUP BY 1"),
       doubles=["accuracy"])
def q_accuracy_by_tier(spark, sf):
    """E6 + J8."""
    return E.accuracy_by_tier(scored_test_split(spark, sf))


@query("brier", _ev(""",
    b AS (SELECT cls, avg(pow(p - y, 2)) AS brier FROM evl2 GROUP BY cls)
    SELECT cls, brier, (SELECT avg(brier) FROM b) AS mean_brier FROM b"""), doubles=["brier", "mean_brier"])
def q_brier(spark, sf):
    """E7."""
    return E.brier(scored_test_split(spark, sf))


@query("rolling_accuracy", _ev(f"""
    SELECT coalesce(avg(CAST(label = prediction AS DOUBLE)), 0.0) AS rolling_accuracy, count(*) AS n FROM (
      SELECT * FROM ev ORDER BY date DESC, match_id DESC LIMIT {C.UPDATER_LOG_WINDOW})"""),
       doubles=["rolling_accuracy"])
def q_rolling_accuracy(spark, sf):
    """Accuracy over the last 100 scored matches."""
    return E.rolling_accuracy(scored_test_split(spark, sf), ["date", "match_id"])


@query("rolling_accuracy_stream", _ev(f"""
    SELECT 'heuristic' AS model, avg(CAST(label = prediction AS DOUBLE)) AS rolling_accuracy, count(*) AS n FROM (
      SELECT * FROM ev ORDER BY date DESC, match_id DESC LIMIT {C.UPDATER_LOG_WINDOW})"""),
       doubles=["rolling_accuracy"])
def q_rolling_accuracy_stream(spark, sf):
    """E8 + R3 on Structured Streaming: the scored matches arrive as files and
    go through stateful rings of the last 100 results."""
    work = scratch_dir(spark, "rolling")
    scored = scored_test_split(spark, sf).select(F.lit("heuristic").alias("model"), "date", "match_id", "label", *E.PROB_COLS)
    scored.write.option("maxRecordsPerFile", FEED_RECORDS).parquet(f"{work}/feed")
    schema = ", ".join(f"{n} {t}" for n, t in scored.dtypes)
    run_rolling_stream(spark, f"{work}/feed", schema, work, KEYS, max_files_per_trigger=FEED_FILES)
    return current_accuracy(spark, work)
