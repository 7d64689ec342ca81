"""Evaluation tables as plain DataFrame aggregates.

Input: one row per scored match with ``label`` (0/1/2), class
probabilities ``p_home``, ``p_draw``, ``p_away`` and optionally
``tournament_tier``.  ``prediction`` = argmax, ties to the lower class.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchstats import config as C
from matchstats.operators.rownum import prefix_sums

PROB_COLS = ["p_home", "p_draw", "p_away"]
EPS = 1e-15


def with_prediction(scored: DataFrame) -> DataFrame:
    ph, pd_, pa = (F.col(c) for c in PROB_COLS)
    pred = F.when((ph >= pd_) & (ph >= pa), F.lit(0)).when(pd_ >= pa, F.lit(1)).otherwise(F.lit(2))
    return scored.withColumn("prediction", pred)


def _long(scored: DataFrame) -> DataFrame:
    """One row per (match, class): p = probability of that class, y = 1 if
    it is the true class."""
    arr = F.array(*[F.struct(F.lit(i).alias("cls"), F.col(c).alias("p")) for i, c in enumerate(PROB_COLS)])
    return scored.select("label", F.explode(arr).alias("__c")).select(
        F.col("__c.cls").alias("cls"), F.col("__c.p").alias("p"),
        (F.col("label") == F.col("__c.cls")).cast("int").alias("y"))


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """3 x 3 counts; rows = true label, columns = predicted label."""
    s = with_prediction(scored)
    return (s.groupBy("label").pivot("prediction", [0, 1, 2]).count().na.fill(0)
            .select("label", *[F.col(str(i)).cast("long").alias(f"pred_{i}") for i in range(3)]))


def _tallies(scored: DataFrame) -> DataFrame:
    """One row of everything E2 and E3 need, from one pass over the scored
    rows: per class the true positives ``tp``, predicted ``pp``, support
    ``sup`` and the ratios made of them, and the log loss."""
    s = with_prediction(scored)
    p_true = F.when(F.col("label") == 0, F.col("p_home")).when(F.col("label") == 1, F.col("p_draw")) \
        .otherwise(F.col("p_away"))
    norm = F.col("p_home") + F.col("p_draw") + F.col("p_away")
    counts = s.agg(*[
        x for k in range(3) for x in (
            F.count(F.when((F.col("label") == k) & (F.col("prediction") == k), F.lit(1))).alias(f"tp{k}"),
            F.count(F.when(F.col("prediction") == k, F.lit(1))).alias(f"pp{k}"),
            F.count(F.when(F.col("label") == k, F.lit(1))).alias(f"sup{k}"))],
        F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"),
        (-F.avg(F.log(F.least(F.greatest(p_true / norm, F.lit(EPS)), F.lit(1 - EPS))))).alias("log_loss"),
        F.count(F.lit(1)).alias("n"))
    ratios = counts.select("*", *[
        x for k in range(3) for x in (
            F.when(F.col(f"pp{k}") > 0, F.col(f"tp{k}") / F.col(f"pp{k}")).otherwise(0.0).alias(f"precision{k}"),
            F.when(F.col(f"sup{k}") > 0, F.col(f"tp{k}") / F.col(f"sup{k}")).otherwise(0.0).alias(f"recall{k}"))])
    return ratios.select("*", (F.col("sup0") + F.col("sup1") + F.col("sup2")).alias("support"), *[
        F.when(F.col(f"precision{k}") + F.col(f"recall{k}") > 0,
               2 * F.col(f"precision{k}") * F.col(f"recall{k}") / (F.col(f"precision{k}") + F.col(f"recall{k}")))
        .otherwise(0.0).alias(f"f1{k}") for k in range(3)])


def _macro(metric: str):
    return (F.col(f"{metric}0") + F.col(f"{metric}1") + F.col(f"{metric}2")) / 3


def _weighted(metric: str):
    """Mean by support; NULL without rows."""
    total = sum((F.col(f"{metric}{k}") * F.col(f"sup{k}") for k in range(1, 3)), F.col(f"{metric}0") * F.col("sup0"))
    return F.when(F.col("support") > 0, total / F.col("support"))


def classification_report(scored: DataFrame) -> DataFrame:
    """Precision, recall, f1, support per class plus macro / weighted
    averages and accuracy; zero division -> 0."""
    metrics = ["precision", "recall", "f1"]

    def row(name: str, of, support: str):
        return F.struct(F.lit(name).alias("class"), *[of(m).alias(m) for m in metrics], F.col(support).alias("support"))

    rows = [row(name, lambda m, k=k: F.col(f"{m}{k}"), f"sup{k}") for k, name in enumerate(C.RESULT_CLASSES)]
    rows += [row("macro avg", _macro, "support"), row("weighted avg", _weighted, "support"),
             row("accuracy", lambda m: F.col("accuracy"), "support")]
    return _tallies(scored).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def summary_metrics(scored: DataFrame) -> DataFrame:
    """Accuracy, weighted F1, macro F1 and log loss in one row."""
    return _tallies(scored).select("accuracy", "log_loss", "n", _weighted("f1").alias("f1_weighted"),
                                   _macro("f1").alias("f1_macro"))


def calibration_bins(scored: DataFrame, n_bins: int = 10) -> DataFrame:
    """Per class, 10 uniform bins of the predicted probability (a value
    on an inner edge belongs to the lower bin); mean predicted vs fraction
    positive; empty bins are simply absent."""
    lg = _long(scored)
    b = F.least(F.greatest(F.ceil(F.col("p") * n_bins) - 1, F.lit(0)), F.lit(n_bins - 1)).cast("int")
    return lg.groupBy("cls", b.alias("bin")).agg(
        F.avg("p").alias("mean_predicted"), F.avg("y").alias("fraction_positive"), F.count(F.lit(1)).alias("n"))


def roc_auc(scored: DataFrame) -> DataFrame:
    """E5: one-vs-rest ROC AUC per class (trapezoid over the ROC points,
    i.e. the Mann-Whitney statistic with ties counting one half).

    Rows collapse to (class, score) with positive / negative counts (map-side
    partial aggregation); distributed prefix sums in descending score order
    give the positives ranked above each score, and AUC is one aggregate:
    sum(neg_i * (pos_above_i + pos_i / 2)) / (P * N).
    """
    lg = _long(scored)
    col = lg.groupBy("cls", "p").agg(F.sum("y").cast("long").alias("pos"),
                                     F.sum(1 - F.col("y")).cast("long").alias("neg"))
    ps = prefix_sums(col, ["cls"], [F.col("p").desc()], ["pos", "neg"])
    den = F.sum("pos") * F.sum("neg")
    return ps.groupBy("cls").agg(
        F.when(den > 0, F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2.0)) / den).alias("auc"),
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))


def roc_curve(scored: DataFrame) -> DataFrame:
    """E5: the ROC points (threshold, fpr, tpr) per class."""
    lg = _long(scored)
    col = lg.groupBy("cls", "p").agg(F.sum("y").cast("long").alias("pos"),
                                     F.sum(1 - F.col("y")).cast("long").alias("neg"))
    tot = col.groupBy("cls").agg(F.sum("pos").alias("__all_pos"), F.sum("neg").alias("__all_neg"))
    ps = prefix_sums(col, ["cls"], [F.col("p").desc()], ["pos", "neg"])
    return ps.join(F.broadcast(tot), "cls").select(
        "cls", F.col("p").alias("threshold"),
        F.when(F.col("__all_neg") > 0, F.col("cum_neg") / F.col("__all_neg")).alias("fpr"),
        F.when(F.col("__all_pos") > 0, F.col("cum_pos") / F.col("__all_pos")).alias("tpr"))


def accuracy_by_tier(scored: DataFrame) -> DataFrame:
    """E6 (+J8): accuracy and n per tournament tier."""
    s = with_prediction(scored)
    return s.groupBy("tournament_tier").agg(
        F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("n"))


def brier(scored: DataFrame) -> DataFrame:
    """Brier score per class and their mean."""
    lg = _long(scored)
    per = lg.groupBy("cls").agg(F.avg(F.pow(F.col("p") - F.col("y"), 2)).alias("brier"))
    mean = per.agg(F.avg("brier")).scalar()
    return per.withColumn("mean_brier", mean)


def rolling_accuracy(scored: DataFrame, order_cols: list[str], window: int = C.UPDATER_LOG_WINDOW) -> DataFrame:
    """Accuracy over the last ``window`` scored rows; 0.0 if none.
    The last rows come from a TakeOrdered (n rows per task, then merged)."""
    s = with_prediction(scored)
    last = s.orderBy(*[F.col(c).desc() for c in order_cols]).limit(window)
    return last.agg(F.coalesce(F.avg((F.col("label") == F.col("prediction")).cast("double")), F.lit(0.0))
                    .alias("rolling_accuracy"), F.count(F.lit(1)).alias("n"))
