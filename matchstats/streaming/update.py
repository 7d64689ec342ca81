"""R3 + R4 + E8 as a per-micro-batch step of the ingest stream.

After a micro-batch is appended to the master table:

1. the batch's matches are scored with the *previous* model (test-then-train):
   their features look back over the refreshed master, and shootouts given as
   a path are read anew; the scored rows are written per epoch;
2. accuracy over the last 100 scored matches is taken (E8);
3. the model is refit on all complete matches and saved (S7); of several model
   names the one with the best expanding-window weighted F1 is kept (M9);
4. one record per new match is written as JSON per epoch (R4 / S5).

A replayed epoch keeps its first scores (the saved model may have seen its
rows since) and overwrites its own records.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstats import config as C
from matchstats.operators import evaluation as E
from matchstats.operators import learn as L
from matchstats.operators import model_store
from matchstats.operators.features import build_features, feature_names
from matchstats.streaming.ingest import finished


def _saved_model(spark: SparkSession, model_dir: str):
    """The newest model of the store, None where there is none."""
    return L.load_model(model_dir) if model_store.versions(spark, model_dir) else None


def make_update_hook(shootouts: DataFrame | str | None, model_dir: str, log_path: str, keys: list[str],
                     model_name: str | list[str] = "logistic_regression", with_cv: bool = False):
    """The ``on_batch`` step of :func:`run_ingest_stream`.  ``log_path`` belongs
    to one stream, like its work folder; scored rows lie beside it in
    ``<log_path>-scored``.  Cross-validation runs with ``with_cv`` or where
    ``model_name`` lists several models."""
    feats = feature_names()
    names = [model_name] if isinstance(model_name, str) else list(model_name)
    order = list(dict.fromkeys(["date", *keys]))
    scored_path = f"{log_path}-scored"

    def hook(spark: SparkSession, epoch_id: int, master_path: str, rows: DataFrame) -> None:
        master = spark.read.parquet(master_path)
        shoot = spark.read.parquet(shootouts) if isinstance(shootouts, str) else shootouts
        previous = _saved_model(spark, model_dir)
        rolling = None
        if previous is not None:
            if not finished(spark, f"{scored_path}/epoch={epoch_id}"):
                batch = build_features(master, shoot, queries=rows, keys=keys, materialize=False)
                L.score(previous, L.prepare(batch, feats)).select(*order, "label", *E.PROB_COLS) \
                    .write.mode("overwrite").parquet(f"{scored_path}/epoch={epoch_id}")
            scored = spark.read.parquet(scored_path)
            rolling = E.rolling_accuracy(scored, ["epoch", *order], C.UPDATER_LOG_WINDOW).first()["rolling_accuracy"]
        fm = build_features(master, shoot, keys=keys, materialize=False)
        best, cv_f1 = names[0], None
        if with_cv or len(names) > 1:
            folds = reduce(DataFrame.unionByName, [L.cross_validate(fm, n, feats, order) for n in names])
            top = L.cv_summary(folds).first()
            best, cv_f1 = top["model"], top["f1_weighted_mean"]
        L.save_model(L.fit(L.prepare(fm, feats), best, feats), model_dir, best)
        rows.select(
            F.current_timestamp().cast("string").alias("timestamp"),
            F.concat_ws(" ", "home_team", F.concat_ws("-", "home_score", "away_score"), "away_team").alias("match"),
            F.col("date").cast("string").alias("date"), "result", F.lit(best).alias("model"),
            F.lit(cv_f1).cast("double").alias("new_cv_f1"),
            F.lit(rolling).cast("double").alias("rolling_accuracy_last_100"),
        ).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{log_path}/epoch={epoch_id}")

    return hook
