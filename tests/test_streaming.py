"""Structured Streaming ingest: per-batch hook (R3), log (R4), idempotent
replay, late arrival (R2)."""

import datetime as dt

from pyspark.sql import functions as F

from matchstats.plans.pipeline import fixture_inputs
from matchstats.streaming.ingest import run_ingest_stream
from tests.conftest import SF0001


def test_stream_ingest_hook_log_and_replay(spark, scratch):
    inp = fixture_inputs(spark, SF0001)
    cut = dt.date(2001, 1, 1)
    master_path = f"{scratch}/master"
    inp.master.filter(F.col("date") < F.lit(cut)).write.parquet(master_path)
    base = spark.read.parquet(master_path).count()
    so = inp.shootouts.select("match_id", F.col("winner").alias("shootout_winner"))
    feed = inp.results.join(so, "match_id", "left").filter(F.col("date") >= F.lit(cut))
    # three files, newest first (late data)
    for i, (lo, hi) in enumerate([("2001-05-01", "2002-01-01"), ("2001-03-01", "2001-05-01"),
                                  ("2001-01-01", "2001-03-01")]):
        feed.filter((F.col("date") >= lo) & (F.col("date") < hi)).coalesce(1).write.json(f"{scratch}/feed/p{i}")
    seen = []

    def hook(spark_, epoch, path, rows):  # R3: refresh step after each batch
        seen.append((epoch, spark_.read.parquet(path).count()))

    out = run_ingest_stream(spark, f"{scratch}/feed/*", master_path, f"{scratch}/w1", ["match_id"], on_batch=hook)
    n_valid = feed.filter(F.col("home_score").isNotNull() & F.col("away_score").isNotNull()).count()
    final = spark.read.parquet(master_path)
    assert final.count() == base + n_valid
    assert final.select("match_id").distinct().count() == final.count()
    assert len(seen) == 3 and seen[-1][1] == base + n_valid
    assert spark.read.json(out["log"]).count() == n_valid
    assert spark.read.json(out["rejects"]).count() == feed.count() - n_valid
    # every epoch once more over the same work folder, as after a crash that
    # came before its commit: nothing is doubled, and the log stays whole
    run_ingest_stream(spark, f"{scratch}/feed/*", master_path, f"{scratch}/w1", ["match_id"],
                      checkpoint_path=f"{scratch}/again")
    assert spark.read.parquet(master_path).count() == base + n_valid
    assert spark.read.json(out["log"]).count() == n_valid
    assert spark.read.json(out["rejects"]).count() == feed.count() - n_valid
    # replay of the whole feed with a fresh stream checkpoint is a no-op
    run_ingest_stream(spark, f"{scratch}/feed/*", master_path, f"{scratch}/w2", ["match_id"])
    assert spark.read.parquet(master_path).count() == base + n_valid


def test_stream_retrain_hook(spark, scratch):
    from matchstats.streaming.update import make_update_hook
    inp = fixture_inputs(spark, SF0001)
    cut = dt.date(2001, 1, 1)
    master_path = f"{scratch}/master"
    inp.master.filter(F.col("date") < F.lit(cut)).write.parquet(master_path)
    so = inp.shootouts.select("match_id", F.col("winner").alias("shootout_winner"))
    feed = inp.results.join(so, "match_id", "left").filter(F.col("date") >= F.lit(cut))
    for i, (lo, hi) in enumerate([("2001-01-01", "2001-04-01"), ("2001-04-01", "2002-01-01")]):
        feed.filter((F.col("date") >= lo) & (F.col("date") < hi)).coalesce(1).write.json(f"{scratch}/feed/p{i}")
    shootouts = f"{scratch}/shootouts"
    inp.shootouts.filter(F.col("date") < F.lit(cut)).write.parquet(shootouts)
    hook = make_update_hook(shootouts, f"{scratch}/model", f"{scratch}/w/retrain_log", ["match_id"])

    def run(**more):
        run_ingest_stream(spark, f"{scratch}/feed/*", master_path, f"{scratch}/w", ["match_id"], on_batch=hook,
                          shootouts_path=shootouts, **more)
        log = spark.read.json(f"{scratch}/w/retrain_log")
        return log, log.groupBy("epoch").agg(F.first("rolling_accuracy_last_100").alias("r")).orderBy("epoch").collect()

    log, rolling = run()
    n_new = spark.read.parquet(master_path).filter(F.col("date") >= F.lit(cut)).filter(~F.col("is_incomplete")).count()
    assert log.count() == n_new                              # one record per new match
    assert {"match", "date", "result", "new_cv_f1", "rolling_accuracy_last_100"} <= set(log.columns)
    assert len(rolling) == 2 and rolling[0]["r"] is None     # no earlier model to test with
    # only rows of the second batch were scored, before the refit saw them
    staged = spark.read.parquet(f"{scratch}/w/staged").filter("epoch = 1").select("match_id")
    scored = spark.read.parquet(f"{scratch}/w/retrain_log-scored")
    assert sorted(scored.select("match_id").collect()) == sorted(staged.collect())
    last = scored.orderBy(F.desc("date"), F.desc("match_id")).limit(100).withColumn(
        "best", F.greatest("p_home", "p_draw", "p_away")).withColumn(
        "prediction", F.when(F.col("p_home") == F.col("best"), 0).when(F.col("p_draw") == F.col("best"), 1).otherwise(2))
    assert rolling[1]["r"] == last.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    # the shootouts of new matches reached the table that the hook reads anew
    assert spark.read.parquet(shootouts).filter(F.col("date") >= F.lit(cut)).count() > 0
