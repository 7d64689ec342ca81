"""Incremental ingest of new results.

The reference updates one match per call.  Here a *batch* of new matches
is validated, turned into master rows and appended idempotently (anti-join
on the match key), and the same function runs per micro-batch of a
Structured Streaming file source through ``foreachBatch``.  Late data needs
no watermark: every row is keyed, features are recomputed from the table,
and arrival order does not change the result (R2).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstats.functions import scalar as S
from matchstats.operators.master import MASTER_COLUMNS
from matchstats.sources.schemas import NEW_MATCH_SCHEMA
from matchstats.session import ensure_checkpoint_dir


def validate_feed(feed: DataFrame) -> DataFrame:
    """Date, teams and scores present, scores >= 0, teams differ, shootout
    winner only on a level score.  Adds ``reason`` (a code, NULL when valid)
    and ``accepted``."""
    hs, as_ = F.col("home_score"), F.col("away_score")
    reason = (F.when(F.col("date").isNull() | F.col("home_team").isNull() | F.col("away_team").isNull(), F.lit("missing_key"))
              .when(hs.isNull() | as_.isNull(), F.lit("missing_score"))
              .when((hs < 0) | (as_ < 0), F.lit("negative_score"))
              .when(F.col("home_team") == F.col("away_team"), F.lit("same_team"))
              .when((hs != as_) & F.col("shootout_winner").isNotNull(),
                    F.lit("winner_without_draw")))
    return feed.withColumn("reason", reason).withColumn("accepted", reason.isNull())


def feed_to_master_rows(accepted: DataFrame, keys: list[str]) -> DataFrame:
    """Derive result / tier / weight; goal counts are the scores, with
    no penalties or own goals recorded (the feed has no goal rows)."""
    extra = [k for k in keys if k not in ("date", "home_team", "away_team")]
    hs, as_ = F.col("home_score"), F.col("away_score")
    zero = F.lit(0).cast("long")
    rows = accepted.select(
        *extra, "date", "home_team", "away_team", hs.cast("int").alias("home_score"), as_.cast("int").alias("away_score"),
        "tournament", "city", "country", F.coalesce(F.col("neutral"), F.lit(False)).alias("neutral"),
        "shootout_winner", F.lit(None).cast("string").alias("first_shooter"),
        hs.cast("long").alias("home_goal_count"), as_.cast("long").alias("away_goal_count"),
        zero.alias("home_penalty_count"), zero.alias("away_penalty_count"),
        zero.alias("home_own_goals"), zero.alias("away_own_goals"),
        (hs + as_).cast("long").alias("total_goals"), F.lit(False).alias("is_incomplete"),
        hs.cast("int").alias("home_goals"), as_.cast("int").alias("away_goals"),
        S.result_label(hs, as_).alias("result"),
        S.tournament_tier("tournament").alias("tournament_tier"))
    return rows.withColumn("match_weight", S.match_weight("tournament_tier")).select(*extra, *MASTER_COLUMNS)


def new_master_rows(master: DataFrame, feed: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Validated feed rows not yet in ``master`` (as master rows) and the
    rejected feed rows.  Re-delivered rows (key already in master, or
    repeated in the batch) are dropped, so replaying a batch is a no-op."""
    v = validate_feed(feed)
    rejected = v.filter(~F.col("accepted"))
    accepted = v.filter(F.col("accepted"))
    # only master's key columns are read; adaptive execution sends the batch's
    # keys to them when their measured size allows, else it shuffles both
    existing = master.select(*keys).join(accepted.select(*keys).distinct(), keys, "left_semi")
    # of a key delivered twice in a batch the largest record stays, whatever the order of arrival
    rest = [c for c in accepted.columns if c not in keys]
    one = accepted.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("__r")).select(*keys, "__r.*")
    fresh = one.join(existing, keys, "left_anti")
    return feed_to_master_rows(fresh, keys), rejected


def ingest_batch(master: DataFrame, feed: DataFrame, keys: list[str],
                 shootouts: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """U3 + R1: returns (new master, rejected feed rows, new shootouts)."""
    rows, rejected = new_master_rows(master, feed, keys)
    new_master = master.unionByName(rows)
    new_shoot = None
    if shootouts is not None:
        extra = [k for k in keys if k in shootouts.columns and k not in ("date", "home_team", "away_team")]
        new_shoot = shootouts.unionByName(shootout_rows(rows, extra), allowMissingColumns=True)
    return new_master, rejected, new_shoot


def shootout_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Shootout rows of new master rows that name a shootout winner."""
    return rows.filter(F.col("shootout_winner").isNotNull()).select(
        *dict.fromkeys([*keys, "date", "home_team", "away_team"]), F.col("shootout_winner").alias("winner"),
        F.lit(None).cast("string").alias("first_shooter"))


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a Spark job has committed its output to ``path``."""
    try:
        spark.read.text(f"{path}/_SUCCESS")
        return True
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def run_ingest_stream(spark: SparkSession, feed_dir: str, master_path: str, work_dir: str, keys: list[str],
                      max_files_per_trigger: int = 1, on_batch=None, shootouts_path: str | None = None,
                      checkpoint_path: str | None = None) -> dict:
    """R1-R4 on Structured Streaming.

    ``feed_dir`` holds JSON-lines files of NEW_MATCH_SCHEMA records.  Each
    micro-batch is validated and appended to the parquet master at
    ``master_path`` (anti-join on ``keys`` keeps replays idempotent);
    rejects and one log record per accepted match (R4 / S5) are written as
    JSON per epoch under ``work_dir``; with ``shootouts_path`` the shootouts
    of new matches are appended to that table.  ``on_batch(spark, epoch_id, master_path, rows)``
    (rows: the batch's new master rows) is the R3 hook (feature refresh / retrain) run after each batch.
    Runs with the ``availableNow`` trigger and returns the output paths.
    """
    rejects_path = f"{work_dir}/rejects"
    log_path = f"{work_dir}/update_log"

    def process(batch: DataFrame, epoch_id: int) -> None:
        # foreachBatch runs at least once.  The batch's new rows are staged
        # first; a replay finds them and repeats the later steps, each of which
        # overwrites its own epoch's folder or appends only missing keys.
        staged = f"{work_dir}/staged/epoch={epoch_id}"
        if not finished(spark, staged):
            fresh, _ = new_master_rows(spark.read.parquet(master_path), batch, keys)
            fresh.write.mode("overwrite").parquet(staged)
        rows = spark.read.parquet(staged)
        present = spark.read.parquet(master_path).select(*keys).join(rows.select(*keys), keys, "left_semi")
        rows.join(present, keys, "left_anti").select(*rows.columns).write.mode("append").parquet(master_path)
        if shootouts_path is not None:
            won = shootout_rows(rows, keys)
            known = spark.read.parquet(shootouts_path)
            won.join(known.select(*keys), keys, "left_anti").select(
                *[F.col(c) if c in won.columns else F.lit(None).cast(t).alias(c) for c, t in known.dtypes]
            ).write.mode("append").parquet(shootouts_path)
        rejected = validate_feed(batch).filter(~F.col("accepted"))
        rejected.write.mode("overwrite").json(f"{rejects_path}/epoch={epoch_id}")
        log = rows.select(
            F.current_timestamp().cast("string").alias("timestamp"),
            F.concat_ws(" ", "home_team", F.concat_ws("-", "home_score", "away_score"), "away_team").alias("match"),
            F.col("date").cast("string").alias("date"), "result")
        log.write.mode("overwrite").json(f"{log_path}/epoch={epoch_id}")
        if on_batch is not None:
            on_batch(spark, epoch_id, master_path, rows)

    stream = (spark.readStream.schema(NEW_MATCH_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
              .json(feed_dir))
    q = (stream.writeStream.foreachBatch(process)
         .option("checkpointLocation", checkpoint_path or f"{work_dir}/_stream_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return {"master": master_path, "rejects": rejects_path, "log": log_path}


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{label}-{dt.datetime.now(dt.timezone.utc):%Y%m%d%H%M%S}-{uuid.uuid4().hex[:8]}"
