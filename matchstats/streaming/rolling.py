"""Rolling accuracy as a stateful stream.

Scored matches arrive in any order, some more than once.  Per model, state
keeps the last ``window`` results in match order (date, then keys), so that a
late match takes its place and one that came before is not counted twice.  A
model's results are dealt to ``SALT`` such rings by their key: the last hundred
of all are among the last hundred of each, and no task holds a whole model.
Every micro-batch writes the rings that changed, as one epoch; a replayed epoch
overwrites itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from matchstats import config as C
from matchstats.operators.evaluation import with_prediction
from matchstats.session import ship_code

SALT = 16
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class Ring(StatefulProcessor):
    """The last ``window`` results of one (model, salt), by ``order``."""

    def __init__(self, order: list[str], types: list[str], window: int):
        self.order, self.window = order, window
        self.ddl = ", ".join([*(f"`{c}` array<{t}>" for c, t in zip(order, types)), "hit array<boolean>"])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getValueState("ring", self.ddl)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held: dict[tuple, bool] = {}
        if self.ring.exists():
            *places, hits = (list(c) for c in self.ring.get())
            held = dict(zip(zip(*places), hits))
        before = dict(held)
        for part in rows:
            for *place, hit in zip(*(part[c].tolist() for c in self.order), part["hit"].tolist()):
                held.setdefault(tuple(place), bool(hit))
        last = sorted(held)[-self.window:]
        held = {p: held[p] for p in last}
        if held != before:
            self.ring.update((*([p[i] for p in last] for i in range(len(self.order))), [held[p] for p in last]))
            out = {"model": [key[0]] * len(last), "salt": [key[1]] * len(last)}
            out |= {c: [p[i] for p in last] for i, c in enumerate(self.order)}
            yield pd.DataFrame(out | {"hit": [held[p] for p in last]})

    def close(self) -> None:
        pass


def run_rolling_stream(spark: SparkSession, scored_dir: str, schema: str, path: str, keys: list[str],
                       window: int = C.UPDATER_LOG_WINDOW, max_files_per_trigger: int = 1) -> str:
    """Read scored matches (``model``, date, keys, label, probabilities) that
    stand as Parquet files in ``scored_dir`` and keep the rings in ``path``.
    Runs until all files are read and may be run again for new ones."""
    ship_code(spark)
    order = list(dict.fromkeys(["date", *keys]))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(scored_dir)
    results = with_prediction(stream).filter(F.col("date").isNotNull()).select(
        "model", F.pmod(F.xxhash64(*order), F.lit(SALT)).cast("int").alias("salt"), *order, (F.col("label") == F.col("prediction")).alias("hit"))
    # days as numbers: state and pandas then agree about their type
    results = results.withColumn("date", F.unix_date("date"))
    types = [dict(results.dtypes)[c] for c in order]
    out_schema = "model string, salt int, " + ", ".join(f"`{c}` {t}" for c, t in zip(order, types)) + ", hit boolean"
    rings = results.groupBy("model", "salt").transformWithStateInPandas(
        Ring(order, types, window), out_schema, "Update", "None")

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/rings/epoch={epoch}")

    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)  # what arbitrary state needs
    try:
        query = (rings.writeStream.foreachBatch(write).outputMode("update")
                 .option("checkpointLocation", f"{path}/_checkpoint").trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        spark.conf.set(PROVIDER, before)
    return path


def current_accuracy(spark: SparkSession, path: str, window: int = C.UPDATER_LOG_WINDOW) -> DataFrame:
    """model, rolling_accuracy, n from each ring's last epoch: ``SALT`` times
    ``window`` rows a model."""
    rings = spark.read.parquet(f"{path}/rings")
    newest = rings.withColumn("last", F.max("epoch").over(Window.partitionBy("model", "salt"))).filter("epoch = last")
    order = [c for c in newest.columns if c not in ("model", "salt", "hit", "epoch", "last")]
    w = Window.partitionBy("model").orderBy(*[F.col(c).desc() for c in order])
    best = newest.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= window)
    return best.groupBy("model").agg(F.avg(F.col("hit").cast("double")).alias("rolling_accuracy"), F.count(F.lit(1)).alias("n"))
