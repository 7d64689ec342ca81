"""Daily feature states as a stored table that late data repairs.

The look-back features of a match are read from two daily tables: the state of
a team and that of a pair of teams, strictly before a date.  A batch of new
matches, however old, changes a team's states from its earliest new day on and
nothing else.  ``repair_states`` finds these (team, day) and (pair, day) ranges,
recomputes them from the touched teams' and pairs' own matches, and rewrites
only the partitions that hold them.

Layout: ``<path>/<kind>/v=<n>/bucket=<b>/year=<y>`` holds what version n wrote,
``<path>/manifest/<n>`` names the version of every current partition, and the
highest file in ``<path>/current`` is the version that readers use.  A repair
that stops anywhere before its last step changes nothing for readers; done
twice it gives the same rows.  Partitions that the version replaced stay until
``remove_old_versions``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstats.operators.features import assemble, h2h_day_states, team_day_states
from matchstats.operators.model_store import Folder
from matchstats.session import remove_work_table, work_table

KEYS = {"team": ["team"], "pair": ["lo", "hi"]}
MANIFEST_DDL = "kind string, bucket int, year int, v int"
#: Partitions by the hash of a team or pair; with a year's days in each, a
#: partition's rows are bounded by teams / BUCKETS x 366.
BUCKETS = 16


def _placed(states: DataFrame, kind: str, buckets: int) -> DataFrame:
    bucket = F.pmod(F.xxhash64(*KEYS[kind]), F.lit(buckets)).cast("int")
    return states.withColumn("bucket", bucket).withColumn("year", F.year("date"))


def touched_ranges(rows: DataFrame) -> dict[str, DataFrame]:
    """Teams and pairs of the new matches ``rows`` with their first new day."""
    first = F.min("date").alias("since")
    teams = rows.select(F.explode(F.array("home_team", "away_team")).alias("team"), "date")
    pairs = rows.select(F.least("home_team", "away_team").alias("lo"), F.greatest("home_team", "away_team").alias("hi"), "date")
    return {"team": teams.filter("team IS NOT NULL AND date IS NOT NULL").groupBy("team").agg(first),
            "pair": pairs.filter("lo IS NOT NULL AND date IS NOT NULL").groupBy("lo", "hi").agg(first)}


def _computed(kind: str, master: DataFrame, shootouts: DataFrame | None, keys: list[str], only: DataFrame | None) -> DataFrame:
    if kind == "team":
        return team_day_states(master, shootouts, None, keys, only=only)
    return h2h_day_states(master, None, only=only)


def current_version(spark: SparkSession, path: str) -> int:
    return max([0, *map(int, Folder(spark, path).names("current"))])


def current_partitions(spark: SparkSession, path: str) -> list:
    """(kind, bucket, year, v) of every current partition: kinds x buckets x
    years rows."""
    n = current_version(spark, path)
    return spark.read.schema(MANIFEST_DDL).parquet(f"{path}/manifest/{n:08d}").collect() if n else []


def _read(spark: SparkSession, path: str, kind: str, parts: list) -> DataFrame | None:
    if not parts:
        return None
    base = f"{path}/{kind}"
    return spark.read.option("basePath", base).parquet(*[f"{base}/v={p['v']}/bucket={p['bucket']}/year={p['year']}" for p in parts])


def read_states(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The current daily states of ``kind`` (team or pair)."""
    return _read(spark, path, kind, [p for p in current_partitions(spark, path) if p["kind"] == kind]).drop("v", "bucket", "year")


def _publish(spark: SparkSession, path: str, number: int, parts: list[tuple]) -> None:
    spark.createDataFrame(parts, MANIFEST_DDL).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/{number:08d}")
    Folder(spark, path).create(f"current/{number:08d}")


def _next_version(spark: SparkSession, path: str) -> int:
    """A number that no writer has used, not even one that stopped."""
    folder, number = Folder(spark, path), current_version(spark, path) + 1
    while not folder.reserve(f"writers/{number:08d}"):
        number += 1
    return number


def _write(rows: DataFrame, path: str, kind: str, number: int) -> None:
    rows.repartition("bucket", "year").write.mode("overwrite").partitionBy("bucket", "year").parquet(f"{path}/{kind}/v={number}")


def build_states(master: DataFrame, shootouts: DataFrame | None, path: str, keys: list[str], buckets: int = BUCKETS) -> int:
    """Compute all states anew, as a version of their own."""
    spark, parts = master.sparkSession, []
    number = _next_version(spark, path)
    for kind in KEYS:
        _write(_placed(_computed(kind, master, shootouts, keys, None), kind, buckets), path, kind, number)
        written = spark.read.parquet(f"{path}/{kind}/v={number}").select("bucket", "year").distinct().collect()
        parts += [(kind, r["bucket"], r["year"], number) for r in written]
    _publish(spark, path, number, parts)
    return number


def repair_states(master: DataFrame, shootouts: DataFrame | None, rows: DataFrame, path: str, keys: list[str],
                  buckets: int = BUCKETS) -> list[tuple]:
    """Bring the states up to date after the matches ``rows`` (and their
    shootouts) were added to ``master``; returns the rewritten partitions
    (kind, bucket, year)."""
    spark, rewritten = master.sparkSession, []
    parts = {(p["kind"], p["bucket"], p["year"]): p["v"] for p in current_partitions(spark, path)}
    number = _next_version(spark, path)
    for kind, key in KEYS.items():
        since = work_table(touched_ranges(rows)[kind], f"touched-{kind}")
        states = _computed(kind, master, shootouts, keys, since.select(*key))
        fresh = work_table(_placed(states.join(since, key).filter("date >= since").drop("since"), kind, buckets), f"states-{kind}")
        places = fresh.select("bucket", "year").distinct().collect()
        changed = [(kind, r["bucket"], r["year"]) for r in places]
        old = _read(spark, path, kind, [{"bucket": b, "year": y, "v": parts[kind, b, y]} for _, b, y in changed
                                        if (kind, b, y) in parts])
        out = fresh
        if old is not None:
            kept = old.drop("v").join(since, key, "left").filter("since IS NULL OR date < since").drop("since")
            out = fresh.unionByName(kept)
        if changed:
            _write(out, path, kind, number)
        rewritten += changed
        for table in (since, fresh):
            remove_work_table(table)
    parts.update(dict.fromkeys(rewritten, number))
    _publish(spark, path, number, [(*k, v) for k, v in parts.items()])
    return sorted(rewritten)


def remove_old_versions(spark: SparkSession, path: str) -> None:
    """Remove partitions that the current version does not use."""
    folder, current = Folder(spark, path), current_partitions(spark, path)
    used = {(p["kind"], f"v={p['v']}", f"bucket={p['bucket']}", f"year={p['year']}") for p in current}
    newest = current_version(spark, path)
    for kind in KEYS:
        for v in folder.names(kind):
            if int(v.removeprefix("v=")) > newest:
                continue  # another writer's, not published yet
            for b in (x for x in folder.names(f"{kind}/{v}") if x.startswith("bucket=")):
                for y in folder.names(f"{kind}/{v}/{b}"):
                    if (kind, v, b, y) not in used:
                        folder.remove(f"{kind}/{v}/{b}/{y}")


def stored_features(queries: DataFrame, path: str, keys: list[str], keep_cols: list[str] | None = None) -> DataFrame:
    """W11 of matches that are in the stored table, from its states."""
    spark = queries.sparkSession
    keep = [c for c in (keep_cols or ["result", "match_weight"]) if c in queries.columns]
    q = queries.select(*dict.fromkeys([*keys, "date", "home_team", "away_team", "neutral", "tournament", "tournament_tier", *keep]))
    return assemble(q, read_states(spark, path, "team"), read_states(spark, path, "pair"), keys, keep)


def make_state_hook(path: str, keys: list[str], shootouts_path: str | None = None, ranges: list | None = None):
    """An ``on_batch`` step of ``run_ingest_stream``: repair the states after
    each micro-batch.  ``ranges`` collects the rewritten partitions."""
    def hook(spark: SparkSession, epoch_id: int, master_path: str, rows: DataFrame) -> None:
        shootouts = spark.read.parquet(shootouts_path) if shootouts_path else None
        got = repair_states(spark.read.parquet(master_path), shootouts, rows, path, keys)
        if ranges is not None:
            ranges.append((epoch_id, got))

    return hook
