"""Stored feature states after late data: any arrival order equals a rebuild, only touched ranges are rewritten."""

import datetime as dt
import itertools
import json

import pytest
from pyspark.sql import functions as F

from matchstats.operators.features import build_features
from matchstats.operators.master import complete_matches
from matchstats.plans.pipeline import fixture_inputs
from matchstats.streaming import states as ST
from matchstats.streaming.ingest import run_ingest_stream
from tests.conftest import SF0001
from tests.helpers import master_of, shootouts_of

KEYS = ["match_id"]
D = dt.date


@pytest.fixture(scope="module")
def inputs(spark):
    inp = fixture_inputs(spark, SF0001)
    return inp.master.persist(), inp.shootouts.persist()


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_any_arrival_order_equals_a_rebuild(spark, inputs, scratch):
    master, shootouts = inputs
    want = rows_of(build_features(master, shootouts, keys=KEYS))
    cuts = [D(1900, 1, 1), D(1996, 3, 1), D(1998, 6, 15), D(2100, 1, 1)]
    parts = [master.filter((F.col("date") >= a) & (F.col("date") < b)) for a, b in zip(cuts, cuts[1:])]
    for k, order in enumerate(itertools.permutations(range(3))):
        if k % 2:
            continue
        path, here = f"{scratch}/{k}", parts[order[0]]
        ST.build_states(here, shootouts, path, KEYS, buckets=3)
        for i in order[1:]:
            here = here.union(parts[i])
            ST.repair_states(here, shootouts, parts[i], path, KEYS, buckets=3)
        assert rows_of(ST.stored_features(complete_matches(master), path, KEYS)) == want
        assert ST.repair_states(master, shootouts, parts[order[-1]], path, KEYS, buckets=3)  # once more: nothing changes
        assert rows_of(ST.stored_features(complete_matches(master), path, KEYS)) == want
        ST.remove_old_versions(spark, path)
        assert rows_of(ST.stored_features(complete_matches(master), path, KEYS)) == want


GAMES = [(i, D(2000 + i // 4, 1 + i % 4, 3), a, b, i % 3, (i + 1) % 2) for i, (a, b) in enumerate(
    [("A", "B"), ("C", "D"), ("A", "C"), ("B", "D"), ("A", "D"), ("C", "B"), ("D", "C"), ("B", "A")] * 2)]


def test_only_touched_ranges_are_rewritten(spark, scratch):
    late = [g for g in GAMES if g[0] == 9]  # C - D on 2002-02-03
    early = [g for g in GAMES if g[0] != 9]
    base, full = master_of(spark, early), master_of(spark, GAMES)
    n = ST.build_states(base, None, scratch, KEYS, buckets=64)
    before = {(p["kind"], p["bucket"], p["year"]): p["v"] for p in ST.current_partitions(spark, scratch)}
    assert set(before.values()) == {n}
    got = ST.repair_states(full, None, master_of(spark, late), scratch, KEYS, buckets=64)
    place = {t: spark.sql(f"SELECT pmod(xxhash64('{t}'), 64)").first()[0] for t in "ABCD"}
    pair = spark.sql("SELECT pmod(xxhash64('C', 'D'), 64)").first()[0]
    want = {("team", place[t], y) for t in "CD" for y in (2002, 2003)} | {("pair", pair, y) for y in (2002, 2003)}
    played = {("pair", pair, g[1].year) for g in GAMES if {g[2], g[3]} == {"C", "D"}}
    assert set(got) == {w for w in want if w[0] == "team" or w in played}
    after = {(p["kind"], p["bucket"], p["year"]): p["v"] for p in ST.current_partitions(spark, scratch)}
    assert {k for k, v in after.items() if v != n} == set(got)
    # what stands in rewritten partitions but outside the ranges is kept
    q = complete_matches(full)
    assert rows_of(ST.stored_features(q, scratch, KEYS)) == rows_of(build_features(full, None, keys=KEYS))


@pytest.mark.parametrize("step", ["_write", "_publish"])
def test_a_stopped_repair_changes_nothing(spark, scratch, monkeypatch, step):
    base, full = master_of(spark, GAMES[:10]), master_of(spark, GAMES)
    ST.build_states(base, None, scratch, KEYS)
    want = rows_of(ST.read_states(spark, scratch, "team"))

    def stop(*a):
        raise RuntimeError("stopped")

    monkeypatch.setattr(ST, step, stop)
    with pytest.raises(RuntimeError):
        ST.repair_states(full, None, master_of(spark, GAMES[10:]), scratch, KEYS)
    monkeypatch.undo()
    assert rows_of(ST.read_states(spark, scratch, "team")) == want
    ST.repair_states(full, None, master_of(spark, GAMES[10:]), scratch, KEYS)
    assert rows_of(ST.stored_features(complete_matches(full), scratch, KEYS)) == rows_of(build_features(full, None, keys=KEYS))


def test_the_stream_repairs_after_each_batch(spark, scratch):
    """Files arrive latest first; shootouts of new matches count, too."""
    so = shootouts_of(spark, [(1, D(2000, 2, 3), "C", "D", "C", None)])
    master_path, states, shoot, feed = (f"{scratch}/{x}" for x in ("master", "states", "shootouts", "feed"))
    master_of(spark, GAMES[:6]).write.parquet(master_path)
    so.write.parquet(shoot)
    ST.build_states(spark.read.parquet(master_path), so, states, KEYS)
    import os
    os.makedirs(feed)
    for k, g in enumerate(reversed(GAMES[6:])):
        level = g[4] == g[5]
        with open(f"{feed}/{k:03d}.json", "w") as f:
            f.write(json.dumps({"match_id": g[0], "date": str(g[1]), "home_team": g[2], "away_team": g[3], "home_score": g[4],
                                "away_score": g[5], "tournament": "Friendly", "neutral": False,
                                "shootout_winner": g[2] if level else None}) + "\n")
    ranges = []
    run_ingest_stream(spark, feed, master_path, f"{scratch}/work", KEYS, max_files_per_trigger=4, shootouts_path=shoot,
                      on_batch=ST.make_state_hook(states, KEYS, shoot, ranges))
    master = spark.read.parquet(master_path)
    assert master.count() == len(GAMES) and len(ranges) >= 2 and all(r for _, r in ranges)
    got = ST.stored_features(complete_matches(master), states, KEYS)
    assert rows_of(got) == rows_of(build_features(master, spark.read.parquet(shoot), keys=KEYS))


def test_late_data_repair_computes_its_inputs_once(spark, monkeypatch):
    """Each step reads the slim matches and the shootouts from the shared folder, not from the raw tables again."""
    from matchstats.operators.features import MASTER_FEATURE_COLS
    from matchstats.plans import catalog_ingest as CI
    seen = []
    monkeypatch.setattr(CI, "build_states", lambda master, shootouts, *a: seen.append((master, shootouts)))
    monkeypatch.setattr(CI, "repair_states", lambda master, shootouts, *a: seen.append((master, shootouts)))
    monkeypatch.setattr(CI, "stored_features", lambda queries, *a: queries)
    CI.q_late_data_repair(spark, SF0001)
    assert len(seen) == 3
    for master, shootouts in seen:
        assert set(master.columns) == {*KEYS, *MASTER_FEATURE_COLS}
        assert master.inputFiles() and all("/work-master-" in f for f in master.inputFiles())
        assert shootouts.inputFiles() and all("/work-shootouts-" in f for f in shootouts.inputFiles())
