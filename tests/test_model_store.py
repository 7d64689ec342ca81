"""Versioned model store: a writer that stops between its steps leaves the old model in place."""

import pytest
from pyspark.sql import functions as F

from matchstats.operators import learn as L
from matchstats.operators import model_store as M

FEATS = ["a", "b"]


@pytest.fixture(scope="module")
def fm(spark):
    return spark.range(400).select(
        F.col("id").alias("match_id"), (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"),
        F.lit(2).alias("match_weight"), F.element_at(F.array(*map(F.lit, ["home_win", "draw", "away_win"])),
                                                     ((F.col("id") % 7) % 3 + 1).cast("int")).alias("result"))


def scores(model, df):
    return [[round(v, 9) for v in r] for r in L.score(model, df).orderBy("match_id").select("p_home", "p_draw", "p_away").collect()]


def test_versions(spark, fm, scratch):
    data = L.prepare(fm, FEATS)
    with pytest.raises(FileNotFoundError):
        L.load_model(scratch)
    small = {"maxIter": 2, "maxDepth": 2, "numTrees": 3}
    for i, name in enumerate(L.MODEL_NAMES):
        model = L.fit(data, name, FEATS, small)
        assert L.save_model(model, scratch, name) == i + 1
        assert M.manifest(spark, scratch)["model_name"] == name
        assert scores(L.load_model(scratch), data) == scores(model, data)
    assert M.versions(spark, scratch) == [1, 2, 3, 4]
    assert M.manifest(spark, scratch, 1)["model_name"] == L.MODEL_NAMES[0]


@pytest.mark.parametrize("stop_at", ["_taken", "model", "manifest.json", "current/"])
def test_a_stopped_writer_leaves_the_old_model(spark, fm, scratch, monkeypatch, stop_at):
    data = L.prepare(fm, FEATS)
    params = {"numTrees": 3, "maxDepth": 2}
    old, new = (L.fit(data.filter(f"match_id % 3 = {k}"), "extra_trees", FEATS, params) for k in (0, 1))
    L.save_model(old, scratch, "old")
    real = M.Folder.create

    def create(self, name, data=b""):
        if stop_at in name or (stop_at == "model" and name.endswith("manifest.json")):
            raise RuntimeError("stopped")
        return real(self, name, data)

    monkeypatch.setattr(M.Folder, "create", create)
    with pytest.raises(RuntimeError):
        L.save_model(new, scratch, "new")
    monkeypatch.undo()
    assert M.manifest(spark, scratch)["model_name"] == "old"
    assert scores(L.load_model(scratch), data) == scores(old, data)
    L.save_model(new, scratch, "new")
    assert scores(L.load_model(scratch), data) == scores(new, data)


def test_train_all_refits_and_saves_the_best(spark, fm, scratch):
    small = {n: {"maxIter": 2, "maxDepth": 3, "numTrees": 4} for n in L.MODEL_NAMES}
    board, best, model = L.train_all(fm, FEATS, ["match_id"], scratch, params=small, n_splits=3)
    rows = board.collect()
    assert sorted(r["model"] for r in rows) == sorted(L.MODEL_NAMES) and rows[0]["model"] == best
    assert rows[0]["f1_weighted_mean"] == max(r["f1_weighted_mean"] for r in rows)
    found = M.manifest(spark, scratch)
    assert found["model_name"] == best and [r["model"] for r in found["metrics"]] == [r["model"] for r in rows]
    data = L.prepare(fm, FEATS)
    assert scores(L.load_model(scratch), data) == scores(model, data)
