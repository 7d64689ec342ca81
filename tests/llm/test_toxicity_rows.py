"""Operator 10 learns from every labelled row, with its whole text (brute force on rows built here)."""

import numpy as np

from matchstats.llm import toxicity as T


def rows(n, words, seed):
    rng = np.random.default_rng(seed)
    vocabulary = np.array([f"longword{i}" for i in range(40)])
    out, labels = [], []
    for i in range(n):
        own, toxic = rng.choice(vocabulary, words), int(i % 3 == 0)
        if toxic:
            own[-4:] = ["vile", "rotten", "vile", "nasty"]  # at the end
        out.append((i, " ".join(own), "en"))
        labels.append((i, toxic))
    return out, labels


def frames(spark, n, words, seed=3):
    out, labels = rows(n, words, seed)
    return spark.createDataFrame(out, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_long_texts_are_learnt_from(spark):
    docs, labels = frames(spark, 100, 6_000)
    assert docs.selectExpr("min(length(text))").first()[0] > 60_000
    out = T.toxicity(docs, labels).join(labels, "doc_id").toPandas()
    assert out.score.nunique() > 1
    held = out[out.held_out]
    assert held[held.toxic == 1].score.mean() > held[held.toxic == 0].score.mean()


def test_every_labelled_row_is_kept(spark):
    docs, labels = frames(spark, 9000, 4)
    kept = T.labelled_rows(docs, labels)
    want = labels.filter(~T.held_out())
    assert want.count() > 4500
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(r[0] for r in want.select("doc_id").collect())
    packed = T.dealt_to_shards(kept, 5).collect()
    texts, shards = [], [r["shard"] for r in packed]
    for r in packed:
        off = np.frombuffer(bytes(r["offsets"]), np.int64)
        own = [bytes(r["data"])[a:b].decode() for a, b in zip(off, off[1:])]
        texts += zip(own, np.frombuffer(bytes(r["labels"]), np.int8).tolist())
    assert sorted(shards) == sorted(set(shards)) and len(shards) > 1
    assert sorted(texts) == sorted((r["text"], r["toxic"]) for r in kept.collect())


def test_the_model_does_not_depend_on_the_layout(spark, monkeypatch):
    monkeypatch.setattr(T, "SHARD_BYTES", 20_000)
    docs, labels = frames(spark, 300, 60)
    a = T.train(docs.repartition(7), labels)
    b = T.train(docs.repartition(2, "text"), labels.repartition(3))
    assert a.trained and np.array_equal(a.tables, b.tables) and np.array_equal(a.out, b.out)
    assert np.isclose(a.scale, b.scale, rtol=1e-3) and np.isclose(a.shift, b.shift, rtol=1e-2, atol=1e-2)


def test_cut_of_counts_is_the_best_one(spark):
    rng = np.random.default_rng(1)
    rows_ = [(lang, int(b), int(n), int(rng.integers(0, n + 1))) for lang in ("a", "b") for b, n in
             zip(rng.choice(400, 40, replace=False), rng.integers(1, 9, 40))]
    got = {r["lang"]: r for r in T._best_cuts(spark.createDataFrame(rows_, "lang string, bin int, n long, hits long")).collect()}
    for lang in ("a", "b"):
        own = sorted((r[1:] for r in rows_ if r[0] == lang), reverse=True)
        f1 = [2 * sum(h for _, _, h in own[: k + 1]) / (sum(n for _, n, _ in own[: k + 1]) + sum(h for _, _, h in own)) for k in range(40)]
        k = int(np.argmax(f1))
        assert got[lang]["high"] == own[k][0] and got[lang]["low"] == (own[k + 1][0] if k < 39 else None)
