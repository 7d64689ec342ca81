"""Columns of the input that are named like those the operators and stages work with."""

from pyspark.sql import functions as F

from tests.llm.test_operators import SCHEMA, sample_rows

CLASHING = ["n_lines", "n_dropped", "kept_lines", "tkey", "k_doc", "k_key", "copy", "sid", "root", "size", "kept", "rest", "n_words",
            "contaminated", "line", "h"]


def clashing(spark):
    docs = spark.createDataFrame(sample_rows(), SCHEMA)
    return docs, docs.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING])


def rows_of(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=str)


def test_operators_with_clashing_columns(spark):
    import public_tokenizers
    from matchstats.llm.line_dedup import dedup_lines
    from matchstats.llm.ngram_join import ngram_components
    from matchstats.llm.quality import quality_rules
    docs, more = clashing(spark)
    out, want = dedup_lines(more), dedup_lines(docs)
    assert rows_of(out, want.columns) == rows_of(want, want.columns)
    kept = [c for c in CLASHING if c not in ("n_lines", "n_dropped", "tkey")]
    assert all(r[c] == f"own {c}" for r in out.collect() for c in kept)
    columns = ["doc_id", "n_shingles", "component_id"]
    assert rows_of(ngram_components(more), columns) == rows_of(ngram_components(docs), columns)
    path = public_tokenizers.path("piece_bpe_32k.model")
    columns = ["doc_id", "n_words", "kept"]
    assert rows_of(quality_rules(more, path), columns) == rows_of(quality_rules(docs, path), columns)


def test_pipeline_stages_with_clashing_columns(spark, scratch):
    import corpus_pipeline
    docs, more = clashing(spark)
    spark.createDataFrame([(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14")], "item_id long, text string").write.parquet(
        f"{scratch}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out, want = stage(spark, more, scratch), stage(spark, docs, scratch)
        assert out.columns == more.columns, name
        assert rows_of(out, docs.columns) == rows_of(want, docs.columns), name
        assert all(r[c] == f"own {c}" for r in out.collect() for c in CLASHING), name
