"""Corpus pipeline: quality rules, line dedup, n-gram Jaccard join, benchmark
decontamination and packing over the documents table.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before
it kept, and its decisions take effect.  All but the last return the columns of
documents.  ``run`` writes each stage's rows as Parquet to the shared folder
and reads them again as the next one's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchstats.llm.common import read_table, text_key, written
from matchstats.llm.decontam import decontaminate
from matchstats.llm.line_dedup import dedup_lines
from matchstats.llm.ngram_join import ngram_components
from matchstats.llm.packing import pack
from matchstats.llm.quality import quality_rules

#: Near duplicates share four fifths of their five-word shingles.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def _among(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, text) is among ``rows`` (doc_id, tkey);
    equal rows come back as often as they are there."""
    keyed = docs.withColumn("__tkey", text_key())
    keys = rows.select(F.col("doc_id").alias("__doc"), F.col("tkey").alias("__text")).distinct()
    same = keyed["doc_id"].eqNullSafe(keys["__doc"]) & (keyed["__tkey"] == keys["__text"])
    return keyed.join(keys, same, "left_semi").select(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality_rules(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return _among(docs, judged.filter("kept"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand earlier; n_chars follows."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]  # packed: their names can't meet the operator's
    out = dedup_lines(docs.select("doc_id", "text", F.struct(*rest).alias("rest")))
    chars = F.length("text").cast(dict(docs.dtypes)["n_chars"])
    n_chars = F.when(F.col("n_dropped") > 0, chars).otherwise(F.col("rest.n_chars")).alias("n_chars")
    return out.select(*[c if c in ("doc_id", "text") else n_chars if c == "n_chars" else F.col("rest")[c].alias(c) for c in docs.columns])


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest
    doc_id; of equal rows one."""
    found = written(ngram_components(docs, SHINGLE_WORDS, SIMILAR_PERCENT, 100), "groups")
    linked = found.filter("n_shingles > 0").groupBy("component_id").agg(F.min(F.struct("doc_id", "tkey")).alias("k"))
    unnamed = linked.select("k.*")
    single = found.filter("n_shingles = 0").select("doc_id", "tkey")
    kept = _among(docs, unnamed.union(single))
    w = Window.partitionBy("doc_id", text_key()).orderBy(*[c for c in docs.columns if c != "text"])
    return kept.withColumn("__copy", F.row_number().over(w)).filter("__copy = 1").select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    judged = decontaminate(docs, read_table(spark, sf_dir, "benchmark"))
    return _among(docs, judged.filter(~F.col("contaminated")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1,024 ids."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("ngram_join", ngram_join_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Bands from token statistics, near lines and similarity joins have no SQL
#: form; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return written(STAGES[-1][1](spark, docs, sf_dir), f"stage-{STAGES[-1][0]}")
