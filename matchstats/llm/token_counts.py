"""Token counts through a digest cache (operator 3).

The SHA-256 of a text's UTF-8 bytes (null: the empty text) is joined, with a
digest of the tokenizer's file and library version, to stored counts.  Only
distinct texts that the cache lacks are encoded; their counts are appended to
the cache, a Parquet folder that later runs and other tables share.

Defined results: null and empty texts count 0 bytes and 0 tokens; repeated
rows each get the count of their text; an empty table gives an empty result;
extra columns of the input are ignored.  Very long texts are encoded whole.
Rows of one text are combined before each shuffle, and the join back is by
digest over narrow rows, which Spark splits when one digest is frequent.
"""

from __future__ import annotations

import hashlib
from importlib.metadata import version

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstats.llm.common import ship_code, work_path
from matchstats.llm.tokens import memo, text_slices

#: Documents of more tokens are over the limit.
TOKEN_LIMIT = 4096
CACHE_SCHEMA = "digest binary, tokenizer binary, n_tokens long"


def tokenizer_digest(path: str) -> bytes:
    """Names the exact tokenizer: its file and its library's version."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + f"\n{library} {version(library)}".encode()).digest()


def read_cache(spark: SparkSession, path: str, tokenizer: bytes) -> DataFrame:
    """Stored counts of one tokenizer, one row per digest (two runs that
    appended the same text at once left the same count twice)."""
    try:
        stored = spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], CACHE_SCHEMA)
    stored = stored.filter(F.col("tokenizer") == F.lit(bytearray(tokenizer)))
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str | None = None,
                 limit: int = TOKEN_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``."""
    spark = docs.sparkSession
    ship_code(spark)
    cache_path = cache_path or work_path(spark, "token-cache")
    name = tokenizer_digest(tokenizer_path)
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"))

    def encode(batches):
        counts = memo(tokenizer_path)
        for batch in batches:
            for at, part in text_slices(batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("digest").slice(at, len(part)), pa.array([name] * len(part), pa.binary()),
                     pa.array(counts.counts(part))], ["digest", "tokenizer", "n_tokens"])

    known = read_cache(spark, cache_path, name)
    misses = keyed.select("digest", "text").dropDuplicates(["digest"]).join(known, "digest", "left_anti")
    misses.mapInArrow(encode, CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    counts = read_cache(spark, cache_path, name)
    narrow = keyed.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    return narrow.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
