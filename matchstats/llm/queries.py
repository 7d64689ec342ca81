"""Registered queries of the operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from matchstats.llm.common import read_table
from matchstats.llm.decontam import decontaminate
from matchstats.llm.license_scan import scan_licenses
from matchstats.llm.line_dedup import dedup_lines
from matchstats.llm.ngram_join import ngram_components
from matchstats.llm.packing import pack
from matchstats.llm.pii import find_personal_data
from matchstats.llm.quality import quality_rules
from matchstats.llm.ranked_search import ORACLE_SQL as SEARCH_SQL
from matchstats.llm.ranked_search import ranked_search
from matchstats.llm.sentencepiece_codec import codec_digests
from matchstats.llm.token_counts import count_tokens
from matchstats.llm.toxicity import toxicity
from matchstats.llm.vector_codes import coded
from matchstats.llm.vector_codes import oracle_sql as codes_sql
from matchstats.llm.warc import archive_round_trip

PIECE_MODEL = "piece_bpe_32k.model"
BYTE_MODEL = "byte_bpe_50k.json"

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

#: Five bits at a time of the digest's hexadecimal digits.
WARC_SQL = """
WITH p AS (SELECT row_number() OVER () AS r, page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT *, strlen(payload) AS payload_bytes, sha1(payload) AS digest FROM p),
bits AS (SELECT r, list_reduce(list_transform(range(1, 41), lambda i:
    right('000' || bin(instr('0123456789abcdef', digest[i]) - 1), 4)), lambda a, b: a || b) AS b FROM d),
named AS (SELECT r, list_reduce(list_transform(range(0, 32), lambda i:
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + list_sum(list_transform(range(1, 6), lambda j:
      (b[5 * i + j] = '1')::INT * (1 << (5 - j))))::INT]), lambda a, b: a || b) AS payload_digest FROM bits),
last AS (SELECT payload, max(page_id) AS kept FROM d GROUP BY payload)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM d JOIN named USING (r) JOIN last USING (payload)"""

#: Every pair of documents that share a shingle is compared.
JOIN_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_SPACED}, []) AS w FROM documents),
shingles AS (
  SELECT DISTINCT r, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i:
    w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM docs),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
shared AS (SELECT a.r AS x, b.r AS y, count(*) AS common FROM shingles a JOIN shingles b USING (s) WHERE a.r < b.r GROUP BY a.r, b.r),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.r = x JOIN sizes q ON q.r = y WHERE 100 * common >= 90 * (p.n + q.n - common)),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (
  WITH RECURSIVE walk AS (SELECT x AS r, y AS o FROM edges UNION SELECT w.r, e.y FROM walk w JOIN edges e ON e.x = w.o)
  SELECT r, o FROM walk),
least AS (SELECT reach.r, min(d.doc_id) AS m FROM reach JOIN docs d ON d.r = reach.o GROUP BY reach.r)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, m) AS component_id
FROM docs LEFT JOIN sizes USING (r) LEFT JOIN least USING (r)"""

#: Every run of words as long as some window is compared with all windows.
DECONTAMINATION_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_ALNUM}, []) AS w FROM documents),
items AS (SELECT item_id, coalesce({_ALNUM}, []) AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS k, unnest(list_transform(range(1, greatest(len(w) - 12, 1) + 1), lambda i:
    array_to_string(w[i : i + least(len(w), 13) - 1], ' '))) AS s FROM items WHERE len(w) > 0),
runs AS (
  SELECT r, k, unnest(range(1, len(w) - k + 2)) AS i, unnest(list_transform(range(1, len(w) - k + 2), lambda i:
    array_to_string(w[i : i + k - 1], ' '))) AS s FROM docs, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k),
hits AS (SELECT r, i, k, item_id FROM runs JOIN windows USING (k, s)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hits) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT r, item_id::VARCHAR AS item_id FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN found USING (r)"""

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return add


@query("op1_warc", WARC_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written as WARC files and read back."""
    return archive_round_trip(read_table(spark, sf_dir, "pages"))


@query("op2_license_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and labels of all documents."""
    return scan_licenses(read_table(spark, sf_dir, "documents")).drop("tkey")


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents through a fresh digest cache."""
    return count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


@query("op4_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1,024 ids."""
    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_MODEL))


@query("op5_pii")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return find_personal_data(read_table(spark, sf_dir, "documents")).drop("tkey")


@query("op6_line_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines that stand, or nearly stand, earlier."""
    return dedup_lines(read_table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_dropped")


@query("op7_ngram_join", JOIN_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingles are 90 % alike."""
    return ngram_components(read_table(spark, sf_dir, "documents"), 3, 90, 100).drop("tkey")


@query("op8_decontamination", DECONTAMINATION_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of 13 words in all documents."""
    return decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("tkey")


@query("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fertility and base quality rules over all documents."""
    return quality_rules(read_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL)).drop("tkey")


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    return toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op11_ranked_search", SEARCH_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of each benchmark item."""
    return ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query("op12_sentencepiece")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of all documents and of the texts they decode to."""
    return codec_digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


@query("op13_vector_codes", codes_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors, 8 parts of 16 entries each."""
    return coded(read_table(spark, sf_dir, "embeddings"))
