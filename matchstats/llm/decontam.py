"""Benchmark decontamination by winnowing (operator 8).

Of every ``w`` consecutive k-word hashes the least (the rightmost, if equal)
is a fingerprint; with k + w - 1 = 13 words any shared span of 13 words shares
one.  Fingerprints of the benchmark go into a bitmap of fixed size.  Each
document's fingerprints are looked up there in the one pass over its text, and
the 13-word windows round those found are joined, by their words, with the
benchmark's windows: that extends a hit to all of the shared span and drops
false ones.  An item of fewer than 13 words is one window, looked up whole.

Defined results: null and empty texts have no words and are clean; a null or
empty item has no window; items that share a window all count; repeated rows
get the same result each; empty tables give no hit, or no row; extra columns
are ignored.  Only windows that hit travel, so a long text costs its own pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchstats.llm.common import bitmap_of, in_bitmap, ship_code, text_key, written
from matchstats.llm.wordtable import row_chunks, run_hash, words

#: Words of a window, and words of a hashed gram within it.
WINDOW = 13
GRAM = 8
#: A document is contaminated if at least one word in so many is hit.
ONE_IN = 20


def fingerprints(hashes: np.ndarray, row: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word of each window of one row, hash of its fingerprint)."""
    m = len(hashes) - window + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = run_hash(hashes, np.arange(len(hashes) - gram + 1), gram)
    least = grams[:m].copy()
    for j in range(1, window - gram + 1):
        np.minimum(least, grams[j: j + m], out=least)
    at = np.flatnonzero(row[:m] == row[window - 1:])
    return at, least[at]


def test_windows(benchmark: DataFrame, window: int, gram: int) -> DataFrame:
    """item_id, n (words of the window), words, fingerprint: a row per window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, _b, data, off in row_chunks(batch.column("text")):
                w = words(data, off, "alnum", lower=True)
                at, prints = fingerprints(w.hash, w.row, window, gram)
                counts, heads = w.counts(), w.firsts()
                short = np.flatnonzero((counts > 0) & (counts < window))
                rows = [(w.row[i], window, w.text(i, window), p) for i, p in zip(at, prints.astype(np.int64))]
                for r in short:
                    n, i = int(counts[r]), int(heads[r])
                    p = run_hash(w.hash, np.array([i]), n).astype(np.int64)[0]
                    rows.append((r, n, w.text(i, n), p))
                item = batch.column("item_id").take(pa.array([a + int(r[0]) for r in rows], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [item, pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.string()),
                     pa.array([int(r[3]) for r in rows], pa.int64())], ["item_id", "n", "words", "print"])

    slim = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), "text")
    return slim.mapInArrow(run, "item_id long, n int, words string, print long")


def candidates(docs: DataFrame, bitmap: bytes, short: list[int], window: int, gram: int) -> DataFrame:
    """doc_id, tkey, n_words and the windows whose fingerprint may be the
    benchmark's (start, n, words), one row per document.  ``short``: lengths of
    the items with fewer words than a window."""
    ddl = "doc_id long, tkey long, n_words long, found array<struct<start: long, n: int, words: string>>"
    found_type = pa.struct([("start", pa.int64()), ("n", pa.int32()), ("words", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap, np.uint64)
        for batch in batches:
            for a, b, data, off in row_chunks(batch.column("text")):
                w = words(data, off, "alnum", lower=True)
                heads = w.firsts()
                hits: list[list[dict]] = [[] for _ in range(b - a)]
                at, prints = fingerprints(w.hash, w.row, window, gram)
                sets = [(window, at, prints)]
                for n in short:
                    at_n, h = w.windows(n)
                    sets.append((n, at_n, h))
                for n, where, h in sets:
                    for i in where[in_bitmap(bits, h)]:
                        r = int(w.row[i])
                        hits[r].append({"start": int(i - heads[r]), "n": n, "words": w.text(i, n)})
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), batch.column("tkey").slice(a, b - a),
                     pa.array(w.counts(), pa.int64()), pa.array(hits, pa.list_(found_type))],
                    ["doc_id", "tkey", "n_words", "found"])

    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_key(), "text")
    return slim.mapInArrow(run, ddl)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and tkey of
    every row of ``docs``."""
    spark = docs.sparkSession
    ship_code(spark)
    tests = written(test_windows(benchmark, window, gram).distinct(), "test-windows")
    short = [r["n"] for r in tests.filter(F.col("n") < window).select("n").distinct().collect()]  # under ``window``
    scanned = written(candidates(docs, bitmap_of(tests, "print"), sorted(short), window, gram), "candidates")

    key = ["doc_id", "tkey"]
    windows = scanned.filter(F.size("found") > 0).dropDuplicates(key).select(*key, F.inline("found"))
    hits = windows.join(tests.select("words", "n", "item_id"), ["words", "n"])
    spans = F.array_sort(F.collect_set(F.struct("start", "n")))
    # words covered by the spans, in order of their starts
    covered = F.aggregate(
        F.col("spans"), F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("hit")),
        lambda s, x: F.struct(
            F.greatest(s["end"], x["start"] + x["n"]).alias("end"),
            (s["hit"] + F.greatest(F.lit(0).cast("long"), x["start"] + x["n"] - F.greatest(s["end"], x["start"]))
             ).alias("hit")))["hit"]
    ids = F.array_sort(F.collect_set(F.col("item_id").cast("string")))
    per_doc = hits.groupBy(*key).agg(spans.alias("spans"), ids.alias("ids")).select(
        *[F.col(c).alias(f"h_{c}") for c in key], covered.alias("hit"), "ids")
    n_hit, n_items = F.coalesce("hit", F.lit(0).cast("long")), F.coalesce(F.size("ids"), F.lit(0)).cast("long")
    same = F.col("doc_id").eqNullSafe(F.col("h_doc_id")) & (F.col("tkey") == F.col("h_tkey"))
    return scanned.drop("found").join(per_doc, same, "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.greatest(n_items, F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.concat_ws(",", "ids"), 256).alias("items_sha256"),
        ((n_hit > 0) & (F.lit(ONE_IN) * n_hit >= F.col("n_words"))).alias("contaminated"), "tkey")
