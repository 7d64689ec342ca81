"""Tokeniser-fertility quality rules (operator 9).

One pass measures each text with a public vocabulary: characters per token,
share of byte-fallback tokens and entropy of its tokens, beside plain counts
of words, symbols and repetitions.  The corpus then sets the rejection bands:
for each language and length class (the bits of the token count) the median
and the quartiles of each measure over all documents; a document outside
median +/- ``WIDTH`` robust deviations in any measure is rejected.

Every document has a band.  A class of n rows weighs n against ``PRIOR_ROWS``
rows of what its language says at other, near lengths, that against the language at
all lengths, and that against all rows; so the bands change smoothly with the
counts and no count turns the verdict off.  What few rows leave unknown about
a language widens its bands by the spread between languages.

Defined results: null and empty texts have no words, fail the base rules and
are not kept; repeated rows are judged alike; a null language is a language of
its own; a text that is alone in its table is the middle of its band; an empty
table gives an empty result; extra columns of the input are ignored.
Very long texts are measured whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchstats.llm.common import ship_code, text_key, written
from matchstats.llm.tokens import memo, text_slices
from matchstats.llm.wordtable import CLASSES, string_hashes, text_bytes, words

#: Base rules: fewer words, or a larger share of words in repeated windows, fail.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
#: Words of a window that may repeat.
WINDOW = 3
#: Share of regular texts (measures normal round their class's centre) that the
#: bands may reject over all measures.  It gives the half width of a band in
#: robust deviations (quartile distance / 1.349): 4.15.  Then the least deviation
#: that counts, for each measure.
FALSE_REJECTION = 1e-4
WIDTH = NormalDist().inv_cdf(1 - FALSE_REJECTION / 2 / 3)
LEAST_SPREAD = {"chars_per_token": 0.03, "byte_share": 0.004, "entropy": 0.05}
#: Rows that a prior counts for (a quartile of twenty rows is known to a third
#: of a deviation), and the weight of a length class by its distance.
PRIOR_ROWS = 20
NEAR = 0.25

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_CHAR_START = np.ones(256, dtype=bool)
_CHAR_START[128:192] = False

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens"]
RATES = ["chars_per_token", "byte_share", "entropy"]


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated_words(w) -> np.ndarray:
    """Words in a window that occurs twice or more in its row."""
    at, h = w.windows(WINDOW)
    covered = np.zeros(len(w.hash) + 1, np.int64)
    if len(at):
        order = np.lexsort((h, w.row[at]))
        a, b = order[:-1], order[1:]
        same = (h[a] == h[b]) & (w.row[at[a]] == w.row[at[b]])
        twice = np.zeros(len(at), dtype=bool)
        twice[a[same]] = True
        twice[b[same]] = True
        first = at[twice]
        np.add.at(covered, first, 1)
        np.add.at(covered, first + WINDOW, -1)
    inside = np.cumsum(covered)[:-1] > 0
    return np.bincount(w.row[inside], minlength=w.rows)


def _duplicate_lines(texts: pa.Array, rows: int) -> np.ndarray:
    """Lines with a word that equal an earlier line of their row."""
    lists = pc.split_pattern(texts, "\n")
    per_row = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    lines = lists.flatten()
    row = np.repeat(np.arange(rows), per_row)
    data, off = text_bytes(lines)
    full = _per_row(CLASSES["space"][data], off) > 0
    h, row = string_hashes(lines)[full], row[full]
    order = np.lexsort((h, row))
    a, b = order[:-1], order[1:]
    again = (h[a] == h[b]) & (row[a] == row[b])
    return np.bincount(row[b[again]], minlength=rows)


def measure_texts(texts: pa.Array, tokens, byte_ids: np.ndarray) -> dict[str, np.ndarray]:
    """Counts and rates of each text of one slice."""
    texts = texts.fill_null("") if texts.null_count else texts
    rows = len(texts)
    data, off = text_bytes(texts)
    w = words(data, off, "space", lower=False)
    out = {"n_words": w.counts(), "word_chars": _per_row(CLASSES["space"][data] & _CHAR_START[data], off),
           "n_symbols": _per_row(_SYMBOL[data], off), "n_dup_lines": _duplicate_lines(texts, rows),
           "n_repeat_words": _repeated_words(w)}
    chars = _per_row(_CHAR_START[data], off)
    ids, ends = tokens.ids(texts)
    n = np.diff(ends)
    row = np.repeat(np.arange(rows), n)
    used, counts = np.unique(row * len(byte_ids) + ids, return_counts=True)
    share = counts / np.maximum(n, 1)[used // len(byte_ids)]
    least = np.maximum(n, 1)
    return out | {"n_tokens": n, "chars_per_token": chars / least,
                  "byte_share": np.bincount(row[byte_ids[ids]], minlength=rows) / least,
                  "entropy": np.bincount(used // len(byte_ids), weights=-share * np.log2(share), minlength=rows)}


def measure(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, tkey, lang and the measures of every row."""
    ship_code(docs.sparkSession)
    names = MEASURES + RATES
    ddl = ("doc_id long, tkey long, lang string, " + ", ".join(f"{c} long" for c in MEASURES) + ", "
           + ", ".join(f"{c} double" for c in RATES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path)
        byte_ids = np.array([sp.is_byte(i) for i in range(sp.get_piece_size())])
        tokens = memo(vocabulary_path)
        for batch in batches:
            for at, part in text_slices(batch.column("text")):
                got = measure_texts(part, tokens, byte_ids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(at, len(part)) for c in ("doc_id", "tkey", "lang")]
                    + [pa.array(got[c], pa.int64()) for c in MEASURES] + [pa.array(got[c], pa.float64()) for c in RATES],
                    ["doc_id", "tkey", "lang", *names])

    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_key(), docs["lang"].cast("string"), "text")
    return slim.mapInArrow(run, ddl)


def bands(m: DataFrame) -> DataFrame:
    """One row per language and length class: centre m_ and robust deviation
    s_ of each measure.  All tables but the first are as small as the result."""
    # exact quartiles of rounded values: few distinct values per class, and the
    # same bands whatever the order in which partial results meet
    quartiles = [F.percentile(F.round(c, 3), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q_{c}") for c in RATES]
    centres = [F.col(f"q_{c}")[1].alias(f"m_{c}") for c in RATES]
    spreads = [((F.col(f"q_{c}")[2] - F.col(f"q_{c}")[0]) / F.lit(1.349)).alias(f"s_{c}") for c in RATES]
    classes = written(
        m.rollup("band_size", "band_lang").agg(F.count("*").alias("n"), *quartiles).filter("band_size IS NOT NULL")
        .select("band_size", "band_lang", "n", *centres, *spreads), "classes")
    names = [f"{k}_{c}" for c in RATES for k in "ms"]
    prior = F.lit(float(PRIOR_ROWS))
    # a class is no prior of its own
    apart = F.abs(F.col("band_size") - F.col("size_2"))
    weight = F.when(apart > 0, F.col("n_2") * F.pow(F.lit(NEAR), apart)).otherwise(F.lit(0.0))

    def second(df: DataFrame, columns: list[str]) -> DataFrame:
        return df.select(*[c for c in ["band_lang"] if c in df.columns], F.col("band_size").alias("size_2"),
                         F.col("n").alias("n_2"), *[F.col(c).alias(f"{c}_2") for c in columns])

    # all rows by length
    whole = classes.filter("band_lang IS NULL").drop("band_lang")
    curve = (whole.crossJoin(second(whole, names)).groupBy("band_size", "n", *names)
             .agg(*[F.coalesce(F.try_divide(F.sum(weight * F.col(f"{c}_2")), F.sum(weight)), F.col(c)).alias(f"{c}_near") for c in names])
             .select("band_size", *[((F.col("n") * F.col(c) + prior * F.col(f"{c}_near")) / (F.col("n") + prior)).alias(f"{c}_all")
                                    for c in names]))
    own = classes.filter("band_lang IS NOT NULL").join(curve, "band_size").withColumns(
        {f"d_{c}": F.col(f"m_{c}") - F.col(f"m_{c}_all") for c in RATES})
    # languages: distance from all rows, and its spread between languages
    langs = own.groupBy("band_lang").agg(F.sum("n").alias("n_lang"), *[F.sum(F.col("n") * F.col(f"d_{c}")).alias(f"t_{c}") for c in RATES])
    known = F.col("n_lang") / (F.col("n_lang") + prior)
    between = langs.agg(*[(F.sum(known * F.pow(F.col(f"t_{c}") / F.col("n_lang"), 2)) / F.sum(known)).alias(f"b_{c}") for c in RATES])
    # near lengths of the language
    local = [f"{k}_{c}" for c in RATES for k in "ds"]
    near = own.join(second(own, local), "band_lang").groupBy("band_lang", "band_size").agg(
        F.sum(weight).alias("w"), *[F.sum(weight * F.col(f"{c}_2")).alias(f"{c}_near") for c in local])
    out = own.join(near, ["band_lang", "band_size"]).join(langs, "band_lang").crossJoin(between)

    def mixed_in(x, p):
        return (F.col("n") * x + prior * p) / (F.col("n") + prior)

    columns = []
    for c in RATES:
        offset = (F.col(f"d_{c}_near") + prior * F.col(f"t_{c}") / (F.col("n_lang") + prior)) / (F.col("w") + prior)
        spread = mixed_in(F.col(f"s_{c}"), (F.col(f"s_{c}_near") + prior * F.col(f"s_{c}_all")) / (F.col("w") + prior))
        spread = F.greatest(spread, F.lit(LEAST_SPREAD[c]))
        # all rows count this much in the centre, and so does their distance from the language
        share = prior / (F.col("n") + prior) * prior / (F.col("w") + prior) * prior / (F.col("n_lang") + prior)
        unknown = F.col(f"b_{c}") * share * share
        columns += [F.round(mixed_in(F.col(f"m_{c}"), F.col(f"m_{c}_all") + offset), 6).alias(f"m_{c}"),
                    F.round(F.sqrt(spread * spread + unknown), 6).alias(f"s_{c}")]
    return out.select("band_lang", "band_size", *columns)


def judged(measured: DataFrame) -> DataFrame:
    """Adds base_failed and kept.  Bands come from all measured rows: one row
    per language and length class, joined back (rows are combined before the
    shuffle, and the small side is left to the optimiser)."""
    base = F.coalesce(F.col("lang"), F.lit("")), F.length(F.bin("n_tokens"))
    m = measured.withColumns({"band_lang": base[0], "band_size": base[1]})
    odd = F.lit(False)
    for c in RATES:
        odd = odd | (F.abs(F.col(c) - F.col(f"m_{c}")) > F.lit(WIDTH) * F.col(f"s_{c}"))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(MOST_REPEATED_PERCENT) * F.col("n_words"))
    return (m.join(written(bands(m), "bands"), ["band_lang", "band_size"])
            .withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~odd))


def quality_rules(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """Measures and verdict of every row of ``docs``."""
    return judged(written(measure(docs, vocabulary_path), "quality")).select(
        "doc_id", *MEASURES[:-1], "base_failed", "kept", "tkey", "n_tokens", *RATES)
