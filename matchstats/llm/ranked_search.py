"""Ranked lexical search without random access (operator 11, NRA).

1. ``term_vectors``: one pass over the texts keeps, of every document, its
   length and the frequencies of the words that some item asks for (looked up
   in a bitmap of fixed size; what it lets through too much is dropped by the
   join with the items' terms).
2. Term weights come from document frequencies counted over all documents.
3. ``search``: each task cuts its documents into segments of bounded size and
   sorts every term's postings in a segment by falling impact.  The lists of
   an item are read in turn, a run at a time.  A document's score lies between
   the impacts read (lower) and these plus the next impact of each list where
   it was not met (upper).  Those whose upper end is under the k-th lower end
   leave; reading goes on until every document left has both ends equal, so
   that members, ties and scores are final.  The k-th score found so far is
   carried to the next segment; a first run over a sample of the documents
   gives all tasks a lower bound of it (it only saves reading).
4. The segments' best documents are ranked per item.

Defined results: null and empty texts hold no term and are never returned; an
item without a term has no rows; each row of the benchmark is an item and each
row of the documents a document of its own, repeated or not; equal scores go by
doc_id, null ones last; empty tables give no row; extra columns are ignored.
Words are told apart by 64-bit hashes.  Memory of a task: one segment; of the
driver: one block of items.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchstats.llm.common import bitmap_of, in_bitmap, ship_code, written
from matchstats.llm.wordtable import row_chunks, words

#: Documents returned per item.
TOP = 50
#: A segment ends with the document that brings it to so many postings.
SEGMENT_POSTINGS = 1 << 19
#: First run read from each list; each further one is four times as long.
FIRST_RUN = 256
#: Items searched together hold so many (item, term) pairs, or are one item.
BLOCK_PAIRS = 1 << 18
#: Share of the documents that give the first bound of the k-th score.
BOUND_SHARE = 1 / 64

VECTORS_DDL = "doc_id long, n long, terms array<long>, tfs array<int>"
FOUND_DDL = "item int, doc_id long, score long"


def _grouped(row: np.ndarray, h: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets by row, distinct hashes of each row, how often each stands there)."""
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(h)))
    return np.searchsorted(row[first], np.arange(rows + 1)), h[first], times


def term_vectors(docs: DataFrame, bitmap: bytes | None) -> DataFrame:
    """doc_id, n (terms with repeats), distinct terms and their frequencies of
    every row; only terms in ``bitmap``, if one is given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if bitmap is None else np.frombuffer(bitmap, np.uint64)
        for batch in batches:
            for a, b, data, off in row_chunks(batch.column("text")):
                w = words(data, off, "alnum", lower=True)
                keep = slice(None) if bits is None else in_bitmap(bits, w.hash)
                at, terms, times = _grouped(w.row[keep], w.hash[keep], b - a)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(w.counts(), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(terms.astype(np.int64))),
                     pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(times, pa.int32()))],
                    ["doc_id", "n", "terms", "tfs"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, VECTORS_DDL)


def item_terms(benchmark: DataFrame) -> DataFrame:
    """row, item_id and distinct terms of every benchmark row."""
    slim = benchmark.select(benchmark["item_id"].cast("long").alias("doc_id"), "text")
    return term_vectors(slim, None).select(F.monotonically_increasing_id().alias("row"),
                                           F.col("doc_id").alias("item_id"), "terms")


def weighted_items(items: DataFrame, vectors: DataFrame, n_docs: int) -> DataFrame:
    """item_id and, by term, the weights over 0 of every item."""
    asked = items.select("row", "item_id", F.explode("terms").alias("term"))
    df = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    share = (F.lit(2.0) * n_docs + 2) / (F.lit(2.0) * F.col("df") + 1)
    weight = F.floor(F.lit(1000.0) * F.log(share)).cast("long")
    weights = asked.select("term").distinct().join(df, "term").select("term", weight.alias("w")).filter("w > 0")
    return (asked.join(weights, "term").groupBy("row")
            .agg(F.first("item_id").alias("item_id"), F.sort_array(F.collect_list(F.struct("term", "w"))).alias("t")))


class Best:
    """An item's best documents so far, and the score that a further one needs."""

    def __init__(self, top: int, floor: int):
        self.top, self.floor = top, max(1, floor)
        self.score, self.doc, self.null = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        score, doc, null = (np.concatenate(x) for x in ((self.score, score), (self.doc, doc), (self.null, null)))
        order = np.lexsort((doc, null, -score))[: self.top]
        self.score, self.doc, self.null = score[order], doc[order], null[order]
        if len(order) == self.top:
            self.floor = max(self.floor, int(self.score[-1]))


def resolved(lists: list[tuple[int, np.ndarray, np.ndarray]], n: int, top: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, final scores) of a segment of ``n`` documents that may be
    among the best ``top``: all with at least ``floor`` and the k-th score.
    ``lists``: weight, documents and impacts, these falling, of each term."""
    lower, read, run = np.zeros(n, np.int64), [0] * len(lists), FIRST_RUN
    left = np.ones(n, dtype=bool)
    while True:
        following = []
        for k, (w, docs, impact) in enumerate(lists):
            part = docs[read[k]: read[k] + run]
            lower[part] += w * impact[read[k]: read[k] + run]
            read[k] += len(part)
            following.append(w * int(impact[read[k]]) if read[k] < len(docs) else 0)
        upper = lower + sum(following)
        for k, (_w, docs, _impact) in enumerate(lists):
            if following[k]:
                upper[docs[: read[k]]] -= following[k]
        if n > top:
            floor = max(floor, int(np.partition(lower, n - top)[n - top]))
        left &= upper >= floor
        if not (upper[left] > lower[left]).any():
            found = np.flatnonzero(left)
            return found, lower[found]
        run *= 4


def _segments(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple]:
    """(doc_ids, n, terms, frequencies, document of each posting) of runs of
    documents with about ``most`` postings."""
    held: list[tuple] = []
    size = 0

    def close() -> tuple:
        ids = pa.concat_arrays([x[0] for x in held])
        per_doc = np.concatenate([x[2] for x in held])
        return (ids, np.concatenate([x[1] for x in held]), np.concatenate([x[3] for x in held]),
                np.concatenate([x[4] for x in held]), np.repeat(np.arange(len(ids)), per_doc))

    for batch in batches:
        ends = batch.column("terms").offsets.to_numpy().astype(np.int64)
        terms = batch.column("terms").values.to_numpy()
        tfs, at = batch.column("tfs").values.to_numpy(), batch.column("tfs").offsets.to_numpy().astype(np.int64)
        n, row = batch.column("n").to_numpy(), 0
        while row < batch.num_rows:
            end = max(row + 1, int(np.searchsorted(ends, ends[row] + most - size, side="right")) - 1)
            held.append((batch.column("doc_id").slice(row, end - row), n[row:end], np.diff(ends[row: end + 1]),
                         terms[ends[row]: ends[end]], tfs[at[row]: at[end]]))
            size += int(ends[end] - ends[row])
            row = end
            if size >= most or row < batch.num_rows:
                yield close()
                held, size = [], 0
    if held:
        yield close()


def search(vectors: DataFrame, items: list[list[tuple[int, int]]], n_docs: int, n_terms: int, floors: list[int],
           top: int = TOP, most: int = SEGMENT_POSTINGS) -> DataFrame:
    """item (its place in ``items``), doc_id, score: each task's best documents
    of each item.  ``items``: (term, weight) pairs; ``floors``: scores that a
    document needs at least."""
    terms = np.unique(np.array([t for i in items for t, _ in i], np.int64))
    by_item = [(np.searchsorted(terms, np.array([t for t, _ in i], np.int64)), [w for _, w in i]) for i in items]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top, f) for f in floors]
        for ids, n, term, tf, doc in _segments(batches, most):
            place = np.minimum(np.searchsorted(terms, term), len(terms) - 1)
            asked = terms[place] == term
            place, tf, doc = place[asked], tf[asked].astype(np.int64), doc[asked]
            m = 100 - 50 + (50 * n[doc] * n_docs) // n_terms
            impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m)
            order = np.lexsort((-impact, place))
            place, doc, impact = place[order], doc[order], impact[order]
            heads = np.searchsorted(place, np.arange(len(terms) + 1))
            null = ids.is_null().to_numpy(zero_copy_only=False)
            numbers = ids.fill_null(0).to_numpy()
            for k, (at, weights) in enumerate(by_item):
                lists = [(w, doc[heads[t]: heads[t + 1]], impact[heads[t]: heads[t + 1]])
                         for t, w in zip(at, weights) if heads[t] < heads[t + 1]]
                if not lists:
                    continue
                found, score = resolved(lists, len(ids), top, best[k].floor)
                if len(found):
                    best[k].add(score, numbers[found], null[found])
        for k, b in enumerate(best):
            if len(b.score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(b.score), k, np.int32)), pa.array(b.doc, pa.int64(), mask=b.null),
                     pa.array(b.score)], ["item", "doc_id", "score"])

    return vectors.mapInArrow(run, FOUND_DDL)


def _ranked(found: DataFrame, item: str, top: int) -> DataFrame:
    w = Window.partitionBy(item).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)


def blocks(items: DataFrame, pairs: int = BLOCK_PAIRS) -> Iterator[list]:
    """The items' rows, a bounded number of (item, term) pairs at a time."""
    held, size = [], 0
    for r in items.toLocalIterator():
        if held and size + len(r["t"]) > pairs:
            yield held
            held, size = [], 0
        held.append(r)
        size += len(r["t"])
    if held:
        yield held


def ranked_search(docs: DataFrame, benchmark: DataFrame, top: int = TOP, segment: int = SEGMENT_POSTINGS,
                  pairs: int = BLOCK_PAIRS, share: float = BOUND_SHARE) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``top`` best documents."""
    spark = docs.sparkSession
    ship_code(spark)
    items = written(item_terms(benchmark), "items")
    asked = items.select(F.explode("terms").alias("term"))
    vectors = written(term_vectors(docs, bitmap_of(asked, "term")), "term-vectors")
    n_docs, n_terms = vectors.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    weighted = written(weighted_items(items, vectors, n_docs), "weighted-items")
    parts = []
    for block in blocks(weighted, pairs):
        lists = [[(x["term"], x["w"]) for x in r["t"]] for r in block]
        floors = [0] * len(block)
        some = search(vectors.sample(share, seed=1), lists, n_docs, n_terms, floors, top, segment)
        for r in _ranked(some, "item", top).filter(F.col("rank") == top).select("item", "score").collect():
            floors[r["item"]] = r["score"]  # one row for each item of the block at most
        names = spark.createDataFrame([(k, r["row"], r["item_id"]) for k, r in enumerate(block)],
                                      "item int, row long, item_id long")
        found = search(vectors, lists, n_docs, n_terms, floors, top, segment)
        parts.append(written(_ranked(found, "item", top).join(F.broadcast(names), "item")
                             .select("row", "item_id", "rank", "doc_id", "score"), "found"))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


#: The same rows by exhaustive scoring.
ORACLE_SQL = r"""
WITH doc_terms AS (
  SELECT doc_id, r, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT doc_id, text, row_number() OVER () AS r FROM documents)),
tf AS (SELECT r, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM doc_terms GROUP BY r, term),
len AS (SELECT r, sum(tf)::BIGINT AS n FROM tf GROUP BY r),
total AS (SELECT count(*) AS nd, sum(n)::BIGINT AS l FROM len),
weight AS (
  SELECT term, floor(1000 * ln((2 * any_value(nd) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, total GROUP BY term),
item_terms AS (
  SELECT DISTINCT q, item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT item_id, text, row_number() OVER () AS q FROM benchmark)),
scored AS (
  SELECT i.q, i.item_id, t.r, t.doc_id,
    sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 20 * (50 + (50 * len.n * total.nd) // total.l))))::BIGINT AS score
  FROM item_terms i JOIN weight w USING (term) JOIN tf t USING (term) JOIN len USING (r), total
  GROUP BY i.q, i.item_id, t.r, t.doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
  FROM scored WHERE score > 0)
WHERE rank <= 50
"""
