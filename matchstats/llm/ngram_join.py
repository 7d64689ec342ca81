"""N-gram Jaccard join as a blocked sparse matrix product (operator 7).

The matrix has a row per distinct set of word n-grams and a column per n-gram.
Rows are dealt into blocks by bounds from their sizes alone: with n-grams in
one order for all sets, two sets of similarity >= t agree in one of the first
n - ceil(t n) + 1 of each, and their sizes differ by the factor t at most.  So
a block is the rows of one size class that hold one such n-gram; frequent
n-grams come last in the order, which keeps blocks small.

Every row has a parity sketch: bit b tells whether the row's n-grams of hash b
are odd in number.  Bits that differ bound the symmetric difference of two rows
from below, and sizes give the largest difference of a similar pair, so pairs
beyond it are discarded without their columns.  For the rest the product is
computed: overlap counts of the rows' columns, against t * union.  First each
row meets its block's pivot; then, where rows of a block are not yet in one
component, all pairs of rows of different components meet, in tiles of ``TILE``
rows inside the tasks.  Of the pairs that pass their sketch a task first returns
those of a spanning forest of its components; once these are joined, all that
are left.  No pair is left out.

Defined results: texts without words (null, empty) have an empty set and are
linked with nothing; texts of fewer than n words have one n-gram, the whole;
equal sets are one row of the matrix, so copies cost one row; repeated rows
share a component; null doc_ids never name a component unless all are null;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchstats.llm.common import bitmap_of, dropped, in_bitmap, ship_code, text_key, written
from matchstats.llm.components import components
from matchstats.llm.wordtable import Words, mixed, row_chunks, run_hash, words

#: Size classes grow by this factor.
CLASS_RATIO = 1.5
#: N-grams that go to the end of the order, most frequent first; and how many
#: of them one task may propose (a proposal only orders, it drops nothing).
FREQUENT = 1 << 17
PROPOSED = 1 << 15
LEAST_PROPOSED = 4
#: Rows of a tile.
TILE = 512
#: Least bits of a sketch; it has a power of two of them, one per n-gram at least.
SKETCH_BITS = 64

_BOUNDS = np.unique(np.ceil(CLASS_RATIO ** np.arange(0, 80)).astype(np.int64))


def gram_sets(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct n-gram hashes row by row, offsets of the rows)."""
    at, h = w.windows(n)
    counts, heads = w.counts(), w.firsts()
    short = np.flatnonzero((counts > 0) & (counts < n))
    row = w.row[at]
    if len(short):
        whole = np.array([run_hash(w.hash, heads[r: r + 1], int(counts[r]))[0] for r in short], np.uint64)
        row, h = np.concatenate([row, short]), np.concatenate([h, whole])
        order = np.argsort(row, kind="stable")
        row, h = row[order], h[order]
    off = np.searchsorted(row, np.arange(w.rows + 1))
    for a, b in zip(off[:-1], off[1:]):
        h[a:b].sort()
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    total = np.concatenate([[0], np.cumsum(new)])
    return h[new], total[off]


def _each(docs: DataFrame, n: int, out, ddl: str, keep: bytes | None = None) -> DataFrame:
    """Runs ``out(batch columns, gram sets)`` over the texts (those whose tkey
    may be in the bitmap ``keep``, if given)."""
    ship_code(docs.sparkSession)
    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_key(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(keep, np.uint64) if keep is not None else None
        for batch in batches:
            if bits is not None:
                mine = in_bitmap(bits, batch.column("tkey").to_numpy().view(np.uint64))
                batch = batch.filter(pa.array(mine))
            for a, b, data, off in row_chunks(batch.column("text")):
                yield from out(batch.slice(a, b - a), *gram_sets(words(data, off, "space", lower=True), n))

    return slim.mapInArrow(run, ddl)


def _offsets(off: np.ndarray) -> pa.Array:
    return pa.array(off, pa.int32())


def _set_ids(grams: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One number per set, from its size and its n-grams in any order."""
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(grams + np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
        return mixed(total[off[1:]] - total[off[:-1]] + np.diff(off).astype(np.uint64)).astype(np.int64)


def sketches(grams: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words of all sketches, offsets)."""
    size = np.diff(off)
    bits = np.maximum(SKETCH_BITS, 1 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64))
    ends = np.concatenate([[0], np.cumsum(bits)])
    h = mixed(grams ^ np.uint64(0x2545F4914F6CDD1D))
    place = (h & np.repeat(bits - 1, size).astype(np.uint64)).astype(np.int64) + np.repeat(ends[:-1], size)
    odd = (np.bincount(place, minlength=int(ends[-1])) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64), ends // 64


def frequent_grams(docs: DataFrame, n: int) -> np.ndarray:
    """At most ``FREQUENT`` hashes, the most frequent last in the order."""
    def count(batch, grams, off):
        seen, times = np.unique(grams, return_counts=True)
        often = np.flatnonzero(times >= LEAST_PROPOSED)
        if len(often) > PROPOSED:
            often = often[np.argsort(-times[often], kind="stable")[:PROPOSED]]
        yield pa.RecordBatch.from_arrays([pa.array(seen[often].view(np.int64)), pa.array(times[often])], ["gram", "n"])

    counts = _each(docs, n, count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "gram").limit(FREQUENT).select("gram").toArrow()  # at most FREQUENT rows
    return top["gram"].to_numpy().view(np.uint64)


def describe(docs: DataFrame, n: int, num: int, den: int, frequent: np.ndarray) -> DataFrame:
    """doc_id, tkey, size, sid (the set's number), block keys and sketch of
    every row."""
    order = np.argsort(frequent)
    known, rank = frequent[order].copy(), (len(frequent) - order).astype(np.uint64)

    def keys(batch, grams, off):
        size = np.diff(off)
        place = mixed(grams) >> np.uint64(1)
        if len(known) and len(grams):
            at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
            hot = known[at] == grams
            place[hot] = np.uint64(1 << 63) + rank[at[hot]]
        kind = np.searchsorted(_BOUNDS, size, side="right")
        beyond = _BOUNDS[np.minimum(kind, len(_BOUNDS) - 1)]
        also = den * size >= num * beyond
        out, ends = [], [0]
        for i, (a, b) in enumerate(zip(off[:-1], off[1:])):
            m = int(size[i])
            take = m + (-num * m // den) + 1 if m else 0  # m - ceil(t m) + 1
            if take:
                first = grams[a:b][np.argpartition(place[a:b], take - 1)[:take]] if take < m else grams[a:b]
                with np.errstate(over="ignore"):
                    for k in (int(kind[i]), int(kind[i]) + 1)[: 1 + bool(also[i])]:
                        out.append(mixed(first + np.uint64(k) * np.uint64(0x9E3779B97F4A7C15)))
                take *= 1 + bool(also[i])
            ends.append(ends[-1] + take)
        flat = np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)
        sketch, at = sketches(grams, off)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("tkey"), pa.array(size, pa.int64()),
             pa.array(_set_ids(grams, off)), pa.ListArray.from_arrays(_offsets(np.array(ends)), pa.array(flat)),
             pa.ListArray.from_arrays(_offsets(at), pa.array(sketch))],
            ["doc_id", "tkey", "size", "sid", "keys", "sketch"])

    return _each(docs, n, keys, "doc_id long, tkey long, size long, sid long, keys array<long>, sketch array<long>")


def matrix_rows(docs: DataFrame, n: int, pairs: DataFrame, described: DataFrame) -> DataFrame:
    """sid and n-grams of every set of the pairs (a, b)."""
    wanted = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct()
    texts = described.groupBy("sid").agg(F.min("tkey").alias("tkey")).join(wanted, "sid", "left_semi")

    def rows(batch, grams, off):
        yield pa.RecordBatch.from_arrays(
            [pa.array(_set_ids(grams, off)), pa.ListArray.from_arrays(_offsets(off), pa.array(grams.view(np.int64)))],
            ["sid", "grams"])

    found = _each(docs, n, rows, "sid long, grams array<long>", keep=bitmap_of(texts, "tkey"))
    return found.join(wanted, "sid", "left_semi").dropDuplicates(["sid"])


def product_links(docs: DataFrame, n: int, pairs: DataFrame, described: DataFrame, num: int, den: int) -> DataFrame:
    """Those of the pairs (a, b) whose rows' product reaches the similarity."""
    matrix = written(matrix_rows(docs, n, pairs, described), "matrix")
    rows = pairs.join(matrix.select(F.col("sid").alias("a"), F.col("grams").alias("ga")), "a").join(
        matrix.select(F.col("sid").alias("b"), F.col("grams").alias("gb")), "b")
    overlap = F.size(F.array_intersect("ga", "gb"))
    links = rows.filter(F.lit(den) * overlap >= F.lit(num) * (F.size("ga") + F.size("gb") - overlap)).select("a", "b")
    links = written(links, "product-links")
    dropped(matrix)  # the largest work table
    return links


def most_different(size_a, size_b, num: int, den: int):
    """Largest symmetric difference of similar sets of these sizes: with
    overlap >= num * (a + b) / (den + num), a + b - 2 * overlap."""
    total = size_a + size_b
    return total - 2 * -((-num * total) // (den + num))


def pivot_pairs(blocks: DataFrame, rows: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (pivot, other row) of the blocks that pass sizes and sketches."""
    pairs = (blocks.filter("sid != pivot")
             .filter(F.lit(den) * F.least("size", "pivot_size") >= F.lit(num) * F.greatest("size", "pivot_size"))
             .select(F.col("pivot").alias("a"), F.col("sid").alias("b")).distinct())
    left = rows.select(F.col("sid").alias("a"), F.col("size").alias("na"), F.col("sketch").alias("sa"))
    right = rows.select(F.col("sid").alias("b"), F.col("size").alias("nb"), F.col("sketch").alias("sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (x, at), (y, to) = _padded(batch.column("sa")), _padded(batch.column("sb"))
            own = np.arange(batch.num_rows)
            differ = pair_distance(np.concatenate([x, y]), np.concatenate([at, to[1:] + at[-1]]), own, own + len(own))
            limit = most_different(batch.column("na").to_numpy(), batch.column("nb").to_numpy(), num, den)
            yield batch.select(["a", "b"]).filter(pa.array(differ <= limit))

    both = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "sa", "sb")
    return both.mapInArrow(run, "a long, b long")


def _padded(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(flat sketch words, offsets) of a list column."""
    off = lists.offsets.to_numpy()
    return lists.flatten().to_numpy().view(np.uint64), off - off[0]


def _taken(flat: np.ndarray, off: np.ndarray, at: np.ndarray, width: int, folded: int) -> np.ndarray:
    """Sketches of rows ``at`` (all of ``width`` words), folded to fewer words."""
    sketch = flat[off[at][:, None] + np.arange(width)]
    while sketch.shape[1] > folded:
        half = sketch.shape[1] // 2
        sketch = sketch[:, :half] ^ sketch[:, half:]
    return sketch


def tile_pairs(blocks: DataFrame, rows: DataFrame, roots: DataFrame, num: int, den: int, spanning: bool) -> DataFrame:
    """Pairs of rows of different components, of blocks that hold several,
    that pass sizes and sketches (pairs with the pivot were seen before); if
    ``spanning``, of each task's only those that join its components."""
    rooted = blocks.join(roots, blocks["sid"] == roots["node"], "left").select(
        "key", "sid", "pivot", F.coalesce("root", "sid").alias("root"))
    span = rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"),
                                     F.count("*").alias("members")).filter("lo != hi and members > 2")
    tiles = F.ceil(F.col("members") / TILE).cast("int")
    own = F.pmod(F.xxhash64("sid", F.lit(7)), F.col("tiles")).cast("int")
    dealt = (rooted.filter("sid != pivot").join(span.select("key", tiles.alias("tiles")), "key").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .select("key", "sid", "root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own"))
    full = dealt.join(rows.select("sid", "size", "sketch"), "sid").repartition("key", "i", "j").sortWithinPartitions(
        "key", "i", "j")

    def pairs_of(part: pa.Table, ends: np.ndarray) -> np.ndarray:
        """Pairs (a, b) of rows of one tile that pass; ends: each row's tile's end."""
        side, size, root, sid, i, j = (part[c].to_numpy() for c in ("own", "size", "root", "sid", "i", "j"))
        flat, off = _padded(part["sketch"].combine_chunks())
        found, left = [np.zeros((0, 5), np.int64)], np.arange(len(sid))
        for step in range(1, len(sid)):
            left = left[left + step < ends[left]]
            if not len(left):
                break
            a, b = left, left + step
            # tiles of two sides hold the pairs across them
            ok = (root[a] != root[b]) & ((i[a] == j[a]) | (side[a] != side[b]))
            ok &= den * np.minimum(size[a], size[b]) >= num * np.maximum(size[a], size[b])
            a, b = a[ok], b[ok]
            differ = pair_distance(flat, off, a, b)
            ok = differ <= most_different(size[a], size[b], num, den)
            a, b = a[ok], b[ok]
            found.append(np.stack([sid[a], sid[b], root[a], root[b], differ[ok]], axis=1))
        found = np.concatenate(found)
        if spanning:
            return _forest(found)
        return np.unique(np.sort(found[:, :2], axis=1), axis=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ends in _runs(batches, ["key", "i", "j"]):
            if len(pairs := pairs_of(part, ends)):
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return full.mapInArrow(run, "a long, b long").distinct()


def pair_distance(flat: np.ndarray, off: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of the sketches of rows a and b, pair by pair."""
    width = np.diff(off)
    out = np.zeros(len(a), np.int64)
    for wa, wb in set(zip(width[a].tolist(), width[b].tolist())):
        at = np.flatnonzero((width[a] == wa) & (width[b] == wb))
        x, y = _taken(flat, off, a[at], wa, min(wa, wb)), _taken(flat, off, b[at], wb, min(wa, wb))
        out[at] = np.bitwise_count(x ^ y).sum(axis=1)
    return out


def _forest(found: np.ndarray) -> np.ndarray:
    """Of rows (a, b, root of a, root of b, distance) the pairs that join
    components, the closest first."""
    found = found[np.argsort(found[:, 4], kind="stable")]
    _, first = np.unique(np.sort(found[:, 2:4], axis=1), axis=0, return_index=True)
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    out = []
    for k in np.sort(first):
        p, q = top(int(found[k, 2])), top(int(found[k, 3]))
        if p != q:
            up[p] = q
            out.append(k)
    return found[out, :2]


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole runs of rows with equal keys, some at a time, with the end of each
    row's run; a run that a batch cuts is kept for the next."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        if not table.num_rows:
            continue
        change = np.zeros(table.num_rows - 1, dtype=bool)
        for k in keys:
            c = table[k].to_numpy()
            change |= c[1:] != c[:-1]
        cuts = np.flatnonzero(change) + 1
        held = table.slice(cuts[-1]) if len(cuts) else table
        if len(cuts):
            yield table.slice(0, cuts[-1]), np.repeat(cuts, np.diff(cuts, prepend=0))
    if held is not None:
        yield held, np.full(held.num_rows, held.num_rows)


def ngram_components(docs: DataFrame, n: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """doc_id, tkey, n_shingles and component_id of every row of ``docs``; sets
    link when den * intersection >= num * union."""
    if not 7 * den <= 10 * num <= 10 * den:
        raise ValueError("the similarity must be from 0.7 to 1")
    described = written(describe(docs, n, num, den, frequent_grams(docs, n)), "gram-sets")
    full = described.filter("size > 0")
    one = full.select("sid", "size", "keys").dropDuplicates(["sid"])
    rows = full.select("sid", "size", "sketch").dropDuplicates(["sid"])
    w = Window.partitionBy("key")
    blocks = written(
        one.select(F.explode("keys").alias("key"), "sid", "size")
        .withColumn("p", F.min(F.struct("sid", "size")).over(w)).withColumn("last", F.max("sid").over(w))
        .filter(F.col("last") != F.col("p")["sid"])
        .select("key", "sid", "size", F.col("p")["sid"].alias("pivot"), F.col("p")["size"].alias("pivot_size")),
        "blocks")
    pairs = written(pivot_pairs(blocks, rows, num, den), "pivot-pairs")
    links = product_links(docs, n, pairs, full, num, den)
    dropped(pairs)
    roots = components(links)
    for spanning in (True, False):
        more = written(tile_pairs(blocks, rows, roots, num, den, spanning), "tile-pairs")
        if not more.isEmpty():
            found = product_links(docs, n, more, full, num, den)
            before, links = links, written(links.union(found), "tile-links")
            for table in (before, found):
                dropped(table)
            roots = components(links)
        dropped(more)
    for table in (blocks, links):
        dropped(table)

    rooted = described.join(roots, described["sid"] == roots["node"], "left").select(
        "doc_id", "tkey", F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.coalesce("root", "sid")).alias("root"))
    # a table of its own: the join below may then split a root with many rows
    names = written(rooted.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("least")), "least")
    return rooted.join(names, "root", "left").select(
        "doc_id", "tkey", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))
