"""Vector code compression by Drake-Hamerly adaptive bounds (operator 13).

Vectors become integers, are cut into equal parts, and each part position gets
a codebook by rounds of assigning and averaging in whole numbers.  With every
vector its parts' bounds are kept from round to round: an upper bound of the
distance to the assigned entry, the ``b`` closest other entries with a lower
bound each, in order, and one outer bound for all the rest.  A round moves the
bounds by how far the entries moved.  Where the upper bound is below all others
the assignment stands; else the distance to the assigned entry is computed, then
those to the kept entries whose bound does not exclude them, and to all entries
only if the outer bound does not hold.  These are compared as integers, ties to
the lower index.  ``b`` follows what the parts needed in the round before.

Each round is one pass without a shuffle: vectors with their bounds, and each
task's sums per entry, are written to the shared folder; sums of all tasks
give the next codebooks (as many numbers as entries times dimensions).  The
rows of the round before are removed then.

Defined results: rows whose vector is null or holds a null or non-finite
component are dropped, also vectors of another length than that of the smallest
kept vec_id; null vec_ids count as the largest; of repeated vec_ids the least
vector starts an entry, and every row is coded; with fewer than 16 ids the
codebooks are shorter; an empty table gives no row; extra columns are ignored.
A length that can't be cut equally, or a component beyond 2^26 after scaling,
raises ValueError.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchstats.llm.common import dropped, ship_code, written
from matchstats.llm.wordtable import text_bytes

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Integers beyond this could overflow the 64-bit distances.
LARGEST = 1 << 26
#: Bounds kept per part: between these shares of the entries, at first the middle one.
LEAST_SHARE, FIRST_SHARE, MOST_SHARE = 8, 4, 2
#: A round may leave one part in so many beyond its bounds.
BEYOND = 100
#: Groups of labels up to this number are joined as a broadcast table.
BROADCAST_LABELS = 1 << 16
#: Parts of a large group of one label.
SALT = 32
NONE = 255

STATE_DDL = ("vec_id long, label {label}, ints array<int>, bounds binary, error long, part int, entry int, n long, "
             "sums array<long>")
NAMES = ["vec_id", "label", "ints", "bounds", "error", "part", "entry", "n", "sums"]


def _up(x: np.ndarray) -> np.ndarray:
    """Float32 not below the value; infinity stays."""
    return np.nextafter((x * (1 + 1e-12)).astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    """Float32 not above the value; infinity stays."""
    y = (x * (1 - 1e-12)).astype(np.float32)
    return np.where(np.isinf(y), y, np.nextafter(y, np.float32(-np.inf)))


class Bounds:
    """Bounds of one part position of many vectors."""

    def __init__(self, n: int, b: int):
        self.assigned = np.zeros(n, np.uint8)
        self.near = np.full((n, b), NONE, np.uint8)
        self.upper = np.full(n, np.inf, np.float32)
        self.lower = np.full((n, b), np.inf, np.float32)
        self.outer = np.zeros(n, np.float32)

    @staticmethod
    def width(b: int) -> int:
        return 9 + 5 * b

    def bytes(self) -> np.ndarray:
        n = len(self.assigned)
        parts = (self.assigned, self.near, self.upper, self.lower, self.outer)
        return np.concatenate([np.ascontiguousarray(x).view(np.uint8).reshape(n, -1) for x in parts], axis=1)

    @classmethod
    def read(cls, raw: np.ndarray, b: int) -> "Bounds":
        out, n = cls(0, 0), len(raw)
        cuts = np.cumsum([0, 1, b, 4, 4 * b, 4])
        a, near, up, low, outer = (raw[:, i:j].copy() for i, j in zip(cuts[:-1], cuts[1:]))
        out.assigned, out.near = a[:, 0], near
        out.upper, out.outer = up.view(np.float32)[:, 0], outer.view(np.float32)[:, 0]
        out.lower = low.view(np.float32) if b else np.zeros((n, 0), np.float32)
        return out

    def moved(self, moves: np.ndarray) -> None:
        """The entries went at most so far."""
        self.upper = _up(self.upper.astype(np.float64) + moves[self.assigned])
        by_near = np.append(moves, [0.0] * (256 - len(moves)))[self.near]
        self.lower = _down(self.lower.astype(np.float64) - by_near)
        self.outer = _down(self.outer.astype(np.float64) - moves.max())
        self.ordered(slice(None))

    def ordered(self, rows) -> None:
        order = np.argsort(self.lower[rows], axis=1, kind="stable")
        self.lower[rows] = np.take_along_axis(self.lower[rows], order, 1)
        self.near[rows] = np.take_along_axis(self.near[rows], order, 1)

    def resized(self, b: int) -> None:
        """Keep ``b`` bounds; those dropped go into the outer one."""
        have = self.near.shape[1]
        if b < have:
            self.outer = np.minimum(self.outer, self.lower[:, b])
            self.near, self.lower = self.near[:, :b].copy(), self.lower[:, :b].copy()
        elif b > have:
            n, more = len(self.assigned), b - have
            self.near = np.concatenate([self.near, np.full((n, more), NONE, np.uint8)], axis=1)
            self.lower = np.concatenate([self.lower, np.full((n, more), np.inf, np.float32)], axis=1)


def distances(x: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Squared distances as integers."""
    d = x - entry
    return np.einsum("ij,ij->i", d, d)


def assign(x: np.ndarray, book: np.ndarray, s: Bounds) -> np.ndarray:
    """Bring ``s`` up to date with the entries of ``book`` (its bounds hold
    already) and return how many kept bounds each part needed; one more than
    there are stands for all entries."""
    b, k = s.near.shape[1], len(book)
    needed = np.zeros(len(x), np.int64)
    first = np.minimum(s.lower[:, 0], s.outer) if b else s.outer
    rows = np.flatnonzero(~(s.upper < first))
    if not len(rows):
        return needed
    own = distances(x[rows], book[s.assigned[rows]]) if np.isfinite(s.upper[rows]).all() else None
    if own is not None:
        s.upper[rows] = _up(np.sqrt(own.astype(np.float64)))
        open_ = ~(s.upper[rows] < first[rows])
        rows, own = rows[open_], own[open_]
        beyond = ~(s.upper[rows] < s.outer[rows])
        some, best = rows[~beyond], own[~beyond]
        # integer comparison with the kept entries that are not excluded
        old, upper = s.assigned[some].copy(), s.upper[some].copy()
        winner, where = old.copy(), np.full(len(some), -1)
        mine = best.copy()
        for j in range(b):
            check = np.flatnonzero(~(upper < s.lower[some, j]) & (s.near[some, j] != NONE))
            if not len(check):
                break  # the bounds are in order
            needed[some[check]] = j + 1
            at = s.near[some[check], j]
            d = distances(x[some[check]], book[at])
            s.lower[some[check], j] = _down(np.sqrt(d.astype(np.float64)))
            better = (d < best[check]) | ((d == best[check]) & (at < winner[check]))
            hit = check[better]
            best[hit], winner[hit], where[hit] = d[better], at[better], j
        changed = np.flatnonzero(where >= 0)
        s.near[some[changed], where[changed]] = old[changed]
        s.lower[some[changed], where[changed]] = _down(np.sqrt(mine[changed].astype(np.float64)))
        s.assigned[some], s.upper[some] = winner, _up(np.sqrt(best.astype(np.float64)))
        if b:
            s.ordered(some)
        rows = rows[beyond]
    for a in range(0, len(rows), 8192):
        part = rows[a: a + 8192]
        diff = x[part][:, None, :] - book[None, :, :]
        d = np.einsum("ijk,ijk->ij", diff, diff)
        order = np.argsort(d, axis=1, kind="stable")
        near = np.take_along_axis(d, order, 1).astype(np.float64)
        s.assigned[part], s.upper[part] = order[:, 0], _up(np.sqrt(near[:, 0]))
        s.near[part], s.lower[part] = NONE, np.inf
        kept = min(b, k - 1)
        s.near[part, :kept] = order[:, 1: 1 + kept]
        s.lower[part, :kept] = _down(np.sqrt(near[:, 1: 1 + kept]))
        s.outer[part] = _down(np.sqrt(near[:, 1 + kept])) if 1 + kept < k else np.inf
        needed[part] = b + 1
    return needed


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, ints of the rows with whole vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("embedding").is_valid())
            v = batch.column("embedding")
            at = v.offsets.to_numpy().astype(np.int64)
            flat = v.values.slice(at[0], at[-1] - at[0])
            bad = flat.is_null().to_numpy(zero_copy_only=False)
            x = flat.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False)
            bad = bad | ~np.isfinite(x)
            row = np.repeat(np.arange(batch.num_rows), np.diff(at))
            whole = np.bincount(row[bad], minlength=batch.num_rows) == 0
            x = np.floor(np.where(bad, 0.0, x) * scale)
            if (np.abs(x[whole[row]]) > LARGEST).any():
                raise ValueError(f"a component beyond {LARGEST} after scaling")
            x = np.where(whole[row], x, 0.0)
            ints = pa.ListArray.from_arrays(pa.array(at - at[0], pa.int32()), pa.array(x.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), ints],
                                             ["vec_id", "label", "ints"]).filter(pa.array(whole))

    slim = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), "embedding", "label")
    label = vectors.schema["label"].dataType.simpleString()
    return slim.mapInArrow(run, f"vec_id long, label {label}, ints array<int>")


def first_vectors(ints: DataFrame, entries: int = ENTRIES) -> list[list[int]]:
    """Vectors of the smallest vec_ids, ascending; all of one length."""
    out, last, ids, length = [], None, set(), None
    while len(ids) < entries:
        rest = ints if length is None else ints.filter(F.size("ints") == length)
        if last is not None:
            rest = rest.filter((F.col("vec_id") > last) | F.col("vec_id").isNull())
        rows = rest.select("vec_id", "ints").orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).collect()
        for r in rows:
            length = length if length is not None else len(r["ints"])
            if len(r["ints"]) == length and r["vec_id"] not in ids and len(ids) < entries:
                ids.add(r["vec_id"])
                out.append(list(r["ints"]))
        if len(rows) < entries or rows[-1]["vec_id"] is None:
            break
        last = rows[-1]["vec_id"]
    return out


def _pass(rows: DataFrame, books: np.ndarray, moves: np.ndarray | None, b_in: int, b: int) -> DataFrame:
    """All rows with their bounds after one assignment, and the sums (part,
    entry, n, sums) of each task; rows of part -1 count the bounds needed."""
    parts, k, w = books.shape
    d = parts * w

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts, k, w), np.int64), np.zeros((parts, k), np.int64)
        needs, label = np.zeros(b + 2, np.int64), None
        for batch in batches:
            n, label = batch.num_rows, batch.schema.field("label").type
            if not n:
                continue
            x = batch.column("ints").flatten().to_numpy().astype(np.int64).reshape(n, d)
            raw = None
            if moves is not None:
                raw = text_bytes(batch.column("bounds").view(pa.string()))[0].reshape(n, parts, Bounds.width(b_in))
            error, new = np.zeros(n, np.int64), []
            for p in range(parts):
                xp = x[:, p * w: (p + 1) * w]
                if raw is None:
                    s = Bounds(n, b)
                else:
                    s = Bounds.read(raw[:, p], b_in)
                    s.moved(moves[p])
                    s.resized(b)
                needs += np.bincount(assign(xp, books[p], s), minlength=b + 2)
                own = distances(xp, books[p][s.assigned])
                error += own
                # a batch's sums stay below 2^53, so doubles hold them exactly
                hot = (s.assigned[:, None] == np.arange(k)).astype(np.float64)
                total[p] += (hot.T @ xp.astype(np.float64)).astype(np.int64)
                count[p] += np.bincount(s.assigned, minlength=k)
                new.append(s.bytes())
            blob = np.concatenate(new, axis=1)
            at = np.arange(n + 1, dtype=np.int32) * blob.shape[1]
            bounds = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(blob.tobytes())])
            no = [pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), batch.column("ints"), bounds, pa.array(error), *no], NAMES)
        if count.any():
            part = np.concatenate([np.repeat(np.arange(parts), k), np.full(b + 2, -1)])
            entry = np.concatenate([np.tile(np.arange(k), parts), np.arange(b + 2)])
            ns = np.concatenate([count.ravel(), needs])
            sums = [*total.reshape(parts * k, w).tolist(), *[[0] * w] * (b + 2)]
            m = len(ns)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, pa.int64()), pa.nulls(m, label), pa.nulls(m, pa.list_(pa.int32())), pa.nulls(m, pa.binary()),
                 pa.nulls(m, pa.int64()), pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(ns),
                 pa.array(sums, pa.list_(pa.int64()))], NAMES)

    return rows.mapInArrow(run, STATE_DDL.format(label=rows.schema["label"].dataType.simpleString()))


def _sums(state: DataFrame, parts: int, k: int, w: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(count per entry, sums per entry, parts by bounds needed) of all tasks:
    entries times dimensions numbers reach the driver."""
    rows = (state.filter("part IS NOT NULL").select("part", "entry", "n", F.posexplode("sums").alias("pos", "v"))
            .groupBy("part", "entry", "pos").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect())
    count, total, needs = np.zeros((parts, k), object), np.zeros((parts, k, w), object), np.zeros(b + 2, np.int64)
    for r in rows:
        if r["part"] < 0:
            needs[r["entry"]] = r["n"]
        else:
            count[r["part"], r["entry"]] = r["n"]
            total[r["part"], r["entry"], r["pos"]] = r["v"]
    return count, total, needs


def _next_width(needs: np.ndarray, b: int, k: int) -> int:
    """The fewest bounds that would have done for all but one part in
    ``BEYOND``; one more than now if the present ones did not."""
    if k < 2:
        return 0
    least, most = max(1, k // LEAST_SHARE), max(1, k // MOST_SHARE)
    over = needs.sum() - np.cumsum(needs)  # parts that needed more than z bounds
    enough = np.flatnonzero(over * BEYOND <= needs.sum())
    want = int(enough[0]) if enough[0] <= b else b + 1
    return min(max(want, least), most, k - 1)


def _codebooks(books: np.ndarray, count: np.ndarray, total: np.ndarray) -> np.ndarray:
    new = books.copy()
    for p, e in zip(*np.nonzero(count)):
        new[p, e] = [int(v) // int(count[p, e]) for v in total[p, e]]
    return new


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                 scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, codes, error of every kept row; codebooks by part, entry
    and position)."""
    spark = vectors.sparkSession
    ship_code(spark)
    ints = written(quantised(vectors, scale), "vector-ints")
    start = first_vectors(ints, entries)
    if not start:
        none = ints.select("vec_id", "label", F.lit(b"").alias("codes"), F.lit(0).cast("long").alias("error"))
        return none, np.zeros((parts, 0, 0), np.int64)
    d, k = len(start[0]), len(start)
    if d % parts or not d:
        raise ValueError(f"vectors of {d} components can't be cut into {parts} equal parts")
    w = d // parts
    books = np.ascontiguousarray(np.array(start, np.int64).reshape(k, parts, w).transpose(1, 0, 2))
    b = min(max(1, k // FIRST_SHARE), k - 1)
    state = written(_pass(ints.filter(F.size("ints") == d), books, None, b, b), "vector-bounds")
    dropped(ints)
    for _ in range(rounds):
        count, total, needs = _sums(state, parts, k, w, b)
        new = _codebooks(books, count, total)
        moves = np.sqrt(((new - books).astype(np.float64) ** 2).sum(axis=2)) * (1 + 1e-9)
        books, wide, before = new, _next_width(needs, b, k), state
        state = written(_pass(state.filter("part IS NULL").select("vec_id", "label", "ints", "bounds"),
                              books, moves, b, wide), "vector-bounds")
        dropped(before)
        b = wide
    at = [1 + p * Bounds.width(b) for p in range(parts)]
    codes = F.concat(*[F.substring("bounds", i, 1) for i in at])
    return state.filter("part IS NULL").select("vec_id", "label", codes.alias("codes"), "error"), books


def coded(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
          scale: int = SCALE) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every kept row."""
    rows, books = vector_codes(vectors, parts, entries, rounds, scale)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    sums = written(rows.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    sums = sums.withColumnRenamed("label", "s_label")
    if sums.count() <= BROADCAST_LABELS:
        out = rows.join(F.broadcast(sums), rows["label"].eqNullSafe(sums["s_label"]))
    else:  # a label may hold most rows: its rows go to several tasks
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id", "codes"), F.lit(SALT)))
        sums = sums.withColumn("s_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))))
        out = salted.join(sums, salted["label"].eqNullSafe(sums["s_label"]) & (salted["salt"] == sums["s_salt"]))
    return out.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error",
                      F.lit(digest).alias("codebooks_sha256"))


def oracle_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """DuckDB SQL with the same rows: every round compares all entries."""
    nearest = """
a{r} AS MATERIALIZED (
  SELECT rid, p, e, d FROM (
    SELECT x.rid, x.p, c.e, list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d,
      row_number() OVER (PARTITION BY x.rid, x.p ORDER BY
        list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), c.e) AS o
    FROM parts x JOIN c{r} c USING (p)) WHERE o = 1)"""
    update = """
u{r} AS MATERIALIZED (
  SELECT p, e, list((s - (((s % n) + n) % n)) // n ORDER BY i) AS v FROM (
    SELECT a.p, a.e, g.i, sum(x.v[g.i])::BIGINT AS s, count(*) AS n
    FROM a{q} a JOIN parts x USING (rid, p), (SELECT unnest(range(1, (SELECT max(len(v)) FROM parts) + 1)) AS i) g
    GROUP BY a.p, a.e, g.i) GROUP BY p, e),
c{r} AS MATERIALIZED (SELECT c.p, c.e, coalesce(u.v, c.v) AS v FROM c{q} c LEFT JOIN u{r} u ON c.p = u.p AND c.e = u.e)"""
    head = f"""WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label,
    list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT rid, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS v
  FROM kept, (SELECT unnest(range(0, {parts})) AS p)),
first AS (SELECT rid, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {entries}),
c0 AS MATERIALIZED (SELECT p, e, v FROM parts JOIN first USING (rid))"""
    steps = [head, nearest.format(r=0)]
    for r in range(1, rounds + 1):
        steps += [update.format(r=r, q=r - 1), nearest.format(r=r)]
    tail = f"""
digest AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds}),
coded AS (
  SELECT rid, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY rid)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rid), digest"""
    return ",".join(steps) + "," + tail
