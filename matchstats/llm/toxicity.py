"""Toxicity by a small convolutional text classifier (operator 10).

Words are hashed into two embedding tables, whose sum is the word's vector;
filters of several widths run over the words, max pooling keeps each filter's
strongest place, and a logistic layer scores.  It learns from every labelled
row with its whole text: the rows are dealt to shards of bounded size by a hash
of the doc_id, each round the shards go on from the same model, one task each,
and their changes are averaged (an embedding's over the shards that hold it).
Changes are added up as integers, so that neither order nor layout of the
tables matters.  The score is calibrated on one labelled row in
``CALIBRATE_EVERY``, which training doesn't see, and thresholds per language
are set there as well, from counts of all these rows by logit.  All documents
are then scored, whole, where they lie.

Rows whose crc32(doc_id as text) mod 4 is 2 are held out: their labels are
never read.  A score depends on the text alone.

Defined results: null and empty texts have no words and get the score of the
bias; repeated rows score alike and are learnt from as often as they come; rows
without a doc_id are not held out and have no label; without labels of both
classes every score is 0; where the rows kept for calibration leave training
without a class, training takes them as well and nothing is calibrated; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchstats.llm.common import dropped, ship_code, written
from matchstats.llm.wordtable import CHUNK_BYTES, row_chunks, span_hash, text_bytes, words

#: Bytes of text of a shard, on average (a text is never cut).
SHARD_BYTES = 8 << 20
#: Hash tables of 2 ** HASH_BITS vectors of DIM numbers: for the word, and for
#: its first bytes (related words share them).
HASH_BITS, DIM = 17, 8
PREFIX_BYTES = (4, 6, 8)
TABLES = 1 + len(PREFIX_BYTES)
WIDTHS, FILTERS = (1, 2, 3), 8
#: The shards' changes are averaged after each of ``ROUNDS`` rounds of ``PASSES``
#: passes over their rows, in batches of ``BATCH``.
ROUNDS, PASSES, BATCH = 4, 2, 32
DENSE_RATE, TABLE_RATE = 0.01, 0.1
#: One labelled doc_id in so many is kept for calibration.
CALIBRATE_EVERY = 4
#: Words of a batch whose filters are held in memory at once, beyond one text.
BATCH_WORDS = 1 << 16
#: Logits are counted in steps of 1 / LOGIT_STEPS up to LOGIT_MOST.
LOGIT_STEPS, LOGIT_MOST = 1024, 64
#: Changes are added up in units of 1 / UNITS.
UNITS = float(1 << 44)
HELD_OUT = 2
#: Score from which a text is predicted toxic; calibration puts the best cut of
#: the calibration rows there.
THRESHOLD = 0.3
LEAST_PER_LANGUAGE = 30


def word_ids(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a row of each table per word, offsets of the texts' words)."""
    w = words(data, off, "alnum", lower=True)
    hashes = [w.hash, *(span_hash(data, w.start, np.minimum(w.start + n, w.end), lower=True) for n in PREFIX_BYTES)]
    mask = np.uint64((1 << HASH_BITS) - 1)
    return np.stack([h & mask for h in hashes], axis=1).astype(np.int32), w.firsts()


@dataclass
class Model:
    tables: np.ndarray  # TABLES x 2 ** HASH_BITS x DIM
    filters: list[np.ndarray]  # width x DIM x FILTERS, for each width
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float = 0.0
    scale: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    trained: bool = False

    @classmethod
    def fresh(cls, seed: int = 7) -> "Model":
        rng = np.random.default_rng(seed)
        tables = rng.normal(0, 0.05, (TABLES, 1 << HASH_BITS, DIM)).astype(np.float32)
        filters = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        return cls(tables, filters, [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
                   np.abs(rng.normal(0, 0.3, len(WIDTHS) * FILTERS)).astype(np.float32))

    def vectors(self, ids: np.ndarray) -> np.ndarray:
        x = self.tables[0].take(ids[:, 0], axis=0)
        for t in range(1, TABLES):
            x += self.tables[t].take(ids[:, t], axis=0)
        return x

    def pooled(self, ids: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Strongest response of every filter in every text (0 without a place)."""
        x = self.vectors(ids)
        out = np.zeros((len(off) - 1, len(WIDTHS) * FILTERS), np.float32)
        counts = np.diff(off)
        for j, (f, b) in enumerate(zip(self.filters, self.bias)):
            width = len(f)
            total = x @ f[0]
            for k in range(1, width):
                total[: len(x) - k] += x[k:] @ f[k]
            full = np.flatnonzero(counts >= width)
            if not len(full):
                continue
            # places that run into the next text don't count
            for k in range(1, width):
                total[off[1:][full] - k] = -np.inf
            best = np.maximum.reduceat(total, off[:-1][counts > 0], axis=0)
            rows = np.flatnonzero(counts > 0)
            ok = counts[rows] >= width
            out[rows[ok], j * FILTERS: (j + 1) * FILTERS] = np.tanh(best[ok] + b)
        return out

    def logits(self, ids: np.ndarray, off: np.ndarray) -> np.ndarray:
        return self.pooled(ids, off) @ self.out + self.out_bias

    def score(self, ids: np.ndarray, off: np.ndarray) -> np.ndarray:
        if not self.trained:
            return np.zeros(len(off) - 1)
        z = self.scale * self.logits(ids, off).astype(np.float64) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _views(flat: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Filters, their biases and output weights within a vector of all dense
    numbers, which ends with the output's bias."""
    shapes = [*((w, DIM, FILTERS) for w in WIDTHS), *((FILTERS,) for _ in WIDTHS), (len(WIDTHS) * FILTERS,)]
    ends = np.cumsum([int(np.prod(x)) for x in shapes])
    parts = [flat[e - int(np.prod(x)): e].reshape(x) for x, e in zip(shapes, ends)]
    return parts[: len(WIDTHS)], parts[len(WIDTHS): -1], parts[-1]


@dataclass
class _State:
    """What training goes on from: the model, whose dense numbers lie in
    ``dense``, their Adam moments, and the squared slopes of the embeddings."""

    tables: np.ndarray
    squares: np.ndarray
    dense: np.ndarray
    m: np.ndarray
    v: np.ndarray
    steps: int = 0

    @classmethod
    def fresh(cls, seed: int = 7) -> "_State":
        x = Model.fresh(seed)
        dense = np.concatenate([*(p.reshape(-1) for p in [*x.filters, *x.bias, x.out]), [x.out_bias]]).astype(np.float32)
        return cls(x.tables, np.full(x.tables.shape[:2], 1e-4, np.float32), dense, np.zeros_like(dense), np.zeros_like(dense))

    def model(self) -> Model:
        """The model, with views of these numbers."""
        filters, bias, out = _views(self.dense)
        return Model(self.tables, filters, bias, out, float(self.dense[-1]), trained=True)

    def copy(self) -> "_State":
        return _State(*(x.copy() for x in (self.tables, self.squares, self.dense, self.m, self.v)), self.steps)

    def step(self, slope: np.ndarray, rate: float) -> None:
        """One Adam step of the dense numbers."""
        self.steps += 1
        self.m += 0.1 * (slope - self.m)
        self.v += 0.001 * (slope * slope - self.v)
        self.dense -= rate * (self.m / (1 - 0.9**self.steps)) / (np.sqrt(self.v / (1 - 0.999**self.steps)) + 1e-8)


def _runs(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(first, end) of runs of entries that add up to ``most`` at most, or of one."""
    ends, a = np.cumsum(sizes), 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, side="right")))
        yield a, b
        a = b


def _pass(state: _State, ids: np.ndarray, off: np.ndarray, labels: np.ndarray, weight: np.ndarray, rng: np.random.Generator,
          share: float) -> None:
    """One pass over a shard's texts, in batches; rates fall with the ``share``
    of the training that lies behind."""
    rate, table_rate = DENSE_RATE * (1 - share), TABLE_RATE * (1 - share)
    counts = np.diff(off)
    for at in np.array_split(rng.permutation(len(labels)), max(1, len(labels) // BATCH)):
        model, slope = state.model(), np.zeros_like(state.dense)
        g_filters, g_bias, g_out = _views(slope)
        taps = np.concatenate([f.transpose(0, 2, 1).reshape(-1, DIM) for f in model.filters])
        # the word at which each filter is strongest, and the filter's value there
        best = np.zeros((len(at), len(WIDTHS), FILTERS), np.int64)
        value = np.zeros((len(at), len(WIDTHS), FILTERS), np.float32)
        for a, b in _runs(counts[at], BATCH_WORDS):
            head = np.concatenate([[0], np.cumsum(counts[at[a:b]])])
            word = np.repeat(off[at[a:b]] - head[:-1], counts[at[a:b]]) + np.arange(head[-1])
            y, row = taps @ model.vectors(ids[word]).T, 0
            for j, width in enumerate(WIDTHS):
                total = y[row: row + FILTERS]
                for k in range(1, width):
                    total[:, : total.shape[1] - k] += y[row + k * FILTERS: row + (k + 1) * FILTERS, k:]
                row += width * FILTERS
                for i in np.flatnonzero(counts[at[a:b]] >= width):
                    own = total[:, head[i]: head[i + 1] - width + 1]
                    place = own.argmax(axis=1)
                    best[a + i, j], value[a + i, j] = off[at[a + i]] + place, own[np.arange(FILTERS), place]
        full = counts[at][:, None] >= np.array(WIDTHS)
        value = np.where(full[:, :, None], np.tanh(value + np.stack(model.bias)), np.float32(0))
        features = value.reshape(len(at), -1)
        z = np.clip(features @ model.out + model.out_bias, -30, 30).astype(np.float64)
        d = ((1 / (1 + np.exp(-z)) - labels[at]) * weight[labels[at]] / len(at)).astype(np.float32)
        d[counts[at] == 0] = 0  # a text without words teaches nothing
        g_out += d @ features
        slope[-1] = d.sum()
        back = d[:, None, None] * model.out.reshape(len(WIDTHS), FILTERS) * (1 - value * value)
        touched: list[tuple[np.ndarray, np.ndarray]] = []
        for j, width in enumerate(WIDTHS):
            some = full[:, j]
            g_bias[j] += back[some, j].sum(axis=0)
            for k in range(width):
                rows, own = ids[best[some, j] + k].reshape(-1, TABLES), back[some, j]
                x = model.vectors(rows).reshape(-1, FILTERS, DIM)
                g_filters[j][k] += np.einsum("ifd,if->df", x, own)
                touched.append((rows, (own[:, :, None] * model.filters[j][k].T).reshape(-1, DIM)))
        state.step(slope, rate)
        rows = np.concatenate([r for r, _ in touched])
        slopes = np.concatenate([s for _, s in touched])
        for t in range(TABLES):
            used, at_row = np.unique(rows[:, t], return_inverse=True)
            total = np.zeros((len(used), DIM), np.float32)
            np.add.at(total, at_row, slopes)
            state.squares[t, used] += (total * total).mean(axis=1)
            state.tables[t, used] -= table_rate * total / np.sqrt(state.squares[t, used])[:, None]


def _units(change: np.ndarray) -> np.ndarray:
    return np.rint(change.astype(np.float64) * UNITS).astype(np.int64)


#: A changed row of the model: row of an embedding table or, below 0, dense
#: number -1 - slot (whose change and those of its moments are c0, c1, c2).
CHANGES = ["slot", *(f"c{i}" for i in range(DIM)), "squares"]


def _changes(before: _State, after: _State) -> pa.RecordBatch:
    table, row = np.nonzero(after.squares != before.squares)
    moved = _units(after.tables[table, row] - before.tables[table, row])
    dense = np.zeros((len(before.dense), DIM), np.int64)
    for i, (x, y) in enumerate(((before.dense, after.dense), (before.m, after.m), (before.v, after.v))):
        dense[:, i] = _units(y - x)
    slot = np.concatenate([(table << HASH_BITS) + row, -1 - np.arange(len(dense))])
    square = np.concatenate([_units(after.squares[table, row] - before.squares[table, row]), np.zeros(len(dense), np.int64)])
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (slot, *np.concatenate([moved, dense]).T, square)], CHANGES)


def _applied(state: _State, sums: pa.Table, steps: int) -> None:
    """The shards' mean changes; an embedding's over the shards that changed it."""
    slot, n = sums["slot"].to_numpy(), sums["n"].to_numpy()
    change = np.stack([sums[c].to_numpy() for c in CHANGES[1:]], axis=1) / (n * UNITS)[:, None]
    dense = slot < 0
    for i, x in enumerate((state.dense, state.m, state.v)):
        x[-1 - slot[dense]] += change[dense, i].astype(np.float32)
    np.maximum(state.v, 0, out=state.v)
    table, row = slot[~dense] >> HASH_BITS, slot[~dense] & ((1 << HASH_BITS) - 1)
    state.tables[table, row] += change[~dense, :DIM].astype(np.float32)
    state.squares[table, row] += change[~dense, DIM].astype(np.float32)
    state.steps = steps


def _platt(z: np.ndarray, n: np.ndarray, hits: np.ndarray) -> tuple[float, float]:
    """Scale and shift of logits ``z`` with ``n`` rows each, ``hits`` of them
    toxic, by logistic regression (Newton steps, with a prior that keeps
    separable rows finite)."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w = n * (p * (1 - p) + 1e-9)
        g = np.array([((n * p - hits) * z).sum() + 1e-2 * (a - 1), (n * p - hits).sum() + 1e-2 * b])
        h = np.array([[(w * z * z).sum() + 1e-2, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-2]])
        da, db = np.linalg.solve(h, g)
        a, b = a - da, b - db
        if abs(da) + abs(db) < 1e-8:
            break
    return max(a, 1e-3), b


def _best_cuts(counts: DataFrame) -> DataFrame:
    """Of rows and toxic rows (``n``, ``hits``) by ``lang`` and logit (``bin``):
    ``high`` and ``low``, the logits round the cut of best F1 of each language
    (the highest such cut; ``low`` null below all), its rows and toxic rows."""
    down = Window.partitionBy("lang").orderBy(F.col("bin").desc())
    so_far = down.rowsBetween(Window.unboundedPreceding, 0)
    rows = counts.withColumn("f1", 2 * F.sum("hits").over(so_far) / (
        F.sum("n").over(so_far) + F.sum("hits").over(Window.partitionBy("lang")))).withColumn("low", F.lead("bin").over(down))
    best = F.max(F.struct("f1", F.col("bin").alias("high"), "low")).alias("best")
    return rows.groupBy("lang").agg(best, F.sum("n").alias("n"), F.sum("hits").alias("hits")).select(
        "lang", "best.high", "best.low", "n", "hits")


def _calibrated(model: Model, counts: DataFrame) -> Model:
    """``model`` with scale, shift and thresholds from ``counts`` (lang, bin,
    n, hits) of the calibration rows."""
    known = counts.groupBy("bin").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))  # one row per step at most
    table = known.toArrow().sort_by("bin")
    z, n, hits = (table[c].to_numpy().astype(np.float64) for c in ("bin", "n", "hits"))
    if not 0 < hits.sum() < n.sum():
        return model
    model.scale, model.shift = _platt(z / LOGIT_STEPS, n, hits)
    score = lambda at: 1 / (1 + np.exp(-(model.scale * at / LOGIT_STEPS + model.shift)))
    middle = lambda r: float((score(r["high"]) + (0.0 if r["low"] is None else score(r["low"]))) / 2)
    cut = np.clip(middle(_best_cuts(known.withColumn("lang", F.lit(""))).first()), 1e-6, 1 - 1e-6)
    # the best cut of the calibration rows becomes the threshold
    model.shift += np.log(THRESHOLD / (1 - THRESHOLD)) - np.log(cut / (1 - cut))
    for r in _best_cuts(counts).filter(f"n >= {LEAST_PER_LANGUAGE} AND hits > 0 AND hits < n").collect():
        model.thresholds[r["lang"]] = middle(r)  # one row per language
    return model


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == HELD_OUT, F.lit(False))


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, text, toxic, n_bytes and ``calibrate`` of every row with a
    label that may be read."""
    known = (labels.filter(~held_out() & F.col("toxic").isin(0, 1)).groupBy("doc_id")
             .agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    # never a broadcast of the labels, which grow with the documents
    rows = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), "text").join(known.hint("merge"), "doc_id")
    turn = F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(CALIBRATE_EVERY))
    return rows.select("*", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n_bytes"),
                       (turn == CALIBRATE_EVERY - 1).alias("calibrate"))


def dealt_to_shards(rows: DataFrame, shards: int) -> DataFrame:
    """A row per shard: its labels, and its texts one after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, labels, sizes, texts = None, [], [], []

        def packed() -> pa.RecordBatch:
            off = np.concatenate([[0], *sizes]).cumsum()
            cells = [np.concatenate(labels).astype(np.int8).tobytes(), off.astype(np.int64).tobytes(), b"".join(texts)]
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), *(pa.array([c], pa.large_binary()) for c in cells)],
                                              ["shard", "labels", "offsets", "data"])

        for batch in batches:
            of = batch.column("shard").to_numpy()
            heads = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1), len(of)] if len(of) else [0]
            for a, b in zip(heads, heads[1:]):
                if shard is not None and of[a] != shard:
                    yield packed()
                    labels, sizes, texts = [], [], []
                shard = int(of[a])
                labels.append(batch.column("toxic").slice(a, b - a).to_numpy())
                data, off = text_bytes(batch.column("text").slice(a, b - a))
                sizes.append(np.diff(off))
                texts.append(data.tobytes())
        if shard is not None:
            yield packed()

    order = F.xxhash64("doc_id", F.lit("order"))
    slim = rows.select(F.pmod(F.xxhash64("doc_id"), F.lit(shards)).alias("shard"), order.alias("at"), "doc_id", "toxic", "text")
    slim = slim.repartition(shards, "shard").sortWithinPartitions("shard", "at", "doc_id", "text").select("shard", "toxic", "text")
    return slim.mapInArrow(run, "shard long, labels binary, offsets binary, data binary")


def train(docs: DataFrame, labels: DataFrame, seed: int = 7) -> Model:
    """The calibrated model of all labelled rows; what reaches the driver is
    bounded by the model and the steps of a logit."""
    spark = docs.sparkSession
    ship_code(spark)
    rows = written(labelled_rows(docs, labels), "toxic-rows")
    found = {r["calibrate"]: r for r in rows.groupBy("calibrate").agg(
        F.sum("n_bytes").alias("size"), F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("hits")).collect()}
    if not 0 < sum(r["hits"] for r in found.values()) < sum(r["n"] for r in found.values()):
        dropped(rows)
        return Model.fresh(seed)
    own = found.get(False)
    apart = own is not None and 0 < own["hits"] < own["n"]
    learnt = rows.filter("NOT calibrate") if apart else rows
    used = [own] if apart else list(found.values())
    n, hits = sum(r["n"] for r in used), sum(r["hits"] for r in used)
    weight = np.array([0.5 * n / (n - hits), 0.5 * n / hits])
    count = max(1, -(-sum(r["size"] for r in used) // SHARD_BYTES))
    shards = written(dealt_to_shards(learnt, count), "toxic-shards")
    steps = PASSES * max(1, n // count // BATCH)  # of a shard in a round, on average
    state = _State.fresh(seed)
    for round_ in range(ROUNDS):
        sent = spark.sparkContext.broadcast(state)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            before = sent.value
            for batch in batches:
                for i in range(batch.num_rows):
                    cell = lambda c, t: np.frombuffer(batch.column(c)[i].as_buffer(), t)  # noqa: B023, E731
                    after, label, off = before.copy(), cell("labels", np.int8), cell("offsets", np.int64)
                    ids, first = _shard_ids(cell("data", np.uint8), off)
                    rng = np.random.default_rng([seed, round_, batch.column("shard")[i].as_py()])
                    for k in range(PASSES):
                        _pass(after, ids, first, label, weight, rng, (round_ * PASSES + k) / (ROUNDS * PASSES))
                    yield _changes(before, after)

        changes = shards.mapInArrow(run, ", ".join(f"{c} long" for c in CHANGES))
        sums = changes.groupBy("slot").agg(*[F.sum(c).alias(c) for c in CHANGES[1:]], F.count(F.lit(1)).alias("n"))
        _applied(state, sums.toArrow(), state.steps + steps)
        sent.destroy()
    dropped(shards)
    model = state.model()
    if apart:
        counts = written(logit_counts(model, rows.filter("calibrate")), "toxic-logits")
        model = _calibrated(model, counts)
        dropped(counts)
    dropped(rows)
    return model


def _shard_ids(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``word_ids`` of a shard's texts, by chunks."""
    parts, firsts = [np.zeros((0, TABLES), np.int32)], [np.zeros(1, np.int64)]
    for a, b in _runs(np.diff(off), CHUNK_BYTES):
        ids, first = word_ids(data[off[a]: off[b]], off[a: b + 1] - off[a])
        parts.append(ids)
        firsts.append(first[1:] + firsts[-1][-1])
    return np.concatenate(parts), np.concatenate(firsts)


def logit_counts(model: Model, rows: DataFrame) -> DataFrame:
    """lang, bin, n, hits: rows and toxic rows by language and logit, in steps."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, off in row_chunks(batch.column("text"), 1 << 19):
                z = np.clip(shared.value.logits(*word_ids(data, off)).astype(np.float64), -LOGIT_MOST, LOGIT_MOST)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("lang").slice(a, b - a), pa.array(np.rint(z * LOGIT_STEPS).astype(np.int32)),
                     batch.column("toxic").slice(a, b - a)], ["lang", "bin", "toxic"])

    binned = rows.select("lang", "text", "toxic").mapInArrow(run, "lang string, bin int, toxic int")
    return binned.groupBy("lang", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("hits"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and toxic_by_language (the score
    against the threshold of the row's language) of every row."""
    spark = docs.sparkSession
    model = train(docs, labels)
    shared = spark.sparkContext.broadcast(model)  # of fixed size: tables and filters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for a, b, data, off in row_chunks(batch.column("text"), 1 << 19):
                score = m.score(*word_ids(data, off))
                lang = batch.column("lang").slice(a, b - a).to_pylist()
                limit = np.array([m.thresholds.get(x or "", THRESHOLD) for x in lang])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), batch.column("held_out").slice(a, b - a),
                     pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32)), pa.array(score >= limit)],
                    ["doc_id", "held_out", "score", "predicted", "toxic_by_language"])

    slim = docs.select("doc_id", held_out().alias("held_out"), F.col("lang").cast("string").alias("lang"), "text")
    kind = dict(slim.dtypes)["doc_id"]
    return slim.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int, toxic_by_language boolean")
