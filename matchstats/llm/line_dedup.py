"""Line deduplication by a deletion-neighbourhood join (operator 6).

A line of at least ``LEAST_WORDS`` words goes when an equal line, or one within
one edit (a character put in, left out or replaced), stands earlier: in an
earlier document by doc_id, or above it in the same one.  The bound grows with
the line, by the words of the shorter of the two: from ``ONE_WORD`` words on a
word may be put in, left out or replaced, from ``TWO_WORDS`` on two words may
be replaced.

Equal lines are one row: their first place.  Of those, lines that can be one
edit apart share a half: with m the shorter length, the first or the last
(m - 1) // 2 characters.  Only lines that share a half and m with another line
emit their deletion neighbourhood, as hashed keys: one per position for
replacements (position and the line without that character) and the line
itself against every line less one character for insertions.  Lines that share
a replacement key differ at one place only, so the earliest is a witness for
all the others, and a key has at most one row per letter of the alphabet;
no pairs within a key are made.  Each (witness, line) is then verified by its
edit distance.

One word is found in the same way, with words for characters.  Two replaced
words leave a third of the line equal; lines that share one are cut into about
sqrt(words) blocks and give a key for the line without each pair of blocks.
Only for pairs of blocks that are shared do they give the keys of the line
without one word of each, again with the earliest as witness for all.

Defined results: a null text stays null; lines of fewer words always stay, so
do blank ones; spaces round a line do not count; a repeated row (same doc_id
and text) shares the fate of its copy; of rows with one doc_id the text's hash
decides; an empty table gives an empty result; all columns of the input stay,
but for those named like the three it adds (tkey, n_lines, n_dropped).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchstats.llm.common import bitmap_of, in_bitmap, ship_code, text_key, written
from matchstats.llm.wordtable import mixed, position_powers, row_chunks

#: Shorter lines are headings, list marks and the like, and stay.
LEAST_WORDS = 5
#: Words from which one word may differ, and two.
ONE_WORD, TWO_WORDS = 20, 40

_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_HALF = np.uint64(0x632BE59BD9B4E019)
_REPLACED, _WHOLE = np.uint64(0x8CB92BA72F3D8DD7), np.uint64(0xABC98388FB8FAC03)
_WORD_HALF, _THIRD = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9E6C63D0876A9A47)
_WORD_REPLACED, _WORD_WHOLE = np.uint64(0xD1342543DE82EF95), np.uint64(0xDA942042E4DD58B5)
_BLOCKS, _TWO = np.uint64(0xB5026F5AA96619E9), np.uint64(0xC6BC279692B5CC83)
#: Why a line gives keys: it shares its first or last half with a line as long
#: (one place behind it, or before it, is replaced), with one longer by one (it
#: gives itself), or its first or last half with one shorter by one (it drops a
#: place behind it, or before it).  For characters; for words the same, shifted.
REPLACE_FIRST, REPLACE_LAST, ITSELF, DROP_FIRST, DROP_LAST = 1, 2, 4, 8, 16
WORD_SHIFT = 5
#: It shares its first, middle or last third with a line of as many words.
THIRDS = [1 << 10, 1 << 11, 1 << 12]
WORDS = sum(THIRDS)


class Lines:
    """The lines (of enough words) of some texts, in code points, with prefix
    sums from which the hash of any span follows."""

    def __init__(self, texts: list[str]):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        n, ends = len(self.points), np.cumsum(sizes)
        self.space = space = (self.points == 32) | (self.points - np.uint32(9) < 5)
        before = np.concatenate([[True], space[:-1]]) if n else space
        after = np.concatenate([space[1:], [True]]) if n else space
        heads = (ends - sizes)[sizes > 0]
        before[heads], after[ends[sizes > 0] - 1] = True, True
        first, last = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
        # number of each line over all texts, and in its text
        breaks = np.cumsum(self.points == 10) if n else np.zeros(0, np.int64)
        row = np.searchsorted(ends, first, side="right")
        line = breaks[first] + row if len(first) else first
        at = np.flatnonzero(np.diff(line, prepend=-1))  # lines come in order
        words = np.diff(np.append(at, len(line)))
        keep = words >= LEAST_WORDS
        at_end = at + words - 1
        self.start, self.end = first[at[keep]], last[at_end[keep]]
        self.row = row[at[keep]]
        self.word_at, self.words, self.spans = at[keep], words[keep], (first, last)
        heads_all = ends - sizes
        base = np.where(heads_all > 0, breaks[np.maximum(heads_all - 1, 0)] if n else 0, 0)
        self.number = breaks[self.start] - base[self.row] if len(self.start) else self.start

    @cached_property
    def total(self) -> np.ndarray:
        n = len(self.points)
        with np.errstate(over="ignore"):
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(mixed(self.points.astype(np.uint64) + np.uint64(0x51ED270B)) * position_powers(n)[1][:n], out=total[1:])
        return total

    @property
    def inverse(self) -> np.ndarray:
        return position_powers(len(self.points))[0]

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.total[end] - self.total[start]) * self.inverse[start]

    def hashes(self) -> np.ndarray:
        return mixed(self.raw(self.start, self.end) + (self.end - self.start).astype(np.uint64))

    def halves(self) -> np.ndarray:
        """Four keys per line: first and last half, as the shorter or the
        longer of a pair."""
        n = self.end - self.start
        out = []
        with np.errstate(over="ignore"):
            for m in (n, n - 1):
                h = np.maximum(m - 1, 0) // 2
                out.append(mixed(self.raw(self.start, self.start + h) + _HALF * m.astype(np.uint64)))
                out.append(mixed(self.raw(self.end - h, self.end) + _HALF * (m.astype(np.uint64) + np.uint64(1 << 40))))
        return np.stack(out, axis=1)

    def count_words(self) -> None:
        """Prefix sums over the words of all lines."""
        first, last = self.spans
        n = len(first)
        with np.errstate(over="ignore"):
            h = mixed(self.raw(first, last) + (last - first).astype(np.uint64))
            self.word_total = np.zeros(n + 1, np.uint64)
            np.cumsum(h * position_powers(n)[1][:n], out=self.word_total[1:])

    def raw_words(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.word_total[end] - self.word_total[start]) * self.inverse[start]

    def parts(self) -> np.ndarray:
        """Seven keys per line, 0 for none: halves in words as ``halves`` (for
        one word), and thirds (for two)."""
        s, n = self.word_at, self.words
        e, t, out = s + n, n // 3, []
        with np.errstate(over="ignore"):
            for m in (n, n - 1):
                h = (m - 1) // 2
                out.append(mixed(self.raw_words(s, s + h) + _WORD_HALF * m.astype(np.uint64)))
                out.append(mixed(self.raw_words(e - h, e) + _WORD_HALF * (m.astype(np.uint64) + np.uint64(1 << 40))))
            for k, (a, b) in enumerate([(s, s + t), (s + t, s + 2 * t), (s + 2 * t, e)]):
                out.append(mixed(self.raw_words(a, b) + _THIRD * (n.astype(np.uint64) + np.uint64(k << 40))))
        keys = np.stack(out, axis=1)
        keys[n < ONE_WORD, :4], keys[n < TWO_WORDS, 4:] = 0, 0
        return keys

    def word_neighbourhood(self, why: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``neighbourhood``, with words for characters; from ``TWO_WORDS``
        words on the keys for two words find a replaced one."""
        n = self.words
        replaced_at, dropped_at = _open_places(n, np.where(n < TWO_WORDS, why, why & ~(REPLACE_FIRST | REPLACE_LAST)))
        pick = np.flatnonzero(why & ITSELF)
        with np.errstate(over="ignore"):
            power = position_powers(int(n.max()) + 1 if len(n) else 1)[1]

            def less(line: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                s = self.word_at[line]
                e = s + n[line]
                return self.raw_words(s, s + place) + self.raw_words(s + place + 1, e) * power[place], n[line].astype(np.uint64)

            rest, size = less(*replaced_at)
            replaced = mixed(rest + _WORD_REPLACED * (replaced_at[1].astype(np.uint64) + np.uint64(1)) + size)
            rest, size = less(*dropped_at)
            shorter = mixed(rest + _WORD_WHOLE * size)
            whole = mixed(self.raw_words(self.word_at[pick], self.word_at[pick] + n[pick])
                          + _WORD_WHOLE * (n[pick].astype(np.uint64) + np.uint64(1)))
        return (np.concatenate([replaced_at[0], pick, dropped_at[0]]),
                np.repeat([0, 1, 2], [len(replaced), len(pick), len(shorter)]), np.concatenate([replaced, whole, shorter]))

    def _without(self, i: int, a: np.ndarray, b: np.ndarray, salt: np.uint64, bounds: np.ndarray) -> np.ndarray:
        """Keys of line i without its spans a and b (numbers in bounds); other words keep their places."""
        s, n = int(self.word_at[i]), int(self.words[i])
        with np.errstate(over="ignore"):
            sums = (self.word_total[s + bounds] - self.word_total[s]) * self.inverse[s]
            span = np.diff(sums)
            rest = sums[-1] - span[a] - np.where(a == b, np.uint64(0), span[b])
            return mixed(rest + salt * (a.astype(np.uint64) * np.uint64(1 << 32) + b.astype(np.uint64) + np.uint64(1)) + np.uint64(n))

    def _blocks(self, i: int) -> np.ndarray:
        n = int(self.words[i])
        return np.unique(np.append(np.arange(0, n, int(n**0.5)), n))

    def block_keys(self, i: int, why: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(block, block, key) of line i without each pair of blocks, or one,
        that reach beyond a third which the line shares: two lines that share a
        third differ outside of it."""
        bounds, n = self._blocks(i), int(self.words[i])
        a, b = np.triu_indices(len(bounds) - 1)
        ends, asked = [0, n // 3, 2 * (n // 3), n], np.zeros(len(a), dtype=bool)
        for k, bit in enumerate(THIRDS):
            if why & bit:
                beyond = (bounds[:-1] < ends[k]) | (bounds[1:] > ends[k + 1])
                asked |= beyond[a] & beyond[b]
        a, b = a[asked], b[asked]
        return a, b, self._without(i, a, b, _BLOCKS, bounds)

    def two_word_keys(self, i: int, pairs: list[tuple[int, int]]) -> np.ndarray:
        """Keys of line i without two words, one of each block of a pair."""
        bounds, at = self._blocks(i), []
        for a, b in pairs:
            x, y = np.meshgrid(np.arange(bounds[a], bounds[a + 1]), np.arange(bounds[b], bounds[b + 1]), indexing="ij")
            at.append(np.stack([x[x < y], y[x < y]]))
        x, y = np.concatenate(at, axis=1)
        return self._without(i, x, y, _TWO, np.arange(int(self.words[i]) + 1))

    def neighbourhood(self, why: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(line, role, key) of the lines, as ``why`` asks of each: role 0
        replacement keys, 1 the whole line, 2 the line less one character.  In
        lines of more than ``ONE_WORD`` words the latter only for spaces: with a
        letter put in, the shorter line has ``ONE_WORD`` words at least, and one
        word of the longer is put in or replaced."""
        n = self.end - self.start
        replaced_at, dropped_at = _open_places(n, why)
        put_in = (self.words[dropped_at[0]] <= ONE_WORD) | self.space[self.start[dropped_at[0]] + dropped_at[1]]
        dropped_at = dropped_at[0][put_in], dropped_at[1][put_in]
        pick = np.flatnonzero(why & ITSELF)
        with np.errstate(over="ignore"):
            power = position_powers(int(n.max()) + 1 if len(n) else 1)[1]

            def less(line: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                s, e = self.start[line], self.end[line]
                return self.raw(s, s + place) + self.raw(s + place + 1, e) * power[place], (e - s).astype(np.uint64)

            rest, size = less(*replaced_at)
            replaced = mixed(rest + _REPLACED * (replaced_at[1].astype(np.uint64) + np.uint64(1)) + size)
            rest, size = less(*dropped_at)
            shorter = mixed(rest + _WHOLE * size)
            whole = mixed(self.raw(self.start[pick], self.end[pick]) + _WHOLE * (n[pick].astype(np.uint64) + np.uint64(1)))
        return (np.concatenate([replaced_at[0], pick, dropped_at[0]]),
                np.repeat([0, 1, 2], [len(replaced), len(pick), len(shorter)]), np.concatenate([replaced, whole, shorter]))

    def texts(self) -> list[str]:
        return [self.points[a:b].tobytes().decode("utf-32-le", "surrogatepass") for a, b in zip(self.start, self.end)]


def _open_places(n: np.ndarray, why: np.ndarray) -> tuple[tuple, tuple]:
    """(line, place) of the places that may be replaced, and of those that may
    be dropped.  Lines that share their first half have their first difference
    behind it, and one that is longer by one less that place is the other line;
    from the end likewise."""
    out = []
    for first, last, m in ((REPLACE_FIRST, REPLACE_LAST, n), (DROP_FIRST, DROP_LAST, n - 1)):
        half = np.maximum(m - 1, 0) // 2
        low = np.where(why & last, 0, half)
        high = np.where(why & first, n, np.where(why & last, n - half, low))
        count = np.maximum(high - low, 0)
        line = np.repeat(np.arange(len(n)), count)
        out.append((line, np.arange(len(line)) + np.repeat(low - (np.cumsum(count) - count), count)))
    return out[0], out[1]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_key(), F.coalesce("text", F.lit("")).alias("text"))


def line_places(docs: DataFrame) -> DataFrame:
    """doc_id, tkey, line (its number), h (its hash), words, halves (and the
    parts behind them): a row per line."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, _data, _off in row_chunks(batch.column("text")):
                x = Lines(batch.column("text").slice(a, b - a).to_pylist())
                rows = pa.array(x.row + a)
                x.count_words()
                shared = np.concatenate([x.halves(), x.parts()], axis=1)
                halves = pa.FixedSizeListArray.from_arrays(_signed(shared.reshape(-1)), shared.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(rows), batch.column("tkey").take(rows), pa.array(x.number, pa.int64()),
                     _signed(x.hashes()), pa.array(x.words, pa.int32()), halves.cast(pa.list_(pa.int64()))],
                    ["doc_id", "tkey", "line", "h", "words", "halves"])

    return _keyed(docs).mapInArrow(run, "doc_id long, tkey long, line long, h long, words int, halves array<long>")


def line_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """rank, h, kinds and text of the wanted lines (h, place, kinds, rank), read once more."""
    bits_of = bitmap_of(wanted, "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bits_of, np.uint64)
        for batch in batches:
            for a, b, _data, _off in row_chunks(batch.column("text")):
                x = Lines(batch.column("text").slice(a, b - a).to_pylist())
                h = x.hashes()
                hit = in_bitmap(bits, h)
                x.start, x.end, x.row, x.number = x.start[hit], x.end[hit], x.row[hit], x.number[hit]
                rows = pa.array(x.row + a)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(rows), batch.column("tkey").take(rows), pa.array(x.number, pa.int64()),
                     _signed(h[hit]), pa.array(x.texts(), pa.string())], ["doc_id", "tkey", "line", "h", "line_text"])

    found = _keyed(docs).mapInArrow(run, "doc_id long, tkey long, line long, h long, line_text string")
    place = F.struct("doc_id", "tkey", "line")
    return found.select("h", place.alias("place"), "line_text").join(wanted, ["h", "place"]).dropDuplicates(["h"]).select(
        "rank", "h", "kinds", "line_text")


def neighbourhood_keys(lines: DataFrame) -> DataFrame:
    """key and code (4 * rank + role) of every deletion variant of the lines:
    less a character, and less a word, for the lines whose kinds say so."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("kinds", "rank"))
            for a, b, _data, _off in row_chunks(batch.column("line_text"), 1 << 17):
                x = Lines(batch.column("line_text").slice(a, b - a).to_pylist())
                x.count_words()
                mine = kinds[x.row + a]
                for line, role, key in (x.neighbourhood(mine), x.word_neighbourhood(mine >> WORD_SHIFT)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(4 * rank[x.row[line] + a] + role, pa.int64()), _signed(key)], ["code", "key"])

    return lines.select("rank", "kinds", "line_text").mapInArrow(run, "code long, key long")


def two_word_keys(lines: DataFrame) -> DataFrame:
    """rank and key of the lines without two words, for pairs of blocks
    without which a line equals another."""
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, _data, _off in row_chunks(batch.column("line_text"), 1 << 17):
                x = Lines(batch.column("line_text").slice(a, b - a).to_pylist())
                x.count_words()
                got = [x.block_keys(i, why) for i, why in enumerate(batch.column("kinds").to_numpy()[x.row + a].tolist())]
                rows = pa.array(np.repeat(x.row + a, [len(g[0]) for g in got]))
                pair = np.concatenate([g[0] << 32 | g[1] for g in got])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rank").take(rows), pa.array(pair, pa.int64()), _signed(np.concatenate([g[2] for g in got]))],
                    ["rank", "pair", "key"])

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, _data, _off in row_chunks(batch.column("line_text"), 1 << 17):
                x = Lines(batch.column("line_text").slice(a, b - a).to_pylist())
                x.count_words()
                pairs = batch.column("pairs").slice(a, b - a).to_pylist()
                for i, r in enumerate(x.row):
                    key = x.two_word_keys(i, [(p >> 32, p & 0xFFFFFFFF) for p in pairs[r]])
                    rows = pa.array(np.full(len(key), r + a))
                    yield pa.RecordBatch.from_arrays([batch.column("rank").take(rows), _signed(key)], ["rank", "key"])

    by_key = Window.partitionBy("key")
    keys = lines.select("rank", "kinds", "line_text").mapInArrow(blocks, "rank long, pair long, key long")
    shared = (keys.withColumn("lo", F.min("rank").over(by_key)).withColumn("hi", F.max("rank").over(by_key))
              .filter("lo != hi").groupBy("rank").agg(F.collect_list("pair").alias("pairs")))
    return lines.select("rank", "line_text").join(shared, "rank").mapInArrow(words, "rank long, key long")


def words_apart(x: str, y: str) -> bool:
    """Within the bound in words of lines x and y."""
    a, b = sorted((_WORDS.findall(x), _WORDS.findall(y)), key=len)
    if len(a) < ONE_WORD or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(u != v for u, v in zip(a, b)) <= (1 if len(a) < TWO_WORDS else 2)
    at = next((i for i, (u, v) in enumerate(zip(a, b)) if u != v), len(a))
    return a[at:] == b[at + 1:]


def near_lines(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """h of the distinct lines within the bound of an earlier line."""
    shared = Window.partitionBy("half")
    pos = F.col("pos")
    halves = (distinct.select("h", "words", F.posexplode("halves").alias("pos", "half")).filter("half != 0")
              .select("h", "words", "half", "pos"))
    # of two lines of as many words, ONE_WORD at least, that differ in a
    # character all words but one are equal: their word keys find them; so do
    # from TWO_WORDS words on those for two words, if one is replaced
    needed = ((F.min("words").over(shared) != F.max("words").over(shared)) | (pos >= 8)
              | ((pos < 4) & (F.col("words") <= ONE_WORD)) | ((pos >= 4) & (F.col("words") < TWO_WORDS)))
    # places 2 and 3 (of four) are halves as the longer of a pair
    longer = (pos < 8) & (pos.bitwiseAND(2) != 0)
    found = (halves.withColumn("longer", longer).withColumn("lo", F.min(F.when(~longer, F.col("h"))).over(shared))
             .withColumn("hi", F.max(F.when(~longer, F.col("h"))).over(shared))
             .withColumn("has_longer", F.max("longer").over(shared)).withColumn("needed", needed).filter("needed"))
    last, shift = pos.bitwiseAND(1) != 0, F.when(pos < 4, 1).otherwise(1 << WORD_SHIFT)
    why = F.when(pos >= 8, F.when(F.col("lo") != F.col("hi"), F.expr(f"shiftleft({THIRDS[0]}, pos - 8)"))).when(
        F.col("longer"), F.when(F.col("lo").isNotNull(), shift * F.when(last, DROP_LAST).otherwise(DROP_FIRST))).otherwise(
        shift * (F.when(F.col("lo") != F.col("hi"), F.when(last, REPLACE_LAST).otherwise(REPLACE_FIRST)).otherwise(0)
                 + F.when(F.col("has_longer"), ITSELF).otherwise(0)))
    candidates = found.select("h", why.alias("why")).filter("why > 0").groupBy("h").agg(F.bit_or("why").alias("kinds"))
    # rank: one number in the order of places, so that the many keys carry no more
    order = ["place.doc_id", "place.tkey", "place.line"]
    wanted = written(distinct.join(candidates, "h").select("h", "place", "kinds").repartitionByRange(*order)
                     .sortWithinPartitions(*order).withColumn("rank", F.monotonically_increasing_id()), "line-candidates")
    lines = written(line_texts(docs, wanted), "line-texts")
    # few bytes become many keys: every shuffle partition takes a share of the lines
    share = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = lines.repartition(share, "h")
    keys = neighbourhood_keys(spread)
    by_key = Window.partitionBy("key")

    role = F.col("code").bitwiseAND(F.lit(3))

    def first(r: int) -> F.Column:
        return F.min(F.when(role == r, F.col("code"))).over(by_key)

    # the earliest line of a replacement key is within the bound of all the
    # others; so are a line and all those with one character or word more
    single = (keys.withColumn("w", F.when(role == 0, first(0)).when(role == 1, first(2)).otherwise(first(1)))
              .select(F.shiftright("code", 2).alias("rank"), F.shiftright("w", 2).alias("witness")))
    double = two_word_keys(spread.filter(F.col("kinds").bitwiseAND(F.lit(WORDS)) != 0)).withColumn(
        "witness", F.min("rank").over(by_key)).select("rank", "witness")
    pairs = single.union(double).filter("witness < rank").distinct()
    text = lines.select("rank", "h", F.col("line_text").alias("x"))
    other = lines.select(F.col("rank").alias("witness"), F.col("line_text").alias("y"))
    compared = pairs.join(text, "rank").join(other, "witness").select(
        "h", "x", "y", F.levenshtein("x", "y", 1).between(0, 1).alias("near"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("near", "x", "y")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("h").filter(pa.array([near or words_apart(x, y) for near, x, y in rows], pa.bool_()))], ["h"])

    return compared.mapInArrow(run, "h long").distinct()


def dedup_lines(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``, the text without its later lines, and tkey,
    n_lines and n_dropped (lines of enough words, and those dropped)."""
    ship_code(docs.sparkSession)
    places = line_places(docs)
    place = F.struct("doc_id", "tkey", "line", "words", "halves")
    distinct = written(
        places.groupBy("h").agg(F.min(place).alias("first"))
        .select("h", F.struct("first.doc_id", "first.tkey", "first.line").alias("place"),
                F.col("first.words").alias("words"), F.col("first.halves").alias("halves")), "lines")
    kept = distinct.select("h", "place").join(near_lines(docs, distinct), "h", "left_anti")
    per_doc = kept.groupBy(F.col("place.doc_id").alias("__kept_doc"), F.col("place.tkey").alias("__kept_key")).agg(
        F.collect_list("place.line").alias("__kept_lines"))
    rows = docs.drop("n_lines", "n_dropped").withColumn("tkey", text_key())
    same = rows["doc_id"].cast("long").eqNullSafe(per_doc["__kept_doc"]) & (rows["tkey"] == per_doc["__kept_key"])
    joined = rows.join(per_doc, same, "left").drop("__kept_doc", "__kept_key")
    names = [c for c in joined.columns if c not in ("text", "__kept_lines")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, _data, _off in row_chunks(batch.column("text")):
                part = batch.slice(a, b - a)
                texts = part.column("text").to_pylist()
                x = Lines([t or "" for t in texts])
                keep = part.column("__kept_lines").to_pylist()
                lost: list[set[int]] = [set() for _ in texts]
                for r, i in zip(x.row.tolist(), x.number.tolist()):
                    lost[r].add(i)
                counts = [len(s) for s in lost]
                for r, mine in enumerate(keep):
                    lost[r].difference_update(mine or ())
                out = [t if not gone else "\n".join(s for i, s in enumerate(t.split("\n")) if i not in gone)
                       for t, gone in zip(texts, lost)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in names] + [pa.array(out, pa.string()), pa.array(counts, pa.int64()),
                                                       pa.array([len(s) for s in lost], pa.int64())],
                    [*names, "text", "n_lines", "n_dropped"])

    types = dict(joined.dtypes)
    ddl = ", ".join(f"`{c}` {types[c]}" for c in names) + ", text string, n_lines long, n_dropped long"
    return joined.select(*names, "text", "__kept_lines").mapInArrow(run, ddl)
