"""Global order without a single-partition window.

*Where does the row at position p stand?*  ``rank_cuts`` finds the sort keys
at given positions without sorting the table: rows are counted per day (one
aggregate, combined before the shuffle), the day that holds each position
follows from the running counts, and only the keys of these few days are put in
order.  ``temporal_split`` and ``cv_folds`` then are plain comparisons with the
cut keys: the feature rows are neither exchanged nor written.

*Which position does each row have?*  ``row_numbers`` adds the count of earlier
days to the position within the day.  A day too large for one task, or a first
key with too many values to count on the driver, goes by ``global_row_number``:
the keys are range-partitioned on the full sort key (so a hot day is spread),
checkpointed so that the layout is fixed, and numbered as offset of the
partition + position in it.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from matchstats import config as C
from matchstats.session import cut_lineage


def global_row_number(df: DataFrame, order_cols: list[str], out_col: str = "row_idx",
                      num_partitions: int | None = None) -> DataFrame:
    """0-based position of each row in ``order_cols`` order (ties broken by
    the full key, which the caller makes unique)."""
    # without a number adaptive execution joins small range partitions
    dealt = df.repartitionByRange(num_partitions, *order_cols) if num_partitions else df.repartitionByRange(*order_cols)
    ranged = cut_lineage(dealt.sortWithinPartitions(*order_cols))
    tagged = ranged.withColumn("__pid", F.spark_partition_id()).withColumn(
        "__local", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33))
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.coalesce(1).select("__pid", F.coalesce(F.sum("__cnt").over(w), F.lit(0)).alias("__off"))
    return (tagged.join(F.broadcast(offsets), "__pid")
            .withColumn(out_col, F.col("__off") + F.col("__local"))
            .drop("__pid", "__local", "__off"))


#: Days (values of the first sort key) that are counted on the driver at most.
MAX_DAYS = 1 << 17
#: Rows of a day that one task may put in order.
MAX_DAY_ROWS = 1 << 20


def day_counts(df: DataFrame, day: str) -> list[tuple] | None:
    """(day, rows) in order, nulls first; None if there are too many days."""
    rows = df.groupBy(day).agg(F.count(F.lit(1)).alias("n")).limit(MAX_DAYS + 1).collect()
    if len(rows) > MAX_DAYS:
        return None
    return sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r[0]))


def rank_cuts(df: DataFrame, order_cols: list[str], positions: list[int], days: list[tuple] | None = None) -> list[tuple | None]:
    """Sort key (values of ``order_cols``) of the row at each 0-based position,
    None beyond the end.  ``days``: the table's ``day_counts``."""
    days = days if days is not None else day_counts(df, order_cols[0])
    keys = df.select(*order_cols)
    if days is None:
        numbered, wanted = global_row_number(keys, order_cols), {p: p for p in positions if p >= 0}
    else:
        ends, total = [], 0
        for _, n in days:
            total += n
            ends.append(total)
        at = {p: bisect_right(ends, p) for p in positions if 0 <= p < total}
        held = sorted(set(at.values()))
        if not held:
            return [None] * len(positions)
        same = [F.col(order_cols[0]).eqNullSafe(F.lit(days[i][0])) for i in held]
        keys = keys.filter(reduce(Column.__or__, same))
        before, of_day = 0, {}  # rows of the kept days before each of them
        for i in held:
            of_day[i] = before
            before += days[i][1]
        wanted = {p: of_day[i] + p - (ends[i] - days[i][1]) for p, i in at.items()}
        numbered = _by_day(keys, order_cols, [days[i] for i in held])
    found = numbered.filter(F.col("row_idx").isin(list(wanted.values()))).select("row_idx", *order_cols).collect()
    by_number = {r["row_idx"]: tuple(r[c] for c in order_cols) for r in found}  # one row per position asked for
    return [by_number.get(wanted.get(p)) for p in positions]


def _by_day(df: DataFrame, order_cols: list[str], days: list[tuple]) -> DataFrame:
    """``row_idx`` of every row; ``days``: the table's days and their rows."""
    if max((n for _, n in days), default=0) > MAX_DAY_ROWS:
        return global_row_number(df, order_cols)
    starts, total = [], 0
    for day, n in days:
        starts.append((day, total))
        total += n
    schema = StructType([StructField("__day", df.schema[order_cols[0]].dataType), StructField("__start", LongType())])
    offsets = df.sparkSession.createDataFrame(starts, schema)  # MAX_DAYS rows at most
    w = Window.partitionBy(order_cols[0]).orderBy(*order_cols)
    ranked = df.withColumn("__rank", F.row_number().over(w))
    return (ranked.join(F.broadcast(offsets), F.col(order_cols[0]).eqNullSafe(F.col("__day")))
            .withColumn("row_idx", F.col("__start") + F.col("__rank") - 1).drop("__day", "__start", "__rank"))


def row_numbers(df: DataFrame, order_cols: list[str]) -> DataFrame:
    """Every row with its 0-based position ``row_idx`` in ``order_cols`` order."""
    days = day_counts(df, order_cols[0])
    return global_row_number(df, order_cols) if days is None else _by_day(df, order_cols, days)


def before_key(df: DataFrame, order_cols: list[str], key: tuple) -> Column:
    """Whether a row stands before ``key`` (nulls are first, as in a sort)."""
    cells = [F.lit(v).cast(df.schema[c].dataType).alias(c) for v, c in zip(key, order_cols)]
    return F.struct(*order_cols) < F.struct(*cells)


def _row_count(df: DataFrame, days: list[tuple] | None) -> int:
    return sum(n for _, n in days) if days is not None else df.count()


def temporal_split(df: DataFrame, order_cols: list[str], train_frac: float = 0.9) -> DataFrame:
    """Rows before position int(frac * n) are train, the rest test.
    ``df`` is read for the counts, for the keys of one day, and for the rows;
    rows that are equal in all ``order_cols`` stay on one side."""
    days = day_counts(df, order_cols[0])
    key = rank_cuts(df, order_cols, [math.floor(_row_count(df, days) * train_frac)], days)[0]
    train = F.lit(True) if key is None else before_key(df, order_cols, key)
    return df.withColumn("split", F.when(train, F.lit("train")).otherwise(F.lit("test")))


def cv_folds(df: DataFrame, order_cols: list[str], n_splits: int = C.N_CV_SPLITS) -> DataFrame:
    """Expanding-window folds.  test size = n // (k+1); fold i tests on
    [n - (k-i)*size, n - (k-i-1)*size) and trains on everything before.
    ``test_fold`` = fold where the row is a test row, -1 for rows that are
    only ever trained on; fold i trains on rows with test_fold < i."""
    days = day_counts(df, order_cols[0])
    n = _row_count(df, days)
    size = n // (n_splits + 1)
    keys = rank_cuts(df, order_cols, [n - (n_splits - i) * size for i in range(n_splits)], days)
    passed = [(~before_key(df, order_cols, k)).cast("int") for k in keys if k is not None]
    return df.withColumn("test_fold", reduce(Column.__add__, passed, F.lit(-1)))


def prefix_sums(df: DataFrame, group_cols: list[str], order_cols: list, sum_cols: list[str],
                num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` per group in ``order_cols``
    order, without putting a whole group into one task.

    Rows are range-partitioned on (group, order), each partition's per-group
    totals (a table of partitions x groups) give the carried-in offsets, and
    a window per (partition, group) adds the local running sum.
    ``order_cols`` may hold Column expressions (e.g. ``F.col('s').desc()``).
    """
    keys = [F.col(c) for c in group_cols] + [F.col(c) if isinstance(c, str) else c for c in order_cols]
    dealt = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    ranged = cut_lineage(dealt.sortWithinPartitions(*keys))
    tagged = ranged.withColumn("__pid", F.spark_partition_id())
    totals = tagged.groupBy("__pid", *group_cols).agg(*[F.sum(c).alias(f"__tot_{c}") for c in sum_cols])
    w_off = Window.partitionBy(*group_cols).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__pid", *group_cols, *[
        F.coalesce(F.sum(f"__tot_{c}").over(w_off), F.lit(0)).alias(f"__off_{c}") for c in sum_cols])
    w_loc = Window.partitionBy("__pid", *group_cols).orderBy(*[k for k in keys[len(group_cols):]]) \
        .rowsBetween(Window.unboundedPreceding, 0)
    local = tagged.select("*", *[F.sum(c).over(w_loc).alias(f"__loc_{c}") for c in sum_cols])
    out = local.join(F.broadcast(offsets), ["__pid", *group_cols])
    for c in sum_cols:
        out = out.withColumn(f"cum_{c}", F.col(f"__off_{c}") + F.col(f"__loc_{c}"))
    return out.drop("__pid", *[f"__off_{c}" for c in sum_cols], *[f"__loc_{c}" for c in sum_cols])
