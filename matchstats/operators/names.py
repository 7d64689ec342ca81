"""Date-aware entity-name resolution (temporal range join)."""

from __future__ import annotations

import datetime as dt

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchstats.session import remove_work_table, work_table

#: Up to so many rows a name dimension is closed on the driver and sent to the facts.
MAX_DIMENSION_ROWS = 100_000
#: Time is cut into eras of this many days; a name with many rows into
#: stretches of an era (a power of two days) with about ``BUCKET_ROWS`` starts.
ERA_DAYS, BUCKET_ROWS = 512, 32
#: Renames that are looked up one after the other before chains are doubled.
PLAIN_ROUNDS = 6
_DAY = dt.timedelta(days=1)


def normalise_dimension(dim: DataFrame) -> DataFrame:
    """The dimension as disjoint intervals per former name, closed under
    renaming, so that one left join equals applying its rows one after the
    other in file order (a row sees the names that earlier rows gave).

    Equal rows, equal starts, overlaps and chains Old -> Mid -> New are
    resolved here, per former name and stretch of days between two interval
    ends.  Rows with a NULL end, start or former name never match.
    """
    rows = _bounded_rows(dim)
    if rows is None:
        raise ValueError(f"beyond {MAX_DIMENSION_ROWS} rows names are resolved by resolve_names_large")
    return _normalised(dim, rows)


def _bounded_rows(dim: DataFrame) -> list[tuple] | None:
    """The dimension's rows in file order, None if there are too many."""
    rows = [(r["former"], r["current"], r["start_date"], r["end_date"])
            for r in dim.select("former", "current", "start_date", "end_date").limit(MAX_DIMENSION_ROWS + 1).collect()]
    return rows if len(rows) <= MAX_DIMENSION_ROWS else None


def name_resolver(dim: DataFrame, order_cols: list[str] | None = None) -> Callable[[DataFrame, list[str]], DataFrame]:
    """A function (table, name columns) -> table with resolved names, by the
    size of the dimension, which is read once for all tables."""
    rows = _bounded_rows(dim.orderBy(*order_cols) if order_cols else dim)
    if rows is None:
        return lambda df, cols: resolve_names_large(df, dim, cols, order_cols=order_cols)
    names = _normalised(dim, rows)
    return lambda df, cols: resolve_names(df, names, cols, normalised=True)


def _normalised(dim: DataFrame, rows: list[tuple]) -> DataFrame:
    rows = [r for r in rows if None not in (r[0], r[2], r[3]) and r[2] <= r[3]]
    by_name: dict[str, list[int]] = {}
    for i, r in enumerate(rows):
        by_name.setdefault(r[0], []).append(i)

    out = []
    for former in by_name:
        reach, open_names = set(), [former]
        while open_names:  # rows that a chain from this name may use
            for i in by_name.get(open_names.pop(), []):
                if i not in reach:
                    reach.add(i)
                    open_names.append(rows[i][1])
        order = sorted(reach)
        cuts = sorted({d for i in order for d in (rows[i][2], rows[i][3] + _DAY if rows[i][3] < dt.date.max else None) if d})
        for start, after in zip(cuts, [*cuts[1:], None]):
            name = former
            for i in order:
                if rows[i][0] == name and rows[i][2] <= start <= rows[i][3]:
                    name = rows[i][1]
            end = after - _DAY if after else max(rows[i][3] for i in order)
            if name != former and start <= end:
                if out and out[-1][:2] == (former, name) and out[-1][3] + _DAY == start:
                    out[-1] = (*out[-1][:3], end)
                else:
                    out.append((former, name, start, end))
    return dim.sparkSession.createDataFrame(out, "former string, current string, start_date date, end_date date")


def resolve_names(df: DataFrame, dim: DataFrame, name_cols: list[str], date_col: str = "date",
                  normalised: bool = False, order_cols: list[str] | None = None) -> DataFrame:
    """Replace ``name`` as the dimension's rows do in file order: with
    ``current`` when ``name == former`` and ``start_date <= date <= end_date``
    (both ends inclusive); NULL dates and unmatched names stay unchanged.
    A fact row matches one normalised interval at most, so none is doubled.

    Each column is a hash join on ``name == former`` with the interval as join
    condition; the dimension is bounded (``MAX_DIMENSION_ROWS``) and sent to
    the facts.  ``normalised``: ``dim`` is a ``normalise_dimension`` result.
    A larger one goes by ``resolve_names_large``; ``order_cols`` name its file
    order where the order of reading does not.
    """
    if not normalised:
        if dim.limit(MAX_DIMENSION_ROWS + 1).count() > MAX_DIMENSION_ROWS:
            return resolve_names_large(df, dim, name_cols, date_col, order_cols)
        dim = dim.orderBy(*order_cols) if order_cols else dim
    d = dim if normalised else normalise_dimension(dim)
    out = df
    for i, c in enumerate(name_cols):
        r = d.select(
            F.col("former").alias(f"__former{i}"), F.col("current").alias(f"__current{i}"),
            F.col("start_date").alias(f"__start{i}"), F.col("end_date").alias(f"__end{i}"))
        cond = ((F.col(c) == F.col(f"__former{i}"))
                & (F.col(date_col) >= F.col(f"__start{i}"))
                & (F.col(date_col) <= F.col(f"__end{i}")))
        out = (out.join(F.broadcast(r), cond, "left")
               .withColumn(c, F.coalesce(F.col(f"__current{i}"), F.col(c)))
               .drop(f"__former{i}", f"__current{i}", f"__start{i}", f"__end{i}"))
    return out


def _bucket(day: Column, width: Column) -> Column:
    return F.floor(day / width)


def _pieces(cands: Column, low: Column, high: Column) -> Column:
    """Stretches of [low, high] with the first row (``pos``) of ``cands``
    (pos, s, e) that covers each, null where none does."""
    starts = F.transform(cands, lambda c: F.greatest(c["s"], low))
    after = F.filter(F.transform(cands, lambda c: c["e"] + 1), lambda d: (d > low) & (d <= high))
    cuts = F.array_sort(F.array_distinct(F.concat(F.array(low), F.filter(starts, lambda d: d <= high), after)))

    def piece(cut: Column, i: Column) -> Column:
        covering = F.filter(cands, lambda c: (c["s"] <= cut) & (c["e"] >= cut))
        end = F.coalesce(F.get(cuts, i + 1) - 1, high)
        return F.struct(cut.alias("s"), end.alias("e"), F.array_min(F.transform(covering, lambda c: c["pos"])).alias("dst"))

    return F.transform(cuts, piece)


def _hop(left: DataFrame, hops: DataFrame, keys: list[str]) -> DataFrame:
    """``left`` (keys, s, e, dst) one composition further: where ``dst`` has
    hops, the stretch goes on to theirs."""
    h = hops.select(F.col("src").alias("dst"), F.col("era").alias("h_era"), F.col("s").alias("h_s"), F.col("e").alias("h_e"),
                    F.col("dst").alias("h_dst"))
    j = left.join(h, (left["dst"] == h["dst"]) & (left["era"] == h["h_era"]) & (left["s"] <= h["h_e"]) & (h["h_s"] <= left["e"]), "left")
    new = F.coalesce("h_dst", left["dst"])
    return j.select(*keys, "era", F.greatest("s", "h_s").alias("s"), F.least("e", "h_e").alias("e"), new.alias("dst"),
                    (new != left["dst"]).alias("moved"))


def _numbered(valid: DataFrame, order_cols: list[str]) -> DataFrame:
    """``valid`` with ``pos``, ascending (with gaps) in ``order_cols`` order: a
    range partition's number and the place in it.  To be written once."""
    return valid.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols).withColumn("pos", F.monotonically_increasing_id())


def _renamed(asked: DataFrame, widths: DataFrame, groups: DataFrame) -> DataFrame:
    """``asked`` (name, day, at, dst) one rename further: the first row after
    ``dst`` that covers the day and renames ``at``; ``moved`` where there is one."""
    placed = asked.join(widths.withColumnRenamed("former", "at"), "at", "left").withColumn("b", _bucket(F.col("day"), F.col("w")))
    g = groups.select(F.col("former").alias("at"), "b", "cands")
    later = F.filter("cands", lambda c: (c["pos"] > F.col("dst")) & (c["s"] <= F.col("day")) & (c["e"] >= F.col("day")))
    first = F.array_min(F.transform(later, lambda c: F.struct(c["pos"].alias("pos"), c["current"].alias("current"))))
    return (placed.join(g, ["at", "b"], "left").withColumn("first", first)
            .select("name", "day", F.when(F.col("first").isNull(), F.col("at")).otherwise(F.col("first.current")).alias("at"),
                    F.coalesce("first.pos", "dst").alias("dst"), F.col("first").isNotNull().alias("moved")))


def resolve_names_large(df: DataFrame, dim: DataFrame, name_cols: list[str], date_col: str = "date",
                        order_cols: list[str] | None = None) -> DataFrame:
    """``resolve_names`` for a dimension of any size, closed in Spark.

    The distinct (name, date) pairs of the facts are what is asked.  The
    dimension's intervals, cut to the facts' days, are dealt to time buckets per
    former name (narrower ones for names with many rows).  The first row of a
    pair's bucket that covers its day begins the pair's chain; the first *later*
    row for the name that a row gives follows.  ``PLAIN_ROUNDS`` renames are
    looked up pair by pair.  Pairs that still move go on by pointer doubling
    over all rows (``_doubled``), in as many rounds as the logarithm of the
    longest chain.  The facts get their answers by equality on (name, date).
    Work grows with the rows, the eras they span, and the pairs of rows of one
    name that overlap within a bucket.  Tables and shuffle files of a step are
    removed as soon as the next one has what it needs of them."""
    pairs = reduce(DataFrame.union, [df.select(F.col(c).alias("name"), F.col(date_col).cast("date").alias("day")) for c in name_cols])
    asked = work_table(pairs.filter("name IS NOT NULL AND day IS NOT NULL").distinct().withColumn("day", F.unix_date("day")), "asked")
    low, high = asked.agg(F.min("day"), F.max("day")).first()
    if low is None:
        remove_work_table(asked)
        return df
    valid = dim.select(*dict.fromkeys(["former", "current", "start_date", "end_date", *(order_cols or [])]))
    numbered = _numbered(valid, order_cols) if order_cols else valid.withColumn("pos", F.monotonically_increasing_id())
    rows = work_table(
        numbered.filter("former IS NOT NULL AND start_date IS NOT NULL AND end_date IS NOT NULL")
        .select("pos", "former", "current", F.greatest(F.unix_date("start_date"), F.lit(low)).alias("s"),
                F.least(F.unix_date("end_date"), F.lit(high)).alias("e")).filter("s <= e"), "names")
    # a power of two days per former name
    days = F.lit(float((high - low + 1) * BUCKET_ROWS)) / F.count(F.lit(1))
    width = F.pow(F.lit(2.0), F.least(F.greatest(F.floor(F.log2(days)), F.lit(0)), F.lit(ERA_DAYS.bit_length() - 1)))
    widths = work_table(rows.groupBy("former").agg(width.cast("int").alias("w")), "name-widths")
    groups = work_table(_dealt(rows.join(widths, "former")).groupBy("former", "w", "b")
                        .agg(F.collect_list(F.struct("pos", "s", "e", "current")).alias("cands")), "name-buckets")
    remove_work_table(rows)  # the buckets hold them, too
    before, answers = asked, []
    at = asked.select("name", "day", F.col("name").alias("at"), F.lit(-1).cast("long").alias("dst"))
    for _ in range(PLAIN_ROUNDS):
        step = work_table(_renamed(at, widths, groups).filter("moved OR dst >= 0"), "name-rounds")
        ended = step.filter("NOT moved AND NOT (at <=> name)").select("name", "day", F.col("at").alias("current"))
        answers.append(work_table(ended, "name-ended"))
        remove_work_table(before)
        before, at = step, step.filter("moved").drop("moved")
        if not at.limit(1).count():
            break
    else:
        rows = work_table(groups.select("former", F.inline("cands")).dropDuplicates(["pos"]), "names")
        begin = _doubled(at, rows, widths, groups)
        last = begin.join(rows.select(F.col("pos").alias("dst"), "current"), "dst").filter("NOT (current <=> name)")
        answers.append(work_table(last.select("name", F.col("s").alias("day"), "current"), "name-ended"))
        for table in (begin, rows):
            remove_work_table(table)
    for table in (before, widths, groups):
        remove_work_table(table)
    answers = reduce(DataFrame.union, answers).select("name", F.date_from_unix_date("day").alias("day"), "current")
    out = df
    for i, c in enumerate(name_cols):
        a = answers.toDF(f"__name{i}", f"__day{i}", f"__current{i}")
        out = (out.join(a, (F.col(c) == F.col(f"__name{i}")) & (F.col(date_col).cast("date") == F.col(f"__day{i}")), "left")
               .withColumn(c, F.coalesce(f"__current{i}", c)).drop(f"__name{i}", f"__day{i}", f"__current{i}"))
    return out


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows with their name's width ``w``, once for each bucket ``b`` that they reach."""
    return rows.withColumn("b", F.explode(F.sequence(_bucket(F.col("s"), F.col("w")), _bucket(F.col("e"), F.col("w")))))


def _doubled(at: DataFrame, rows: DataFrame, widths: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs ``at`` (name, day, dst) with the last row of their chains, as a
    work table (name, s, e, dst; s and e the day).  A row's hops lead, by stretches of its days, to the first later row for the
    name that it gives; pairs and hops are composed with the hops until no pair
    moves."""
    first, last = F.col("b") * F.col("w"), (F.col("b") + 1) * F.col("w") - 1
    era = _bucket(F.col("s"), F.lit(ERA_DAYS)).alias("era")
    src = rows.select(F.col("pos").alias("src"), F.col("current").alias("former"), "s", "e").join(widths, "former")
    later = _dealt(src).join(groups.select("former", "b", "cands"), ["former", "b"], "left").select(
        "src", F.greatest(F.col("s"), first).cast("int").alias("low"), F.least(F.col("e"), last).cast("int").alias("high"),
        F.filter(F.coalesce("cands", F.array().cast(groups.schema["cands"].dataType)),
                 lambda c: (c["pos"] > F.col("src")) & (c["e"] >= F.greatest(F.col("s"), first)) & (c["s"] <= F.least(F.col("e"), last))
                 ).alias("cands"))
    hops = later.select("src", F.inline(_pieces(F.col("cands"), F.col("low"), F.col("high"))))
    hops = work_table(hops.select("src", era, "s", "e", F.coalesce("dst", "src").alias("dst")), "name-hops")
    begin = work_table(at.select("name", F.col("day").alias("s"), F.col("day").alias("e"), "dst").select("name", era, "s", "e", "dst"), "name-begin")
    while True:
        before, begin = begin, work_table(_hop(begin, hops, ["name"]), "name-begin")
        remove_work_table(before)
        if not begin.filter("moved").limit(1).count():
            break
        before, hops = hops, work_table(_hop(hops, hops.select("*"), ["src"]), "name-hops")
        remove_work_table(before)
    remove_work_table(hops)
    return begin
