"""Strict backward as-of lookups on keyed daily state tables.

"Everything about key K strictly before date D" is answered without a
per-row scan: state changes are first collapsed to one row per (key, date)
(partial aggregation before the shuffle), then a window per key over the
*daily* table carries the last state forward with a frame that ends one
row before the current date.  Per key the window holds at most one row per
calendar day, so a hot key cannot blow up a task; queries are answered by
an equi-join on (key, date).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_strict(queries: DataFrame, states: DataFrame, key_cols: list[str], date_col: str,
                state_cols: list[str], query_key_cols: list[str] | None = None,
                order_cols: list[str] | None = None, prefix: str = "") -> DataFrame:
    """For each query row, the latest ``state_cols`` of the same key with
    ``states.date < queries.date`` (NULL if none).

    ``states`` may hold several rows per (key, date); the last one by
    ``order_cols`` (default: any) is the state after that date.
    ``query_key_cols`` names the key columns on the query side (defaults to
    ``key_cols``).
    """
    qk = query_key_cols or key_cols
    st = states.select(*key_cols, date_col, *state_cols, *(order_cols or []))
    if order_cols:
        # state after the day = last row of the day (top-1 per group, which
        # Spark plans as a partial group limit before the shuffle).
        w_day = Window.partitionBy(*key_cols, date_col).orderBy(*[F.col(c).desc() for c in order_cols])
        st = st.withColumn("__rn", F.row_number().over(w_day)).filter("__rn = 1").drop("__rn", *order_cols)
    packed = st.select(*key_cols, date_col, F.struct(*state_cols).alias("__state"))
    qdays = queries.select(*[F.col(a).alias(b) for a, b in zip(qk, key_cols)], F.col(date_col)).distinct() \
        .withColumn("__state", F.lit(None).cast(packed.schema["__state"].dataType))
    days = (packed.unionByName(qdays)
            .groupBy(*key_cols, date_col).agg(F.max("__state").alias("__state")))
    w = Window.partitionBy(*key_cols).orderBy(date_col).rowsBetween(Window.unboundedPreceding, -1)
    before = days.select(*key_cols, date_col, F.last("__state", ignorenulls=True).over(w).alias("__before"))
    before = before.select(*[F.col(a).alias(b) for a, b in zip(key_cols, qk)], date_col,
                           *[F.col(f"__before.{c}").alias(prefix + c) for c in state_cols])
    return queries.join(before, qk + [date_col], "left")
