"""Planning of WARC shards: a fixed number of jobs, shards from the data alone, rows without an id spread."""

import pytest
from pyspark.sql import functions as F


def planned(spark, sizes, target, group):
    from matchstats.llm.warc import plan_shards
    spark.sparkContext.setJobGroup(group, group)
    try:
        return plan_shards(sizes, target), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("rows", [40, 6000])
def test_every_range_is_heavy(spark, rows):
    """Ids far apart, each larger than a shard: a shard each, in as many jobs for many as for few."""
    sizes = spark.range(rows).select((F.col("id") * 10**14).alias("page_id"), F.lit(100).cast("long").alias("bytes"))
    (bounds, unnamed), jobs = planned(spark, sizes, 64, f"heavy-{rows}")
    assert bounds == [i * 10**14 for i in range(1, rows)] and unnamed == 0
    assert 0 < jobs <= 20


def test_shards_follow_from_the_data(spark):
    sizes = spark.range(-500, 500).select(
        F.when(F.col("id") % 10 != 0, F.col("id") * 7).alias("page_id"), (F.abs("id") % 13).cast("long").alias("bytes"))
    sizes = sizes.union(sizes.filter("page_id % 3 = 0"))
    got = [planned(spark, sizes.repartition(n), 50, f"same-{n}")[0] for n in (1, 4, 9)]
    assert got[0] == got[1] == got[2]
    rows = sorted((r["page_id"], r["bytes"]) for r in sizes.filter("page_id IS NOT NULL").collect())
    edges = [None, *got[0][0], None]
    for low, high in zip(edges, edges[1:]):
        mine = [b for i, b in rows if (low is None or i >= low) and (high is None or i < high)]
        assert mine and sum(mine) < 50 + 2 * 12 * 2
    nulls = sum(r["bytes"] for r in sizes.filter("page_id IS NULL").collect())
    assert got[0][1] == -(-nulls // 50)


def test_rows_without_an_id_go_to_several_shards(spark, scratch):
    from matchstats.llm.warc import read_archive, write_archive
    pages = spark.range(400).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("page_id"), F.lit("u").alias("url"),
                                    F.concat(F.lit("page "), F.col("id").cast("string"), F.lit(" x" * 50)).alias("html"))
    write_archive(pages, f"{scratch}/w", shard_bytes=3_000)
    shards = spark.read.parquet(f"{scratch}/w/_manifest").groupBy("shard").agg(F.sum("records").alias("n"))
    assert shards.count() > 10 and shards.agg(F.max("n")).first()[0] < 80
    assert read_archive(spark, f"{scratch}/w").count() == 400
