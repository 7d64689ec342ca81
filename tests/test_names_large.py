"""Names resolved by time buckets and pointer doubling equal the rows applied one after the other."""

import datetime as dt
import random

import pytest

from matchstats.operators import names as N

D0 = dt.date(1969, 6, 1)  # days before and after the epoch
DIM = "former string, current string, start_date date, end_date date, at int"


def applied(rows, name, day):
    if name is None or day is None:
        return name
    for former, current, start, end in rows:
        if None not in (former, start, end) and name == former and start <= day <= end:
            name = current
    return name


def check(spark, rows, facts, days):
    dim = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], DIM).repartition(3)
    df = spark.createDataFrame([(i, a, b, d, "x") for i, (a, b, d) in enumerate(facts)], "i int, a string, b string, date date, name string")
    got = {r["i"]: (r["a"], r["b"]) for r in N.resolve_names_large(df, dim, ["a", "b"], "date", ["at"]).collect()}
    assert got == {i: (applied(rows, a, d), applied(rows, b, d)) for i, (a, b, d) in enumerate(facts)}


@pytest.mark.parametrize("seed,era,bucket", [(1, 512, 32), (2, 16, 1), (3, 4, 2)])
def test_random_dimensions(spark, monkeypatch, seed, era, bucket):
    """Overlaps, equal rows, chains, loops, a name with a third of the rows, open ends, nulls."""
    monkeypatch.setattr(N, "ERA_DAYS", era)
    monkeypatch.setattr(N, "BUCKET_ROWS", bucket)
    rng = random.Random(seed)
    names = ["hot"] * 4 + [f"n{i}" for i in range(8)]
    rows = []
    for _ in range(120):
        start = D0 + dt.timedelta(days=rng.randrange(-40, 500))
        end = rng.choice([start, start + dt.timedelta(days=rng.randrange(0, 200)), dt.date(9999, 12, 31), start - dt.timedelta(days=3)])
        rows.append((rng.choice(names), rng.choice(names), start, end))
    rows += [rows[0], rows[1], (None, "q", D0, D0), ("n1", "q", None, D0), ("n1", "q", D0, None), ("n2", None, D0, D0)]
    rng.shuffle(rows)
    facts = [(rng.choice([*names, "unknown", None]), rng.choice(names), rng.choice([None, D0 + dt.timedelta(days=rng.randrange(-60, 520))]))
             for _ in range(400)]
    check(spark, rows, facts, 500)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rows = [(f"c{i}", f"c{i + 1}", D0, D0 + dt.timedelta(days=9 if i < 40 else 4)) for i in range(60)]
    rounds = []
    real = N._hop
    monkeypatch.setattr(N, "_hop", lambda *a: rounds.append(a[2]) or real(*a))
    facts = [(f"c{i}", "c0", D0 + dt.timedelta(days=k)) for i in (0, 1, 30, 59, 60) for k in (0, 4, 5, 9, 10)]
    check(spark, rows, facts, 10)
    assert rounds.count(["name"]) <= 8  # 60 renames one after the other


def test_size_decides(spark, monkeypatch):
    monkeypatch.setattr(N, "MAX_DIMENSION_ROWS", 2)
    rows = [("a", "b", D0, D0), ("b", "c", D0, D0), ("c", "d", D0, D0)]
    dim = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], DIM)
    df = spark.createDataFrame([("a", D0)], "team string, date date")
    assert N.resolve_names(df, dim, ["team"], order_cols=["at"]).first()["team"] == "d"
    assert N.resolve_names(df, dim.limit(0), ["team"]).first()["team"] == "a"
    assert N.resolve_names_large(df, dim.limit(0), ["team"]).first()["team"] == "a"
    assert N.resolve_names_large(df.limit(0), dim, ["team"]).count() == 0


def test_short_chains_need_no_doubling(spark, monkeypatch):
    """Hops of all rows, and hops of hops, are made only for chains beyond ``PLAIN_ROUNDS`` renames."""
    monkeypatch.setattr(N, "_hop", lambda *a: pytest.fail("doubled"))
    rows = [("a", "b", D0, D0 + dt.timedelta(days=9)), ("b", "c", D0, D0 + dt.timedelta(days=4)), ("c", "a", D0, D0)]
    rows += [("c", "d", D0, D0 + dt.timedelta(days=3)), ("d", None, D0, D0 + dt.timedelta(days=9)), ("a", "e", D0, D0), rows[0], rows[1]]
    check(spark, rows[:4] + rows[5:], [(n, "b", D0 + dt.timedelta(days=k)) for n in "abcde" for k in (-1, 0, 1, 4, 5, 10)], 10)


def test_steps_leave_the_disks_early(spark, monkeypatch):
    """When a step begins, of the former steps only what is still needed lies in the shared folder, and no shuffle files stay."""
    import os
    import time
    from tests.test_trees import shuffle_files
    rows = [(i, f"n{i}", f"n{i + 1}", dt.date(2000, 1, 1), dt.date(2001, 1, 1)) for i in range(4)]
    dim = spark.createDataFrame(rows, "at int, former string, current string, start_date date, end_date date")
    df = spark.createDataFrame([(dt.date(2000, 5, 1), "n0"), (dt.date(2000, 6, 1), "n2"), (dt.date(2003, 1, 1), "n1")], "date date, team string")
    there, real, made, before = [], N.work_table, [], shuffle_files(spark)

    def kept(table, name):
        there.append((name, sorted(n for n, t in made if os.path.exists(t._work_path.replace("file:", "")))))
        made.append((name, real(table, name)))
        return made[-1][1]

    monkeypatch.setattr(N, "work_table", kept)
    got = N.resolve_names_large(df, dim, ["team"], order_cols=["at"]).collect()
    assert sorted(r["team"] for r in got) == ["n1", "n4", "n4"]
    rounds = [held for name, held in there if name == "name-rounds"]
    assert len(rounds) >= 4 and not any("names" in held for held in rounds)
    assert all(held.count("name-rounds") <= 1 and ("asked" in held) == (i == 0) for i, held in enumerate(rounds))
    until = time.time() + 20
    while shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.1)
    assert sorted({n for n, t in made if os.path.exists(t._work_path.replace("file:", ""))}) == ["name-ended"]
