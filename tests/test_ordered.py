"""Block-wise ordered operators against sequential models, with keys cut over many blocks."""

from __future__ import annotations

import random
from collections import defaultdict
from functools import reduce

import pytest
from pyspark.sql import functions as F

from ledgerbrook.operators import ordered


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def skewed(n: int, seed: int = 3):
    """One key holds more than half of all rows; some keys have a single row."""
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        draw = rng.random()
        key = "hot" if draw < 0.6 else None if draw < 0.65 else f"k{rng.randrange(n // 4)}"
        rows.append((key, seq, rng.randrange(-50, 100)))
    rng.shuffle(rows)
    return rows


def sequential(rows, initial=()):
    totals = defaultdict(int, initial)
    out = []
    for key, seq, value in sorted(rows, key=lambda r: r[1]):
        totals[key] += value
        out.append((str(key), seq, totals[key]))
    return sorted(out)


LAYOUTS = [{}, {"blocks": 1}, {"blocks": 4}, {"blocks": 16}]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_running_sum(spark, layout):
    rows = skewed(400)
    df = spark.createDataFrame(rows, "key string, seq int, value int").repartition(5)
    got = ordered.running_sum(df, "key", ["seq"], "value", **layout)
    shown = rows_of(got, F.coalesce("key", F.lit("None")), "seq", "running_sum")
    assert shown == sequential(rows)


@pytest.mark.parametrize("layout", LAYOUTS)
def test_running_sum_with_initial(spark, layout):
    rows = skewed(300, 9)
    initial = {"hot": 1000, "k3": 7, "absent": 5}
    df = spark.createDataFrame(rows, "key string, seq int, value bigint")
    seeds = spark.createDataFrame(list(initial.items()), "key string, value bigint")
    got = ordered.running_sum(df, "key", ["seq"], "value", initial=seeds, **layout)
    assert rows_of(got, F.coalesce("key", F.lit("None")), "seq", "running_sum") == sequential(rows, initial)


def test_two_keys(spark):
    rows = [("a", i % 2 if i % 5 else None, i, i) for i in range(120)]
    df = spark.createDataFrame(rows, "k string, g int, seq int, v bigint").repartition(4)
    plain = ordered.running_totals(df, ["k", "g"], ["seq"], {"s": F.col("v"), "n": F.lit(1)})
    cut = ordered.running_totals(
        df, ["k", "g"], ["seq"], {"s": F.col("v"), "n": F.lit(1)}, blocks=9
    )
    assert rows_of(cut, "seq", "s", "n") == rows_of(plain, "seq", "s", "n")
    assert cut.where("n = 48").count() == 2


def test_running_sum_hello(spark):
    words = [("hello", 1, 1), ("hello", 2, 1), ("x", 3, 1), ("hello", 4, 1)]
    df = spark.createDataFrame(words, "key string, seq int, value int")
    seeds = spark.createDataFrame([("hello", 1), ("world", 1)], "key string, value int")
    got = ordered.running_sum(df, "key", ["seq"], "value", initial=seeds).orderBy("seq").collect()
    assert [(r.key, r.running_sum) for r in got] == [("hello", 2), ("hello", 3), ("x", 1), ("hello", 4)]


@pytest.mark.parametrize("blocks", [None, 2, 9])
def test_surrogate_ids(spark, blocks):
    names = [f"{w}{i}" for i in range(40) for w in ("b", "a", "中", "")]
    names = sorted(set(names))
    df = spark.createDataFrame([(n,) for n in reversed(names)], "name string")
    got = rows_of(ordered.surrogate_ids(df, "name", blocks=blocks), "id", "name")
    assert got == list(enumerate(sorted(names, key=lambda n: n.encode()), 1))


@pytest.mark.parametrize("blocks", [1, 4, 16])
def test_nulls_count_as_zero(spark, blocks):
    """Keys that start with nulls, end with them, or hold nothing else."""
    rows = [(f"k{i % 3}", i, None if i < 20 or i % 3 == 2 or i % 4 == 0 else i) for i in range(60)]
    df = spark.createDataFrame(rows, "key string, seq int, value bigint").repartition(5)
    got = ordered.running_sum(df, "key", ["seq"], "value", blocks=blocks)
    assert rows_of(got, "key", "seq", "running_sum") == sequential([(k, s, v or 0) for k, s, v in rows])


def test_floating_point_sums_need_a_decimal(spark):
    df = spark.createDataFrame([("a", i, 0.1 * i) for i in range(40)], "key string, seq int, value double").repartition(4)
    with pytest.raises(TypeError, match="decimal"):
        ordered.running_sum(df, "key", ["seq"], "value")
    exact = df.withColumn("value", F.col("value").cast("decimal(20,6)"))
    results = [rows_of(ordered.running_sum(exact, "key", ["seq"], "value", blocks=n), "seq", "running_sum") for n in (1, 4, 16)]
    assert results[0] == results[1] == results[2]


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("size", [2, 3])
def test_count_window_avg(spark, layout, size):
    rows = skewed(300, 5)
    df = spark.createDataFrame(rows, "key string, seq int, value int")
    got = ordered.count_window_avg(df, "key", ["seq"], "value", size, **layout)
    groups = defaultdict(list)
    for key, _, value in sorted(rows, key=lambda r: r[1]):
        groups[str(key)].append(value)
    expected = []
    for key, values in groups.items():
        for i in range(len(values) // size):
            expected.append((key, i, int(sum(values[i * size:(i + 1) * size]) / size)))
    assert rows_of(got, F.coalesce("key", F.lit("None")), "window_no", "average") == sorted(expected)


def test_count_window_avg_golden(spark):
    values = [3, 5, 7, 4, 2, 3, 9]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], "key bigint, seq int, value bigint")
    got = ordered.count_window_avg(df, "key", ["seq"], "value").orderBy("window_no").collect()
    assert [(r.key, r.average) for r in got] == [(1, 4), (1, 5), (1, 2)]


def test_ordered_reduce_golden(spark):
    points = spark.createDataFrame([(0, 1, 1.0, 2.0), (0, 2, 3.0, 4.0), (0, 3, 5.0, 6.0)], "g int, seq int, x double, y double")
    got = ordered.ordered_reduce(points.where("x > 1"), ["g"], ["seq"]).collect()
    assert [(r.x, r.y) for r in got] == [(7.0, 11.0)]


def test_ordered_reduce_is_the_fold(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(6), seq, float(rng.randrange(100)), float(rng.randrange(100))) for seq in range(60)]
    rows.append((99, 60, 1.0, 2.0))
    df = spark.createDataFrame(rows, "g int, seq int, x double, y double").repartition(4)
    got = rows_of(ordered.ordered_reduce(df, ["g"], ["seq"]), "g", "x", "y")
    groups = defaultdict(list)
    for g, _, x, y in rows:
        groups[g].append((x, y))
    folded = {g: reduce(lambda a, b: (sum(a), sum(b)), points) for g, points in groups.items()}
    assert got == sorted((g, x, y) for g, (x, y) in folded.items())
