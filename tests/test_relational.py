"""Joins with hot keys, best rows, defaults, audit and upsert columns."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerbrook.operators import audit, counting, hot, relational


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(4)
    left = [(k, f"l{i}") for i, k in enumerate([0, 1, 1, 2, 3, 4, 50, None])]
    # Key 1 holds most rows of the right side, many of them exact copies.
    right = [(1, i % 3) for i in range(120)] + [(rng.randrange(6), 100 + i) for i in range(40)] + [(None, 7)]
    return (
        spark.createDataFrame(left, "key int, l string"),
        spark.createDataFrame(right, "key int, r int").repartition(6),
    )


@pytest.mark.parametrize("hot_rows", [1, 7, 30, 10**6])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_keys_change_no_result(sides, how, hot_rows):
    left, right = sides
    join = relational.left_join if how == "left" else relational.inner_join
    got = join(left, right, "key", hot_rows=hot_rows)
    assert got.columns == ["key", "l", "r"]
    assert rows_of(got) == rows_of(left.join(right, "key", how))


def test_hot_key_is_spread(spark):
    right = spark.range(2000).select(F.lit(1).alias("key"), F.col("id").alias("r")).repartition(4)
    left = spark.createDataFrame([(1, "a")], "key int, l string")
    joined = relational.left_join(left, right, "key", hot_rows=100)
    assert joined.count() == 2000
    assert "_salt" in joined._jdf.queryExecution().analyzed().toString()


def test_equal_rows_get_different_salts(spark):
    right = spark.createDataFrame([(1, "same")] * 1000, "key int, r string").repartition(2)
    found = relational.hot_keys([right], "key", 100)
    salted = relational._salted(right, "key", found, 0)
    assert salted.select("_salt").distinct().count() == found.first()["_salts"] == 10


@pytest.mark.parametrize("hot_rows", [1, 9, 40, 10**6])
def test_chains_with_hot_left_rows_and_without_keys(spark, hot_rows):
    """Nine left rows in ten share a key, or have none; sides are unique, hot or empty for it."""
    left = spark.createDataFrame([(1 if i % 10 else i, i) for i in range(300)] + [(None, i) for i in range(300, 330)], "key int, l int").repartition(4)
    one = spark.createDataFrame([(1, "a"), (10, "b")], "key int, x string")
    many = spark.createDataFrame([(1, i) for i in range(25)] + [(20, 7), (None, 1)], "key int, y int")
    last = spark.createDataFrame([(1, 0.5), (30, 1.5), (None, 9.5)], "key int, z double")
    got = relational.left_joins(left, [one, many, last], "key", hot_rows=hot_rows)
    plain = left.join(one, "key", "left").join(many, "key", "left").join(last, "key", "left")
    assert got.columns == plain.columns and rows_of(got) == rows_of(plain)


def test_hot_left_rows_stay_spread_through_a_chain(spark):
    left = spark.createDataFrame([(1 if i % 10 else i, i) for i in range(2000)], "key int, l int")
    sides = [spark.createDataFrame([(1, f"v{n}")], f"key int, c{n} string") for n in range(3)]
    found = relational.hot_keys([left, *sides], "key", 100)
    salts = relational._salted(left, "key", found, 0).where("key = 1").groupBy("_salt").count().collect()
    assert len(salts) == 18 and max(r["count"] for r in salts) <= 2 * 1800 / 18


def test_semi_anti_presence(sides):
    left, right = sides
    assert [r[1] for r in rows_of(relational.anti_join(left, right, "key"))] == ["l6", "l7"]
    assert relational.semi_join_master(left, right, "key").count() == 6
    flags = relational.presence_flag(left, right, "key", "seen").orderBy("l").collect()
    assert [r.seen for r in flags] == [1, 1, 1, 1, 1, 1, 0, 0]


def test_longest_by_key(spark):
    df = spark.createDataFrame(
        [("a", "x"), ("a", "yyy"), ("a", "zzz"), ("a", None), ("b", None), ("c", "")], "k string, t string"
    )
    assert rows_of(relational.longest_by_key(df, "k", "t")) == [("a", "zzz"), ("b", None), ("c", "")]


def test_top1_per_key(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 9.0), ("a", 3, 9.0), ("b", 4, None)], "k string, id int, p double")
    got = relational.top1_per_key(df, "k", [F.col("p"), -F.col("id")])
    assert rows_of(got) == [("a", 2, 9.0), ("b", 4, None)]


def test_union_distinct_and_counts(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    b = spark.createDataFrame([(2,), (3,)], "id int")
    assert rows_of(relational.union_distinct([a, b])) == [(1,), (2,), (3,)]
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", None)], "k string, v string")
    assert rows_of(relational.nonnull_count(df, "k", "v", "n")) == [("a", 1), ("b", 0)]


def test_defaults(spark):
    df = spark.createDataFrame([(None, None, None, None)], "s string, i int, l bigint, d double")
    assert rows_of(relational.typed_defaults(df)) == [("-", 0, 0, 0.0)]
    assert rows_of(relational.typed_defaults(relational.na_fill(df, {"s": ""}))) == [("", 0, 0, 0.0)]
    assert rows_of(relational.typed_defaults(df, columns=["i"])) == [(None, 0, None, None)]


def test_audit(spark):
    df = spark.createDataFrame([(1,)], "id int")
    text = audit.with_audit(df, 99).first()
    assert text.create_time == 99 and text.update_time == "0" and text.is_deleted == "0"
    number = audit.with_audit(df, 99, "int").first()
    assert number.update_time == 0 and number.op_latest == "bd_insert" and number.update_user == "bd"


def test_upsert_plan(spark):
    source = audit.with_audit(spark.createDataFrame([("1",), ("2",)], "id string"), 5, "int")
    target = spark.createDataFrame([("1",), ("1",), ("9",)], "id string")
    planned = audit.upsert_plan(source, target, 77)
    assert planned.columns == source.columns
    got = {r.id: (r.op_latest, r.remark, r.update_time) for r in planned.collect()}
    assert got == {
        "1": ("bd_update", "bd_update-大数据更新", 77),
        "2": ("bd_insert", "bd_insert-大数据首次插入", 0),
    }


def test_grand_total_of_many_categories(spark):
    totals = spark.range(300_000).select(F.col("id").cast("string").alias("category"), F.lit(1).cast("bigint").alias("total"))
    summed = counting.with_grand_total(totals)
    assert summed.select("grand_total").distinct().collect() == [(300_000,)]
    assert summed.count() == 300_000 and summed.where("category = '7'").first() == ("7", 1, 300_000)


def test_denylist(spark):
    counts = spark.createDataFrame([("a", 3), ("b", 2), ("c", 1)], "word string, n bigint")
    deny = spark.createDataFrame([("a",), ("c",), ("z",)], "word string")
    assert rows_of(counting.denylist_filter(counts, deny)) == [("b", 2)]
    assert counting.denylist_dropped(counts, deny).first().dropped == 4
    assert counting.denylist_dropped(counts, deny.where("word = 'z'")).first().dropped == 0


def jobs(spark, group, run):
    """How many jobs a call starts."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_small_sides_are_joined_without_a_look_at_their_keys(spark, tmp_path):
    for name, n in (("left", 5000), ("right", 50)):
        spark.range(n).select((F.col("id") % 40).alias("k"), F.col("id").alias(name)).write.parquet(str(tmp_path / name))
    left, right = (spark.read.parquet(str(tmp_path / n)) for n in ("left", "right"))
    assert jobs(spark, "plain", lambda: relational.inner_join(left, right, "k")) == 0
    assert jobs(spark, "counted", lambda: relational.inner_join(left, right, "k", hot_rows=10**6)) > 0
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert jobs(spark, "large", lambda: relational.left_join(left, right, "k")) > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_sketch_never_misses_a_hot_key(spark, monkeypatch):
    """With few buckets many keys share one; those that are hot are found, and no others."""
    monkeypatch.setattr(hot, "BUCKETS", 3)
    rows = [(k, i) for k in range(50) for i in range(30 if k in (7, 11) else 4)] + [(None, i) for i in range(90)]
    side = spark.createDataFrame(rows, "key int, v int")
    other = spark.createDataFrame([(k, k) for k in range(50)] + [(20, i) for i in range(25)], "key int, w int")
    found = hot.hot_keys([side, other], "key", 20)
    assert sorted((r["key"], r["_salts"], r["_hot"]) for r in found.collect()) == [(7, 2, [0]), (11, 2, [0]), (20, 2, [1])]
    assert hot.hot_keys([side, other], "key", 20, unique=(0, 1)) is None
    assert [r["key"] for r in hot.hot_keys([side, other], "key", 20, unique=(0,)).collect()] == [20]
    assert hot.hot_keys([side, other], "key", 500) is None
