"""Key scans, stored layouts and point lookups."""

from __future__ import annotations

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F, types as T

from ledgerbrook.operators import keyvalue as kv


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns or df.columns).collect())


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_key_range_is_half_open(spark):
    df = spark.createDataFrame([("a", "1", "x"), ("b", "no", "y"), ("c", "3", "z")], "k string, age string, uuid string")
    record = T.StructType([T.StructField("age", T.IntegerType()), T.StructField("uuid", T.StringType())])
    assert rows_of(kv.key_range_scan(df, "k", "a", "c", record), "k", "uuid") == [("a", "x"), ("b", "y")]
    ages = {r.k: r.age for r in kv.key_range_scan(df, "k", None, None, record).collect()}
    assert ages == {"a": 1, "b": None, "c": 3}
    assert rows_of(kv.key_range_scan(df, "k", "b", None), "k") == [("b",), ("c",)]


def test_key_order_layout_pushes_the_range(spark, tmp_path):
    path = str(tmp_path / "table")
    df = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("k"), "id")
    kv.write_by_key(df, "k", path)
    scan = kv.key_range_scan(spark.read.parquet(path), "k", "000100", "000110").select("k")
    assert scan.count() == 10
    assert "GreaterThanOrEqual(k,000100)" in plan(scan) and "LessThan(k,000110)" in plan(scan)
    assert "ReadSchema: struct<k:string>" in plan(scan)


def test_salted_range(spark):
    df = spark.createDataFrame([("A", "A-10"), ("A", "A-20"), ("B", "B-15"), ("B", "B-30"), ("C", "C-15")], "salt string, k string")
    got = kv.salted_range_scan(df, "k", ["A", "B"], "10", "20", original="plain")
    assert rows_of(got) == [("A", "A-10", "10"), ("B", "B-15", "15")]


def test_salted_layout_is_pruned(spark, tmp_path):
    path = str(tmp_path / "salted")
    salts = ["A", "B", "C"]
    df = spark.range(900).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("k"), "id")
    kv.write_salted(kv.with_salt(df, "k", salts), "k", path)
    stored = spark.read.parquet(path)
    assert {r.salt for r in stored.select("salt").distinct().collect()} == set(salts)
    scan = kv.salted_range_scan(stored, "k", salts, "000100", "000120", original="plain")
    assert rows_of(scan, "plain") == [(f"{i:06d}",) for i in range(100, 120)]
    part = kv.salted_range_scan(stored, "k", ["A"], "000100", "000120")
    text = plan(part)
    assert "PartitionFilters: [isnotnull(salt" in text and "(salt" in text and "= A" in text
    assert "GreaterThanOrEqual(k,A-000100)" in text


def test_several_salts_are_pruned(spark, tmp_path):
    path = str(tmp_path / "salted")
    df = spark.range(90).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("k"), "id")
    kv.write_salted(kv.with_salt(df, "k", ["A", "B", "C"]), "k", path)
    scan = kv.salted_range_scan(spark.read.parquet(path), "k", ["A", "C"], "0", "1")
    text = plan(scan)
    filters = text[text.index("PartitionFilters"):text.index("PushedFilters")]
    assert "A" in filters and "C" in filters and "B" not in filters.replace("Batched", "")
    pushed = text[text.index("PushedFilters"):text.index("ReadSchema")]
    assert "A-0" in pushed and "C-0" in pushed


def test_cells(spark):
    df = spark.createDataFrame([("k", "x", 5, None)], "rowkey string, a string, b int, c string")
    assert rows_of(kv.cells(df, "rowkey")) == [("k", "a", "x"), ("k", "b", "5")]
    assert rows_of(kv.cells(df, "rowkey", ["a"], family="f")) == [("k", "f", "a", "x")]
    full = kv.cells(df.withColumn("at", F.lit(9)), "rowkey", family="f", timestamp="at")
    assert full.columns == ["rowkey", "family", "qualifier", "at", "value"]
    assert rows_of(full) == [("k", "f", "a", 9, "x"), ("k", "f", "b", 9, "5")]


def test_point_lookup(spark):
    table = spark.createDataFrame([("123", "ann", "7"), ("456", "bob", "8")], "rowkey string, name string, age string")
    lines = spark.createDataFrame([("321,x,y",), ("321",), ("999,z",)], "value string")
    assert rows_of(kv.point_lookup(table, kv.reversed_keys(lines))) == [("123", "age", "7"), ("123", "name", "ann")]


def leaves(run) -> list:
    """The scans of an executed plan, those inside finished stages too."""
    if run.nodeName().startswith("AdaptiveSparkPlan"):
        return leaves(run.executedPlan())
    found = run.collectLeaves()
    out = []
    for leaf in (found.apply(i) for i in range(found.size())):
        out += leaves(leaf.plan()) if "QueryStage" in leaf.nodeName() else [leaf]
    return out


def scanned(df) -> dict:
    """What the stored table's scan read: rows handed on, files and partitions listed."""
    df.collect()
    for leaf in leaves(df._jdf.queryExecution().executedPlan()):
        if "parquet" in leaf.nodeName():
            metrics = leaf.metrics()
            return {n: metrics.apply(n).value() for n in ("numOutputRows", "numFiles", "numPartitions") if metrics.contains(n)}
    return {"numOutputRows": 0, "numFiles": 0, "numPartitions": 0}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """200,000 even numbers' digests in eight buckets with small row groups."""
    path = str(tmp_path_factory.mktemp("lookup") / "table")
    df = spark.range(200_000).select(F.md5((F.col("id") * 2).cast("string")).alias("rowkey"), F.col("id").cast("string").alias("name"))
    kv.write_for_lookup(df.repartition(8), "rowkey", path, buckets=8, group_bytes=128 << 10)
    return path


def digests(spark, numbers):
    return spark.createDataFrame([(i,) for i in numbers], "id long").select(F.md5(F.col("id").cast("string")).alias("rowkey"))


def test_lookup_skips_row_groups_without_the_key(spark, stored):
    table = spark.read.parquet(stored)
    groups = sum(pq.ParquetFile(f).metadata.num_row_groups for f in Path(stored).glob("*/*.parquet"))
    assert groups > 40
    absent = kv.rows_of_keys(table, digests(spark, [1]), buckets=8)
    read = scanned(absent)
    assert read["numOutputRows"] == 0 and read["numPartitions"] == 1 and absent.count() == 0
    rare = kv.rows_of_keys(table, digests(spark, [8, 11, 13]), buckets=8)
    read = scanned(rare)
    assert 0 < read["numOutputRows"] <= 200_000 / groups * 3 and read["numPartitions"] <= 3
    assert rows_of(rare, "name") == [("4",)]


def test_bloom_filter_rules_out_keys_between_the_bounds(spark, tmp_path):
    """Keys in no order: every row group's bounds hold the key, its Bloom filter does not."""
    path = str(tmp_path / "unordered")
    df = spark.range(60_000).select(F.md5((F.col("id") * 2).cast("string")).alias("rowkey"), F.lit(0).alias(kv.BUCKET))
    writer = df.coalesce(1).write.option("parquet.bloom.filter.enabled#rowkey", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    writer.partitionBy(kv.BUCKET).option("parquet.block.size", 256 << 10).option("parquet.page.size.row.check.min", 100).parquet(path)
    found = scanned(kv.rows_of_keys(spark.read.parquet(path), digests(spark, [8]), buckets=1))["numOutputRows"]
    assert 0 < found < 30_000
    assert scanned(kv.rows_of_keys(spark.read.parquet(path), digests(spark, [9, 15]), buckets=1))["numOutputRows"] == 0


def test_many_keys_are_joined_and_prune_folders(spark, stored):
    table = spark.read.parquet(stored)
    keys = digests(spark, [2 * i for i in range(40)] + [2 * i + 1 for i in range(40)])
    joined = kv.rows_of_keys(table, keys, buckets=8, few=10)
    assert rows_of(joined) == rows_of(kv.rows_of_keys(table, keys, buckets=8)) and joined.count() == 40
    assert "dynamicpruning" in plan(joined).lower()
    one_bucket = keys.where(F.pmod(F.xxhash64("rowkey"), F.lit(8)) == 3)
    assert scanned(kv.rows_of_keys(table, one_bucket, buckets=8, few=1))["numPartitions"] == 1


def test_stored_lookup_equals_the_plain_one(spark, tmp_path):
    rows = [(str(i), f"n{i}", str(i % 7)) for i in range(300)] + [(None, "x", "1"), ("", "y", "2"), ("5", "twice", None)]
    df = spark.createDataFrame(rows, "rowkey string, name string, age string")
    keys = spark.createDataFrame([("5",), ("5",), ("299",), ("300",), (None,), ("",)], "rowkey string")
    kv.write_for_lookup(df, "rowkey", str(tmp_path / "t"), buckets=5)
    table = spark.read.parquet(str(tmp_path / "t"))
    expected = rows_of(kv.point_lookup(df, keys))
    assert rows_of(kv.stored_point_lookup(table, keys, buckets=5)) == expected
    assert rows_of(kv.stored_point_lookup(table, keys, buckets=5, few=1)) == expected
    assert kv.rows_of_keys(table, keys.limit(0), buckets=5).count() == 0
