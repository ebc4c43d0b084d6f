"""Mixing, sharding and the helpers they share, against plain Python."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import cases
import pytest
from pyspark.sql import functions as F

from ledgerbrook.llm import common, mixing, sharding


@pytest.mark.parametrize("blocks", [1, 4, 16])
def test_running_sums(spark, blocks):
    rows = [(g, k, v) for g in "abc" for k in range(40) for v in [(k * 7 + ord(g)) % 11 if k % 5 else None]]
    df = spark.createDataFrame(rows, "g string, k int, v long").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", blocks)
    try:
        got = common.running(df, "g", ["k"], {"s": F.col("v"), "i": F.lit(1)}, "test").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for g in "abc":
        total = 0
        for i, r in enumerate(sorted((r for r in got if r["g"] == g), key=lambda r: r["k"])):
            assert (r["i"], r["s"]) == (i, total)
            total += r["v"] or 0


def targets(sizes: dict, weights=mixing.WEIGHTS, share=mixing.SHARE, stop=mixing.STOP) -> dict:
    """Reshare the excess by weight, round after round."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed, open_ = {}, set(order)
    while True:
        left = share * sum(sizes.values()) - sum(fixed.values())
        total = sum(weight[s] for s in open_)
        now = {s: left * weight[s] / total for s in open_} if total else {}
        over = {s for s in open_ if now[s] > stop * sizes[s] + 1e-9}
        if not over:
            return fixed | now
        fixed |= {s: stop * sizes[s] for s in over}
        open_ -= over


def test_targets_reshare_until_none_is_above(spark):
    for sizes in ({"a": 10, "b": 1000, "c": 5, "d": 700, None: 40}, {"a": 3}, {"z": 0, "y": 8}, {f"s{i:02}": i * i for i in range(30)}):
        df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
        expected = targets(sizes)
        assert got.keys() == expected.keys()
        assert all(math.isclose(got[s], expected[s], rel_tol=1e-9, abs_tol=1e-9) for s in got)


def test_draws_and_mix(spark):
    df = cases.table(spark)
    data = cases.rows()
    sizes: dict = defaultdict(int)
    for r in data:
        sizes[r[3]] += len(cases.words(r[1]))
    expected = targets(sizes)
    got = mixing.draws(df).collect()
    assert len(got) == len(data)
    for r in got:
        u = int(hashlib.md5(f"mix:{'' if r['doc_id'] is None else r['doc_id']}".encode()).hexdigest()[:13], 16) / 2**52
        rate = expected[r["source"]] / sizes[r["source"]] if sizes[r["source"]] else 0
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], expected[r["source"]], rel_tol=1e-9)
        assert r["copies"] == math.floor(rate) + (u < rate - math.floor(rate)) and r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    copies = Counter()
    for r in got:
        copies[(r["doc_id"], r["source"], r["size"])] += r["copies"]
    found = Counter((r["doc_id"], r["source"], len(cases.words(r["text"]))) for r in mixed.collect())
    assert found == +copies


def test_mix_comes_near_its_targets_and_reruns_agree(spark):
    data = [(i, "w " * (1 + i % 13), None, f"s{i % 5}", None) for i in range(6000)]
    df = cases.table(spark, data, extra=False)
    first, again = mixing.draws(df), mixing.draws(df.repartition(2))
    sums = first.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r["taken"] - r["target"]) < 0.05 * r["target"] for r in sums)
    assert first.exceptAll(again).isEmpty()


def test_mix_of_nothing(spark):
    empty = cases.table(spark, [])
    assert mixing.draws(empty).count() == mixing.mix(empty).count() == 0


def brute_kd(data: list[tuple], shards: int) -> dict:
    """Recursive splits in plain Python."""
    def size(r):
        return len((r[1] or "").encode()) + 1

    def crc(r):
        return zlib.crc32((r[1] or "").encode())

    dims = (lambda r: r[3], lambda r: r[2], lambda r: r[4])

    def spread(rows, d):
        values = [dims[d](r) for r in rows if dims[d](r) is not None]
        if not values:
            return 0.0
        return float(max(values) - min(values)) if d == 2 else float(len(set(values)) - 1)

    whole = [spread(data, d) for d in range(3)]
    out: dict = {}

    def split(rows, first, k):
        share = [spread(rows, d) / whole[d] if whole[d] else 0.0 for d in range(3)]
        d = max(range(3), key=lambda i: (share[i], -i))
        none = [dims[d](r) is None for r in rows]
        key = lambda i: (none[i], 0 if none[i] else dims[d](rows[i]), crc(rows[i]), rows[i][0] is None, rows[i][0] or 0)
        rows = [rows[i] for i in sorted(range(len(rows)), key=key)]
        if k == 1:
            return rows, first
        total, before, left, right = sum(map(size, rows)), 0, [], []
        for r in rows:
            (right if before + size(r) / 2 > total * (k // 2 / k) else left).append(r)
            before += size(r)
        return (left, first, k // 2), (right, first + k // 2, k - k // 2)

    todo = [(data, 0, shards)]
    while any(k > 1 for _, _, k in todo):
        new = []
        for rows, first, k in todo:
            if k == 1:
                rows, _ = split(rows, first, 1) if rows else (rows, first)
                new.append((rows, first, 1))
            else:
                new += [*split(rows, first, k)]
        todo = new
    for rows, first, _ in todo:
        for r in rows:
            out[r[0]] = first
    return out


@pytest.mark.parametrize("shards", [1, 2, 5, 8])
def test_kd_shards(spark, shards):
    data = cases.unique(cases.rows())
    got = sharding.kd_shards(cases.table(spark, data), shards).collect()
    assert len(got) == len(data)
    assert {r["doc_id"]: r["shard"] for r in got} == brute_kd(data, shards)
    texts = {r[0]: (r[1] or "").encode() for r in data}
    slots = defaultdict(list)
    for r in got:
        assert r["size"] == len(texts[r["doc_id"]]) + 1 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]])
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_have_near_equal_bytes(spark):
    data = [(i, "x" * (1 + i * 37 % 400), ("en", "de")[i % 3 == 0], f"s{i % 7}", i % 400) for i in range(3000)]
    data += [(5000 + i, "copy of one text", "en", "s0", 16) for i in range(3000)]
    sums: dict = defaultdict(int)
    for r in sharding.kd_shards(cases.table(spark, data, extra=False), 16).collect():
        sums[r["shard"]] += r["size"]
    mean = sum(sums.values()) / 16
    assert len(sums) == 16 and all(abs(s - mean) <= 2 * 400 for s in sums.values())


def test_shards_by_target_bytes_and_awkward_rows(spark):
    got = sharding.kd_shards(cases.table(spark), target_bytes=40_000).collect()
    assert len(got) == len(cases.rows())
    assert max(r["shard"] for r in got) + 1 <= sharding.leaves_for(sum(r["size"] for r in got), 40_000)
    assert sharding.kd_shards(cases.table(spark, []), 16).count() == 0


def test_write_shards(spark, tmp_path):
    data = cases.unique(cases.rows())
    df = cases.table(spark, data, extra=False)
    placed = sharding.kd_shards(df, 4)
    sharding.write_shards(df, placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.select("doc_id", "shard", "slot").exceptAll(placed.select("doc_id", "shard", "slot")).isEmpty()
    assert back.count() == len(data)
