"""Hot keys of joins: keys with more rows or bytes than one task should handle.

A one-sided sketch comes first: rows are counted per bucket of the key's hash, in one pass that reads the key alone and
combines before its shuffle. A bucket's count is an upper bound for each of its keys, so a bucket below the
limit has no hot key. Only keys of the other buckets, mostly none, are counted exactly, by rows and by bytes.
Whether there is a hot one decides the plan only; the result is the same.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, functions as F

from ledgerbrook.session import materialise

# Rows and bytes of one key that are worth spreading over several tasks.
HOT_ROWS = 5_000_000
HOT_BYTES = 1 << 30
# Texts are taken to have so many bytes when rows stand for bytes in the sketch.
TEXT_BYTES = 256
# Buckets of the sketch. More of them tell keys of larger tables apart.
BUCKETS = 1 << 16


def row_bytes(df: DataFrame) -> Column:
    """About what a row takes: the length of its texts and 8 bytes for every other column."""
    widths = [
        F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0)) if kind in ("string", "binary") else F.lit(8)
        for name, kind in df.dtypes
    ]
    return reduce(add, widths).cast("bigint")


def is_broadcast(side: DataFrame) -> bool:
    """Whether Catalyst's own size check broadcasts this side of a join.

    Such a join has no shuffle of the other side, so hot keys are no burden to it.
    """
    limit = side.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(side._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def _limit(side: DataFrame, hot_rows: int) -> int:
    """Rows of one key up to which a side is sure to be no burden."""
    width = sum(TEXT_BYTES if kind in ("string", "binary") else 8 for _, kind in side.dtypes)
    return max(1, min(hot_rows, HOT_BYTES // width))


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _hot_buckets(sides: Mapping[int, DataFrame], key: str, hot_rows: int) -> list[int]:
    """Buckets that may hold a hot key, from one narrow pass over all sides."""
    buckets = [
        side.where(F.col(key).isNotNull()).select(_bucket(key).alias("_bucket"), F.lit(i).alias("_side")) for i, side in sides.items()
    ]
    over = [F.count_if(F.col("_side") == i) > _limit(side, hot_rows) for i, side in sides.items()]
    counted = reduce(DataFrame.unionByName, buckets).groupBy("_bucket").agg(reduce(or_, over).alias("_over"))
    return [r["_bucket"] for r in counted.where("_over").select("_bucket").collect()]


def hot_keys(
    sides: Sequence[DataFrame], key: str, hot_rows: int = HOT_ROWS, unique: Collection[int] = ()
) -> DataFrame | None:
    """(key, salts, hot) for the keys that are hot in any of ``sides``; None when there is none.

    ``salts`` is how many parts the key's largest side is worth, ``hot`` the positions of the sides in
    which the key is hot. Sides at the positions ``unique`` have one row per key and are not read. At most
    (rows / ``hot_rows``) + (bytes / ``HOT_BYTES``) keys can be hot, so the result is safe to broadcast.
    """
    sides = {i: side for i, side in enumerate(sides) if i not in unique}
    if not sides:
        return None
    buckets = _hot_buckets(sides, key, hot_rows)
    if not buckets:
        return None
    counts = [
        side.where(F.col(key).isNotNull() & _bucket(key).isin(buckets)).select(key, row_bytes(side).alias("_bytes")).groupBy(key)
        .agg(F.count(F.lit(1)).alias("_rows"), F.sum("_bytes").alias("_bytes")).withColumn("_side", F.lit(i))
        for i, side in sides.items()
    ]
    parts = F.ceil(F.greatest(F.col("_rows") / F.lit(hot_rows), F.col("_bytes") / F.lit(HOT_BYTES))).cast("int")
    large = reduce(DataFrame.unionByName, counts).withColumn("_salts", parts).where(F.col("_salts") > 1)
    stored = materialise(large.select(key, "_side", "_salts"), "hot-keys")
    if stored.isEmpty():
        return None
    return stored.groupBy(key).agg(F.max("_salts").alias("_salts"), F.collect_set("_side").alias("_hot"))
