"""Helpers that several operators share: words, folds, uniform draws, running sums in blocks."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerbrook.session import materialise

#: A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: A table of one row per key is broadcast up to this size; beyond it the join is left to Spark.
BROADCAST_BYTES = 8 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of rows that go to a Python worker at once. Spark's own bound is 10,000 rows, however long their texts are.
BATCHES, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 2 << 20


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, whatever their folder.

    A cluster gets the package with ``--py-files`` or an installed wheel; then this adds nothing.
    """
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{known}:{root}" if known else root


def bounded_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold few bytes, unless the session has a bound of its own. Spark plans a frame when it
    is run, so the setting stays. Results do not depend on it."""
    if spark.conf.get(BATCHES, None) is None:
        spark.conf.set(BATCHES, str(BATCH_BYTES))


@contextmanager
def shuffles_cleared(spark: SparkSession) -> Iterator[None]:
    """For passes that store their results: the shuffle files of a pass go when it ends."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)


def few_rows(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that a task holds the results of few texts at once."""
    for whole in batches:
        for start in range(0, whole.num_rows, rows):
            yield whole.slice(start, rows)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def empty_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words as long; null text has none."""
    return F.regexp_count(empty_if_null(text), F.lit(WORD)).cast("long")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(empty_if_null(doc_id.cast("string")).cast("binary")) % n


def uniform(key: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on key and seed alone: 52 bits of an md5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), empty_if_null(key.cast("string"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def small(df: DataFrame) -> bool:
    """Whether a stored table of strings and numbers stays under the broadcast size."""
    width = sum((F.coalesce(F.octet_length(F.col(c)), F.lit(0)) if t == "string" else F.lit(8)) for c, t in df.dtypes)
    size = df.select(F.sum(width + 16)).first()[0]
    return (size or 0) <= BROADCAST_BYTES


def hinted(df: DataFrame) -> DataFrame:
    """``df``, to be broadcast if its measured size allows it. The hint changes the plan only."""
    return F.broadcast(df) if small(df) else df


def join_spread(rows: DataFrame, unique: DataFrame, keys: list[str], count: str, place: list[Column]) -> DataFrame:
    """``rows`` inner joined with ``unique``, which has one row per key and the number of its rows in ``count``.

    A key with more rows than an average partition is cut into so many parts that none is larger. The
    part follows from ``place``, columns that tell a key's rows apart, so a retry deals them alike. Fewer
    keys than there are partitions can be that large, which bounds what is broadcast and repeated.
    ``count`` is dropped; the result does not depend on it.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mean = max(1.0, (unique.agg(F.sum(count)).first()[0] or 0) / parts)
    cut = unique.withColumn("__parts", F.ceil(F.col(count) / mean).cast("int")).drop(count)
    large = F.broadcast(cut.filter("__parts > 1").select(*keys, "__parts"))
    part = F.coalesce(F.pmod(F.xxhash64(*place), F.col("__parts")).cast("int"), F.lit(0))
    dealt = rows.join(large, keys, "left").withColumn("__part", part).drop("__parts")
    repeated = cut.withColumn("__part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1))).drop("__parts")
    return dealt.join(repeated, [*keys, "__part"]).drop("__part")


def running(df: DataFrame, group: str, order: list[str], sums: dict[str, Column], name: str) -> DataFrame:
    """Add to each row, per entry of ``sums``, the sum over the rows of its group that come before it.

    The rows are range-partitioned by (group, order), stored, and summed block by block; each block
    then starts from the sums of the blocks before it, so no task holds a whole group. Rows that tie
    in ``order`` may stand in either order. Nulls in a summed column count as 0.
    """
    spark = df.sparkSession
    blocks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    values = df.withColumns({f"__v_{k}": F.coalesce(v, F.lit(0)) for k, v in sums.items()})
    stored = materialise(
        values.repartitionByRange(blocks, F.col(group), *[F.col(c).asc_nulls_last() for c in order])
        .withColumn("__block", F.spark_partition_id()),
        name,
    )
    before = Window.partitionBy(group).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        stored.groupBy(group, "__block").agg(*[F.sum(f"__v_{k}").alias(f"__b_{k}") for k in sums])
        .select(group, "__block", *[F.coalesce(F.sum(f"__b_{k}").over(before), F.lit(0)).alias(f"__s_{k}") for k in sums])
    )
    inside = (
        Window.partitionBy(group, "__block").orderBy(*[F.col(c).asc_nulls_last() for c in order])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    within = stored.withColumns({f"__w_{k}": F.coalesce(F.sum(f"__v_{k}").over(inside), F.lit(0)) for k in sums})
    return within.join(starts, [group, "__block"]).select(
        *[F.col(c) for c in df.columns], *[(F.col(f"__w_{k}") + F.col(f"__s_{k}")).alias(k) for k in sums]
    )
