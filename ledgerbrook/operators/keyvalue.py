"""Key-range scans, salted-key scans, point lookups and cell form of wide tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerbrook.functions.records import strip_salt
from ledgerbrook.operators.relational import semi_join_master
from ledgerbrook.session import materialise

#: Folders of a table stored for point reads; column that names them.
BUCKETS, BUCKET = 64, "bucket"
#: Keys that are handed to the scan as values; more are joined.
FEW_KEYS = 1_000


def in_key_range(key: Column, start: str | None, stop: str | None) -> Column:
    """``start <= key < stop`` in byte order; an open end is None."""
    tests = []
    if start is not None:
        tests.append(key >= start)
    if stop is not None:
        tests.append(key < stop)
    return reduce(lambda a, b: a & b, tests, F.lit(True)) if len(tests) != 1 else tests[0]


def key_range_scan(
    df: DataFrame,
    key: str,
    start: str | None,
    stop: str | None,
    record: T.StructType | Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows with ``start <= key < stop``; ``record`` picks columns and casts them.

    On a table written by ``write_by_key`` the range reaches the scan and skips row groups.
    A value that does not fit its type becomes null.
    """
    rows = df.where(in_key_range(F.col(key), start, stop))
    if record is None:
        return rows
    if isinstance(record, T.StructType):
        record = {f.name: f.dataType for f in record.fields}
    return rows.select(key, *[F.col(c).try_cast(t).alias(c) for c, t in record.items() if c != key])


def write_by_key(df: DataFrame, key: str, path: str) -> None:
    """Store a table in key order: range-partitioned files, sorted inside."""
    df.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").parquet(path)


def with_salt(df: DataFrame, key: str, salts: Sequence[str], salt: str = "salt") -> DataFrame:
    """Spread keys over ``salts`` by hash and prefix the key with ``salt-``."""
    names = F.array(*[F.lit(s) for s in salts])
    chosen = F.get(names, F.pmod(F.xxhash64(key), F.lit(len(salts))).cast("int"))
    return df.withColumn(salt, chosen).withColumn(key, F.concat_ws("-", F.col(salt), F.col(key)))


def write_salted(df: DataFrame, key: str, path: str, salt: str = "salt") -> None:
    """Store a salted table: one folder per salt, files sorted by key."""
    (
        df.repartitionByRange(salt, key)
        .sortWithinPartitions(salt, key)
        .write.mode("overwrite")
        .partitionBy(salt)
        .parquet(path)
    )


def salted_range_scan(
    df: DataFrame,
    key: str,
    salts: Sequence[str],
    start: str,
    stop: str,
    salt: str = "salt",
    original: str | None = None,
) -> DataFrame:
    """Read the original-key range ``[start, stop)`` under every salt.

    Each salt has its own key range, so a salt-partitioned table is pruned to the listed
    folders and inside them by key. ``original`` names a column for the key without salt.
    """
    ranges = [
        (F.col(salt) == s) & in_key_range(F.col(key), f"{s}-{start}", f"{s}-{stop}") for s in salts
    ]
    rows = df.where(reduce(lambda a, b: a | b, ranges))
    return rows.withColumn(original, strip_salt(F.col(key))) if original else rows


def cells(
    df: DataFrame,
    key: str,
    columns: Sequence[str] | None = None,
    family: str | None = None,
    timestamp: str | None = None,
) -> DataFrame:
    """One row per cell: key, qualifier, value (as text); null cells are absent.

    ``family`` adds the column family before the qualifier, ``timestamp`` names a column of
    the row's version, kept beside each of its cells.
    """
    ids = [key, timestamp] if timestamp else [key]
    names = list(columns or [c for c in df.columns if c not in ids])
    text = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in names])
    out = text.unpivot(ids, names, "qualifier", "value").where(F.col("value").isNotNull())
    first = [F.col(key)] + ([F.lit(family).alias("family")] if family is not None else [])
    version = [F.col(timestamp)] if timestamp else []
    return out.select(*first, "qualifier", *version, "value")


def reversed_keys(lines: DataFrame, line: str = "value", key: str = "rowkey") -> DataFrame:
    """Lookup keys from CSV lines: the first field, reversed."""
    return lines.select(F.reverse(F.split(line, ",", 2)[0]).alias(key))


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def write_for_lookup(
    df: DataFrame, key: str, path: str, buckets: int = BUCKETS, group_bytes: int | None = None, bucket: str = BUCKET
) -> None:
    """Store a table for point reads: a folder per bucket of the key's hash, files sorted by key.

    Every row group carries a Bloom filter of its keys, sized by their number, beside its least and greatest key.
    ``group_bytes`` is the size of a row group. A bucket larger than a partition should be is split over several files.
    """
    writer = (
        df.withColumn(bucket, _bucket(key, buckets)).hint("rebalance", bucket).sortWithinPartitions(bucket, key)
        .write.mode("overwrite").partitionBy(bucket)
        .option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    )
    if group_bytes:
        writer = writer.option("parquet.block.size", group_bytes).option("parquet.page.size.row.check.min", 100)
    writer.parquet(path)


def rows_of_keys(
    stored: DataFrame, keys: DataFrame, key: str = "rowkey", buckets: int = BUCKETS, few: int = FEW_KEYS, bucket: str = BUCKET
) -> DataFrame:
    """Rows of a table written by ``write_for_lookup`` whose key is among ``keys``.

    Up to ``few`` different keys reach the scan as values: other buckets' folders are not listed, and row groups whose
    bounds or Bloom filter rule all of them out are not read. More keys are joined, which leaves out the
    folders that hold none of them once the keys are known. The rows are the same.
    """
    asked = keys.select(F.col(key).alias("_key")).dropna().distinct()
    asked = materialise(asked.withColumn("_bucket", _bucket("_key", buckets)), "asked-keys")
    known = asked.limit(few + 1).collect()
    if len(known) <= few:
        folders = sorted({r["_bucket"] for r in known})
        return stored.where(F.col(bucket).isin(folders) & F.col(key).isin([r["_key"] for r in known])).drop(bucket)
    # A stated test lets the planner prune folders by these keys.
    asked = asked.where("length(cast(_key AS string)) >= 0")
    same = (F.col(bucket) == F.col("_bucket")) & (F.col(key) == F.col("_key"))
    return stored.join(asked, same, "left_semi").drop(bucket)


def point_lookup(
    table: DataFrame, keys: DataFrame, key: str = "rowkey", columns: Sequence[str] | None = None
) -> DataFrame:
    """All cells of the rows whose key is asked for; missing keys give no row."""
    return cells(semi_join_master(table, keys, key), key, columns)


def stored_point_lookup(
    stored: DataFrame, keys: DataFrame, key: str = "rowkey", columns: Sequence[str] | None = None, **layout: int
) -> DataFrame:
    """The point lookup on a table written by ``write_for_lookup``, which is not scanned as a whole."""
    return cells(rows_of_keys(stored, keys, key, **layout), key, columns)
