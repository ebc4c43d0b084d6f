"""Catalog tables, partition days and dictionary files."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F

from ledgerbrook.functions.text import java_split

PARTITION = "ptt_day"


def partition_argument(args: Sequence[str] | None) -> str:
    """The first eight digits in a row in the first job argument."""
    if not args or not args[0]:
        raise ValueError("a partition day argument is required")
    found = re.search(r"[0-9]{8}", args[0])
    if not found:
        raise ValueError(f"a partition day like yyyymmdd is required, got {args[0]!r}")
    return found.group()


def partition_day(df: DataFrame, day: str, column: str = PARTITION) -> DataFrame:
    """Rows of one day; on a table partitioned by day only its folder is read."""
    return df.where(F.col(column) == day)


def table_day(spark: SparkSession, table: str, day: str, columns: Sequence[str]) -> DataFrame:
    return partition_day(spark.table(table), day).select(*columns)


def load_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated dictionary lines as (category, keyword).

    The first field is the category, and every field, the first one too, is a keyword.
    """
    fields = java_split(F.col("value"), "\t")
    lines = spark.read.text(path).select(fields.alias("fields")).where(F.size("fields") > 0)
    return dictionary_entries(lines)


def dictionary_entries(lines: DataFrame, fields: str = "fields") -> DataFrame:
    return lines.select(F.col(fields)[0].alias("category"), F.explode(fields).alias("keyword"))


def _writer(df: DataFrame, partition_by: Sequence[str]) -> DataFrameWriter:
    """An overwriting writer; rows of a partition are brought together, large ones stay split."""
    if not partition_by:
        return df.write.mode("overwrite")
    return df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by)


def write_folder(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a parquet folder; one sub-folder per value of the partition columns."""
    _writer(df, partition_by).parquet(path)


def write_table(
    df: DataFrame, table: str, fmt: str | None = None, partition_by: Sequence[str] = (), path: str | None = None
) -> None:
    """Overwrite a managed table, or one at ``path``; ``fmt`` (such as ``hive``) defaults to the session's format."""
    writer = _writer(df, partition_by)
    if path:
        writer = writer.option("path", path)
    (writer.format(fmt) if fmt else writer).saveAsTable(table)


def overwrite_days(df: DataFrame, table: str, columns: Sequence[str] = (PARTITION,)) -> None:
    """Replace the partitions of an existing table that ``df`` has rows of; all others stay.

    New files come to their place once all of them are written, so a write that fails leaves every day as it was.
    Works for the session's format and for Hive tables, whose partitions have to be dynamic.
    """
    spark = df.sparkSession
    ordered = df.select(*spark.table(table).columns)
    rows = ordered.hint("rebalance", *columns)
    settings = {"spark.sql.sources.partitionOverwriteMode": "dynamic", "hive.exec.dynamic.partition.mode": "nonstrict"}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows.write.mode("overwrite").insertInto(table)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """Overwrite a table bucketed and sorted by a join key, one file per bucket.

    Joins and aggregations on the key of tables with equally many buckets need no exchange.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)
