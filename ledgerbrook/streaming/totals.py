"""Ever-growing totals, kept as what changes.

Totals and their grand total come from one aggregation with Spark's state; a batch writes the rows that it changed and
no others. Layout under ``root``::

    changes/batch_id=<n>  new totals of the categories in batch n, and the new grand total (``whole``)
    checkpoint            offsets and state of the query

A replayed batch overwrites its own folder. Readers take the newest row per category.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerbrook.streaming.batches import read_batches, store_batches


def category_totals_stream(
    stream: DataFrame, category: str, value: str, root: str, interval: str | None = None
) -> StreamingQuery:
    """Keep totals per category and the total of all; a null category is one of its own."""
    totals = stream.rollup(category).agg(F.sum(value).alias("total"), (F.grouping(category) == 1).alias("whole"))
    return store_batches(totals, lambda df: df, f"{root}/changes", f"{root}/checkpoint", interval, mode="update")


def current_totals(spark: SparkSession, root: str, category: str) -> DataFrame:
    """Every category with its total and the grand total after the last batch."""
    changes = read_batches(spark, f"{root}/changes")
    newest = F.max_by("total", "batch_id").alias("total")
    whole = changes.where("whole").agg(newest.alias("grand_total"))
    return changes.where("NOT whole").groupBy(category).agg(newest).crossJoin(F.broadcast(whole))
