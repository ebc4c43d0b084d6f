"""Counts by word, deny-list split and category totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerbrook.operators.relational import anti_join, semi_join_master


def word_counts(df: DataFrame, words: Column, word: str = "word", count: str = "n") -> DataFrame:
    """Count every element of an array column."""
    return (
        df.select(F.explode(words).alias(word)).groupBy(word).agg(F.count(F.lit(1)).alias(count))
    )


def value_counts(df: DataFrame, value: str, count: str = "n") -> DataFrame:
    return df.groupBy(value).agg(F.count(F.lit(1)).alias(count))


def table_count(df: DataFrame, count: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(count))


def denylist_filter(counts: DataFrame, deny: DataFrame, word: str = "word") -> DataFrame:
    """Counted words that are not on the deny list."""
    return anti_join(counts, deny, word)


def denylist_dropped(
    counts: DataFrame, deny: DataFrame, word: str = "word", count: str = "n", name: str = "dropped"
) -> DataFrame:
    """One row: how many occurrences the deny list drops."""
    hit = semi_join_master(counts, deny, word)
    return hit.agg(F.coalesce(F.sum(count), F.lit(0)).cast("bigint").alias(name))


def category_totals(df: DataFrame, category: str, value: str, total: str = "total") -> DataFrame:
    return df.groupBy(category).agg(F.sum(value).alias(total))


def with_grand_total(totals: DataFrame, total: str = "total") -> DataFrame:
    """Every row beside the sum of all rows, which is an aggregate of one row."""
    grand = totals.agg(F.sum(total).alias("grand_total")).scalar()
    return totals.withColumn("grand_total", grand)
