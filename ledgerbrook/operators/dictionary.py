"""Keyword dictionaries with dense ids, and labelling by a category dictionary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerbrook.functions.text import drop_newlines, java_split, null_token, trim_ws
from ledgerbrook.operators.ordered import surrogate_ids

# Fixed value: label of an owner that matches no category.
DEFAULT_CATEGORY = "其他"


def owner_keywords(df: DataFrame, owner: str, cell: str, keyword: str = "keyword") -> DataFrame:
    """One row per keyword of a comma-separated cell; null and empty cells give ``null``."""
    return df.select(owner, F.explode(java_split(null_token(F.col(cell)), ",")).alias(keyword))


def keyword_count(df: DataFrame, owner: str, cell: str) -> DataFrame:
    return (
        owner_keywords(df, owner, cell).groupBy("keyword").agg(F.count(F.lit(1)).alias("n"))
    )


def _clean(text: Column) -> Column:
    return trim_ws(drop_newlines(text))


def keyword_dictionary(df: DataFrame, cell: str, name: str = "name") -> DataFrame:
    """Distinct cleaned keywords with dense ids in name order.

    Keywords are cleaned after the split, blank ones dropped.
    """
    words = (
        df.select(F.explode(java_split(null_token(F.col(cell)), ",")).alias(name))
        .select(_clean(F.col(name)).alias(name))
        .where(F.length(name) > 0)
        .distinct()
    )
    return surrogate_ids(words, name)


def clean_owner_keywords(df: DataFrame, owner: str, cell: str, keyword: str = "keyword") -> DataFrame:
    """One row per keyword; the cell is cleaned, split, and each piece trimmed. Repeats stay."""
    raw = F.col(cell)
    cleaned = F.when(raw.isNull() | (raw == ""), "null").otherwise(_clean(raw))
    words = df.select(owner, F.explode(java_split(cleaned, ",")).alias(keyword)).select(
        owner, trim_ws(F.col(keyword)).alias(keyword)
    )
    return words.where((F.length(trim_ws(F.col(owner).cast("string"))) > 0) & (F.length(keyword) > 0))


def keyword_map(words: DataFrame, dictionary: DataFrame, keyword: str = "keyword") -> DataFrame:
    """Owner rows with the id of their keyword; keywords outside the dictionary keep a null id."""
    ids = dictionary.select(F.col("id"), F.col("name").alias(keyword))
    return words.join(ids, keyword, "left").drop(keyword)


def _matches(df: DataFrame, owner: str, cell: str, dictionary: DataFrame) -> DataFrame:
    """The set of categories per owner; empty for owners that match none."""
    words = owner_keywords(df, owner, cell).distinct()
    entries = dictionary.select("keyword", "category").distinct()
    return (
        words.join(entries, "keyword", "left")
        .groupBy(owner)
        .agg(F.collect_set("category").alias("categories"))
    )


def category_label(
    df: DataFrame, owner: str, cell: str, dictionary: DataFrame, default: str = DEFAULT_CATEGORY
) -> DataFrame:
    """The sorted categories of an owner joined by commas, or the default label."""
    found = F.array_join(F.array_sort("categories"), ",")
    return _matches(df, owner, cell, dictionary).select(
        owner, F.when(F.size("categories") == 0, default).otherwise(found).alias("category")
    )


def category_explode(
    df: DataFrame, owner: str, cell: str, dictionary: DataFrame, default: str = DEFAULT_CATEGORY
) -> DataFrame:
    """One row per owner and category; the default label only for owners that match none."""
    labels = F.when(F.size("categories") == 0, F.array(F.lit(default))).otherwise(F.col("categories"))
    return _matches(df, owner, cell, dictionary).select(owner, F.explode(labels).alias("category"))


def category_ids(categories: DataFrame) -> DataFrame:
    """Dense ids over the distinct categories, each with parent 0."""
    names = categories.select(F.col("category").alias("name")).distinct()
    return surrogate_ids(names, "name").select("id", F.lit(0).alias("parent_id"), "name")


def category_map(categories: DataFrame, ids: DataFrame) -> DataFrame:
    """Replace the category of each row by its id."""
    lookup = ids.select(F.col("id").alias("category_id"), F.col("name").alias("category"))
    return categories.join(lookup, "category", "left").drop("category")
