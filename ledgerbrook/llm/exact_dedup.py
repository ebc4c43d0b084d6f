"""Exact duplicates: group by a 128-bit content hash and compare the bytes inside the groups.

Defined results: a null text counts as empty, so null and empty texts are copies of each other; no
text is cut; of equal texts the largest id stays (``keep="smallest"`` keeps the smallest); an empty
table gives no rows. A null id is smaller than any other. Rows that repeat id and text are all
returned by ``duplicate_groups`` with one verdict, and ``deduplicate`` leaves one of them. Other
columns are neither read by the grouping nor renamed, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerbrook.llm.common import empty_if_null


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts meet in an aggregation keyed by (hash, text): the hash deals them out, the text itself
    decides equality, and copies are merged before the shuffle. Rows then find their group by the
    hash and the group's digest, in a join of narrow rows whose hot keys Spark can split.
    """
    pick = F.max if keep == "largest" else F.min
    rows = docs.select(F.col(id_col).alias("__id"), empty_if_null(F.col(text_col)).alias("__text")).withColumn(
        "__hash", F.unhex(F.md5("__text"))
    )
    groups = (
        rows.groupBy("__hash", "__text").agg(pick("__id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("__hash", F.unhex(F.sha2("__text", 256)).alias("__sha"), "keep_id", "group_size")
    )
    narrow = rows.select("__id", "__hash", F.unhex(F.sha2("__text", 256)).alias("__sha"))
    return narrow.join(groups, ["__hash", "__sha"]).select(
        F.col("__id").alias(id_col), "keep_id", "group_size", F.col("__id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("__sha")).alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """The rows that stay, one per distinct text, with all columns. Texts are shuffled once."""
    pick = F.max_by if keep == "largest" else F.min_by
    inner = [f"c{i}" for i in range(len(docs.columns))]
    packed = docs.toDF(*inner)
    names = dict(zip(docs.columns, inner, strict=True))
    text, others = names[text_col], [c for c in inner if c != names[text_col]]
    plain = [c for c, t in packed.dtypes if c in others and "map<" not in t and "variant" not in t]
    row = F.struct(*others, F.col(text).isNull().alias("no_text"))
    rank = F.struct(F.col(names[id_col]).alias("id"), F.col(text).isNull().alias("no_text"), F.xxhash64(*plain).alias("tie"))
    stay = (
        packed.select(F.unhex(F.md5(empty_if_null(F.col(text)))).alias("h"), empty_if_null(F.col(text)).alias("t"),
                      row.alias("row"), rank.alias("rank"))
        .groupBy("h", "t").agg(pick("row", "rank").alias("row"))
    )
    return stay.select(*[
        (F.when(~F.col("row.no_text"), F.col("t")) if c == text else F.col(f"row.{c}")).alias(name) for name, c in names.items()
    ])
