"""K-d tree shards: split at weighted medians along the widest metadata dimension.

Defined results: a null text weighs 1 (no bytes, plus 1) and has the crc of the empty text; a null
in a dimension sorts last and spans nothing; rows that tie in the dimension are ordered by the
text's crc and the id, so equal texts stay together unless a median falls among them, and a group of
copies of any size is split where the bytes ask for it; repeated rows may stand in either order; an
empty table gives no rows. A single text larger than a leaf fills one of its own.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerbrook.llm.common import empty_if_null, running
from ledgerbrook.session import materialise

#: Metadata dimensions, in the order that decides between equally wide ones.
DIMENSIONS = ("source", "lang", "n_chars")


def leaves_for(total_bytes: int, target_bytes: int) -> int:
    """Number of leaves so that an average leaf holds at most ``target_bytes``."""
    return max(1, math.ceil(total_bytes / target_bytes))


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, dimensions=DIMENSIONS,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size, text_crc32, shard (from 0), slot (gapless from 0 in a shard).

    Give either the number of shards or the bytes a leaf may hold. Each level picks per node the
    dimension whose spread is the largest share of the whole table's spread (distinct values for
    text, range for numbers), sorts the node's rows by it and sends the rows before the weighted
    median to the left. A node that stands for k leaves gives k // 2 of them and that share of its
    bytes to the left. Sorted positions come from range blocks, so no task holds a node.
    """
    kinds = dict(docs.dtypes)
    text = empty_if_null(F.col(text_col)).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("crc"),
        *[F.col(d).alias(f"d{i}") for i, d in enumerate(dimensions)],
    )
    rows = materialise(rows.withColumn("node", F.lit(0)), "shard-rows")
    if shards is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        shards = leaves_for(total, target_bytes)
    is_text = [kinds[d] == "string" for d in dimensions]
    spread = [
        F.count_distinct(f"d{i}") - 1 if texty else F.max(F.col(f"d{i}").cast("double")) - F.min(F.col(f"d{i}").cast("double"))
        for i, texty in enumerate(is_text)
    ]
    spread = [F.coalesce(s.cast("double"), F.lit(0.0)) for s in spread]
    whole = rows.agg(*[s.alias(f"s{i}") for i, s in enumerate(spread)]).first()
    # The tree's shape is known beforehand: first leaf and number of leaves of each node of a level.
    level = {0: (0, shards)}
    while max(k for _, k in level.values()) > 1:
        node_rows = rows.groupBy("node").agg(
            F.sum("size").alias("node_size"), *[s.alias(f"s{i}") for i, s in enumerate(spread)]
        )
        share = [F.col(f"s{i}") / F.lit(whole[f"s{i}"]) if whole[f"s{i}"] else F.lit(0.0) for i in range(len(dimensions))]
        widest = F.lit(len(dimensions) - 1)
        for i in reversed(range(len(dimensions) - 1)):
            widest = F.when(share[i] >= F.greatest(F.lit(-1.0), *share[i + 1:]), F.lit(i)).otherwise(widest)
        # At most one row per node of the level, so fewer than ``shards`` rows.
        picked = F.broadcast(node_rows.select("node", "node_size", widest.alias("dim")))
        number, word = F.lit(0.0), F.lit("")
        for i, texty in enumerate(is_text):
            number = F.when(F.col("dim") == i, F.lit(0.0) if texty else F.col(f"d{i}").cast("double")).otherwise(number)
            word = F.when(F.col("dim") == i, F.col(f"d{i}") if texty else F.lit("")).otherwise(word)
        ordered = running(
            rows.join(picked, "node").withColumn("num", number).withColumn("word", word),
            "node", ["num", "word", "crc", "id"], {"before": F.col("size"), "index": F.lit(1)}, "shard-level",
        )
        left_share, split = F.lit(1.0), F.lit(False)
        for node, (_, k) in level.items():
            left_share = F.when(F.col("node") == node, F.lit(k // 2 / k)).otherwise(left_share)
            split = F.when(F.col("node") == node, F.lit(k > 1)).otherwise(split)
        right = split & (F.col("before") + F.col("size") / 2 > F.col("node_size") * left_share)
        rows = materialise(
            ordered.withColumn("node", F.col("node") * 2 + right.cast("int")).select(*rows.columns[:-1], "node", "index"),
            "shard-rows",
        )
        starts = F.broadcast(rows.groupBy("node").agg(F.min("index").alias("first_index")))
        slots = rows.join(starts, "node").withColumn("slot", F.col("index") - F.col("first_index"))
        rows = rows.drop("index")
        level = {
            node * 2 + side: part
            for node, (first, k) in level.items()
            for side, part in (((0, (first, k // 2)), (1, (first + k // 2, k - k // 2))) if k > 1 else ((0, (first, k)),))
        }
    if shards == 1:
        slots = running(rows, "node", ["crc", "id"], {"slot": F.lit(1)}, "shard-level")
    shard = F.lit(0)
    for node, (first, _) in level.items():
        shard = F.when(F.col("node") == node, F.lit(first)).otherwise(shard)
    return slots.select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), shard.cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
    )


def write_shards(docs: DataFrame, shards: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write the documents, one folder per shard and in slot order. Ids have to be unique."""
    placed = docs.join(shards.select(id_col, "shard", "slot"), id_col)
    placed.repartition("shard").sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)
