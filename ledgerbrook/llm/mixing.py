"""Mix sources to target weights: repetition rates per source, whole copies plus one seeded draw.

Defined results: a null text has size 0 and is never taken; a null source is a source of its own,
last in order; a null id draws like the empty id; rows with equal ids draw alike, so a repeated row
is repeated as often as its twin; an empty table gives no rows; long texts count every word. Rates
never exceed ``stop``, so no document is emitted more than ``stop`` times (rounded up). Reruns agree,
since draws depend on id and seed alone. Other columns pass through ``mix`` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerbrook.llm.common import hinted, running, uniform, word_count
from ledgerbrook.session import materialise

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: All targets together, as a share of all sizes; a target stops at STOP times its source's size.
SHARE, STOP = 1.5, 2.0
SEED = "mix"


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, stop: float = STOP) -> DataFrame:
    """From (source, size): one row per source with source_size and target.

    Resharing what full sources leave over, by weight, until none is above its stop, ends at one
    level L with target = min(stop * size, L * weight). Sources sorted by stop * size / weight fill
    up in that order, so L follows from running sums.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("__all", F.lit(0))
    ranked = running(per, "__all", ["source"], {"__pos": F.lit(1)}, "mix-sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("__pos") % len(weights) + 1).cast("int"))
    caps = ranked.withColumn("weight", weight).withColumn("cap", F.lit(stop) * F.col("source_size")).withColumn(
        "full_at", F.col("cap") / F.col("weight")
    )
    sums = {"__cap": F.col("cap"), "__weight": F.col("weight")}
    level = materialise(running(caps, "__all", ["full_at", "__pos"], sums, "mix-levels"), "mix-caps")
    total = level.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    if total["size"] is None:
        return level.select("source", "source_size", F.lit(0.0).alias("target"))
    at = (F.lit(share * total["size"]) - F.col("__cap")) / (F.lit(total["weight"]) - F.col("__weight"))
    free = level.select("full_at", at.alias("level")).filter("level <= full_at")
    top = free.agg(F.min_by("level", "full_at").alias("level")).first()["level"]
    target = F.col("cap") if top is None else F.least(F.col("cap"), F.lit(top) * F.col("weight"))
    return level.select("source", "source_size", target.alias("target"))


def draws(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: str = SEED) -> DataFrame:
    """One row per document: id, source, size, source_size, target, copies (int) and taken (long)."""
    rows = docs.select(F.col(id_col).alias("__id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    targets = materialise(source_targets(rows.select("source", "size")), "mix-targets")
    at = hinted(targets.withColumnRenamed("source", "__source"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor("__rate")
    extra = (uniform(F.col("__id"), seed) < F.col("__rate") - whole).cast("int")
    return (
        rows.join(at, F.col("source").eqNullSafe(F.col("__source")))
        .withColumn("__rate", rate).withColumn("copies", (whole + extra).cast("int"))
        .select(F.col("__id").alias(id_col), "source", "size", "source_size", "target", "copies",
                (F.col("copies") * F.col("size")).alias("taken"))
    )


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: str = SEED) -> DataFrame:
    """The mixed corpus: each row as often as the draws say, with its own columns."""
    rows = docs.select(F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    targets = materialise(source_targets(rows), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    at = hinted(targets.select(F.col("source").alias("__source"), rate.alias("__rate")))
    inner = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    names = dict(zip(docs.columns, inner.columns, strict=True))
    whole = F.floor("__rate")
    copies = (whole + (uniform(F.col(names[id_col]), seed) < F.col("__rate") - whole).cast("int")).cast("int")
    return (
        inner.join(at, F.col(names[source_col]).eqNullSafe(F.col("__source"))).withColumn("__copies", copies)
        .withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("__copies"))))
        .select(*[F.col(c).alias(name) for name, c in names.items()])
    )
