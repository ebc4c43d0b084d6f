"""From raw documents to token ids: language ID, exact and near duplicates, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerbrook.llm import bpe, exact_dedup, jaccard, langid, mixing
from ledgerbrook.llm.common import documents, fold, importable
from ledgerbrook.llm.queries import VOCABULARY
from ledgerbrook.session import materialise


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told apart; the others go."""
    importable(spark)
    return langid.keep_identified(docs, langid.fit(docs.filter(fold(F.col("doc_id"), 3) != 1)))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that of the largest doc_id."""
    return exact_dedup.deduplicate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest doc_id."""
    importable(spark)
    return jaccard.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, their number and digest, and the digest of the text they decode to."""
    importable(spark)
    return bpe.round_trip(docs, VOCABULARY, with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("jaccard_join", near_duplicates),
    ("source_mix", source_mix),
    ("bpe", tokens),
]

#: Compression and BPE are beyond SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
