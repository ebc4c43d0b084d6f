"""Keyword and category pipelines over product remarks.

``remarks`` has company_name, honor_code, business_keywords (a comma list) and ptt_day;
``master`` has company_name and honor_code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerbrook.operators import dictionary as d
from ledgerbrook.operators.audit import with_audit
from ledgerbrook.operators.relational import semi_join_master
from ledgerbrook.session import materialise
from ledgerbrook.sources.tables import partition_day

CELL = "business_keywords"


def capacity_tables(
    remarks: DataFrame, master: DataFrame, day: str, now: int
) -> tuple[DataFrame, DataFrame]:
    """The keyword dictionary with ids, and the company-to-keyword map. Repeats stay in the map."""
    of_day = partition_day(remarks, day)
    words = d.keyword_dictionary(of_day, CELL)
    owned = semi_join_master(of_day.select("honor_code", CELL), master, "honor_code")
    pairs = d.keyword_map(d.clean_owner_keywords(owned, "honor_code", CELL), words)
    mapped = pairs.select(F.col("honor_code").alias("company_id"), F.col("id").alias("capacity_id"))
    return with_audit(words, now), with_audit(mapped, now)


def track_tables(
    remarks: DataFrame,
    master: DataFrame,
    categories: DataFrame,
    day: str,
    now: int,
    default: str = d.DEFAULT_CATEGORY,
) -> tuple[DataFrame, DataFrame]:
    """The categories with ids, and the company-to-category map.

    ``categories`` is a dictionary of (category, keyword). The ids cover all companies of the
    day, the map only those in ``master``.
    """
    found = d.category_explode(partition_day(remarks, day), "honor_code", CELL, categories, default)
    # Both tables are built from the labels; storing them saves matching all keywords twice.
    found = materialise(found, "track-labels")
    tracks = d.category_ids(found)
    owned = semi_join_master(found, master, "honor_code")
    mapped = d.category_map(owned, tracks).select(
        F.col("honor_code").alias("company_id"), F.col("category_id").alias("track_id")
    )
    return with_audit(tracks, now), with_audit(mapped, now)


def remark_tables(
    remarks: DataFrame, categories: DataFrame, day: str, default: str = d.DEFAULT_CATEGORY
) -> tuple[DataFrame, DataFrame]:
    """Keyword frequencies over all days, and one joined category label per company of a day."""
    counts = d.keyword_count(remarks, "company_name", CELL)
    labels = d.category_label(partition_day(remarks, day), "company_name", CELL, categories, default)
    return counts, labels
