"""The wide company profile: one row per company of the master list and matching side row."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ledgerbrook.functions.text import (
    default_if_short,
    fallback_text,
    tag_allowlist,
    whole_number,
)
from ledgerbrook.operators.audit import with_audit
from ledgerbrook.operators.relational import (
    left_join_unique,
    left_joins,
    longest_by_key,
    na_fill,
    semi_join_master,
)
from ledgerbrook.session import materialise
from ledgerbrook.sources.tables import partition_day

# Defaults of profile columns that a side without a match leaves null.
PROFILE_DEFAULTS = {
    "address": "", "bd_longitude": 0.0, "bd_latitude": 0.0, "gd_longitude": 0.0, "gd_latitude": 0.0,
}
DESCRIPTION_LENGTH = 1000


def descriptions(statistics: DataFrame, ads: DataFrame) -> DataFrame:
    """Site, description and status per row of the statistics table.

    The description is the introduction, or else the longest job-ad introduction of the
    same company name.
    """
    intro = longest_by_key(ads, "company_name", "company_intro")
    return left_join_unique(statistics, intro, "company_name").select(
        "honor_code",
        default_if_short(F.col("site"), 1).alias("website"),
        fallback_text(
            [F.col("introduce"), F.col("company_intro")], cut=DESCRIPTION_LENGTH
        ).alias("description"),
        tag_allowlist(F.col("tags")).alias("status"),
    )


def company_profile(
    tables: Mapping[str, DataFrame], day: str, contact_day: str, now: int, logo_prefix: str
) -> DataFrame:
    """The 26 profile columns.

    ``tables``: master (company_name, honor_code); register (honor_code, field); media
    (company_name, honor_code, oss_path, pos); statistics (honor_code, company_name, site,
    introduce, tags); contact (honor_code, company_name, phone, email); ads_boss, ads_lg,
    ads_zhilian (company_name, company_intro); property (honor_code, *_total); all with ptt_day;
    baidu and gaode (company_name, use_address, location_lng, location_lat).

    Sides that join on the same key come one after the other, so the wide row is shuffled
    once per key. A semi join to the master is kept only where its key is not the join's.
    """
    master = tables["master"].select("company_name", "honor_code")
    names = master.select("company_name")

    def of_day(name: str, d: str = day) -> DataFrame:
        return partition_day(tables[name], d)

    ads = reduce(
        DataFrame.unionByName,
        [of_day(n).select("company_name", "company_intro") for n in ("ads_boss", "ads_lg", "ads_zhilian")],
    )
    contact = semi_join_master(of_day("contact", contact_day), names, "company_name").select(
        "honor_code",
        default_if_short(F.col("phone"), 4).alias("phone"),
        default_if_short(F.col("email"), 4).alias("mail"),
    )
    logo = semi_join_master(
        of_day("media").where(F.col("pos") == "1"), master.select("honor_code"), "honor_code"
    ).select("company_name", F.concat(F.lit(logo_prefix), F.col("oss_path")).alias("logo"))
    rights = of_day("property").select(
        "honor_code",
        whole_number(F.col("patent_total")).alias("knowledge_zl_num"),
        whole_number(F.col("brand_total")).alias("knowledge_sb_num"),
        whole_number(F.col("works_total")).alias("knowledge_zzq_num"),
        whole_number(F.col("website_total")).alias("knowledge_icp_num"),
    )

    def place(name: str, prefix: str) -> DataFrame:
        return tables[name].select(
            "company_name",
            default_if_short(F.col("use_address"), 1).alias(f"{prefix}_address"),
            F.col("location_lng").try_cast("double").alias(f"{prefix}_longitude"),
            F.col("location_lat").try_cast("double").alias(f"{prefix}_latitude"),
        )

    statistics = of_day("statistics")
    described = descriptions(statistics, semi_join_master(ads, names, "company_name"))
    industry = of_day("register").select("honor_code", F.col("field").alias("industry"))
    # Stored between the two chains: the second one looks at its keys before it joins.
    wide = materialise(left_joins(master, [industry, described, contact, rights], "honor_code"), "profile-by-code")
    wide = left_joins(wide, [logo, place("baidu", "bd"), place("gaode", "gd").drop("gd_address")], "company_name")
    return na_fill(
        with_audit(
            wide.select(
                F.col("honor_code").alias("id"),
                F.col("company_name").alias("name"),
                "logo",
                "description",
                F.coalesce("phone", F.lit("-")).alias("phone"),
                F.coalesce("mail", F.lit("-")).alias("mail"),
                "website",
                "industry",
                F.col("bd_address").alias("address"),
                F.lit("").alias("type"),
                "status",
                "knowledge_zl_num",
                "knowledge_sb_num",
                "knowledge_zzq_num",
                "knowledge_icp_num",
                "bd_longitude",
                "bd_latitude",
                "gd_longitude",
                "gd_latitude",
            ),
            now,
            "int",
        ),
        PROFILE_DEFAULTS,
    )
