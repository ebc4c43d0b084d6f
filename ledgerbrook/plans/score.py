"""The 0-100 company score: twelve rule scores over joined company tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from ledgerbrook.functions import scoring
from ledgerbrook.functions.text import like_flag, number
from ledgerbrook.operators.relational import (
    anti_join,
    join_chain,
    nonnull_count,
    presence_flag,
    semi_join_master,
    union_distinct,
)
from ledgerbrook.sources.tables import partition_day

# A status with this character is a closed company; the tag that earns a flag.
CLOSED_MARK = "销"
HIGH_TECH_TAG = "高新技术企业"

# The inputs of the score; all are joined by company_name.
INPUTS = (
    "remarks", "register", "customers", "statistics", "property", "run", "products", "ads_boss", "ads_lg", "ads_zhilian",
)

# Fixed order: the scored columns, in the order in which their scores are added up.
SCORED = [
    "reg_capital", "scale_count", "establish_date", "tag_gaoxin", "prod_name_num", "website_total",
    "works_total", "software_total", "patent_total", "brand_total", "finance_total", "has_recruit",
]


def candidates(remarks: DataFrame, register: DataFrame, customers: DataFrame, day: str) -> DataFrame:
    """Distinct names with product remarks that are open and not yet customers."""
    open_names = partition_day(register, day).where(~F.col("business_status").contains(CLOSED_MARK))
    names = partition_day(remarks, day).select("company_name").distinct()
    listed = semi_join_master(names, open_names.select("company_name"), "company_name")
    return anti_join(listed, customers.select("company_name"), "company_name")


def add_scores(companies: DataFrame, as_of: Column) -> DataFrame:
    """Beside every scored column its score, and the total.

    The numbers behind the range scores are projected first, so that each is read from
    its text once and then compared with all its ranges.
    """
    numbers = {
        "reg_capital": (scoring.capital_amount(F.col("reg_capital")), scoring.CAPITAL_RANGES),
        "scale_count": (scoring.headcount_middle(F.col("scale_count")), scoring.HEADCOUNT_RANGES),
        "establish_date": (scoring.years_old(F.col("establish_date"), as_of), scoring.YEARS_RANGES),
        "website_total": (number(F.col("website_total"), "double"), scoring.COUNT_RANGES),
    }
    read = companies.withColumns({f"_{name}": value for name, (value, _) in numbers.items()})
    scores = {name: scoring.range_bucket(F.col(f"_{name}"), r) for name, (_, r) in numbers.items()}
    scores["scale_count"] = scoring.few_staff_or(F.col("scale_count"), scores["scale_count"])
    for name, mark in scoring.FLAG_MARKS.items():
        scores[name] = scoring.score_flag(F.col(name), mark)

    types = dict(companies.dtypes)
    columns: list[str | Column] = ["company_name", "honor_code"]
    for name in SCORED:
        empty = F.lit("") if types[name] == "string" else F.lit(0).cast(types[name])
        columns += [F.coalesce(F.col(name), empty).alias(name), scores[name].alias(f"{name}_score")]
    total = reduce(add, [F.col(f"{name}_score") for name in SCORED])
    return read.select(*columns).withColumn("total_score", total)


def company_score(tables: Mapping[str, DataFrame], list_day: str, day: str, as_of: Column) -> DataFrame:
    """Scores of candidate companies.

    ``tables``: remarks (company_name); register (company_name, honor_code, business_status,
    reg_capital, scale_count, establish_date); customers (company_name); statistics (company_name,
    tags); property (company_name, website_total, works_total, software_total, patent_total,
    brand_total); run (company_name, finance_total); products (company_name, prod_name);
    ads_boss, ads_lg, ads_zhilian (company_name). All but customers, ads_lg and ads_zhilian are
    read for one day: ``list_day`` for the candidate list, ``day`` for the scored values.
    """

    def of_day(name: str) -> DataFrame:
        return partition_day(tables[name], day)

    names = candidates(tables["remarks"], tables["register"], tables["customers"], list_day)
    registered = of_day("register").select(
        "company_name", "honor_code", "reg_capital", "scale_count", "establish_date"
    )
    tags = of_day("statistics").select(
        "company_name", like_flag(F.col("tags"), HIGH_TECH_TAG).alias("tag_gaoxin")
    )
    rights = of_day("property").select(
        "company_name", "website_total", "works_total", "software_total", "patent_total", "brand_total"
    )
    finance = of_day("run").select("company_name", "finance_total")
    products = nonnull_count(of_day("products"), "company_name", "prod_name", "prod_name_num")
    recruiting = union_distinct(
        [
            of_day("ads_boss").select("company_name"),
            tables["ads_lg"].select("company_name"),
            tables["ads_zhilian"].select("company_name"),
        ]
    )

    sides = [(registered, "inner"), *((side, "left") for side in (tags, rights, finance, products))]
    # The names are distinct and the products counted per name.
    rows = join_chain(names, sides, "company_name", unique=(0, 5))
    rows = presence_flag(rows, recruiting, "company_name", "has_recruit")
    return add_scores(rows.withColumn("tag_gaoxin", F.coalesce("tag_gaoxin", F.lit(0))), as_of)
