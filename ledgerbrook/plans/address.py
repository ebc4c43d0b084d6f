"""Address choice: the longest job-ad address of a company beside its registered one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ledgerbrook.functions.text import longest_token
from ledgerbrook.operators.relational import inner_join, left_join_unique, longest_by_key, union_distinct


def ad_addresses(places: DataFrame, addresses: DataFrame, locations: DataFrame) -> DataFrame:
    """The longest address per company over three job-ad sources.

    ``places`` (company_name, company_place) has lists cut by ``,`` ``|`` ``，``;
    ``addresses`` (company_name, company_address) single texts;
    ``locations`` (company_name, company_location) lists cut by ``;``.
    """
    name = F.col("company_name")
    candidates = reduce(
        DataFrame.unionByName,
        [
            places.select(name, longest_token(F.col("company_place")).alias("company_address")),
            addresses.where(F.col("company_address").isNotNull()).select(name, "company_address"),
            locations.select(name, longest_token(F.col("company_location"), ";").alias("company_address")),
        ],
    )
    # Tokens are never null; testing them here would make the scan split every text twice.
    clean = name.isNotNull() & ~name.isin("", "None")
    return longest_by_key(candidates.where(clean), "company_name", "company_address")


def company_address(
    places: DataFrame,
    addresses: DataFrame,
    locations: DataFrame,
    software: DataFrame,
    remarks: DataFrame,
    register: DataFrame,
) -> DataFrame:
    """company_name, address, company_address_zp of companies with software or product remarks."""
    names = union_distinct([software.select("company_name"), remarks.select("company_name")])
    registered = inner_join(names, register.select("company_name", "address"), "company_name")
    ads = ad_addresses(places, addresses, locations).withColumnRenamed(
        "company_address", "company_address_zp"
    )
    return left_join_unique(registered, ads, "company_name")
