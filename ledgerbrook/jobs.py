"""Run the pipelines from catalog tables to catalog tables.

    python -m ledgerbrook.jobs <job> <settings.json> [partition argument]

The settings name the tables; nothing is built in::

    {"inputs":  {"remarks": "ods.remarks", "master": "cdm.companies"},
     "columns": {"remarks": {"key_words": "business_keywords"}},
     "outputs": {"capacity": "ads.capacity", "capacity_map": "ads.capacity_map"},
     "format": "hive"}

Further settings: ``now`` (epoch seconds, default the clock), ``dictionary`` (file path),
``contact_day``, ``list_day``, ``as_of``, ``logo_prefix``, and ``jdbc`` options with ``dialect``.
"""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerbrook.operators import audit, relational
from ledgerbrook.plans import address, keywords, profile, score
from ledgerbrook.session import clear_scratch
from ledgerbrook.sources import jdbc, tables

Settings = Mapping[str, Any]


class Run:
    """One job run: its session, settings and partition day."""

    def __init__(self, spark: SparkSession, settings: Settings, args: Sequence[str]):
        self.spark, self.settings, self.args = spark, settings, args
        self.now = int(settings.get("now") or time.time())

    @property
    def day(self) -> str:
        return tables.partition_argument(self.args)

    def table(self, role: str) -> DataFrame:
        df = self.spark.table(self.settings["inputs"][role])
        return df.withColumnsRenamed(self.settings.get("columns", {}).get(role, {}))

    def tables(self, *roles: str) -> dict[str, DataFrame]:
        return {role: self.table(role) for role in roles}

    def dictionary(self) -> DataFrame:
        return tables.load_dictionary(self.spark, self.settings["dictionary"])


def address_job(run: Run) -> dict[str, DataFrame]:
    sides = run.tables("places", "addresses", "locations", "software", "remarks", "register")
    return {"address": address.company_address(**sides)}


def capacity_job(run: Run) -> dict[str, DataFrame]:
    words, mapped = keywords.capacity_tables(run.table("remarks"), run.table("master"), run.day, run.now)
    return {"capacity": words, "capacity_map": mapped}


def track_job(run: Run) -> dict[str, DataFrame]:
    tracks, mapped = keywords.track_tables(
        run.table("remarks"), run.table("master"), run.dictionary(), run.day, run.now
    )
    return {"track": tracks, "track_map": mapped}


def remarks_job(run: Run) -> dict[str, DataFrame]:
    counts, labels = keywords.remark_tables(run.table("remarks"), run.dictionary(), run.day)
    return {"keyword_count": counts, "category_label": labels}


def profile_job(run: Run) -> dict[str, DataFrame]:
    sides = run.tables(
        "master", "register", "media", "statistics", "contact", "ads_boss", "ads_lg", "ads_zhilian",
        "property", "baidu", "gaode",
    )
    contact_day = run.settings.get("contact_day") or run.day
    return {
        "profile": profile.company_profile(
            sides, run.day, contact_day, run.now, run.settings.get("logo_prefix", "")
        )
    }


def score_job(run: Run) -> dict[str, DataFrame]:
    sides = run.tables(
        "remarks", "register", "customers", "statistics", "property", "run", "products", "ads_boss",
        "ads_lg", "ads_zhilian",
    )
    as_of = run.settings.get("as_of")
    day = F.lit(as_of).cast("date") if as_of else F.current_date()
    return {"score": score.company_score(sides, run.settings.get("list_day") or run.day, run.day, day)}


def publish_job(run: Run) -> dict[str, DataFrame]:
    """Replace the rows of JDBC tables; ``outputs`` maps input roles to JDBC table names."""
    targets = run.settings["outputs"]
    jdbc.publish({targets[role]: run.table(role) for role in targets}, run.settings["jdbc"])
    return {}


def upsert_job(run: Run) -> dict[str, DataFrame]:
    """Upsert the profile table into a JDBC table."""
    options, target = run.settings["jdbc"], run.settings["outputs"]["profile"]
    source = relational.na_fill_text(run.table("profile"))
    ids = jdbc.scan(run.spark, options, table=target).select("id")
    planned = relational.typed_defaults(audit.upsert_plan(source, ids, run.now))
    jdbc.upsert(planned, options, target, dialect=run.settings.get("dialect", "ansi"))
    return {}


def export_job(run: Run) -> dict[str, DataFrame]:
    """Recreate JDBC tables from input tables, renamed by position as ``names`` says."""
    for role, target in run.settings["outputs"].items():
        names = run.settings.get("names", {}).get(role)
        jdbc.replace_table(run.table(role), run.settings["jdbc"], target, names)
    return {}


def import_job(run: Run) -> dict[str, DataFrame]:
    """Copy JDBC tables, named in ``sources``, to catalog tables."""
    sources = run.settings["sources"]
    return {role: jdbc.scan(run.spark, run.settings["jdbc"], table=t) for role, t in sources.items()}


JOBS: dict[str, Callable[[Run], dict[str, DataFrame]]] = {
    "address": address_job,
    "capacity": capacity_job,
    "track": track_job,
    "remarks": remarks_job,
    "profile": profile_job,
    "score": score_job,
    "publish": publish_job,
    "upsert": upsert_job,
    "export": export_job,
    "import": import_job,
}


def run_job(spark: SparkSession, name: str, settings: Settings, args: Sequence[str] = ()) -> None:
    if name not in JOBS:
        raise ValueError(f"unknown job {name!r}; choose one of {', '.join(JOBS)}")
    for role, df in JOBS[name](Run(spark, settings, args)).items():
        tables.write_table(df, settings["outputs"][role], settings.get("format"))


def main(argv: Sequence[str]) -> None:
    if len(argv) < 2:
        raise SystemExit("usage: ledgerbrook.jobs <job> <settings.json> [partition argument]")
    with open(argv[1], encoding="utf-8") as f:
        settings = json.load(f)
    spark = SparkSession.builder.appName(f"ledgerbrook-{argv[0]}").getOrCreate()
    try:
        run_job(spark, argv[0], settings, argv[2:])
    finally:
        clear_scratch(spark)


if __name__ == "__main__":
    main(sys.argv[1:])
