"""Pipelines on small company tables, and the job runner."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerbrook import jobs
from ledgerbrook.catalog import batch, bindings
from ledgerbrook.plans import address, profile, score

DAY = "20191210"
SF_DIR = "/root/testdata/sf0.001"


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


def frame(spark, columns, rows, day=True):
    schema = ", ".join(f"{c} string" for c in columns.split()) + (", ptt_day string" if day else "")
    return spark.createDataFrame([(*r, DAY) if day else r for r in rows], schema)


@pytest.fixture(scope="module")
def company(spark):
    f = lambda columns, rows, day=True: frame(spark, columns, rows, day)
    register = f(
        "company_name honor_code business_status field address reg_capital scale_count establish_date",
        [
            ("a", "H1", "存续", "IT", "road 1", "200万日元", "少于50人", "2016-12-30"),
            ("b", "H2", "注销", "IT", "road 2", None, None, None),
            ("c", "H3", "在业", "Bio", "road 3", "1000万元人民币", "100-199人", "2030-01-01"),
            ("d", "H4", None, "Bio", "road 4", None, None, None),
            ("e", "H5", "存续", "Bio", "road 5", "100", "0-0", "abc"),
            ("a", "H1b", "存续", "IT2", "road 1b", "2000000万元人民币", None, None),
        ],
    )
    return {
        "master": f("company_name honor_code", [("a", "H1"), ("c", "H3"), ("z", "H9")], False),
        "register": register,
        "media": f(
            "company_name honor_code oss_path pos",
            [("a", "H1", "a.png", "1"), ("a", "H1", "a2.png", "2"), ("c", "H8", "c.png", "1")],
        ),
        "statistics": f(
            "honor_code company_name telphone email site introduce tags",
            [
                ("H1", "a", "1", "e", "a.com", "short", "存续|x|高新技术企业"),
                ("H3", "c", "1", "e", "-", "an introduction", None),
                ("H5", "e", "1", "e", "e.com", None, "高新技术企业"),
            ],
        ),
        "contact": f(
            "honor_code company_name phone email",
            [("H1", "a", "12345", "1234"), ("H3", "not c", "99999", "mail@c")],
        ),
        "ads_boss": f("company_name company_intro", [("a", "longest intro of a"), ("a", "intro a")]),
        "ads_lg": f("company_name company_intro", [("c", "unused")]),
        "ads_zhilian": f("company_name company_intro", [("a", None)]),
        "property": f(
            "company_name honor_code patent_total brand_total works_total website_total software_total",
            [("a", "H1", "3", "0", "x", "12", "0"), ("c", "H3", None, "7", "2", "51", None)],
        ),
        "run": f("company_name finance_total", [("a", "1")]),
        "products": f("company_name prod_name", [("a", "p"), ("a", None), ("c", None)]),
        "remarks": f(
            "company_name honor_code business_keywords",
            [("a", "H1", "k1,k2"), ("b", "H2", "k1"), ("c", "H3", None), ("d", "H4", "k2"), ("e", "H5", "k3")],
        ),
        "customers": f("company_name", [("e",), ("e",)], False),
        "baidu": f("company_name use_address location_lng location_lat", [("a", "street", "120.5", "bad")], False),
        "gaode": f("company_name use_address location_lng location_lat", [("a", "street", "1", "2")], False),
    }


def test_profile(company):
    got = {r.id: r for r in profile.company_profile(company, DAY, DAY, 99, "https://x/").collect()}
    assert set(got) == {"H1", "H3", "H9"}
    a = got["H1"]
    assert len(a) == 26
    assert (a.name, a.logo, a.description) == ("a", "https://x/a.png", "longest intro of a")
    assert (a.phone, a.mail, a.website, a.industry, a.address) == ("12345", "-", "a.com", "IT", "street")
    assert (a.status, a.type) == ("存续,高新技术企业", "")
    assert (a.knowledge_zl_num, a.knowledge_sb_num, a.knowledge_zzq_num, a.knowledge_icp_num) == (3, 0, None, 12)
    assert (a.bd_longitude, a.bd_latitude, a.gd_longitude, a.gd_latitude) == (120.5, 0.0, 1.0, 2.0)
    assert (a.op_latest, a.create_time, a.update_time, a.is_deleted) == ("bd_insert", 99, 0, 0)
    c = got["H3"]
    # The contact joins the master by name, the logo by code; neither fits here.
    assert (c.phone, c.mail, c.logo) == ("-", "-", None)
    assert (c.description, c.website, c.status) == ("an introduction", "-", "")
    z = got["H9"]
    assert (z.description, z.website, z.status, z.industry, z.address) == (None, None, None, None, "")


def test_profile_column_order(company):
    columns = profile.company_profile(company, DAY, DAY, 99, "").columns
    assert columns[:4] == ["id", "name", "logo", "description"]
    assert columns[19:] == [
        "op_latest", "remark", "create_user", "create_time", "update_user", "update_time", "is_deleted",
    ]


def test_score(company):
    as_of = F.lit("2019-12-31").cast("date")
    scored = score.company_score(company, DAY, DAY, as_of)
    got = {r.honor_code: r for r in scored.collect()}
    # b is closed, d has no status, e is a customer.
    assert set(got) == {"H1", "H1b", "H3"}
    a = got["H1"]
    assert [a[f"{c}_score"] for c in score.SCORED] == [2.4, 0.8, 1.6, 12, 8, 4.8, 0, 0, 8, 0, 12, 12]
    assert a.total_score == pytest.approx(61.6)
    assert (a.prod_name_num, a.works_total, a.has_recruit) == (1, "x", 1)
    c = got["H3"]
    assert [c[f"{n}_score"] for n in score.SCORED] == [7.2, 1.6, 0, 0, 0, 8, 8, 0, 0, 4, 0, 12]
    assert (c.software_total, c.finance_total, c.prod_name_num) == ("", "", 0)
    assert got["H1b"].reg_capital_score == 0
    assert scored.columns[:4] == ["company_name", "honor_code", "reg_capital", "reg_capital_score"]
    assert scored.columns[-1] == "total_score"


def test_address(spark):
    f = lambda columns, rows: frame(spark, columns, rows, False)
    got = address.company_address(
        f("company_name company_place", [("a", "ab,cdefg|h"), ("None", "long long"), (None, "x"), ("c", None)]),
        f("company_name company_address", [("a", "abc"), ("b", None)]),
        f("company_name company_location", [("a", "x;y"), ("", "zzz")]),
        f("company_name", [("a",), ("a",), ("b",)]),
        f("company_name", [("a",), ("c",), ("d",)]),
        f("company_name address", [("a", "r1"), ("a", "r2"), ("b", "r3"), ("c", None)]),
    )
    assert rows_of(got) == [("a", "r1", "cdefg"), ("a", "r2", "cdefg"), ("b", "r3", None), ("c", None, "")]


@pytest.fixture
def catalog(spark, company):
    names = {}
    for role, df in company.items():
        df.createOrReplaceTempView(f"in_{role}")
        names[role] = f"in_{role}"
    return names


@pytest.fixture
def outputs(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS made LOCATION '{tmp_path / 'made'}'")
    yield lambda *roles: {r: f"made.{r}" for r in roles}
    spark.sql("DROP DATABASE made CASCADE")


def test_jobs_write_tables(spark, catalog, outputs, tmp_path):
    categories = tmp_path / "categories.txt"
    categories.write_text("X\tk1\nY\tk2\n", encoding="utf-8")
    settings = {
        "inputs": catalog, "now": 7, "as_of": "2019-12-31", "dictionary": str(categories), "format": "parquet",
        "outputs": outputs("capacity", "capacity_map", "track", "track_map", "keyword_count", "category_label",
                           "profile", "score"),
    }
    for name in ("capacity", "track", "remarks", "profile", "score"):
        jobs.run_job(spark, name, settings, [f"run={DAY}"])
    jobs.run_job(spark, "capacity", settings, [DAY])
    assert rows_of(spark.table("made.capacity"), "id", "name") == [(1, "k1"), (2, "k2"), (3, "k3"), (4, "null")]
    assert rows_of(spark.table("made.capacity_map"), "company_id", "capacity_id") == [("H1", 1), ("H1", 2), ("H3", 4)]
    assert rows_of(spark.table("made.track_map"), "company_id", "track_id") == [("H1", 1), ("H1", 2), ("H3", 3)]
    assert dict(rows_of(spark.table("made.category_label")))["a"] == "X,Y"
    assert spark.table("made.profile").count() == 3
    assert spark.table("made.score").count() == 3


def test_job_needs_day_and_known_name(spark, catalog):
    settings = {"inputs": catalog, "outputs": {}}
    with pytest.raises(ValueError, match="partition day"):
        jobs.run_job(spark, "capacity", settings)
    with pytest.raises(ValueError, match="unknown job"):
        jobs.run_job(spark, "nope", settings)


def test_renamed_input_columns(spark, company):
    company["remarks"].withColumnRenamed("business_keywords", "words").createOrReplaceTempView("raw_remarks")
    run = jobs.Run(
        spark, {"inputs": {"remarks": "raw_remarks"}, "columns": {"remarks": {"words": "business_keywords"}}}, []
    )
    assert "business_keywords" in run.table("remarks").columns


def test_score_of_bucketed_tables_needs_no_exchange(spark):
    """Joins, distinct names and counts on the bucketed key take the buckets as they are.

    Only the distinct names of the three recruiting tables, a union, are exchanged.
    """
    inputs = batch.bucketed_company_inputs(spark, SF_DIR, int(spark.conf.get("spark.sql.shuffle.partitions")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scored = score.company_score(inputs, bindings.DAY, bindings.DAY, F.lit(bindings.AS_OF).cast("date"))
        plan = scored._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = [line.strip(" :+-*") for line in plan.splitlines()]
    exchanges = [i for i, line in enumerate(lines) if line.startswith("Exchange")]
    assert len(exchanges) == 1 and any(line.startswith("Union") for line in lines[exchanges[0] : exchanges[0] + 4])
    assert sum(line.startswith("SortMergeJoin") for line in lines) == 8
