"""Inputs of the pipelines, derived from the driver's tables.

The company tables are not part of the test data, so customers stand for companies and
parts for companies with keywords. Frames cover their whole source table, but for the roles that
are a choice of rows by nature: urgent orders, large purchases, good documents, parts of the largest size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerbrook.functions.records import page_view_line
from ledgerbrook.functions.text import first_number
from ledgerbrook.session import materialise

DAY = "20240105"
NOW = 1704412800
AS_OF = "2001-06-30"
HOUR = 3600


# Columns of the driver's tables, stated so that no read has to look for them in the files.
SCHEMAS = {
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "labels": "doc_id bigint, quality int, toxic int",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "pages": "page_id bigint, url string, html string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def company(id_col: str) -> Column:
    return F.concat(F.lit("Customer#"), F.lpad(F.col(id_col).cast("string"), 9, "0"))


def code(id_col: str) -> Column:
    return F.concat(F.lit("H"), F.col(id_col).cast("string"))


def of_day(df: DataFrame) -> DataFrame:
    return df.withColumn("ptt_day", F.lit(DAY))


def event_values(events: DataFrame) -> DataFrame:
    """Events with ``k``, the number in their props."""
    return events.select(
        "event_id", "ts", "user_id", "event_type", first_number(F.col("props")).cast("bigint").alias("k")
    )


def event_page_views(events: DataFrame) -> DataFrame:
    """Events as page-view lines; sign-ups carry a malformed status."""
    status = F.expr("CASE event_type WHEN 'error' THEN '500' WHEN 'signup' THEN 'n/a' ELSE '200' END")
    return events.select(
        "event_id",
        "ts",
        page_view_line(
            F.concat(F.lit("/"), F.col("event_type")), status, F.col("user_id") % 10, F.col("user_id")
        ).alias("value"),
    )


def log_lines(events: DataFrame) -> DataFrame:
    """Events as log lines: clicks are INFO, sign-ups WARNING, the rest keeps its name."""
    word = F.expr("CASE event_type WHEN 'click' THEN 'info' WHEN 'signup' THEN 'warning' ELSE event_type END")
    text = F.concat(F.lit("Hello "), F.upper(word), F.lit("   "), F.col("props"))
    return events.select("event_id", "ts", text.alias("value"))


def part_remarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword cells of parts: the words of the name and the brand; null for promotions."""
    words = F.when(
        F.col("p_type") != "PROMO",
        F.concat(F.replace("p_name", F.lit(" "), F.lit(", ")), F.lit(","), F.col("p_brand")),
    )
    parts = table(spark, sf_dir, "part")
    return of_day(
        parts.select(
            F.col("p_name").alias("company_name"),
            F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("honor_code"),
            words.alias("business_keywords"),
        )
    )


def part_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that were ordered."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("honor_code")).distinct()


def brand_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary: the category is a part type, its keywords are itself and the brands of its largest size."""
    parts = table(spark, sf_dir, "part")
    own = parts.select(F.col("p_type").alias("category"), F.col("p_type").alias("keyword"))
    brands = parts.where("p_size = 50").select(
        F.col("p_type").alias("category"), F.col("p_brand").alias("keyword")
    )
    return own.unionByName(brands).distinct()


def address_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    documents = table(spark, sf_dir, "documents")
    conversations = table(spark, sf_dir, "conversations")
    benchmark = table(spark, sf_dir, "benchmark")

    def source(id_col: str) -> Column:
        return F.concat(F.lit("src"), (F.col(id_col) % 20).cast("string")).alias("company_name")

    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return {
        "places": documents.select(F.col("source").alias("company_name"), F.col("text").alias("company_place")),
        "addresses": conversations.select(source("conv_id"), F.col("text").alias("company_address")),
        "locations": benchmark.select(source("item_id"), F.col("text").alias("company_location")),
        "software": documents.join(good, "doc_id", "left_semi").select(F.col("source").alias("company_name")),
        "remarks": documents.where("lang = 'en'").select(F.col("source").alias("company_name")),
        "register": documents.select(
            F.col("source").alias("company_name"), F.concat_ws("/", "source", "lang").alias("address")
        ).distinct(),
    }


def company_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Tables of the profile and score pipelines."""
    customers = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders")
    events = table(spark, sf_dir, "events")

    def count_if(condition: str, name: str) -> Column:
        return F.count(F.expr(f"CASE WHEN {condition} THEN 1 END")).cast("string").alias(name)

    per_customer = orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"),
        count_if("o_orderstatus = 'F'", "patent_total"),
        count_if("o_orderstatus = 'O'", "brand_total"),
        count_if("o_orderstatus = 'P'", "works_total"),
        count_if("o_orderpriority = '1-URGENT'", "software_total"),
        count_if("o_totalprice > 450000", "finance_total"),
        F.count(F.lit(1)).cast("string").alias("website_total"),
    )
    # Three inputs are made of it, so it is computed once.
    per_customer = materialise(per_customer, "per-customer")
    keyed = per_customer.select(
        company("o_custkey").alias("company_name"), code("o_custkey").alias("honor_code"), "*"
    )
    first_orders = per_customer.select(F.col("o_custkey").alias("c_custkey"), "first_order")
    unit = F.expr(
        "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '万元人民币' WHEN 'BUILDING' THEN '万美元'"
        " WHEN 'FURNITURE' THEN '元人民币' WHEN 'HOUSEHOLD' THEN '万日元' ELSE '万英镑' END"
    )
    staff = F.expr(
        "CASE WHEN c_nationkey = 0 THEN NULL WHEN c_nationkey = 1 THEN '少于50人'"
        " ELSE concat(c_nationkey * 10, '-', c_nationkey * 200, '人') END"
    )
    register = customers.join(first_orders, "c_custkey", "left").select(
        F.col("c_name").alias("company_name"),
        code("c_custkey").alias("honor_code"),
        F.expr("CASE c_mktsegment WHEN 'MACHINERY' THEN '注销' ELSE '存续' END").alias("business_status"),
        F.col("c_mktsegment").alias("field"),
        F.concat(F.floor(F.abs("c_acctbal")).cast("string"), unit).alias("reg_capital"),
        staff.alias("scale_count"),
        F.concat(F.lit("成立于"), F.date_format("first_order", "yyyy-MM-dd")).alias("establish_date"),
    )
    introductions = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("c_custkey"), F.col("text").alias("introduce")
    )
    statistics = customers.join(introductions, "c_custkey", "left").select(
        F.col("c_name").alias("company_name"),
        code("c_custkey").alias("honor_code"),
        F.concat(F.lower("c_mktsegment"), F.lit(".example")).alias("site"),
        "introduce",
        F.expr(
            "concat('存续|', CASE WHEN c_acctbal > 5000 THEN '高新技术企业|A轮' ELSE 'other' END)"
        ).alias("tags"),
    )
    ids = [F.col("c_name").alias("company_name"), code("c_custkey").alias("honor_code")]
    places = table(spark, sf_dir, "supplier")
    return {
        "master": customers.select(*ids),
        "register": of_day(register),
        "media": of_day(
            customers.select(
                *ids,
                F.concat(F.lit("logo/"), F.col("c_custkey").cast("string")).alias("oss_path"),
                F.expr("CASE WHEN c_acctbal > 0 THEN '1' ELSE '2' END").alias("pos"),
            )
        ),
        "statistics": of_day(statistics),
        "contact": of_day(
            customers.select(
                *ids,
                F.expr("CASE WHEN c_custkey < 1000 THEN cast(c_custkey AS string) ELSE concat('1380', c_custkey) END").alias("phone"),
                F.expr("CASE WHEN c_acctbal > 0 THEN concat(lower(c_mktsegment), '@mail.example') END").alias("email"),
            )
        ),
        "ads_boss": of_day(
            table(spark, sf_dir, "conversations").select(
                company("conv_id").alias("company_name"), F.col("text").alias("company_intro")
            )
        ),
        "ads_lg": of_day(
            table(spark, sf_dir, "benchmark").select(
                company("item_id").alias("company_name"), F.col("text").alias("company_intro")
            )
        ),
        "ads_zhilian": of_day(
            table(spark, sf_dir, "pages").select(
                company("page_id").alias("company_name"), F.col("url").alias("company_intro")
            )
        ),
        "property": of_day(keyed.drop("o_custkey", "first_order", "finance_total")),
        "run": of_day(keyed.select("company_name", "finance_total")),
        "products": of_day(
            orders.select(
                company("o_custkey").alias("company_name"),
                F.nullif("o_orderpriority", F.lit("5-LOW")).alias("prod_name"),
            )
        ),
        "remarks": of_day(
            orders.where("o_orderpriority = '1-URGENT'").select(company("o_custkey").alias("company_name"))
        ),
        "customers": events.where("event_type = 'purchase' AND value > 90").select(
            company("user_id").alias("company_name")
        ),
        "baidu": places.select(
            company("s_suppkey").alias("company_name"),
            F.col("s_name").alias("use_address"),
            F.concat(F.col("s_nationkey").cast("string"), F.lit(".5")).alias("location_lng"),
            F.col("s_nationkey").cast("string").alias("location_lat"),
        ),
        "gaode": table(spark, sf_dir, "part").select(
            company("p_partkey").alias("company_name"),
            F.col("p_brand").alias("use_address"),
            F.col("p_size").cast("string").alias("location_lng"),
            F.col("p_type").alias("location_lat"),
        ),
    }
