"""Batch queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerbrook.catalog import bindings as b
from ledgerbrook.functions import records, scoring, text
from ledgerbrook.operators import (
    audit,
    counting,
    dictionary,
    keyvalue,
    ordered,
    relational,
    windows,
)
from ledgerbrook.plans import address, keywords, profile, score
from ledgerbrook.session import scratch_path
from ledgerbrook.sources import tables
from ledgerbrook.streaming import clickstream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
col = F.col


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Scans


@query
def scan_project(spark, d):
    logo = F.concat(F.lit("cust/"), col("c_name")).alias("logo")
    return b.table(spark, d, "customer").select("c_custkey", logo)


@query
def partition_day_scan(spark, d):
    day = tables.partition_argument(["run=20240105"])
    events = b.table(spark, d, "events").withColumn("ptt_day", F.date_format("ts", "yyyyMMdd"))
    rows = tables.partition_day(events, day).where("event_type = 'click'")
    return rows.select("event_id", "ptt_day", "user_id")


@query
def table_overwrite(spark, d):
    """A table of events by day, one day of which is overwritten by its later form; all days are read back."""
    path = scratch_path(spark, "events-by-day")
    name = path.rpartition("/")[2].replace("-", "_")
    events = b.table(spark, d, "events").select(
        "event_id", "event_type", F.date_format("ts", "yyyyMMdd").alias("ptt_day")
    )
    tables.write_table(events, name, partition_by=["ptt_day"], path=path)
    later = tables.partition_day(events, b.DAY).withColumn("event_type", F.upper("event_type"))
    tables.overwrite_days(later, name)
    return spark.table(name).select("event_id", "event_type", "ptt_day")


@query
def dictionary_load(spark, d):
    """Categories written as tab-separated lines, the category first, and loaded again."""
    path = scratch_path(spark, "dictionary")
    parts = b.table(spark, d, "part").groupBy("p_type").agg(F.sort_array(F.collect_set("p_brand")).alias("brands"))
    parts.select(F.concat_ws("\t", "p_type", F.concat_ws("\t", "brands")).alias("value")).write.text(path)
    return tables.load_dictionary(spark, path)


def _wide_customers(spark, d):
    """Customers under a letter-number key, with text cells as in a wide-column table."""
    letter = F.char(65 + col("c_custkey") % 26)
    key = F.concat_ws("-", letter, F.lpad(col("c_custkey").cast("string"), 8, "0"))
    return b.table(spark, d, "customer").select(
        key.alias("rowkey"),
        col("c_nationkey").cast("string").alias("age"),
        col("c_name").alias("uuid"),
        col("c_mktsegment").alias("segment"),
    )


@query
def key_range_scan(spark, d):
    path = scratch_path(spark, "customers-by-key")
    keyvalue.write_by_key(_wide_customers(spark, d), "rowkey", path)
    return keyvalue.key_range_scan(
        spark.read.parquet(path), "rowkey", "C-", "H-00000500", {"age": "int", "uuid": "string"}
    )


@query
def salted_range_scan(spark, d):
    salts = [str(i) for i in range(8)]
    salt = (col("user_id") % 8).cast("string")
    key = F.concat_ws("-", salt, F.lpad(col("event_id").cast("string"), 8, "0"))
    salted = b.table(spark, d, "events").select(salt.alias("salt"), key.alias("rowkey"), "event_type")
    path = scratch_path(spark, "events-salted")
    keyvalue.write_salted(salted, "rowkey", path)
    stored = spark.read.schema("rowkey string, event_type string, salt string").parquet(path)
    rows = keyvalue.salted_range_scan(stored, "rowkey", salts, "00000100", "00004000", original="id")
    return rows.select("rowkey", "id", "event_type")


@query
def table_count(spark, d):
    return counting.table_count(b.table(spark, d, "lineitem"))


@query
def point_lookup(spark, d):
    customers = b.table(spark, d, "customer").select(
        col("c_custkey").cast("string").alias("rowkey"), "c_name", "c_mktsegment"
    )
    lines = b.table(spark, d, "orders").select(
        F.concat_ws(",", F.reverse(col("o_custkey").cast("string")), "o_orderpriority").alias("value")
    )
    path = scratch_path(spark, "customers-by-bucket")
    keyvalue.write_for_lookup(customers, "rowkey", path, buckets=8)
    return keyvalue.stored_point_lookup(spark.read.parquet(path), keyvalue.reversed_keys(lines), buckets=8)


@query
def rare_point_lookup(spark, d):
    """Customers of the largest orders, by keys that reach the stored table's scan, and by keys that are nobody's."""
    customers = b.table(spark, d, "customer").select(
        col("c_custkey").cast("string").alias("rowkey"), "c_name", "c_mktsegment"
    )
    path = scratch_path(spark, "customers-by-bucket")
    keyvalue.write_for_lookup(customers, "rowkey", path, buckets=8)
    asked = b.table(spark, d, "orders").where("o_totalprice > 490000").select(col("o_custkey").cast("string").alias("rowkey"))
    absent = asked.select(F.concat(F.lit("0"), "rowkey").alias("rowkey"))
    return keyvalue.stored_point_lookup(spark.read.parquet(path), asked.unionByName(absent), buckets=8)


@query
def cells_unpivot(spark, d):
    parts = b.table(spark, d, "part")
    return keyvalue.cells(parts, "p_partkey", ["p_brand", "p_type", "p_size"], family="f")


# Scalar functions


@query
def java_split(spark, d):
    lines = F.posexplode(text.java_split(col("text"), "\n")).alias("pos", "line")
    return b.table(spark, d, "documents").select("doc_id", lines)


@query
def trim_ws(spark, d):
    lines = b.table(spark, d, "documents").select(
        "doc_id", F.posexplode(F.split("text", "[.]")).alias("pos", "piece")
    )
    return lines.select("doc_id", "pos", text.trim_ws(col("piece")).alias("trimmed"))


@query
def longest_token(spark, d):
    token = text.longest_token(col("text")).alias("token")
    return b.table(spark, d, "documents").select("doc_id", token)


@query
def default_if_short(spark, d):
    brand = text.default_if_short(col("p_brand"), 7).alias("brand")
    return b.table(spark, d, "part").select("p_partkey", brand)


@query
def fallback_text(spark, d):
    documents = b.table(spark, d, "documents").select("doc_id", "text")
    items = b.table(spark, d, "benchmark").select(col("item_id").alias("doc_id"), col("text").alias("item"))
    joined = relational.left_join(documents, items, "doc_id")
    chosen = text.fallback_text([col("item"), col("text")], longer_than=150, cut=1000)
    return joined.select("doc_id", chosen.alias("description"))


@query
def tag_allowlist(spark, d):
    tags = F.concat_ws("|", F.replace("p_name", F.lit(" "), F.lit("|")), "p_type", "p_type")
    kept = text.tag_allowlist(tags, ["red", "widget", "PROMO", "gear", "LARGE"]).alias("kept")
    return b.table(spark, d, "part").select("p_partkey", kept)


@query
def first_number(spark, d):
    return b.table(spark, d, "pages").select(
        "page_id",
        text.first_number(col("url")).alias("number"),
        text.first_match(col("url"), r"\D+").alias("head"),
        text.first_match(col("html"), r"\d+-\d+").alias("span"),
    )


@query
def whole_number(spark, d):
    prices = b.table(spark, d, "part").select(
        "p_partkey", text.whole_number(F.concat(F.lit(" "), col("p_size").cast("string"), F.lit(".75"))).alias("size"),
        text.whole_number(col("p_brand")).alias("brand"),
    )
    return prices


@query
def log_severity(spark, d):
    lines = b.log_lines(b.table(spark, d, "events"))
    return lines.select(
        "event_id",
        records.severity(col("value")).alias("severity"),
        records.severity_value(col("value")).alias("number"),
    )


@query
def pageview_parse(spark, d):
    lines = b.event_page_views(b.table(spark, d, "events"))
    return clickstream.page_views(lines).select("event_id", "url", "status", "zip_code", "user_id")


@query
def pageview_malformed(spark, d):
    return clickstream.malformed_count(b.event_page_views(b.table(spark, d, "events")))


# Scores


def _customer_scores(spark, d, name: str, make: Callable[[], Column], source: str = "register"):
    rows = b.company_inputs(spark, d)[source]
    return rows.select("honor_code", make().alias(name))


@query
def range_bucket(spark, d):
    mark = scoring.range_bucket(col("c_acctbal"), scoring.CAPITAL_RANGES).alias("mark")
    return b.table(spark, d, "customer").select("c_custkey", mark)


@query
def score_capital(spark, d):
    return _customer_scores(spark, d, "score", lambda: scoring.score_capital(col("reg_capital")))


@query
def score_headcount(spark, d):
    return _customer_scores(spark, d, "score", lambda: scoring.score_headcount(col("scale_count")))


@query
def score_years(spark, d):
    as_of = F.lit(b.AS_OF).cast("date")
    written = F.concat(F.lit("on "), F.date_format("o_orderdate", "yyyy-MM-dd"))
    return b.table(spark, d, "orders").select(
        "o_orderkey", scoring.score_years(written, as_of).alias("score")
    )


@query
def score_count(spark, d):
    return _customer_scores(
        spark, d, "score", lambda: scoring.score_count(col("website_total")), "property"
    )


@query
def score_flag(spark, d):
    balance = F.floor("c_acctbal").cast("string")
    return b.table(spark, d, "customer").select(
        "c_custkey", scoring.score_flag(balance, 8.0).alias("score")
    )


@query
def score_company(spark, d):
    return score.company_score(b.company_inputs(spark, d), b.DAY, b.DAY, F.lit(b.AS_OF).cast("date"))


def bucketed_company_inputs(spark, d, buckets: int = 8) -> dict[str, DataFrame]:
    """The score's inputs as tables bucketed by company name."""
    inputs, stored = b.company_inputs(spark, d), {}
    for name in score.INPUTS:
        path = scratch_path(spark, f"bucketed-{name}")
        table = path.rpartition("/")[2].replace("-", "_")
        tables.write_bucketed(inputs[name], table, "company_name", buckets, path)
        stored[name] = spark.table(table)
    return stored


@query
def score_company_bucketed(spark, d):
    """The score over bucketed tables, whose joins and counts need no exchange."""
    return score.company_score(bucketed_company_inputs(spark, d), b.DAY, b.DAY, F.lit(b.AS_OF).cast("date"))


# Joins, sets, best rows


@query
def inner_join(spark, d):
    customers = b.table(spark, d, "customer").select("c_custkey", "c_name")
    orders = b.table(spark, d, "orders").select(col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return relational.inner_join(customers, orders, "c_custkey")


@query
def left_join(spark, d):
    customers = b.table(spark, d, "customer").select("c_custkey", "c_name")
    events = b.table(spark, d, "events").select(col("user_id").alias("c_custkey"), "event_id", "event_type")
    return relational.left_join(customers, events, "c_custkey")


@query
def left_join_hot_keys(spark, d):
    """The left join with every user counted as a hot key."""
    customers = b.table(spark, d, "customer").select("c_custkey", "c_name")
    events = b.table(spark, d, "events").select(col("user_id").alias("c_custkey"), "event_id", "event_type")
    return relational.left_join(customers, events, "c_custkey", hot_rows=4)


@query
def semi_join_master(spark, d):
    users = b.table(spark, d, "events").select(col("user_id").alias("c_custkey"))
    return relational.semi_join_master(b.table(spark, d, "customer"), users, "c_custkey")


@query
def anti_join_unlisted(spark, d):
    urgent = b.table(spark, d, "orders").where("o_orderpriority = '1-URGENT'")
    open_customers = b.table(spark, d, "customer").where(~col("c_mktsegment").contains("MACH"))
    listed = urgent.select(col("o_custkey").alias("c_custkey"))
    return relational.anti_join(open_customers, listed, "c_custkey")


@query
def presence_flag(spark, d):
    buyers = b.table(spark, d, "events").where("event_type = 'purchase'")
    return relational.presence_flag(
        b.table(spark, d, "customer").select("c_custkey"),
        buyers.select(col("user_id").alias("c_custkey")),
        "c_custkey",
        "has_purchase",
    )


@query
def nonnull_count(spark, d):
    orders = b.table(spark, d, "orders").select(
        "o_custkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority")
    )
    return relational.nonnull_count(orders, "o_custkey", "priority", "n")


@query
def union_distinct(spark, d):
    return relational.union_distinct([
        b.table(spark, d, "orders").select(col("o_custkey").alias("id")),
        b.table(spark, d, "customer").select(col("c_custkey").alias("id")),
        b.table(spark, d, "events").select(col("user_id").alias("id")),
    ])


@query
def distinct_keys(spark, d):
    return b.table(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()


@query
def top1_per_key(spark, d):
    orders = b.table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return relational.top1_per_key(orders, "o_custkey", [col("o_totalprice"), -col("o_orderkey")])


@query
def topn_limit(spark, d):
    orders = b.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return relational.top_rows(orders, [col("o_totalprice").desc(), col("o_orderkey")], 10)


@query
def longest_address(spark, d):
    return address.company_address(**b.address_inputs(spark, d))


# Keywords and categories


@query
def keyword_count(spark, d):
    return dictionary.keyword_count(b.part_remarks(spark, d), "honor_code", keywords.CELL)


@query
def keyword_dictionary(spark, d):
    return dictionary.keyword_dictionary(b.part_remarks(spark, d), keywords.CELL)


@query
def surrogate_ids(spark, d):
    """Ids over all distinct lines, always by blocks."""
    lines = F.explode(text.java_split(col("text"), "\n")).alias("line")
    distinct = b.table(spark, d, "documents").select(lines).distinct()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return ordered.surrogate_ids(distinct, "line", blocks=partitions)


@query
def keyword_map(spark, d):
    return keywords.capacity_tables(b.part_remarks(spark, d), b.part_master(spark, d), b.DAY, b.NOW)[1]


@query
def category_label(spark, d):
    return dictionary.category_label(
        b.part_remarks(spark, d), "honor_code", keywords.CELL, b.brand_categories(spark, d)
    )


@query
def category_explode(spark, d):
    return dictionary.category_explode(
        b.part_remarks(spark, d), "honor_code", keywords.CELL, b.brand_categories(spark, d)
    )


@query
def category_map(spark, d):
    return keywords.track_tables(
        b.part_remarks(spark, d), b.part_master(spark, d), b.brand_categories(spark, d), b.DAY, b.NOW
    )[1]


# Profile, audit, upsert


@query
def profile_star_join(spark, d):
    return profile.company_profile(b.company_inputs(spark, d), b.DAY, b.DAY, b.NOW, "https://assets.example/")


@query
def audit_columns(spark, d):
    return audit.with_audit(b.table(spark, d, "supplier").select("s_suppkey", "s_name"), b.NOW)


@query
def na_fill(spark, d):
    customers = b.table(spark, d, "customer").select(
        "c_custkey",
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.nullif("c_nationkey", F.lit(3)).alias("nation"),
        F.when(col("c_acctbal") > 0, col("c_acctbal")).alias("balance"),
    )
    filled = relational.na_fill(customers, {"segment": ""})
    return relational.typed_defaults(filled)


@query
def upsert_plan(spark, d):
    source = b.table(spark, d, "customer").select(col("c_custkey").alias("id"), "c_name")
    target = b.table(spark, d, "events").select(col("user_id").alias("id"))
    return audit.upsert_plan(source, target, b.NOW)


# Counts


@query
def wordcount_space(spark, d):
    lines = b.table(spark, d, "documents").select(F.explode(text.java_split(col("text"), "\n")).alias("line"))
    return counting.word_counts(lines, text.space_words(col("line")))


def _deny(spark, d):
    return counting.word_counts(b.table(spark, d, "benchmark"), text.space_words(col("text"))).select("word")


@query
def denylist_filter(spark, d):
    return counting.denylist_filter(wordcount_space(spark, d), _deny(spark, d))


@query
def denylist_dropped(spark, d):
    return counting.denylist_dropped(wordcount_space(spark, d), _deny(spark, d))


@query
def category_totals_map(spark, d):
    values = b.event_values(b.table(spark, d, "events"))
    return counting.with_grand_total(counting.category_totals(values, "event_type", "k"))


# Ordered operators


def _running_sum(spark, d, value: str = "k", **layout):
    values = b.event_values(b.table(spark, d, "events")).withColumn("k", F.expr(value))
    initial = b.table(spark, d, "supplier").agg(F.count(F.lit(1)).alias("k"))
    initial = initial.select(F.lit("click").alias("event_type"), "k")
    out = ordered.running_sum(values, "event_type", ["ts", "event_id"], "k", initial=initial, **layout)
    return out.select("event_id", "event_type", "k", "running_sum")


@query
def running_sum(spark, d):
    return _running_sum(spark, d)


@query
def running_sum_hot_keys(spark, d):
    """The running sum with every event type cut into twelve blocks."""
    return _running_sum(spark, d, blocks=12)


@query
def running_sum_nulls(spark, d):
    """The running sum over values of which a third are null; they count as 0."""
    return _running_sum(spark, d, "CASE WHEN event_id % 3 <> 0 THEN k END", blocks=7)


@query
def count_window_avg(spark, d):
    values = b.event_values(b.table(spark, d, "events"))
    return ordered.count_window_avg(values, "event_type", ["ts", "event_id"], "k")


@query
def ordered_reduce(spark, d):
    points = b.event_values(b.table(spark, d, "events")).select(
        "user_id", "ts", "event_id", col("k").cast("double").alias("x"), (col("k") + 1).cast("double").alias("y")
    )
    folded = ordered.ordered_reduce(points.where("x > 1"), ["user_id"], ["ts", "event_id"])
    return folded.unpivot("user_id", ["x", "y"], "id", "value")


# Windows and click stream


def _views(spark, d):
    return clickstream.page_views(b.event_page_views(b.table(spark, d, "events")))


@query
def tumbling_wordcount(spark, d):
    line = F.concat_ws(" ", "event_type", "props")
    words = b.table(spark, d, "events").select("ts", F.explode(text.lower_words(line)).alias("word"))
    return windows.tumbling_counts(words, "ts", 24 * b.HOUR, "word")


@query
def page_counts(spark, d):
    return clickstream.metric("pageCounts")(_views(spark, d))


@query
def sliding_page_counts(spark, d):
    return clickstream.metric("slidingPageCounts")(_views(spark, d), 10 * b.HOUR, 2 * b.HOUR)


@query
def error_rate(spark, d):
    return clickstream.metric("errorRatePerZipCode")(_views(spark, d), 30 * b.HOUR, 2 * b.HOUR)


@query
def active_users(spark, d):
    return clickstream.metric("activeUserCount")(_views(spark, d), 15 * b.HOUR, 2 * b.HOUR)


def named_users(spark, d):
    return b.table(spark, d, "customer").select(
        col("c_custkey").alias("user_id"), col("c_name").alias("user_name")
    )


@query
def popular_users_seen(spark, d):
    return clickstream.metric("popularUsersSeen")(_views(spark, d), named_users(spark, d))
