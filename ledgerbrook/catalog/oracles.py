"""The SQL that batch and stream queries are compared with, over the same tables."""

from __future__ import annotations

from ledgerbrook.catalog.bindings import AS_OF, NOW

SQL: dict[str, str] = {}

BLANKS = "(SELECT string_agg(chr(i::INTEGER), '') FROM range(1, 33) r(i))"


def _buckets(value: str, ranges) -> str:
    arms = " ".join(
        f"WHEN {value} > {float(lo)} AND {value} <= {float(hi)} THEN {float(mark)}" for lo, hi, mark in ranges
    )
    return f"CAST(CASE {arms} ELSE 0.0 END AS DOUBLE)"


# Stated here again, so that a wrong mark in the code shows: (above, up to, mark).
CAPITAL = [(0, 100, 2.4), (100, 500, 4.8), (500, 1000, 7.2), (1000, 10000, 9.6), (10000, 1000000, 12.0)]
HEADCOUNT = [(0, 100, 0.8), (100, 500, 1.6), (500, 1000, 2.4), (1000, 10000, 3.2), (10000, 1000000, 4.0)]
YEARS = [(0, 3, 0.8), (3, 5, 1.6), (5, 10, 2.4), (10, 20, 3.2), (20, 1000000, 4.0)]
COUNT = [(0, 5, 1.6), (5, 10, 3.2), (10, 20, 4.8), (20, 50, 6.4), (50, 1000000, 8.0)]
TAGS = [
    "存续", "在业", "经营异常", "注销", "高新技术企业", "吊销", "严重违法", "有失信被执行人",
    "天使轮", "新四板", "A轮", "并购", "B轮", "Pre-A轮", "新三板", "种子轮", "C轮", "A+轮",
    "已退市(新三板)", "B+轮", "D轮", "E轮及以后", "C+轮", "Pre-B轮", "D+轮",
]


def _first(text: str, pattern: str) -> str:
    return f"regexp_extract({text}, '{pattern}', 0)"


def _number(text: str, kind: str = "DOUBLE") -> str:
    return f"TRY_CAST({_first(text, '[0-9]+')} AS {kind})"


def _flag(text: str, mark: float) -> str:
    return f"CAST(CASE WHEN {_number(text)} > 0 THEN {mark} ELSE 0.0 END AS DOUBLE)"


def _company(id_col: str) -> str:
    return f"'Customer#' || lpad(CAST({id_col} AS VARCHAR), 9, '0')"


def _audit(zero: str) -> str:
    return (
        "'bd_insert' AS op_latest, 'bd_insert-大数据首次插入' AS remark, 'bd' AS create_user,"
        f" CAST({NOW} AS BIGINT) AS create_time, 'bd' AS update_user,"
        f" {zero} AS update_time, {zero} AS is_deleted"
    )


# Inputs shared by several queries, as common table expressions.

EVENT_VALUES = """
event_values AS (
  SELECT event_id, ts, user_id, event_type,
         CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS k
  FROM events)
"""

VIEWS = """
views AS (
  SELECT event_id, ts, '/' || event_type AS url,
         CAST(CASE event_type WHEN 'error' THEN 500 ELSE 200 END AS INTEGER) AS status,
         CAST(user_id % 10 AS INTEGER) AS zip_code, user_id
  FROM events WHERE event_type <> 'signup')
"""

LOG_LINES = """
log_lines AS (
  SELECT event_id, ts,
         'Hello ' || upper(CASE event_type WHEN 'click' THEN 'info' WHEN 'signup' THEN 'warning'
                           ELSE event_type END) || '   ' || props AS value
  FROM events),
log_values AS (
  SELECT event_id, ts, severity,
         CASE WHEN severity = 'any' THEN 0
              ELSE coalesce(TRY_CAST(regexp_extract(value, '[0-9]+', 0) AS BIGINT), 0) END AS number
  FROM (SELECT *, CASE WHEN contains(value, 'ERROR') THEN 'ERROR' WHEN contains(value, 'INFO') THEN 'INFO'
                       WHEN contains(value, 'WARNING') THEN 'WARNING' ELSE 'any' END AS severity
        FROM log_lines))
"""

REMARKS = """
remarks AS (
  SELECT p_name AS company_name, 'P' || p_partkey AS honor_code,
         CASE WHEN p_type <> 'PROMO' THEN replace(p_name, ' ', ', ') || ',' || p_brand ELSE 'null' END AS cell
  FROM part),
raw_words AS (SELECT honor_code, unnest(string_split(cell, ',')) AS keyword FROM remarks),
dictionary AS (
  SELECT row_number() OVER (ORDER BY name) AS id, name
  FROM (SELECT DISTINCT trim(keyword) AS name FROM raw_words WHERE length(trim(keyword)) > 0)),
ordered_parts AS (SELECT DISTINCT 'P' || l_partkey AS honor_code FROM lineitem),
categories AS (
  SELECT DISTINCT p_type AS category, p_type AS keyword FROM part
  UNION SELECT DISTINCT p_type, p_brand FROM part WHERE p_size = 50),
found AS (
  SELECT DISTINCT honor_code, category FROM raw_words JOIN categories USING (keyword)),
labelled AS (
  SELECT honor_code, coalesce(category, '其他') AS category
  FROM (SELECT DISTINCT honor_code FROM raw_words) LEFT JOIN found USING (honor_code)),
category_ids AS (
  SELECT row_number() OVER (ORDER BY category) AS id, category
  FROM (SELECT DISTINCT category FROM labelled))
"""

SPACE_WORDS = """
lines AS (
  SELECT unnest(CASE WHEN text = '' THEN [''] WHEN rtrim(text, chr(10)) = '' THEN []
                     ELSE string_split(rtrim(text, chr(10)), chr(10)) END) AS line
  FROM {table}),
words AS (
  SELECT unnest(CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN []
                     ELSE string_split(rtrim(line, ' '), ' ') END) AS word
  FROM lines)
"""

WORD_COUNTS = (
    SPACE_WORDS.format(table="documents")
    + ", counts AS (SELECT word, count(*) AS n FROM words GROUP BY word), deny AS (SELECT DISTINCT word FROM ("
    + "SELECT unnest(CASE WHEN text = '' THEN [''] WHEN rtrim(text, ' ') = '' THEN []"
    + " ELSE string_split(rtrim(text, ' '), ' ') END) AS word FROM benchmark))"
)

COMPANY = f"""
per_customer AS (
  SELECT o_custkey, {_company("o_custkey")} AS company_name, 'H' || o_custkey AS honor_code,
         min(o_orderdate) AS first_order,
         CAST(count(*) FILTER (o_orderstatus = 'F') AS VARCHAR) AS patent_total,
         CAST(count(*) FILTER (o_orderstatus = 'O') AS VARCHAR) AS brand_total,
         CAST(count(*) FILTER (o_orderstatus = 'P') AS VARCHAR) AS works_total,
         CAST(count(*) FILTER (o_orderpriority = '1-URGENT') AS VARCHAR) AS software_total,
         CAST(count(*) FILTER (o_totalprice > 450000) AS VARCHAR) AS finance_total,
         CAST(count(*) AS VARCHAR) AS website_total,
         count(nullif(o_orderpriority, '5-LOW')) AS prod_name_num
  FROM orders GROUP BY o_custkey),
register AS (
  SELECT c_name AS company_name, 'H' || c_custkey AS honor_code,
         CASE c_mktsegment WHEN 'MACHINERY' THEN '注销' ELSE '存续' END AS business_status,
         c_mktsegment AS field,
         CAST(floor(abs(c_acctbal)) AS BIGINT) AS capital,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '万元人民币' WHEN 'BUILDING' THEN '万美元'
              WHEN 'FURNITURE' THEN '元人民币' WHEN 'HOUSEHOLD' THEN '万日元' ELSE '万英镑' END AS unit,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1.0::DOUBLE WHEN 'BUILDING' THEN 7.0304::DOUBLE
              WHEN 'FURNITURE' THEN 0.001::DOUBLE WHEN 'HOUSEHOLD' THEN 0.06474::DOUBLE
              ELSE 9.2886::DOUBLE END AS factor,
         CASE WHEN c_nationkey = 0 THEN NULL WHEN c_nationkey = 1 THEN '少于50人'
              ELSE concat(c_nationkey * 10, '-', c_nationkey * 200, '人') END AS scale_count,
         '成立于' || strftime(first_order, '%Y-%m-%d') AS establish_date,
         first_order, c_custkey, c_acctbal, c_nationkey, c_mktsegment
  FROM customer LEFT JOIN per_customer ON c_custkey = o_custkey),
scored_register AS (
  SELECT *, capital || unit AS reg_capital,
         {_buckets("capital * factor", CAPITAL)} AS reg_capital_score,
         CAST(CASE WHEN c_nationkey = 0 THEN 0.0 WHEN c_nationkey = 1 THEN 0.8
              ELSE {_buckets("(c_nationkey * 10 + (c_nationkey * 200 - c_nationkey * 10) / 2.0)", HEADCOUNT)}
              END AS DOUBLE) AS scale_count_score,
         {_buckets(f"(date_diff('day', first_order::DATE, DATE '{AS_OF}') / 365.0::DOUBLE)", YEARS)}
           AS establish_date_score
  FROM register)
"""

# Scans

SQL["scan_project"] = "SELECT c_custkey, 'cust/' || c_name AS logo FROM customer"
SQL["partition_day_scan"] = """
SELECT event_id, strftime(ts, '%Y%m%d') AS ptt_day, user_id FROM events
WHERE strftime(ts, '%Y%m%d') = '20240105' AND event_type = 'click'
"""
SQL["table_overwrite"] = """
SELECT event_id, CASE WHEN strftime(ts, '%Y%m%d') = '20240105' THEN upper(event_type) ELSE event_type END AS event_type,
       strftime(ts, '%Y%m%d') AS ptt_day FROM events
"""
SQL["dictionary_load"] = """
WITH brands AS (SELECT DISTINCT p_type, p_brand FROM part)
SELECT p_type AS category, p_type AS keyword FROM (SELECT DISTINCT p_type FROM part)
UNION ALL SELECT p_type, p_brand FROM brands
"""
SQL["key_range_scan"] = """
SELECT * FROM (
  SELECT chr(CAST(65 + c_custkey % 26 AS INTEGER)) || '-' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS rowkey,
         c_nationkey AS age, c_name AS uuid FROM customer)
WHERE rowkey >= 'C-' AND rowkey < 'H-00000500'
"""
SQL["salted_range_scan"] = """
SELECT (user_id % 8) || '-' || id AS rowkey, id, event_type
FROM (SELECT *, lpad(CAST(event_id AS VARCHAR), 8, '0') AS id FROM events)
WHERE id >= '00000100' AND id < '00004000'
"""
SQL["table_count"] = "SELECT count(*) AS n FROM lineitem"
SQL["point_lookup"] = """
WITH found AS (
  SELECT CAST(c_custkey AS VARCHAR) AS rowkey, c_name, c_mktsegment FROM customer
  WHERE CAST(c_custkey AS VARCHAR) IN
    (SELECT reverse(split_part(reverse(CAST(o_custkey AS VARCHAR)) || ',' || o_orderpriority, ',', 1)) FROM orders))
SELECT rowkey, 'c_name' AS qualifier, c_name AS value FROM found
UNION ALL SELECT rowkey, 'c_mktsegment', c_mktsegment FROM found
"""
SQL["rare_point_lookup"] = """
WITH found AS (
  SELECT CAST(c_custkey AS VARCHAR) AS rowkey, c_name, c_mktsegment FROM customer
  WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 490000))
SELECT rowkey, 'c_name' AS qualifier, c_name AS value FROM found
UNION ALL SELECT rowkey, 'c_mktsegment', c_mktsegment FROM found
"""
SQL["cells_unpivot"] = """
SELECT p_partkey, 'f' AS family, 'p_brand' AS qualifier, p_brand AS value FROM part
UNION ALL SELECT p_partkey, 'f', 'p_type', p_type FROM part
UNION ALL SELECT p_partkey, 'f', 'p_size', CAST(p_size AS VARCHAR) FROM part
"""

# Scalar functions

SQL["java_split"] = """
SELECT doc_id, CAST(generate_subscripts(lines, 1) - 1 AS INTEGER) AS pos, unnest(lines) AS line
FROM (SELECT doc_id, CASE WHEN text = '' THEN [''] WHEN rtrim(text, chr(10)) = '' THEN []
                          ELSE string_split(rtrim(text, chr(10)), chr(10)) END AS lines
      FROM documents)
"""
SQL["trim_ws"] = f"""
SELECT doc_id, CAST(generate_subscripts(pieces, 1) - 1 AS INTEGER) AS pos,
       trim(unnest(pieces), blanks) AS trimmed
FROM (SELECT doc_id, string_split(text, '.') AS pieces FROM documents), (SELECT {BLANKS} AS blanks)
"""
SQL["longest_token"] = """
SELECT doc_id, token FROM (
  SELECT doc_id, token, row_number() OVER (PARTITION BY doc_id ORDER BY length(token) DESC, pos) AS rn
  FROM (SELECT doc_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos
        FROM (SELECT doc_id, regexp_split_to_array(text, '[,|，]') AS tokens FROM documents)))
WHERE rn = 1
"""
SQL["default_if_short"] = """
SELECT p_partkey, CASE WHEN length(p_brand) > 7 THEN p_brand ELSE '-' END AS brand FROM part
"""
SQL["fallback_text"] = """
SELECT doc_id, substr(CASE WHEN length(i.text) > 150 THEN i.text WHEN length(d.text) > 150 THEN d.text
                           ELSE '-' END, 1, 1000) AS description
FROM documents d LEFT JOIN benchmark i ON doc_id = item_id
"""
SQL["tag_allowlist"] = """
SELECT p_partkey,
       array_to_string(list_filter(string_split(concat_ws('|', replace(p_name, ' ', '|'), p_type, p_type), '|'),
                                   lambda t: t IN ('red', 'widget', 'PROMO', 'gear', 'LARGE')), ',') AS kept
FROM part
"""
SQL["first_number"] = """
SELECT page_id, regexp_extract(url, '[0-9]+', 0) AS number, regexp_extract(url, '[^0-9]+', 0) AS head,
       regexp_extract(html, '[0-9]+-[0-9]+', 0) AS span
FROM pages
"""
SQL["whole_number"] = "SELECT p_partkey, p_size AS size, CAST(NULL AS INTEGER) AS brand FROM part"
SQL["log_severity"] = f"WITH {LOG_LINES} SELECT event_id, severity, number FROM log_values"
SQL["pageview_parse"] = f"WITH {VIEWS} SELECT event_id, url, status, zip_code, user_id FROM views"
SQL["pageview_malformed"] = "SELECT count(*) AS malformed FROM events WHERE event_type = 'signup'"

# Scores

SQL["range_bucket"] = (
    f"SELECT c_custkey, {_buckets('c_acctbal', CAPITAL)} AS mark FROM customer"
)
SQL["score_capital"] = f"WITH {COMPANY} SELECT honor_code, reg_capital_score AS score FROM scored_register"
SQL["score_headcount"] = f"WITH {COMPANY} SELECT honor_code, scale_count_score AS score FROM scored_register"
SQL["score_years"] = f"""
SELECT o_orderkey,
       {_buckets(f"(date_diff('day', o_orderdate::DATE, DATE '{AS_OF}') / 365.0::DOUBLE)", YEARS)} AS score
FROM orders
"""
SQL["score_count"] = f"""
WITH {COMPANY} SELECT honor_code, {_buckets(_number("website_total"), COUNT)} AS score FROM per_customer
"""
SQL["score_flag"] = f"""
SELECT c_custkey, {_flag("CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR)", 8.0)} AS score FROM customer
"""
SQL["score_company"] = f"""
WITH {COMPANY},
names AS (
  SELECT company_name FROM register
  WHERE business_status NOT LIKE '%销%'
    AND company_name IN (SELECT {_company("o_custkey")} FROM orders WHERE o_orderpriority = '1-URGENT')
    AND company_name NOT IN
      (SELECT {_company("user_id")} FROM events WHERE event_type = 'purchase' AND value > 90)),
recruiting AS (
  SELECT {_company("conv_id")} AS company_name FROM conversations
  UNION SELECT {_company("item_id")} FROM benchmark
  UNION SELECT {_company("page_id")} FROM pages),
base AS (
  SELECT r.*, coalesce(p.patent_total, '') AS patent_total, coalesce(p.brand_total, '') AS brand_total,
         coalesce(p.works_total, '') AS works_total, coalesce(p.software_total, '') AS software_total,
         coalesce(p.finance_total, '') AS finance_total, coalesce(p.website_total, '') AS website_total,
         coalesce(p.prod_name_num, 0) AS prod_name_num,
         CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS tag_gaoxin,
         CASE WHEN company_name IN (SELECT company_name FROM recruiting) THEN 1 ELSE 0 END AS has_recruit
  FROM names JOIN scored_register r USING (company_name) LEFT JOIN per_customer p USING (company_name)),
scores AS (
  SELECT company_name, honor_code, reg_capital, reg_capital_score,
         coalesce(scale_count, '') AS scale_count, scale_count_score,
         coalesce(establish_date, '') AS establish_date, establish_date_score,
         tag_gaoxin, CAST(tag_gaoxin * 12 AS DOUBLE) AS tag_gaoxin_score,
         prod_name_num, CAST(CASE WHEN prod_name_num > 0 THEN 8 ELSE 0 END AS DOUBLE) AS prod_name_num_score,
         website_total, {_buckets(_number("website_total"), COUNT)} AS website_total_score,
         works_total, {_flag("works_total", 8.0)} AS works_total_score,
         software_total, {_flag("software_total", 8.0)} AS software_total_score,
         patent_total, {_flag("patent_total", 8.0)} AS patent_total_score,
         brand_total, {_flag("brand_total", 4.0)} AS brand_total_score,
         finance_total, {_flag("finance_total", 12.0)} AS finance_total_score,
         has_recruit, CAST(has_recruit * 12 AS DOUBLE) AS has_recruit_score
  FROM base)
SELECT *, reg_capital_score + scale_count_score + establish_date_score + tag_gaoxin_score
          + prod_name_num_score + website_total_score + works_total_score + software_total_score
          + patent_total_score + brand_total_score + finance_total_score + has_recruit_score AS total_score
FROM scores
"""

# Joins, sets, best rows

SQL["inner_join"] = """
SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer JOIN orders ON c_custkey = o_custkey
"""
SQL["left_join"] = """
SELECT c_custkey, c_name, event_id, event_type FROM customer LEFT JOIN events ON c_custkey = user_id
"""
SQL["left_join_hot_keys"] = SQL["left_join"]
SQL["semi_join_master"] = "SELECT * FROM customer WHERE c_custkey IN (SELECT user_id FROM events)"
SQL["anti_join_unlisted"] = """
SELECT * FROM customer WHERE c_mktsegment NOT LIKE '%MACH%'
  AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
"""
SQL["presence_flag"] = """
SELECT c_custkey, CASE WHEN c_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase')
                       THEN 1 ELSE 0 END AS has_purchase
FROM customer
"""
SQL["nonnull_count"] = """
SELECT o_custkey, count(nullif(o_orderpriority, '5-LOW')) AS n FROM orders GROUP BY o_custkey
"""
SQL["union_distinct"] = """
SELECT o_custkey AS id FROM orders UNION SELECT c_custkey FROM customer UNION SELECT user_id FROM events
"""
SQL["distinct_keys"] = "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem"
SQL["top1_per_key"] = """
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
WHERE rn = 1
"""
SQL["topn_limit"] = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10"
SQL["longest_address"] = """
WITH cells AS (
  SELECT 'd' || doc_id AS cell, source AS company_name, regexp_split_to_array(text, '[,|，]') AS pieces FROM documents
  UNION ALL SELECT 'b' || item_id, 'src' || (item_id % 20), string_split(text, ';') FROM benchmark),
longest AS (
  SELECT company_name, piece AS company_address FROM (
    SELECT *, row_number() OVER (PARTITION BY cell ORDER BY length(piece) DESC, pos) AS rn
    FROM (SELECT cell, company_name, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS pos FROM cells))
  WHERE rn = 1
  UNION ALL SELECT 'src' || (conv_id % 20), text FROM conversations),
best AS (
  SELECT company_name, company_address AS company_address_zp FROM (
    SELECT *, row_number() OVER (PARTITION BY company_name
                                 ORDER BY length(company_address) DESC, company_address DESC) AS rn
    FROM longest WHERE company_name NOT IN ('', 'None') AND company_address IS NOT NULL)
  WHERE rn = 1),
names AS (
  SELECT source AS company_name FROM documents WHERE lang = 'en'
  UNION SELECT source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
register AS (SELECT DISTINCT source AS company_name, source || '/' || lang AS address FROM documents)
SELECT company_name, address, company_address_zp
FROM names JOIN register USING (company_name) LEFT JOIN best USING (company_name)
"""

# Keywords and categories

SQL["keyword_count"] = f"WITH {REMARKS} SELECT keyword, count(*) AS n FROM raw_words GROUP BY keyword"
SQL["keyword_dictionary"] = f"WITH {REMARKS} SELECT id, name FROM dictionary"
SQL["surrogate_ids"] = """
SELECT row_number() OVER (ORDER BY line) AS id, line FROM (
  SELECT DISTINCT unnest(CASE WHEN text = '' THEN [''] WHEN rtrim(text, chr(10)) = '' THEN []
                              ELSE string_split(rtrim(text, chr(10)), chr(10)) END) AS line
  FROM documents)
"""
SQL["keyword_map"] = f"""
WITH {REMARKS}
SELECT honor_code AS company_id, id AS capacity_id, {_audit("'0'")}
FROM raw_words JOIN ordered_parts USING (honor_code) LEFT JOIN dictionary ON trim(keyword) = name
WHERE length(trim(keyword)) > 0
"""
SQL["category_label"] = f"""
WITH {REMARKS}
SELECT honor_code, string_agg(category, ',' ORDER BY category) AS category FROM labelled GROUP BY honor_code
"""
SQL["category_explode"] = f"WITH {REMARKS} SELECT honor_code, category FROM labelled"
SQL["category_map"] = f"""
WITH {REMARKS}
SELECT honor_code AS company_id, id AS track_id, {_audit("'0'")}
FROM labelled JOIN ordered_parts USING (honor_code) LEFT JOIN category_ids USING (category)
"""

# Profile, audit, upsert

SQL["profile_star_join"] = f"""
WITH {COMPANY},
ads AS (
  SELECT {_company("conv_id")} AS company_name, text AS company_intro FROM conversations
  UNION SELECT {_company("item_id")}, text FROM benchmark
  UNION SELECT {_company("page_id")}, url FROM pages),
best_ads AS (
  SELECT company_name, company_intro FROM (
    SELECT *, row_number() OVER (PARTITION BY company_name
                                 ORDER BY length(company_intro) DESC, company_intro DESC) AS rn FROM ads)
  WHERE rn = 1),
status AS (
  SELECT c_custkey, string_agg(tag, ',') AS status FROM (
    SELECT c.c_custkey, t.tag, t.pos FROM customer c,
      LATERAL (SELECT unnest(l) AS tag, generate_subscripts(l, 1) AS pos
               FROM (SELECT string_split('存续|' || CASE WHEN c.c_acctbal > 5000 THEN '高新技术企业|A轮'
                                                        ELSE 'other' END, '|') AS l)) t
    WHERE t.tag IN ({", ".join(f"'{t}'" for t in TAGS)}) ORDER BY c.c_custkey, t.pos)
  GROUP BY c_custkey)
SELECT 'H' || c.c_custkey AS id, c_name AS name,
       CASE WHEN c_acctbal > 0 THEN 'https://assets.example/logo/' || c.c_custkey END AS logo,
       substr(CASE WHEN length(doc.text) > 5 THEN doc.text WHEN length(company_intro) > 5 THEN company_intro
                   ELSE '-' END, 1, 1000) AS description,
       CASE WHEN c.c_custkey < 1000 THEN '-' ELSE '1380' || c.c_custkey END AS phone,
       CASE WHEN c_acctbal > 0 THEN lower(c_mktsegment) || '@mail.example' ELSE '-' END AS mail,
       lower(c_mktsegment) || '.example' AS website,
       c_mktsegment AS industry,
       coalesce(s_name, '') AS address, '' AS type, status,
       CAST(patent_total AS INTEGER) AS knowledge_zl_num, CAST(brand_total AS INTEGER) AS knowledge_sb_num,
       CAST(works_total AS INTEGER) AS knowledge_zzq_num, CAST(website_total AS INTEGER) AS knowledge_icp_num,
       coalesce(s_nationkey + 0.5::DOUBLE, 0.0::DOUBLE) AS bd_longitude,
       coalesce(CAST(s_nationkey AS DOUBLE), 0.0::DOUBLE) AS bd_latitude,
       coalesce(CAST(p_size AS DOUBLE), 0.0::DOUBLE) AS gd_longitude, 0.0::DOUBLE AS gd_latitude,
       {_audit("CAST(0 AS INTEGER)")}
FROM customer c
LEFT JOIN per_customer ON c.c_custkey = o_custkey
LEFT JOIN documents doc ON doc_id = c.c_custkey
LEFT JOIN best_ads b ON b.company_name = c_name
LEFT JOIN status ON status.c_custkey = c.c_custkey
LEFT JOIN supplier ON s_suppkey = c.c_custkey
LEFT JOIN part ON p_partkey = c.c_custkey
"""
SQL["audit_columns"] = f"""SELECT s_suppkey, s_name, {_audit("'0'")} FROM supplier"""
SQL["na_fill"] = """
SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), '') AS segment,
       coalesce(nullif(c_nationkey, 3), 0) AS nation,
       CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE 0.0::DOUBLE END AS balance
FROM customer
"""
SQL["upsert_plan"] = f"""
SELECT c_custkey AS id, c_name,
       CASE WHEN hit THEN 'bd_update' ELSE 'bd_insert' END AS op_latest,
       CASE WHEN hit THEN 'bd_update-大数据更新' ELSE 'bd_insert-大数据首次插入' END AS remark,
       CAST(CASE WHEN hit THEN {NOW} ELSE 0 END AS BIGINT) AS update_time
FROM (SELECT *, c_custkey IN (SELECT user_id FROM events) AS hit FROM customer)
"""

# Counts

SQL["wordcount_space"] = f"WITH {WORD_COUNTS} SELECT word, n FROM counts"
SQL["denylist_filter"] = f"WITH {WORD_COUNTS} SELECT word, n FROM counts WHERE word NOT IN (SELECT word FROM deny)"
SQL["denylist_dropped"] = f"""
WITH {WORD_COUNTS}
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS dropped FROM counts WHERE word IN (SELECT word FROM deny)
"""
SQL["category_totals_map"] = f"""
WITH {EVENT_VALUES}
SELECT event_type, CAST(sum(k) AS BIGINT) AS total, CAST(sum(sum(k)) OVER () AS BIGINT) AS grand_total
FROM event_values GROUP BY event_type
"""

# Ordered operators

SQL["running_sum"] = f"""
WITH {EVENT_VALUES}
SELECT event_id, event_type, k,
       CAST(sum(k) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
            + CASE WHEN event_type = 'click' THEN (SELECT count(*) FROM supplier) ELSE 0 END AS BIGINT) AS running_sum
FROM event_values
"""
SQL["running_sum_hot_keys"] = SQL["running_sum"]
SQL["running_sum_nulls"] = f"""
WITH {EVENT_VALUES},
thinned AS (SELECT event_id, ts, event_type, CASE WHEN event_id % 3 <> 0 THEN k END AS k FROM event_values)
SELECT event_id, event_type, k,
       CAST(coalesce(sum(k) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 0)
            + CASE WHEN event_type = 'click' THEN (SELECT count(*) FROM supplier) ELSE 0 END AS BIGINT) AS running_sum
FROM thinned
"""
COUNT_WINDOWS = f"""
WITH {EVENT_VALUES},
numbered AS (
  SELECT event_type, k, (row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1) // 2 AS window_no
  FROM event_values)
SELECT event_type, {{number}} CAST(sum(k) // 2 AS BIGINT) AS average
FROM numbered GROUP BY event_type, window_no HAVING count(*) = 2
"""
SQL["count_window_avg"] = COUNT_WINDOWS.format(number="window_no,")
SQL["ordered_reduce"] = f"""
WITH {EVENT_VALUES},
points AS (
  SELECT user_id, CAST(k AS DOUBLE) AS x, CAST(k + 1 AS DOUBLE) AS y,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS back,
         count(*) OVER (PARTITION BY user_id) AS n
  FROM event_values WHERE k > 1),
folded AS (
  SELECT user_id,
         CASE WHEN max(n) = 1 THEN max(x) ELSE sum(x + y) FILTER (back > 1) END AS x,
         CASE WHEN max(n) = 1 THEN max(y) ELSE sum(x + y) FILTER (back = 1) END AS y
  FROM points GROUP BY user_id)
SELECT user_id, 'x' AS id, x AS value FROM folded UNION ALL SELECT user_id, 'y', y FROM folded
"""


# Windows and click stream


def _sliding(rows: str, length: int, slide: int) -> str:
    """``rows`` copied to every window of ``length`` hours that covers them, every ``slide`` hours."""
    return f"""
slid AS (
  SELECT v.*, unnest(range(time_bucket(INTERVAL {slide} HOUR, ts, TIMESTAMP '1970-01-01')
                             - INTERVAL {((length + slide - 1) // slide) * slide} HOUR,
                           ts + INTERVAL 1 MICROSECOND, INTERVAL {slide} HOUR)) AS window_start
  FROM {rows} v),
windowed AS (
  SELECT *, window_start + INTERVAL {length} HOUR AS window_end FROM slid
  WHERE window_start <= ts AND window_start + INTERVAL {length} HOUR > ts)
"""


SQL["tumbling_wordcount"] = """
WITH words AS (
  SELECT ts, unnest(list_filter(regexp_split_to_array(lower(event_type || ' ' || props), '[^A-Za-z0-9_]+'),
                                lambda w: w <> '')) AS word
  FROM events)
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, word, n
FROM (SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, word, count(*) AS n FROM words GROUP BY ALL)
"""
SQL["page_counts"] = f"WITH {VIEWS} SELECT url, count(*) AS n FROM views GROUP BY url"
SLIDING_COUNTS = f"""
WITH {VIEWS}, {_sliding("views", 10, 2)}
SELECT window_start, window_end, url, count(*) AS n FROM windowed GROUP BY ALL
"""
SQL["sliding_page_counts"] = SLIDING_COUNTS
SQL["error_rate"] = f"""
WITH {VIEWS}, {_sliding("views", 30, 2)},
sums AS (
  SELECT window_start, window_end, zip_code, count(*) FILTER (status <> 200) AS bad, count(*) AS total
  FROM windowed GROUP BY ALL),
ratios AS (SELECT *, CAST(bad / total AS FLOAT) AS ratio FROM sums)
SELECT window_start, window_end, zip_code, bad, total, ratio,
       CASE WHEN CAST(ratio AS DOUBLE) > 0.05::DOUBLE THEN zip_code || ': **' || CAST(ratio AS VARCHAR) || '**'
            ELSE zip_code || ': ' || CAST(ratio AS VARCHAR) END AS label
FROM ratios
"""
ACTIVE_USERS = f"""
WITH {VIEWS}, {_sliding("views", 15, 2)},
active AS (
  SELECT window_start, window_end, count(DISTINCT user_id) AS active_users FROM windowed GROUP BY ALL)
SELECT *, 'Unique active users: ' || active_users AS label FROM active
"""
SQL["active_users"] = ACTIVE_USERS
SQL["popular_users_seen"] = f"""
WITH {VIEWS}
SELECT c_name AS user_name FROM views JOIN customer ON c_custkey = user_id ORDER BY ts, user_id LIMIT 10
"""

# Streams: every batch carries on from the one before, so the results are those over the whole table.

SQL["stream_batch_wordcount"] = f"WITH {WORD_COUNTS} SELECT word, CAST(n AS BIGINT) AS n FROM counts"
SQL["stream_sql_wordcount"] = f"""
WITH {SPACE_WORDS.format(table="conversations")} SELECT word, count(*) AS n FROM words GROUP BY word
"""
SQL["stream_text_files"] = SQL["stream_sql_wordcount"]
SQL["stream_followed_lines"] = SQL["stream_sql_wordcount"]
SQL["stream_mod_count"] = "SELECT CAST(l_orderkey % 10 AS INTEGER) AS residue, count(*) AS n FROM lineitem GROUP BY ALL"
SQL["stream_union_grep"] = """
SELECT count(*) AS n FROM (
  SELECT unnest(string_split(rtrim(text, chr(10)), chr(10))) AS line FROM (
    SELECT text FROM documents UNION ALL SELECT text FROM conversations UNION ALL SELECT text FROM benchmark))
WHERE contains(line, 'the')
"""
SQL["stream_denylist_wordcount"] = f"""
WITH {WORD_COUNTS} SELECT word, n FROM counts WHERE word NOT IN (SELECT word FROM deny)
"""
SQL["stream_denylist_dropped"] = f"""
WITH {WORD_COUNTS}
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS dropped_total FROM counts WHERE word IN (SELECT word FROM deny)
"""
SQL["stream_tumbling_count"] = """
WITH days AS (
  SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL)
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, event_type, n FROM days
"""
SQL["stream_sliding_counts"] = SLIDING_COUNTS
SQL["stream_error_rate"] = SQL["error_rate"]
SQL["stream_active_users"] = ACTIVE_USERS
SQL["stream_late_rows"] = """
WITH seen AS (SELECT max(ts) - INTERVAL 1 HOUR AS watermark FROM events WHERE event_id % 2 = 0),
tagged AS (SELECT event_type, event_id % 2 = 1 AND date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 DAY <= watermark AS late FROM events, seen)
SELECT event_type, count(*) FILTER (NOT late) AS n_on_time, count(*) FILTER (late) AS n_late FROM tagged GROUP BY event_type
"""
SQL["score_company_bucketed"] = SQL["score_company"]
SQL["stream_static_join"] = f"""
WITH {VIEWS} SELECT event_id, user_id, c_name AS user_name FROM views JOIN customer ON c_custkey = user_id
"""
SQL["stream_popular_users"] = SQL["popular_users_seen"]
SQL["stream_category_totals"] = SQL["category_totals_map"]
SQL["stream_running_sum"] = SQL["running_sum"]
SQL["stream_running_sum_nulls"] = SQL["running_sum_nulls"]
SQL["stream_log_totals"] = f"""
WITH {LOG_LINES}
SELECT event_id, severity,
       CAST(sum(number) OVER (PARTITION BY severity ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
         AS running_sum
FROM log_values
"""
SQL["stream_count_window_avg"] = COUNT_WINDOWS.format(number="")
SQL["stream_keyed_averages"] = f"""
WITH {EVENT_VALUES},
numbered AS (
  SELECT user_id, k, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 3 AS window_no
  FROM event_values)
SELECT user_id, CAST(sum(k) // 3 AS BIGINT) AS average FROM numbered GROUP BY user_id, window_no HAVING count(*) = 3
"""
SQL["stream_recovery"] = SQL["stream_sql_wordcount"]
SQL["stream_keyed_sums"] = f"""
WITH {EVENT_VALUES} SELECT user_id, CAST(sum(k) AS BIGINT) AS total FROM event_values GROUP BY user_id
"""
