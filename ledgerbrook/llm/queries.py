"""The operators as queries over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerbrook.llm import ann, bpe, decontaminate, exact_dedup, html, jaccard, langid, lm, mixing, negatives, repair, sharding, substring
from ledgerbrook.llm.common import documents, fold, table

Query = Callable[[SparkSession, str], DataFrame]

#: Where the public vocabulary lies.
VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
SHARDS = 16


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every row whose id 20 divides, by largest inner product."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return bpe.round_trip(documents(spark, sf_dir), VOCABULARY)


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document left after repeated windows of 50 words are gone."""
    return substring.remove_repeats(documents(spark, sf_dir), digest=True)


def near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with similar sets of five-word shingles."""
    return jaccard.near_duplicates(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model log probabilities of every document."""
    return lm.score(documents(spark, sf_dir))


def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return html.extract(pages, html.fit(pages), keep=("url",))


def exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts and the row that stays."""
    return exact_dedup.duplicate_groups(documents(spark, sf_dir))


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets per source and the words taken of every document."""
    return mixing.draws(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen shards of near equal bytes."""
    shards = sharding.kd_shards(documents(spark, sf_dir), SHARDS)
    return shards.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learnt from two folds of three."""
    docs = documents(spark, sf_dir)
    dictionaries = langid.fit(docs.filter(fold(F.col("doc_id"), 3) != 1))
    found = langid.identify(docs, dictionaries)
    return found.withColumn("held_out", fold(F.col("doc_id"), 3) == 1)


def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of other labels just below the first five of each anchor's label; every 100th id is an anchor."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0, label)


def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after seeded damage."""
    return repair.repair(repair.damage(table(spark, sf_dir, "conversations")), F.col("copies"))


def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside ten-word windows of benchmark items."""
    return decontaminate.report(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_nn_descent": nearest_vectors,
    "op2_bpe": bpe_round_trip,
    "op3_substring_dedup": repeated_passages,
    "op4_jaccard_join": near_copies,
    "op5_lm_scores": lm_scores,
    "op6_exact_dedup": exact_copies,
    "op7_html_text": main_texts,
    "op8_source_mix": source_mix,
    "op9_kd_shards": kd_sharding,
    "op10_language_id": language_id,
    "op11_hard_negatives": hard_negatives,
    "op12_conversation_repair": conversation_repair,
    "op13_decontaminate": benchmark_leaks,
}

#: The six ASCII white-space characters end a word.
WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SQL: dict[str, str] = {}

SQL["op3_substring_dedup"] = rf"""
WITH d AS (SELECT doc_id, {WORDS_SQL} AS ws FROM documents),
w AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS k
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d WHERE len(ws) >= 50)),
f AS (SELECT k, min(doc_id) AS m FROM w GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM w JOIN f USING (k) WHERE m < doc_id),
g AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id),
kept AS (SELECT e.doc_id, string_agg(e.w, ' ' ORDER BY e.p) AS t
         FROM (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM d) e
         LEFT JOIN gone USING (doc_id, p) WHERE gone.p IS NULL GROUP BY e.doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id) LEFT JOIN kept USING (doc_id)"""

SQL["op4_jaccard_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS k
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN r ON r.a = d.doc_id GROUP BY 1, 2"""

SQL["op6_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""

SQL["op8_source_mix"] = rf"""
WITH d AS (SELECT doc_id, source, CAST(len({WORDS_SQL}) AS BIGINT) AS size FROM documents),
p AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS pos
      FROM d GROUP BY source),
c AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(pos % 3 + 1)::INT] AS weight, 2.0::DOUBLE * source_size AS cap FROM p),
f AS (SELECT *, cap / weight AS full_at,
        coalesce(sum(cap) OVER o, 0) AS caps, coalesce(sum(weight) OVER o, 0) AS weights
      FROM c WINDOW o AS (ORDER BY cap / weight, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT sum(source_size)::DOUBLE AS size, sum(weight) AS weight FROM c),
v AS (SELECT min_by((1.5::DOUBLE * t.size - caps) / (t.weight - weights), full_at) AS level FROM f, t
      WHERE (1.5::DOUBLE * t.size - caps) / (t.weight - weights) <= full_at),
g AS (SELECT source, source_size, CASE WHEN level IS NULL THEN cap ELSE least(cap, level * weight) END AS target FROM f, v),
r AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
             ('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM r"""

SQL["op11_hard_negatives"] = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same,
        CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS s
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT a, b, s FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5),
n AS (SELECT p.a AS anchor_id, p.b AS positive_id, n.b AS negative_id, p.s AS positive_score, n.s AS negative_score,
        CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.b) AS INTEGER) AS rank
      FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 80 * p.s <= 100 * n.s AND 100 * n.s <= 100 * p.s)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5"""

#: Words of ASCII letters and digits and of everything beyond ASCII.
PLAIN_WORDS_SQL = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

SQL["op13_decontaminate"] = rf"""
WITH i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {PLAIN_WORDS_SQL} AS ws FROM benchmark),
iw AS (SELECT DISTINCT item, n, array_to_string(ws[p:p + n - 1], ' ') AS k
       FROM (SELECT item, ws, least(len(ws), 10) AS n, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS p FROM i WHERE len(ws) > 0)),
d AS (SELECT doc_id, {PLAIN_WORDS_SQL} AS ws FROM documents),
dw AS (SELECT doc_id, n, p, array_to_string(ws[p:p + n - 1], ' ') AS k
       FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM iw) WHERE len(ws) >= n)),
h AS (SELECT doc_id, n, p, item FROM dw JOIN iw USING (n, k)),
w AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM h) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
      FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN w USING (doc_id) LEFT JOIN s USING (doc_id)"""


def _repair_sql() -> str:
    """The cheapest edits turn by turn: per last emitted role (z none, s, u, a) nine digits of cost and the audit."""
    byte = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    spelt = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    crc = (f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split({spelt}, ''), lambda x: CAST(ascii(x) AS BIGINT))),"
           f" lambda c, b: {byte}), 4294967295)")

    def on(state: str, cost: str, letter: str) -> str:
        return f"CASE WHEN {state} = '~' THEN '~' ELSE lpad(CAST(CAST(left({state}, 9) AS INT) + {cost} AS VARCHAR), 9, '0') || substr({state}, 10) || '{letter}' END"

    def if_(condition: str, state: str) -> str:
        return f"CASE WHEN {condition} THEN {state} ELSE '~' END"

    stays, late = "NOT gone", "CASE WHEN late THEN 5 ELSE 0 END"
    keep = {r: if_(f"{stays} AND x = '{r}'", on(source, late, "K")) for r, source in (("s", "z"), ("a", "u1"))}
    keep_u = if_(f"{stays} AND x = 'u'", f"least({on('z', late, 'K')}, {on('s', late, 'K')}, {on('a1', late, 'K')})")
    role_u = if_(stays, f"least({', '.join(on(q, f'1 + {late}', 'R') for q in ('z', 's', 'a1'))})")
    role_a = if_(stays, on("u1", f"1 + {late}", "R"))
    return rf"""
WITH RECURSIVE o AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS kind FROM conversations),
m AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM o WHERE kind <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, left(role, 1) AS x,
        trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again FROM m),
r AS (SELECT *, body = '' AS blank, body <> '' AND again AS dup, body <> '' AND NOT again AND right(body, 1) NOT IN ('.', '!', '?') AS late,
        body = '' OR again AS gone, lag(x) OVER (PARTITION BY conv_id ORDER BY i) || x AS pair FROM n),
w AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, '000000000' AS z, '~' AS s, '~' AS u, '~' AS a FROM o
  UNION ALL
  SELECT conv_id, i, {on("z", "2", "D")} AS z, least({on("s", "2", "D")}, {keep["s"]}) AS s,
    least({on("u1", "2", "D")}, {keep_u}, {role_u}) AS u, least({on("a1", "2", "D")}, {keep["a"]}, {role_a}) AS a
  FROM (SELECT *, least(a, {on("u1", "5", "I")}) AS a1 FROM (
    SELECT r.conv_id, r.i, r.x, r.gone, r.late, w.z, w.s, w.a, least(w.u, {on("w.z", "5", "I")}, {on("w.s", "5", "I")}, {on("w.a", "5", "I")}) AS u1
    FROM w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1))),
e AS (SELECT conv_id, least(z, a, {on("u", "5", "I")}, {on("s", "10", "II")}) AS best FROM w
      QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
b AS (SELECT conv_id, CAST(left(best, 9) AS BIGINT) AS cost, substr(best, 10) AS audit FROM e),
l AS (SELECT conv_id, p, substr(audit, p, 1) AS edit,
        count(*) FILTER (substr(audit, p, 1) <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS i
      FROM (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS p FROM b)),
t AS (SELECT l.conv_id, p, edit, r.role, r.text, count(*) FILTER (edit <> 'D' AND NOT (edit = 'K' AND r.x = 's'))
        OVER (PARTITION BY l.conv_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
      FROM l LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.i = l.i AND edit <> 'I'),
y AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN before % 2 = 0 THEN 'user' ELSE 'assistant' END
        || ':' || coalesce(text, ''), chr(10) ORDER BY p) AS whole FROM t WHERE edit <> 'D' GROUP BY conv_id),
k AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
        count_if(dup) AS duplicate, count_if(late) AS truncated, count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal
      FROM r GROUP BY conv_id)
SELECT b.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, cost, audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM b LEFT JOIN k ON k.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN y ON y.conv_id IS NOT DISTINCT FROM b.conv_id"""


SQL["op12_conversation_repair"] = _repair_sql()
