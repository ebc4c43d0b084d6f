"""The registered queries against their SQL, and the pipeline against a brute-force version."""

from __future__ import annotations

import struct
from collections import Counter

import cases
import corpus_pipeline
import duckdb
import pytest
from oracle import connect, differences
from test_llm_dedup import brute_jaccard
from test_llm_mining import VECTORS, conversations, leaks, vectors
from test_llm_native import targets
from tokenizers import Tokenizer

from ledgerbrook.llm import langid, queries
from ledgerbrook.llm.common import fold, uniform

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.SQL[name]) == []


OTHER_TABLES = ("embeddings", "conversations", "benchmark")


@pytest.mark.parametrize("name", sorted(n for n, sql in queries.SQL.items() if not any(f"FROM {t}" in sql for t in OTHER_TABLES)))
def test_query_equals_its_sql_on_awkward_rows(spark, tmp_path, name):
    data = [r for r in cases.unique(cases.rows(n=40)) if len(r[1] or "") < 10_000]  # the SQL copies a text per window
    cases.table(spark, data).write.parquet(str(tmp_path / "documents.parquet"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert differences(queries.QUERIES[name](spark, str(tmp_path)), connection, queries.SQL[name]) == []


def test_mining_queries_equal_their_sql_on_awkward_rows(spark, tmp_path):
    docs, items = leaks()
    tables = {
        "documents": cases.table(spark, cases.unique([r for r in docs if len(r[1] or "") < 10_000])),
        "benchmark": spark.createDataFrame([i for i in items if i != (3, items[3][1]) or i is items[3]], "item_id long, text string"),
        "conversations": spark.createDataFrame([r for r in conversations() if r[0] != 78], "conv_id long, turn long, role string, text string"),
        "embeddings": spark.createDataFrame([r for r in vectors() if r[0] and not (r[0] == 3 and r[1][0] == 5.0) and (r[1] is None or len(r[1]) == 6)], VECTORS),
    }
    connection = duckdb.connect()
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    for name in ("op11_hard_negatives", "op12_conversation_repair", "op13_decontaminate"):
        assert differences(queries.QUERIES[name](spark, str(tmp_path)), connection, queries.SQL[name]) == [], name


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_gives_one_row_per_input_row(spark, name):
    got = queries.QUERIES[name](spark, SF_DIR)
    if name.startswith("op1_"):
        n = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").filter("vec_id % 20 = 0").count()
        assert got.count() == 20 * n
    else:
        table = "pages" if name.startswith("op7_") else "documents"
        assert got.count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()


def test_pipeline(spark, tmp_path):
    from pyspark.sql import functions as F

    data = cases.unique(cases.rows(n=120))
    cases.table(spark, data, extra=False).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    classifier = langid.Classifier(langid.fit(docs.filter(fold(F.col("doc_id"), 3) != 1)))
    kept = [r for r in data if not classifier.predict(r[1])[3]]
    largest = {r[1]: r for r in sorted(kept)}
    kept = [r for r in kept if largest[r[1]] is r]
    component = brute_jaccard(kept)
    kept = [r for r in kept if component[r[0]][1] == r[0]]
    sizes: dict = {}
    for r in kept:
        sizes[r[3]] = sizes.get(r[3], 0) + len(cases.words(r[1]))
    rates = {s: t / sizes[s] if sizes[s] else 0 for s, t in targets(sizes).items()}
    u = {r["doc_id"]: r["u"] for r in docs.select("doc_id", uniform(F.col("doc_id"), "mix").alias("u")).collect()}
    library = Tokenizer.from_file(queries.VOCABULARY)
    expected = Counter()
    for r in kept:
        copies = int(rates[r[3]]) + (u[r[0]] < rates[r[3]] - int(rates[r[3]]))
        if copies:
            expected[(r[0], tuple(library.encode(r[1], add_special_tokens=False).ids))] += copies
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == expected
    assert all(len(struct.pack(f"<{len(r['ids'])}I", *r["ids"])) == 4 * r["n_tokens"] for r in got)


def test_stages_keep_the_columns_of_documents(spark):
    docs = cases.table(spark, extra=False)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns
    empty = cases.table(spark, [], extra=False)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0
