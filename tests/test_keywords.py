"""Keyword dictionaries and category labels."""

from __future__ import annotations

import pytest

from ledgerbrook.operators import dictionary as d
from ledgerbrook.plans import keywords
from ledgerbrook.sources import tables


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


@pytest.fixture
def categories(spark, tmp_path):
    path = tmp_path / "categories.txt"
    path.write_text("X\tk1\tk2\nY\tk2\n\nZ\tk,9\t\t\n", encoding="utf-8")
    return tables.load_dictionary(spark, str(path))


@pytest.fixture
def remarks(spark):
    return spark.createDataFrame(
        [
            ("c1", "H1", "k1,k2", "20240101"),
            ("c2", "H2", "X", "20240101"),
            ("c3", "H3", "zz,k 1", "20240101"),
            ("c4", "H4", None, "20240101"),
            ("c5", "H5", ",", "20240101"),
            ("c1", "H1", "k2", "20240101"),
            ("c6", "H6", "k1", "20240102"),
        ],
        "company_name string, honor_code string, business_keywords string, ptt_day string",
    )


@pytest.fixture
def master(spark):
    return spark.createDataFrame([("c1", "H1"), ("c4", "H4"), ("c9", "H9")], "company_name string, honor_code string")


def test_load_dictionary(categories):
    assert rows_of(categories) == [
        ("", ""), ("X", "X"), ("X", "k1"), ("X", "k2"), ("Y", "Y"), ("Y", "k2"), ("Z", "Z"), ("Z", "k,9"),
    ]


def test_category_label(remarks, categories):
    got = dict(rows_of(d.category_label(remarks, "company_name", "business_keywords", categories)))
    assert got == {"c1": "X,Y", "c2": "X", "c3": "其他", "c4": "其他", "c6": "X"}


def test_category_explode(remarks, categories):
    got = rows_of(d.category_explode(remarks, "company_name", "business_keywords", categories))
    assert got == [("c1", "X"), ("c1", "Y"), ("c2", "X"), ("c3", "其他"), ("c4", "其他"), ("c6", "X")]


def test_keyword_dictionary(spark):
    df = spark.createDataFrame([("b,a",), (None,), ("a, c\n",), ("",), (" ,",)], "cell string")
    assert rows_of(d.keyword_dictionary(df, "cell")) == [(1, "a"), (2, "b"), (3, "c"), (4, "null")]


def test_keyword_count(spark):
    df = spark.createDataFrame([("o", "a,b"), ("p", "a, b"), ("q", None), ("r", "a,,")], "owner string, cell string")
    assert rows_of(d.keyword_count(df, "owner", "cell")) == [(" b", 1), ("a", 3), ("b", 1), ("null", 1)]


def test_capacity_tables(remarks, master):
    words, mapped = keywords.capacity_tables(remarks, master, "20240101", 5)
    assert rows_of(words, "id", "name") == [(1, "X"), (2, "k 1"), (3, "k1"), (4, "k2"), (5, "null"), (6, "zz")]
    assert rows_of(mapped, "company_id", "capacity_id") == [("H1", 3), ("H1", 4), ("H1", 4), ("H4", 5)]
    assert mapped.first().update_time == "0"


def test_owner_side_cleaning(spark):
    df = spark.createDataFrame([("H1", "\na, b\n ,,c,"), (" ", "a"), (None, "a"), ("H2", "")], "o string, cell string")
    assert rows_of(d.clean_owner_keywords(df, "o", "cell")) == [("H1", "a"), ("H1", "b"), ("H1", "c"), ("H2", "null")]


def test_unmatched_keyword_keeps_null_id(spark):
    words = spark.createDataFrame([("H1", "a"), ("H1", "q")], "o string, keyword string")
    ids = spark.createDataFrame([(1, "a")], "id bigint, name string")
    assert rows_of(d.keyword_map(words, ids)) == [("H1", 1), ("H1", None)]


def test_track_tables(remarks, master, categories):
    tracks, mapped = keywords.track_tables(remarks, master, categories, "20240101", 5)
    assert rows_of(tracks, "id", "parent_id", "name") == [(1, 0, "X"), (2, 0, "Y"), (3, 0, "其他")]
    assert rows_of(mapped, "company_id", "track_id") == [("H1", 1), ("H1", 2), ("H4", 3)]


def test_remark_tables(remarks, categories):
    counts, labels = keywords.remark_tables(remarks, categories, "20240101")
    assert rows_of(counts) == [("X", 1), ("k 1", 1), ("k1", 2), ("k2", 2), ("null", 1), ("zz", 1)]
    assert dict(rows_of(labels))["c1"] == "X,Y"


@pytest.mark.parametrize("args", [None, [], [""], ["run=2024"]])
def test_partition_argument_required(args):
    with pytest.raises(ValueError):
        tables.partition_argument(args)


def test_partition_argument():
    assert tables.partition_argument(["day=20240105;x=20240106"]) == "20240105"
