"""Text functions against hand-worked rows and plain-Python models."""

from __future__ import annotations

import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerbrook.functions import records, text

LIMITED = settings(max_examples=12, deadline=None)


def one_column(spark, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(make(F.col("s"))).collect()]


def split_model(s: str, d: str) -> list[str]:
    if s == "":
        return [""]
    parts = s.split(d)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@pytest.mark.parametrize("d", [",", "|", "，", "\n", " ", "\t", ";"])
def test_java_split(spark, d):
    cases = [f"a{d}{d}b{d}{d}", "", d, f"{d}a", "plain", None]
    expected = [["a", "", "b"], [""], [], ["", "a"], ["plain"], None]
    assert one_column(spark, cases, lambda c: text.java_split(c, d)) == expected


@LIMITED
@given(st.lists(st.text(alphabet="a,\n b", max_size=12), min_size=20, max_size=60))
def test_java_split_model(spark, values):
    got = one_column(spark, values, lambda c: text.java_split(c, ","))
    assert got == [split_model(v, ",") for v in values]


def test_java_split_takes_one_character():
    with pytest.raises(ValueError):
        text.java_split(F.lit("a"), ", ")


@LIMITED
@given(st.lists(st.text(alphabet="\x00\t\n\r \x1fab\x21　", max_size=10), min_size=20, max_size=60))
def test_trim_ws_model(spark, values):
    blanks = "".join(map(chr, range(0x21)))
    assert one_column(spark, values, text.trim_ws) == [v.strip(blanks) for v in values]


def test_null_token(spark):
    assert one_column(spark, [None, "", "x", " "], text.null_token) == ["null", "null", "x", " "]


def test_longest_token(spark):
    cases = ["ab,cde|f，ghij", "ab,cd", None, ",|", "", "x"]
    assert one_column(spark, cases, text.longest_token) == ["ghij", "ab", "", "", "", "x"]
    assert one_column(spark, ["a;bcd,e;f"], lambda c: text.longest_token(c, ";")) == ["bcd,e"]


def test_default_if_short(spark):
    cases = [None, "", "a", "ab", "abcde"]
    assert one_column(spark, cases, lambda c: text.default_if_short(c, 1)) == ["-", "-", "-", "ab", "abcde"]
    assert one_column(spark, cases, lambda c: text.default_if_short(c, 4)) == ["-", "-", "-", "-", "abcde"]


def test_fallback_text(spark):
    df = spark.createDataFrame(
        [(1, "introduction", "other text"), (2, "short", "other text"), (3, None, "tiny"), (4, "123456", None)],
        "i int, a string, b string",
    )
    got = df.orderBy("i").select(text.fallback_text([F.col("a"), F.col("b")], cut=5).alias("t")).collect()
    assert [r.t for r in got] == ["intro", "other", "-", "12345"]


def test_tag_allowlist(spark):
    cases = ["存续|foo|A轮|存续", "foo", None, "", "已退市(新三板)|x"]
    assert one_column(spark, cases, text.tag_allowlist) == ["存续,A轮,存续", "", "", "", "已退市(新三板)"]


def test_numbers_and_flags(spark):
    cases = ["a12b34", "abc", None, "", "7"]
    assert one_column(spark, cases, text.first_number) == ["12", "", None, "", "7"]
    assert one_column(spark, ["x高新y", "x", None], lambda c: text.like_flag(c, "高新")) == [1, 0, 0]
    cases = ["12", " 12.9 ", "-3.", "+4", "1e3", "abc", "", None, "99999999999"]
    assert one_column(spark, cases, text.whole_number) == [12, 12, -3, 4, None, None, None, None, None]


@LIMITED
@given(st.lists(st.text(alphabet="aB_ -é9\n", max_size=12), min_size=20, max_size=60))
def test_lower_words_model(spark, values):
    got = one_column(spark, values, text.lower_words)
    model = [[w for w in re.split(r"\W+", v.lower(), flags=re.ASCII) if w] for v in values]
    assert got == model


def test_severity(spark):
    cases = ["Hello Flume! ERROR   7", "INFO and ERROR 3", "WARNING", "other 9", "INFO 12 and 13"]
    assert one_column(spark, cases, records.severity) == ["ERROR", "ERROR", "WARNING", "any", "INFO"]
    assert one_column(spark, cases, records.severity_value) == [7, 3, 0, 0, 12]


def test_page_view(spark):
    cases = [
        "http://a\t200\t94709\t5", "http://a\tx\t1\t2", "short\t200", "", "\t-1\t+2\t3\tmore\n",
        "u\t99999999999\t1\t2", "u\t 1\t1\t2", None,
    ]
    got = one_column(spark, cases, records.page_view)
    assert tuple(got[0]) == ("http://a", 200, 94709, 5)
    assert tuple(got[4]) == ("", -1, 2, 3)
    good = one_column(spark, cases, records.is_page_view)
    assert good == [True, False, False, False, True, False, False, False]
    line = spark.range(1).select(
        records.page_view_line(F.lit("u"), F.lit(200), F.lit(1), F.lit(2)).alias("l")
    ).first()
    assert line.l == "u\t200\t1\t2"


def test_strip_salt(spark):
    assert one_column(spark, ["3-abc-1", "plain"], records.strip_salt) == ["abc-1", "plain"]
