"""Scores against hand-worked rows."""

from __future__ import annotations

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerbrook.functions import scoring
from test_text import one_column


def test_capital(spark):
    rows = {
        None: 0, "": 0, "无": 0, "0万元人民币": 0, "200万日元": 2.4, "100万美元": 7.2, "1000万元人民币": 7.2,
        "50000000元人民币": 12, "2000000万元人民币": 0, "200.5万元人民币": 4.8, "约300万欧元": 4.8,
    }
    assert one_column(spark, list(rows), scoring.score_capital) == list(rows.values())


def test_headcount(spark):
    rows = {
        "少于50人": 0.8, "50-99人": 0.8, "100-199人": 1.6, "500-999人": 2.4, "1000-4999人": 3.2,
        "10000-20000人": 4, "10000人以上": 0, "0-0": 0, None: 0, "": 0,
    }
    assert one_column(spark, list(rows), scoring.score_headcount) == list(rows.values())


def test_years(spark):
    rows = {
        "2019-12-31": 0, "2019-01-01": 0.8, "2016-12-31": 0.8, "2016-12-30": 1.6, "成立于2012-06-01": 2.4,
        "1990-05-01": 4, "2030-01-01": 0, "2019-13-45": 0, "abc": 0, "2018-13-01": 0.8, "2019-00-00": 0.8,
        None: 0,
    }
    as_of = F.lit("2019-12-31").cast("date")
    assert one_column(spark, list(rows), lambda c: scoring.score_years(c, as_of)) == list(rows.values())


def test_lenient_date(spark):
    rows = {"2019-13-45": "2020-02-14", "2020-02-30": "2020-03-01", "2019-01-00": "2018-12-31"}
    got = one_column(spark, list(rows), lambda c: scoring.lenient_date(c).cast("string"))
    assert got == list(rows.values())


def test_count(spark):
    rows = {"0": 0, "5": 1.6, "6": 3.2, "20": 4.8, "51家": 8, "1000001": 0, "abc": 0, None: 0}
    assert one_column(spark, list(rows), scoring.score_count) == list(rows.values())


def test_flag(spark):
    rows = {"0": 0, "3": 8, "-5": 8, "0.9": 0, "abc": 0, None: 0, "9" * 400: 8}
    assert one_column(spark, list(rows), lambda c: scoring.score_flag(c, 8.0)) == list(rows.values())


def model(x, ranges):
    return next((m for lo, hi, m in ranges if x != 0 and lo < x <= hi), 0.0)


@settings(max_examples=12, deadline=None)
@given(st.lists(
    st.one_of(st.floats(-10, 2e6), st.sampled_from([0.0, 100.0, 100.0001, 500.0, 1000000.0])),
    min_size=20, max_size=60,
))
def test_range_bucket_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    mark = scoring.range_bucket(F.col("x"), scoring.CAPITAL_RANGES)
    got = [r[0] for r in df.orderBy("i").select(mark).collect()]
    assert got == [model(v, scoring.CAPITAL_RANGES) for v in values]


def test_ranges_must_join_up(spark):
    with pytest.raises(ValueError):
        scoring.range_bucket(F.lit(1.0), [(0, 5, 1.0), (6, 7, 2.0)])


def test_best_company_scores_100():
    top = [max(m for _, _, m in r) for r in (
        scoring.CAPITAL_RANGES, scoring.HEADCOUNT_RANGES, scoring.YEARS_RANGES, scoring.COUNT_RANGES
    )]
    assert sum(top) + sum(scoring.FLAG_MARKS.values()) == 100
