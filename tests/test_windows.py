"""Tumbling and sliding windows against a brute-force copy of rows into windows."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from ledgerbrook.operators import windows
from ledgerbrook.streaming import clickstream

START = datetime(2024, 1, 1)
EPOCH = datetime(1970, 1, 1)


def covering(ts: datetime, length: int, slide: int):
    second = (ts - EPOCH).total_seconds()
    start = int(second // slide) * slide
    while start > second - length:
        yield EPOCH + timedelta(seconds=start)
        start -= slide


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    return [
        (START + timedelta(milliseconds=rng.randrange(90_000)), f"/{rng.randrange(3)}", 200 if rng.random() < 0.9 else 404,
         rng.randrange(4), rng.randrange(12))
        for _ in range(300)
    ]


@pytest.fixture(scope="module")
def views(spark, rows):
    return spark.createDataFrame(rows, "ts timestamp_ntz, url string, status int, zip_code int, user_id bigint")


@pytest.mark.parametrize("length,slide", [(10, 2), (15, 2), (7, 3), (5, 5), (6, 4)])
def test_sliding_counts(views, rows, length, slide):
    expected = defaultdict(int)
    for ts, url, *_ in rows:
        for start in covering(ts, length, slide):
            expected[start, url] += 1
    got = windows.sliding_counts(views, "ts", length, slide, "url").collect()
    assert {(r.window_start, r.url): r.n for r in got} == expected
    assert all(r.window_end - r.window_start == timedelta(seconds=length) for r in got)


def test_tumbling_counts(views, rows):
    expected = defaultdict(int)
    for ts, url, *_ in rows:
        expected[next(covering(ts, 5, 5)), url] += 1
    got = windows.tumbling_counts(views, "ts", 5, "url").collect()
    assert {(r.window_start, r.url): r.n for r in got} == expected


def test_active_users(views, rows):
    expected = defaultdict(set)
    for ts, _, _, _, user in rows:
        for start in covering(ts, 15, 2):
            expected[start].add(user)
    got = clickstream.active_user_count(views).collect()
    assert {r.window_start: r.active_users for r in got} == {k: len(v) for k, v in expected.items()}
    assert got[0].label == f"Unique active users: {got[0].active_users}"


def test_error_rates(views, rows):
    expected = defaultdict(lambda: [0, 0])
    for ts, _, status, zip_code, _ in rows:
        for start in covering(ts, 30, 2):
            expected[start, zip_code][0] += status != 200
            expected[start, zip_code][1] += 1
    got = clickstream.error_rate_per_zip(views).collect()
    assert {(r.window_start, r.zip_code): [r.bad, r.total] for r in got} == expected


def test_five_percent_is_starred(spark):
    views = [(START, "/", 200 if i else 404, 94709, i) for i in range(20)]
    df = spark.createDataFrame(views, "ts timestamp_ntz, url string, status int, zip_code int, user_id bigint")
    labels = {r.label for r in clickstream.error_rate_per_zip(df).collect()}
    assert labels == {"94709: **0.05**"}
    clean = clickstream.error_rate_per_zip(df.where("status = 200")).first()
    assert clean.label == "94709: 0.0"


def test_hot_rows_are_summed_before_the_shuffle(views):
    plan = windows.sliding_counts(views, "ts", 10, 2, "url")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_sum") >= 2 and "Expand" in plan


def test_slide_longer_than_window(views):
    with pytest.raises(ValueError):
        windows.sliding_counts(views, "ts", 2, 10, "url")


def test_metric_names(views, spark):
    assert set(clickstream.METRICS) == {
        "pageCounts", "slidingPageCounts", "errorRatePerZipCode", "activeUserCount", "popularUsersSeen",
    }
    with pytest.raises(ValueError, match="unknown metric"):
        clickstream.metric("nope")
    users = spark.createDataFrame([(1, "ann"), (2, "bob")], "user_id bigint, user_name string")
    seen = clickstream.metric("popularUsersSeen")(views, users)
    assert seen.count() == 10 and {r.user_name for r in seen.collect()} <= {"ann", "bob"}
    assert sum(r.n for r in clickstream.metric("pageCounts")(views).collect()) == 300
