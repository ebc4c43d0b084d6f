"""Click-stream metrics over parsed page views, chosen by name.

Every metric takes page views with ``ts, url, status, zip_code, user_id``. Window lengths are in
seconds and default to the live dashboard's; pass a watermarked stream for streaming use.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ledgerbrook.functions.records import is_page_view, page_view
from ledgerbrook.operators import counting, windows

PAGE_WINDOW = (10, 2)
ERROR_WINDOW = (30, 2)
USER_WINDOW = (15, 2)


def page_views(lines: DataFrame, line: str = "value") -> DataFrame:
    """Parse tab-separated lines; malformed ones are dropped. Other columns stay."""
    others = [c for c in lines.columns if c != line]
    good = lines.where(is_page_view(F.col(line)))
    return good.select(*others, page_view(F.col(line)).alias("_view")).select(*others, "_view.*")


def malformed_count(lines: DataFrame, line: str = "value") -> DataFrame:
    bad = F.when(~is_page_view(F.col(line)), 1)
    return lines.agg(F.count(bad).alias("malformed"))


def page_counts(views: DataFrame) -> DataFrame:
    return counting.value_counts(views, "url")


def sliding_page_counts(views: DataFrame, length: int = PAGE_WINDOW[0], slide: int = PAGE_WINDOW[1]) -> DataFrame:
    return windows.sliding_counts(views, "ts", length, slide, "url")


def error_rate_per_zip(views: DataFrame, length: int = ERROR_WINDOW[0], slide: int = ERROR_WINDOW[1]) -> DataFrame:
    return windows.error_rates(views, "ts", length, slide, "zip_code", "status")


def active_user_count(views: DataFrame, length: int = USER_WINDOW[0], slide: int = USER_WINDOW[1]) -> DataFrame:
    return windows.active_users(views, "ts", length, slide, "user_id")


def users_seen(views: DataFrame, users: DataFrame) -> DataFrame:
    """Page views of known users with their name; ``users`` has user_id and user_name."""
    return views.join(users.select("user_id", "user_name"), "user_id", "inner")


def first_users(seen: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` views of known users in time order."""
    return seen.orderBy("ts", "user_id").limit(n)


def first_users_seen(views: DataFrame, users: DataFrame, n: int = 10) -> DataFrame:
    """``ts, user_id, user_name`` of the first ``n`` known users of a batch; of several batches' the first ``n`` are those of all."""
    return first_users(users_seen(views, users), n).select("ts", "user_id", "user_name")


def popular_users_seen(views: DataFrame, users: DataFrame, n: int = 10) -> DataFrame:
    """The names of the first ``n`` known users of a batch in time order."""
    return first_users_seen(views, users, n).select("user_name")


METRICS: dict[str, Callable[..., DataFrame]] = {
    "pageCounts": page_counts,
    "slidingPageCounts": sliding_page_counts,
    "errorRatePerZipCode": error_rate_per_zip,
    "activeUserCount": active_user_count,
    "popularUsersSeen": popular_users_seen,
}


def metric(name: str) -> Callable[..., DataFrame]:
    if name not in METRICS:
        raise ValueError(f"unknown metric {name!r}; choose one of {', '.join(METRICS)}")
    return METRICS[name]
