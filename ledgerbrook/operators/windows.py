"""Tumbling and sliding time windows over a timestamp column.

Sliding sums are built from panes: rows are first summed per pane, the greatest
common divisor of length and slide, and only the pane sums are copied into the windows
that cover them. Windows are ``[start, end)`` and aligned to the epoch. The same functions
take a stream with a watermark on the timestamp column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, Window, functions as F


def _seconds(n: int) -> str:
    return f"{n} seconds"


def _window_bounds() -> list[Column]:
    return [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]


def window_sums(
    df: DataFrame,
    ts: str,
    length: int,
    slide: int | None,
    keys: Sequence[str],
    sums: Mapping[str, Column],
) -> DataFrame:
    """Sums per window and key; ``length`` and ``slide`` in seconds, no slide = tumbling."""
    slide = slide or length
    if length < slide:
        raise ValueError("a window must be at least as long as its slide")
    pane = gcd(length, slide)
    panes = df.groupBy(F.window(ts, _seconds(pane)), *keys).agg(
        *[F.sum(expr).alias(name) for name, expr in sums.items()]
    )
    windows = panes
    if pane < length:
        windows = panes.groupBy(
            F.window("window", _seconds(length), _seconds(slide)).alias("window"), *keys
        ).agg(*[F.sum(name).alias(name) for name in sums])
    return windows.select(*_window_bounds(), *keys, *sums)


def pane_sums(
    df: DataFrame, ts: str, length: int, slide: int | None, keys: Sequence[str], sums: Mapping[str, Column]
) -> DataFrame:
    """Sums per pane and key, to be stored; those of several batches add up in ``from_panes``."""
    panes = df.groupBy(F.window(ts, _seconds(gcd(length, slide or length))), *keys).agg(
        *[F.sum(expr).alias(name) for name, expr in sums.items()]
    )
    return panes.select(F.col("window.start").alias("pane"), *keys, *sums)


def from_panes(
    panes: DataFrame, length: int, slide: int | None, keys: Sequence[str], sums: Sequence[str]
) -> DataFrame:
    """Sums per window and key of stored pane sums. A window covers whole panes, so their starts tell.

    A stream of them has to be watermarked on ``pane``; it keeps state of open windows only.
    """
    if not panes.isStreaming:
        panes = panes.groupBy("pane", *keys).agg(*[F.sum(name).alias(name) for name in sums])
    windows = panes.groupBy(F.window("pane", _seconds(length), _seconds(slide or length)), *keys).agg(
        *[F.sum(name).alias(name) for name in sums]
    )
    return windows.select(*_window_bounds(), *keys, *sums)


def tumbling_counts(df: DataFrame, ts: str, length: int, value: str, count: str = "n") -> DataFrame:
    return window_sums(df, ts, length, None, [value], {count: F.lit(1).cast("bigint")})


def sliding_counts(
    df: DataFrame, ts: str, length: int, slide: int, value: str, count: str = "n"
) -> DataFrame:
    return window_sums(df, ts, length, slide, [value], {count: F.lit(1).cast("bigint")})


def error_ratio(bad: Column, total: Column) -> Column:
    """Share of bad statuses as a 4-byte float."""
    return (bad / total).cast("float")


def ratio_text(key: Column, ratio: Column, threshold: float = 0.05) -> Column:
    """``key: ratio``, with the ratio starred above the threshold.

    The float ratio is widened to double for the test, so exactly 5 % is starred.
    """
    starred = ratio.cast("double") > F.lit(threshold).cast("double")
    text = ratio.cast("string")
    return F.when(starred, F.format_string("%s: **%s**", key, text)).otherwise(
        F.format_string("%s: %s", key, text)
    )


def error_rates(
    df: DataFrame, ts: str, length: int, slide: int, key: str, status: str, threshold: float = 0.05
) -> DataFrame:
    """Error ratio per sliding window and key, with its highlighted text."""
    return labelled_rates(window_sums(df, ts, length, slide, [key], status_sums(status)), key, threshold)


def status_sums(status: str) -> dict[str, Column]:
    """What an error ratio is made of: bad statuses and all."""
    bad = F.when(F.col(status) != 200, 1).otherwise(0).cast("bigint")
    return {"bad": bad, "total": F.lit(1).cast("bigint")}


def labelled_rates(sums: DataFrame, key: str, threshold: float = 0.05) -> DataFrame:
    """Windows with bad and total, their ratio and its text."""
    ratio = error_ratio(F.col("bad"), F.col("total"))
    return sums.withColumn("ratio", ratio).withColumn(
        "label", ratio_text(F.col(key).cast("string"), F.col("ratio"), threshold)
    )


def active_users(df: DataFrame, ts: str, length: int, slide: int, user: str) -> DataFrame:
    """Distinct users per sliding window.

    Users are made distinct per pane first. In a batch, each pane of a user then counts only in
    the windows that do not reach back to the user's pane before, so users are never
    copied into windows for another shuffle. A stream has no order to look back in, and makes
    users distinct per window.
    """
    if not df.isStreaming:
        return active_from_panes(user_panes(df, ts, length, slide, user), length, slide, user)
    covering = F.window("window", _seconds(length), _seconds(slide))
    panes = df.groupBy(F.window(ts, _seconds(gcd(length, slide))), user).agg(F.count(F.lit(1)).alias("_seen"))
    users = panes.groupBy(covering.alias("window"), user).agg(F.count(F.lit(1)).alias("_seen"))
    return _active(users, user)


def user_panes(df: DataFrame, ts: str, length: int, slide: int, user: str) -> DataFrame:
    """The distinct users of every pane, to be stored; several batches may name the same ones."""
    pane = F.window(ts, _seconds(gcd(length, slide)))
    return df.select(pane.alias("window"), user).select(F.col("window.start").alias("pane"), user).distinct()


def active_from_panes(panes: DataFrame, length: int, slide: int, user: str) -> DataFrame:
    """Distinct users per sliding window of stored panes; users' rows are not copied for another shuffle.

    A stream has no order to look back in, and makes users distinct per window.
    """
    if panes.isStreaming:
        covering = F.window("pane", _seconds(length), _seconds(slide)).alias("window")
        return _active(panes.groupBy(covering, user).agg(F.count(F.lit(1)).alias("_seen")), user)
    before = F.lag("pane").over(Window.partitionBy(user).orderBy("pane"))
    users = (
        panes.select("pane", user).distinct().withColumn("_before", before)
        .select(F.window("pane", _seconds(length), _seconds(slide)).alias("window"), user, "_before")
        .where(F.col("_before").isNull() | (F.col("window.start") > F.col("_before")))
    )
    return _active(users, user)


def _active(users: DataFrame, user: str) -> DataFrame:
    active = users.groupBy("window").agg(F.count(user).alias("active_users"))
    return active.select(
        *_window_bounds(), "active_users", active_text(F.col("active_users")).alias("label")
    )


def active_text(n: Column) -> Column:
    return F.concat(F.lit("Unique active users: "), n.cast("string"))
