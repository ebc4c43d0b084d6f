"""Joins, best-row-per-key, distinct sets and column defaults.

Joins of data tables carry no broadcast hint: Catalyst and AQE broadcast a side when its
measured size allows it, and split skewed partitions of the others.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerbrook.operators.hot import HOT_ROWS, hot_keys, is_broadcast
from ledgerbrook.session import materialise


def key_set(df: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """The distinct keys of ``df``, for semi, anti and flag joins.

    Distinct keys combine before the shuffle, so a hot key of ``df`` is no burden.
    """
    return df.select(*([on] if isinstance(on, str) else on)).distinct()


def semi_join_master(df: DataFrame, master: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``master``."""
    return df.join(key_set(master, on), on, "left_semi")


def anti_join(df: DataFrame, listed: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``listed``."""
    return df.join(key_set(listed, on), on, "left_anti")


def left_join_unique(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Left outer join to a side known to have one row per key, such as an aggregate."""
    return left.join(right, on, "left")


def left_join(left: DataFrame, right: DataFrame, on: str, hot_rows: int | None = None) -> DataFrame:
    """Left outer join; duplicates on the right fan out."""
    return left_joins(left, [right], on, hot_rows)


def left_joins(
    left: DataFrame, sides: Sequence[DataFrame], on: str, hot_rows: int | None = None, unique: Collection[int] = ()
) -> DataFrame:
    """Left outer joins to several sides on one key, one after the other.

    Rows without a key go around the joins; see ``join_chain`` for the others.
    """
    rows = left.where(F.col(on).isNotNull())
    joined = join_chain(rows, [(side, "left") for side in sides], on, hot_rows, unique)
    return joined.unionByName(left.where(F.col(on).isNull()), allowMissingColumns=True)


def join_chain(
    left: DataFrame, sides: Sequence[tuple[DataFrame, str]], on: str, hot_rows: int | None = None, unique: Collection[int] = ()
) -> DataFrame:
    """Joins to (side, "inner" or "left") on one key, one after the other.

    Where Catalyst broadcasts all sides, as their sizes tell it, the plain joins run. Otherwise, or with ``hot_rows``
    given, keys of all inputs are looked at once, see ``hot_keys``; without a hot one the plain joins run and share
    one shuffle of the left rows. A hot key's rows carry a salt through all joins, see ``_salted_chain``. ``unique`` are
    the positions of inputs, 0 the left one, that have one row per key by construction, such as aggregates.
    """
    if hot_rows is None and all(is_broadcast(side) for side, _ in sides):
        hot = None
    else:
        hot = hot_keys([left, *(side for side, _ in sides)], on, hot_rows or HOT_ROWS, unique)
    if hot is None:
        return reduce(lambda out, step: out.join(step[0], on, step[1]), sides, left)
    return _salted_chain(left, sides, on, hot)


def inner_join(left: DataFrame, right: DataFrame, on: str, hot_rows: int | None = None) -> DataFrame:
    """Inner equi join; duplicates on both sides fan out."""
    return join_chain(left, [(right, "inner")], on, hot_rows)


def _salted(df: DataFrame, on: str, hot: DataFrame, side: int) -> DataFrame:
    """``df`` with ``_salt``: rows of keys that are hot in this side get a random one, all others 0.

    Random salts are stored, so a retry or a lost executor cannot change them, and equal rows
    are spread as well as different ones.
    """
    mine = F.broadcast(hot.where(F.array_contains("_hot", side)).select(on, "_salts"))
    spread = df.join(mine, on).withColumn("_salt", F.floor(F.rand() * F.col("_salts")).cast("int")).drop("_salts")
    rest = df.join(mine, on, "left_anti").withColumn("_salt", F.lit(0))
    return rest.unionByName(materialise(spread, "salted-rows"))


def _salted_chain(rows: DataFrame, sides: Sequence[tuple[DataFrame, str]], on: str, hot: DataFrame) -> DataFrame:
    """The joins with hot keys cut into parts by (key, salt).

    Where a side's key is hot, its rows are spread and the left rows repeated once per salt; where it
    is not, the left rows keep the salt they have, from their own spreading or from a side before, and
    the side's few rows are repeated per salt. So rows that fan out in one join stay spread in the next.
    """
    every = F.broadcast(hot.select(on, "_salts", "_hot"))
    out = _salted(rows, on, hot, 0)
    for i, (side, how) in enumerate(sides, 1):
        here = F.coalesce(F.array_contains("_hot", i), F.lit(False))
        all_salts = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
        left = (
            out.join(every, on, "left").withColumn("_repeated", here)
            .withColumn("_salt", F.explode(F.when(here, all_salts).otherwise(F.array("_salt"))))
            .drop("_salts", "_hot")
        )
        right = (
            _salted(side, on, hot, i).join(every, on, "left")
            .withColumn("_salt", F.explode(F.when(here, F.array("_salt")).otherwise(all_salts)))
            .drop("_salts", "_hot").withColumn("_matched", F.lit(True))
        )
        joined = left.join(right, [on, "_salt"], how)
        # A hot key has matches; a repeat of its left row that met an empty salt is no result.
        out = joined.where(~F.col("_repeated") | F.col("_matched").isNotNull()).drop("_repeated", "_matched")
    return out.drop("_salt")


def presence_flag(df: DataFrame, present: DataFrame, on: str, flag: str) -> DataFrame:
    """Add 1/0 for whether the key occurs in ``present``."""
    keys = key_set(present, on).withColumn(flag, F.lit(1))
    return df.join(keys, on, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(0)))


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """Distinct rows over frames with equal column names."""
    return reduce(DataFrame.unionByName, frames).distinct()


def nonnull_count(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(value).alias(name))


def longest_by_key(df: DataFrame, key: str, text: str, name: str | None = None) -> DataFrame:
    """The longest text per key, the alphabetically last one on a tie; nulls never win."""
    longest = F.max(F.when(F.col(text).isNotNull(), F.struct(F.length(text).alias("size"), F.col(text).alias("text"))))
    return df.groupBy(key).agg(longest.alias("_longest")).select(key, F.col("_longest.text").alias(name or text))


def top1_per_key(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The row with the greatest ``order`` per key.

    ``max_by`` combines before the shuffle, so a key with very many rows ships one row per task.
    """
    others = [c for c in df.columns if c != key]
    best = F.max_by(F.struct(*others), F.struct(*order)).alias("_best")
    return df.groupBy(key).agg(best).select(key, *[F.col(f"_best.`{c}`").alias(c) for c in others])


def top_rows(df: DataFrame, order: Sequence[Column], n: int = 10) -> DataFrame:
    return df.orderBy(*order).limit(n)


def na_fill(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace null by a per-column default."""
    return df.fillna(dict(defaults))


def na_fill_text(df: DataFrame, text: str = "") -> DataFrame:
    """Replace null by ``text`` in every string column."""
    return df.fillna(text)


def typed_defaults(
    df: DataFrame, text: str = "-", columns: Sequence[str] | None = None
) -> DataFrame:
    """Replace null by a default of the column's type: ``text`` for strings, 0 for numbers."""
    numbers = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    types = dict(df.dtypes)
    defaults: dict[str, object] = {}
    for c in columns or df.columns:
        if types[c] == "string":
            defaults[c] = text
        elif types[c] in numbers:
            defaults[c] = 0
    return df.fillna(defaults)
