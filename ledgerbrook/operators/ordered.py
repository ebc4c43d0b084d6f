"""Order-dependent operators that never put one key, or the whole table, into one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ledgerbrook.session import materialise

BLOCK = "_block"
HEAD = "_head"


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    totals: Mapping[str, Column],
    blocks: int | None = None,
    stored_at: str | None = None,
) -> DataFrame:
    """Add running sums per key in ``order``, which must be unique within a key.

    ``totals`` maps a new column to the summed expression; a null counts as 0. With no keys the
    whole table is one sequence. Sums of floating-point numbers would depend on where the blocks
    are cut, so such an expression is refused: cast it to a decimal.

    Every key is cut into blocks, at every size: the rows are range-partitioned by key and order and
    stored with their block number. Each block sums on its own; a key that continues from earlier
    blocks then gets their total added. Only the last key of a block can continue, so that table has
    at most one row per block and is safe to broadcast. The blocks are stored in the shared folder,
    or at ``stored_at`` when the caller reuses one place.
    """
    kinds = df.select(*[expr.alias(name) for name, expr in totals.items()]).dtypes
    if inexact := [name for name, kind in kinds if kind in ("float", "double")]:
        raise TypeError(f"cast {', '.join(inexact)} to a decimal: floating-point sums depend on their order")
    return _block_totals(df, keys, order, totals, blocks, stored_at)


def _so_far(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    window = Window.partitionBy(*keys).orderBy(*order)
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _block_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    totals: Mapping[str, Column],
    blocks: int | None,
    stored_at: str | None,
) -> DataFrame:
    by = [*keys, *order]
    ranged = df.repartitionByRange(blocks, *by) if blocks else df.repartitionByRange(*by)
    steps = {f"_step_{name}": F.coalesce(expr, F.lit(0)) for name, expr in totals.items()}
    rows = materialise(
        ranged.withColumns({**steps, BLOCK: F.spark_partition_id()}), "ordered-blocks", stored_at
    )

    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    tails = rows.groupBy(BLOCK).agg(F.max(key).alias(HEAD))
    tail_sums = (
        rows.join(F.broadcast(tails), BLOCK)
        .where(key.eqNullSafe(F.col(HEAD)))
        .groupBy(BLOCK, HEAD)
        .agg(*[F.sum(f"_step_{name}").alias(f"_carry_{name}") for name in totals])
    )
    # One row per block from here on.
    carried = tail_sums.select(
        BLOCK,
        HEAD,
        *[F.sum(f"_carry_{n}").over(_so_far([HEAD], [BLOCK])).alias(f"_carry_{n}") for n in totals],
    )
    carries = carried.select(
        F.lead(BLOCK).over(Window.orderBy(BLOCK)).alias(BLOCK), HEAD, *[f"_carry_{n}" for n in totals]
    ).where(F.col(BLOCK).isNotNull())

    within = _so_far([BLOCK, *keys], order)
    summed = rows.withColumns({n: F.sum(f"_step_{n}").over(within) for n in totals})
    continues = key.eqNullSafe(F.col(HEAD))
    joined = summed.join(F.broadcast(carries), BLOCK, "left")
    result = {
        n: F.col(n) + F.when(continues, F.col(f"_carry_{n}")).otherwise(0) for n in totals
    }
    return joined.withColumns(result).select(*df.columns, *totals)


def running_sum(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    name: str = "running_sum",
    initial: DataFrame | None = None,
    **layout: Any,
) -> DataFrame:
    """One running total per input row; ``initial`` (key, value) rows seed the totals.

    Seeds enter the sequence before the first row of their key and are not emitted. ``layout`` is
    passed to ``running_totals``, here and in the functions below.
    """
    if initial is None:
        return running_totals(df, [key], order, {name: F.col(value)}, **layout)
    seeds = initial.select(key, value, F.lit(0).alias("_turn"))
    rows = df.withColumn("_turn", F.lit(1)).unionByName(seeds, allowMissingColumns=True)
    out = running_totals(rows, [key], ["_turn", *order], {name: F.col(value)}, **layout)
    return out.where(F.col("_turn") == 1).drop("_turn")


def surrogate_ids(df: DataFrame, name: str, id_col: str = "id", **layout: Any) -> DataFrame:
    """Dense ids 1..n over distinct ``name`` values, in name order."""
    numbered = running_totals(df, [], [name], {id_col: F.lit(1).cast("bigint")}, **layout)
    return numbered.select(id_col, *df.columns)


def count_windows(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    size: int = 2,
    initial: DataFrame | None = None,
    **layout: Any,
) -> DataFrame:
    """Cut each key's rows, in order, into groups of ``size``.

    Returns key, window_no (from 0), filled, total; the last group of a key may be
    short. ``initial`` (key, filled, total) rows are short groups left by earlier data.
    """
    rows = df.select(
        key, *order, F.col(value).cast("bigint").alias("total"), F.lit(1).cast("bigint").alias("filled")
    )
    by = list(order)
    if initial is not None:
        seeds = initial.select(key, "filled", "total", F.lit(0).alias("_turn"))
        rows = rows.withColumn("_turn", F.lit(1)).unionByName(seeds, allowMissingColumns=True)
        by = ["_turn", *by]
    seen = running_totals(rows, [key], by, {"_seen": F.col("filled")}, **layout)
    window_no = F.expr(f"(_seen - 1) div {int(size)}").alias("window_no")
    return seen.groupBy(key, window_no).agg(
        F.sum("filled").alias("filled"), F.sum("total").alias("total")
    )


def count_window_avg(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    size: int = 2,
    **layout: Any,
) -> DataFrame:
    """Truncated average of every ``size`` consecutive values of a key; a short rest emits nothing."""
    groups = count_windows(df, key, order, value, size, **layout)
    return groups.where(F.col("filled") == size).select(
        key, "window_no", F.expr("total div filled").alias("average")
    )


def ordered_reduce(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], x: str = "x", y: str = "y"
) -> DataFrame:
    """Fold points in order with ``(x1, y1), (x2, y2) -> (x1 + y1, x2 + y2)``.

    The fold of n >= 2 points is (sum of x+y over all but the last, x+y of the last), so
    it needs only a sum and the last point and combines before the shuffle.
    """
    point = F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    position = F.struct(*order)
    folded = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.col(x) + F.col(y)).alias("_sum"),
        F.max_by(point, position).alias("_last"),
    )
    last = F.col("_last.x") + F.col("_last.y")
    several = F.col("_n") > 1
    return folded.select(
        *keys,
        F.when(several, F.col("_sum") - last).otherwise(F.col("_last.x")).alias(x),
        F.when(several, last).otherwise(F.col("_last.y")).alias(y),
    )
