"""Audit columns of published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerbrook.operators.relational import key_set

# Fixed values of the audit columns.
INSERT_OP = "bd_insert"
INSERT_REMARK = "bd_insert-大数据首次插入"
UPDATE_OP = "bd_update"
UPDATE_REMARK = "bd_update-大数据更新"
AUDIT_USER = "bd"


def with_audit(df: DataFrame, now: int, zero_type: str = "string") -> DataFrame:
    """Append the audit columns of a first insert; ``now`` is an epoch number chosen by the caller.

    ``update_time`` and ``is_deleted`` start as zero of ``zero_type``: string in the
    dictionary tables, int in the profile table.
    """
    zero = F.lit(0).cast(zero_type)
    return df.select(
        "*",
        F.lit(INSERT_OP).alias("op_latest"),
        F.lit(INSERT_REMARK).alias("remark"),
        F.lit(AUDIT_USER).alias("create_user"),
        F.lit(now).cast("bigint").alias("create_time"),
        F.lit(AUDIT_USER).alias("update_user"),
        zero.alias("update_time"),
        zero.alias("is_deleted"),
    )


def upsert_plan(source: DataFrame, target_ids: DataFrame, now: int, id_col: str = "id") -> DataFrame:
    """Decide insert or update per source row by whether its id is in the target.

    Sets ``op_latest``, ``remark`` and ``update_time``; all other columns pass through.
    """
    known = key_set(target_ids, id_col).withColumn("_known", F.lit(True))
    update = F.col("_known").isNotNull()
    decided = source.join(known, id_col, "left").withColumns({
        "op_latest": F.when(update, UPDATE_OP).otherwise(INSERT_OP),
        "remark": F.when(update, UPDATE_REMARK).otherwise(INSERT_REMARK),
        "update_time": F.when(update, F.lit(now)).otherwise(F.lit(0)).cast("bigint"),
    })
    extra = [c for c in ("op_latest", "remark", "update_time") if c not in source.columns]
    return decided.select(*source.columns, *extra)
