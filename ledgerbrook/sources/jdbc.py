"""JDBC tables: scan, publish and upsert. Connection values come from the caller.

Rows move only between executors and the database. The driver runs single statements
through the JVM's JDBC driver: the MERGE of an upsert, and the drop of its staging table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

Options = Mapping[str, str]


def scan_options(
    options: Options,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[Any, Any] | None = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """Reader options of a table or subquery scan, split by a column's range when given.

    A subquery that is to be split goes in as a derived table, since ``query`` cannot be split.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    split = [partition_column, bounds, partitions]
    if any(x is not None for x in split) and any(x is None for x in split):
        raise ValueError("partition_column, bounds and partitions go together")
    out = dict(options)
    if table is not None:
        out["dbtable"] = table
    elif partition_column is None:
        out["query"] = query
    else:
        out["dbtable"] = f"({query}) t"
    if partition_column is not None:
        out.update(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return out


def scan(spark: SparkSession, options: Options, **kwargs: Any) -> DataFrame:
    """A JDBC table as a DataFrame; later ``select`` and ``where`` are pushed to the database."""
    return spark.read.format("jdbc").options(**scan_options(options, **kwargs)).load()


def publish_options(options: Options, table: str) -> dict[str, str]:
    return {**options, "dbtable": table, "truncate": "true"}


def publish(tables: Mapping[str, DataFrame], options: Options) -> None:
    """Replace the rows of each JDBC table; table definitions and indexes stay."""
    for table, df in tables.items():
        df.write.format("jdbc").options(**publish_options(options, table)).mode("overwrite").save()


def replace_table(df: DataFrame, options: Options, table: str, names: Sequence[str] | None = None) -> None:
    """Recreate a JDBC table, with the columns renamed by position when ``names`` is given."""
    out = df.toDF(*names) if names else df
    out.write.format("jdbc").options(**options, dbtable=table).mode("overwrite").save()


def merge_sql(
    table: str,
    staging: str,
    columns: Sequence[str],
    id_col: str = "id",
    dialect: str = "ansi",
) -> str:
    """One statement that updates rows with a known id and inserts the others."""
    if id_col not in columns:
        raise ValueError(f"{id_col} is not among the columns")
    others = [c for c in columns if c != id_col]
    if dialect == "mysql":
        names = ", ".join(f"`{c}`" for c in columns)
        updates = ", ".join(f"`{c}` = VALUES(`{c}`)" for c in others)
        return (
            f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}"
            f" ON DUPLICATE KEY UPDATE {updates}"
        )
    if dialect != "ansi":
        raise ValueError(f"unknown dialect {dialect!r}")
    names = ", ".join(f'"{c}"' for c in columns)
    values = ", ".join(f's."{c}"' for c in columns)
    updates = ", ".join(f'"{c}" = s."{c}"' for c in others)
    return (
        f'MERGE INTO {table} t USING {staging} s ON t."{id_col}" = s."{id_col}"'
        f" WHEN MATCHED THEN UPDATE SET {updates}"
        f" WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def execute(spark: SparkSession, options: Options, statements: Sequence[str]) -> None:
    """Run statements in one transaction over one connection of the driver."""
    jvm = spark._jvm
    properties = jvm.java.util.Properties()
    for key, value in options.items():
        if key != "url":
            properties.setProperty(key, value)
    connection = jvm.java.sql.DriverManager.getConnection(options["url"], properties)
    run_transaction(connection, statements)


def run_transaction(connection: Any, statements: Sequence[str]) -> None:
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for sql in statements:
            statement.execute(sql)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def upsert(
    planned: DataFrame,
    options: Options,
    table: str,
    id_col: str = "id",
    dialect: str = "ansi",
    run: Callable[[SparkSession, Options, Sequence[str]], None] = execute,
) -> None:
    """Upsert rows whose audit columns ``operators.audit.upsert_plan`` has set.

    Executors fill a staging table in parallel, then one MERGE makes all rows visible at
    once. A failed try leaves the target as it was and can be repeated. One row per id goes in, since
    a MERGE refuses repeated source ids. The target needs a unique key on the id: without one the
    MySQL form would insert rows it should update.
    """
    staging = f"{table}_staging_{uuid.uuid4().hex[:12]}"
    spark = planned.sparkSession
    try:
        replace_table(planned.dropDuplicates([id_col]), options, staging)
        run(spark, options, [merge_sql(table, staging, planned.columns, id_col, dialect)])
    finally:
        run(spark, options, [f"DROP TABLE IF EXISTS {staging}"])
