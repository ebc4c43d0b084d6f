"""Stream source factories. Operators take any streaming DataFrame with a ``value`` column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

SECURITY_PROTOCOLS = {"PLAINTEXT", "SSL", "SASL_PLAINTEXT", "SASL_SSL"}


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    return spark.readStream.format("socket").options(host=host, port=port).load()


def text_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of files that appear in a folder; with one file per batch it is a queue of batches."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)


def parquet_files(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """A parquet folder, or one parquet file of a folder, as a stream."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    reader = spark.readStream.schema(schema or spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if fs.getFileStatus(hadoop_path).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", hadoop_path.getName()).parquet(
        hadoop_path.getParent().toString()
    )


def kafka_options(
    servers: str | Sequence[str],
    topics: str | Sequence[str],
    start: str = "latest",
    group_id: str | None = None,
    security_protocol: str | None = None,
    sasl: Mapping[str, str] | None = None,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of a Kafka subscription. Offsets are kept in the query checkpoint, never committed.

    ``sasl`` entries such as ``mechanism`` or ``kerberos.service.name`` become
    ``kafka.sasl.*`` options; secrets come from the caller.
    """
    if start not in ("latest", "earliest"):
        raise ValueError("start must be 'latest' or 'earliest'")
    names = [topics] if isinstance(topics, str) else list(topics)
    hosts = servers if isinstance(servers, str) else ",".join(servers)
    if not hosts or not names or not all(names):
        raise ValueError("at least one server and one topic are required")
    options = {
        "kafka.bootstrap.servers": hosts,
        "subscribe": ",".join(names),
        "startingOffsets": start,
    }
    if group_id:
        options["kafka.group.id"] = group_id
    if security_protocol:
        if security_protocol not in SECURITY_PROTOCOLS:
            raise ValueError(f"unknown security protocol {security_protocol!r}")
        options["kafka.security.protocol"] = security_protocol
    for key, value in (sasl or {}).items():
        options[f"kafka.sasl.{key}"] = value
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_lines(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Key and value of Kafka records as text (needs the Kafka connector on the classpath)."""
    records = spark.readStream.format("kafka").options(**options).load()
    return records.select(F.col("key").cast("string"), F.col("value").cast("string"))


def union_streams(streams: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, streams)
