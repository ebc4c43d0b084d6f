"""Per-batch work of a stream, stored under the batch id so that a replay overwrites itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ledgerbrook.functions.text import space_words
from ledgerbrook.operators import counting

Transform = Callable[[DataFrame], DataFrame]


def start(writer: DataStreamWriter, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Start with a processing-time interval, or read what is there and stop."""
    writer = writer.option("checkpointLocation", checkpoint)
    if interval:
        return writer.trigger(processingTime=interval).start()
    return writer.trigger(availableNow=True).start()


def batch_path(out: str, batch_id: int) -> str:
    return f"{out}/batch_id={batch_id}"


def store_batches(
    stream: DataFrame,
    transform: Transform,
    out: str,
    checkpoint: str,
    interval: str | None = None,
    mode: str = "append",
    after: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Apply a batch transformation to every micro-batch, without carry-over between batches.

    ``after`` is called with the batch's number once its rows are stored and before the batch counts as done.
    """

    def work(df: DataFrame, batch_id: int) -> None:
        transform(df).write.mode("overwrite").parquet(batch_path(out, batch_id))
        if after:
            after(batch_id)

    return start(stream.writeStream.outputMode(mode).foreachBatch(work), checkpoint, interval)


def run_recovering(begin: Callable[[], StreamingQuery], attempts: int = 3) -> int:
    """Run a query until it ends; after a failure start it again from its checkpoint. Returns the number of failures.

    A failed batch is replayed as a whole, so its work has to overwrite what it left, as ``store_batches`` does.
    The failure of the last attempt is raised.
    """
    for failures in range(attempts):
        try:
            begin().awaitTermination()
            return failures
        except StreamingQueryException:
            if failures + 1 == attempts:
                raise
    raise ValueError("at least one attempt is needed")


def append_rows(stream: DataFrame, out: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Append finished rows to a parquet folder, each row once."""
    return start(stream.writeStream.format("parquet").option("path", out), checkpoint, interval)


def show_batches(stream: DataFrame, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Print the first rows of every batch."""
    return start(stream.writeStream.format("console"), checkpoint, interval)


def read_batches(spark: SparkSession, out: str) -> DataFrame:
    """All stored batches with their ``batch_id``."""
    return spark.read.parquet(out)


def space_word_counts(df: DataFrame, text: str = "value") -> DataFrame:
    return counting.word_counts(df, space_words(F.col(text)))


def sql_word_counts(df: DataFrame, text: str = "value") -> DataFrame:
    """Word count as SQL over the batch, which no other stream of the session sees."""
    words = df.select(F.explode(space_words(F.col(text))).alias("word"))
    return df.sparkSession.sql("SELECT word, count(*) AS n FROM {words} GROUP BY word", words=words)


def residue_counts(df: DataFrame, number: str = "value", divisor: int = 10) -> DataFrame:
    residue = (F.col(number) % divisor).cast("int").alias("residue")
    return df.groupBy(residue).agg(F.count(F.lit(1)).alias("n"))


def grep_count(df: DataFrame, part: str, text: str = "value") -> DataFrame:
    """One row per batch, also when nothing matches."""
    return df.where(F.col(text).contains(part)).agg(F.count(F.lit(1)).alias("n"))


def denylist_counts(df: DataFrame, deny: DataFrame, text: str = "value") -> DataFrame:
    """Word counts of a batch with a flag for words on the deny list."""
    listed = deny.select("word").distinct().withColumn("dropped", F.lit(True))
    counts = space_word_counts(df, text).join(listed, "word", "left")
    return counts.withColumn("dropped", F.coalesce("dropped", F.lit(False)))


def denylist_stream(
    stream: DataFrame, deny: DataFrame, root: str, text: str = "value", interval: str | None = None
) -> StreamingQuery:
    """Store every batch's flagged word counts under ``root/out`` and the carried counter of dropped words.

    The counter after batch n is the one after n-1 and the batch's own, so no batch reads the history.
    """

    def work(df: DataFrame, batch_id: int) -> None:
        spark, out = df.sparkSession, batch_path(f"{root}/out", batch_id)
        denylist_counts(df, deny, text).write.mode("overwrite").parquet(out)
        dropped = spark.read.parquet(out).where("dropped").select(F.col("n").alias("dropped_total"))
        if batch_id:
            before = spark.read.parquet(f"{root}/dropped/after={batch_id - 1}")
            dropped = dropped.unionByName(before.select("dropped_total"))
        total = dropped.agg(F.coalesce(F.sum("dropped_total"), F.lit(0)).cast("bigint").alias("dropped_total"))
        total.coalesce(1).write.mode("overwrite").parquet(f"{root}/dropped/after={batch_id}")

    return start(stream.writeStream.foreachBatch(work), f"{root}/checkpoint", interval)


def dropped_total(spark: SparkSession, root: str) -> DataFrame:
    """The counter after the last batch; ``after`` says which one that is."""
    counters = spark.read.parquet(f"{root}/dropped")
    last = counters.agg(F.max_by("dropped_total", "after").alias("dropped_total"))
    return last
