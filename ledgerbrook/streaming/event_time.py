"""Event-time windows that a stream finishes and forgets.

Two queries take turns. The first one parts every batch by its watermark, the greatest event time of the batches
before it less a delay: rows whose pane has ended by then are late and are stored apart as they are; the others
are summed per pane. The second one reads these sums as a stream and adds them up to windows in Spark's own
event-time state, which emits every window once, when the watermark has passed its end, and forgets it. Panes are the
greatest common divisor of length and slide, so rows are summed before they are copied into windows. Layout
under ``root``::

    panes/batch_id=<n>    sums of batch n; their files go once the second query has read them
    late/batch_id=<n>     rows of batch n that came too late or have no event time
    seen/after=<n>        greatest event time up to batch n, one row
    windows               finished windows
    split, close          checkpoints of the two queries

The watermark of the sums trails that of the rows, so the second query never drops what the first one let pass. It
runs while the first one is at rest, so it reads the sums of finished batches only; a replayed batch overwrites its folders.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerbrook.streaming.batches import append_rows, batch_path, run_recovering, start

SECOND = 1_000_000


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


@dataclass(frozen=True)
class EventTimeWindows:
    """Windows of ``length`` seconds every ``slide`` seconds over the column ``ts``; late means ``delay`` seconds.

    ``panes`` turns rows into sums per pane, with the pane's start in ``pane``; ``schema`` is theirs. ``windows`` turns a
    stream of them into windows. See ``operators.windows`` for both.
    """

    root: str
    ts: str
    length: int
    slide: int
    delay: int
    panes: Callable[[DataFrame], DataFrame]
    schema: str
    windows: Callable[[DataFrame], DataFrame]

    def _part(self, df: DataFrame, batch_id: int) -> None:
        spark, root = df.sparkSession, self.root
        before = spark.read.parquet(f"{root}/seen/after={batch_id - 1}").first()["seen"] if batch_id else None
        pane = gcd(self.length, self.slide) * SECOND
        late = F.col(self.ts).isNull()
        if before is not None:
            end = (F.floor(_micros(self.ts) / pane) + 1) * pane
            late = late | (end <= before - self.delay * SECOND)
        self.panes(df.where(~late)).write.mode("overwrite").parquet(batch_path(f"{root}/panes", batch_id))
        df.where(late).write.mode("overwrite").parquet(batch_path(f"{root}/late", batch_id))
        newest = F.greatest(F.max(_micros(self.ts)), F.lit(before).cast("bigint")).alias("seen")
        df.agg(newest).coalesce(1).write.mode("overwrite").parquet(f"{root}/seen/after={batch_id}")

    def _close(self, spark: SparkSession) -> None:
        # The star keeps folder names out of the columns.
        panes = spark.readStream.schema(self.schema).option("cleanSource", "delete").parquet(f"{self.root}/panes/*")
        marked = panes.withColumn("pane", F.col("pane").cast("timestamp")).withWatermark("pane", f"{self.delay} seconds")
        begin = lambda: append_rows(self.windows(marked), f"{self.root}/windows", f"{self.root}/close")
        run_recovering(begin)

    def run(self, stream: DataFrame) -> None:
        """Take in what is there and store the windows that it finishes."""
        run_recovering(lambda: start(stream.writeStream.foreachBatch(self._part), f"{self.root}/split"))
        self._close(stream.sparkSession)

    def end(self, spark: SparkSession) -> None:
        """Finish all windows: an empty pane far after all others lets the watermark pass them.

        Nothing can be taken in afterwards.
        """
        seen = spark.read.parquet(f"{self.root}/seen").agg(F.max("seen")).first()[0]
        if seen is None:
            return
        far = seen + 2 * (self.length + self.delay) * SECOND
        fields = T.StructType.fromDDL(self.schema).fields
        empty = [F.timestamp_micros(F.lit(far)) if f.name == "pane" else F.lit(None) for f in fields]
        marker = spark.range(1).select([c.cast(f.dataType).alias(f.name) for c, f in zip(empty, fields)])
        marker.write.mode("overwrite").parquet(f"{self.root}/panes/batch_id=end")
        self._close(spark)

    def finished(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.root}/windows")

    def late(self, spark: SparkSession) -> DataFrame:
        """Rows that are in no window, with the ``batch_id`` they came in."""
        return spark.read.parquet(f"{self.root}/late")
