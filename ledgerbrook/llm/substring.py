"""Substring dedup: windows of words that also start in a document with a smaller id go.

Level-wise doubling. The first level looks at half windows. Of the half windows inside each window,
the one with the least hash is the window's anchor, so equal windows have equal anchors wherever
they stand, and only anchors (about one position in thirteen) are counted. Anchors that occur in one
document alone end there. The others are extended to twice the length, first as segments, which are
the neighbouring windows of one anchor taken together: where whole segments repeat, all their windows
do, and one representative of each different segment goes on. Its single windows meet last. Candidates
are compared as 128 bits: the anchor's 64 and the window's or segment's 64. Counts are combined before
they are shuffled, and a passage that very many documents share is joined in parts of average size.

Defined results: a null text has no words; texts shorter than a window lose nothing; windows are judged
on the input; a window that repeats inside one document alone stays; rows with a null id are compared
with nothing and stay whole; ids are expected to be unique: rows that repeat an id count as one
document, and each loses what was found under that id; an empty table gives no rows. Other columns are
ignored. Texts are read whole, whatever their length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerbrook.llm.common import few_rows, join_spread
from ledgerbrook.llm.hashing import joined, signed, windows, word_hashes
from ledgerbrook.session import materialise

WINDOW = 50


def _words(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def anchors(half: np.ndarray, span: int) -> np.ndarray:
    """For every run of ``span`` values, the place of the first least one."""
    at = np.arange(len(half))
    now = 1
    while now * 2 <= span:
        a, b = at[:-now], at[now:]
        at = np.where(half[b] < half[a], b, a)
        now *= 2
    if now < span:
        a, b = at[: len(at) - (span - now)], at[span - now :]
        at = np.where(half[b] < half[a], b, a)
    return at


def segments(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, segment hash, first window, number of windows) of a text's segments."""
    hashes = word_hashes(words)
    half_length = (window + 1) // 2
    half = windows(hashes, half_length)
    at = anchors(half, window - half_length + 1)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    n = np.diff(np.append(first, len(at)))
    full = windows(hashes, window)
    # Neighbouring windows of one anchor overlap, so the first and the last one hold all their words.
    segment = joined(joined(full[first], full[first + n - 1]), n.astype(np.uint64))
    return half[at[first]], segment, first, n


def repeated_ranges(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ranges): per document with repeats, the array of (first window, number of windows) to go."""
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            taken, parts = [], []
            for i, text in enumerate(batch.column(1)):
                words = _words(text.as_py())
                if len(words) >= window:
                    parts.append(segments(words, window))
                    taken.append(np.full(len(parts[-1][0]), i))
            if parts:
                anchor, segment, first, n = (np.concatenate(p) for p in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(anchor)), pa.array(signed(segment)), batch.column(0).take(pa.array(np.concatenate(taken))),
                     pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32))],
                    names=["anchor", "segment", "id", "first", "n"],
                )

    schema = f"anchor long, segment long, id {kind}, first int, n int"
    level = materialise(rows.filter("id is not null").mapInArrow(cut, schema), "substring-anchors")
    place = [F.col("id"), F.col("first")]
    alone = level.groupBy("anchor").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("k"))
    repeated = materialise(alone.filter("low < high").select("anchor", "k"), "substring-anchors-repeated")
    level = materialise(join_spread(level, repeated, ["anchor"], "k", place), "substring-repeated")

    distinct = materialise(
        level.groupBy("anchor", "segment").agg(F.min("id").alias("low"), F.count("*").alias("k")), "substring-segments"
    )
    several = materialise(distinct.groupBy("anchor").agg(F.count("*").alias("k")).filter("k > 1"), "substring-several")
    placed = join_spread(level, distinct, ["anchor", "segment"], "k", place)
    whole = placed.filter("low < id").select("id", "first", "n")
    open_rows = join_spread(placed.filter("low = id"), several, ["anchor"], "k", place)
    asked = open_rows.groupBy("id").agg(F.collect_list(F.struct("anchor", "first", "n")).alias("asked"))

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            taken, anchor, full, start = [], [], [], []
            for i, (text, wanted) in enumerate(zip(batch.column(1), batch.column(2), strict=True)):
                hashes = windows(word_hashes(_words(text.as_py())), window)
                part = wanted.values
                first, n = part.field("first").to_numpy(), part.field("n").to_numpy()
                each = np.repeat(first - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                inside = each < len(hashes)
                each = each[inside]
                anchor.append(np.repeat(part.field("anchor").to_numpy(), n)[inside])
                full.append(signed(hashes[each]))
                start.append(each.astype(np.int32))
                taken.append(np.full(len(each), i))
            if taken:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(anchor)), pa.array(np.concatenate(full)),
                     batch.column(0).take(pa.array(np.concatenate(taken))), pa.array(np.concatenate(start))],
                    names=["anchor", "window", "id", "first"],
                )

    single = materialise(
        rows.join(asked, "id").mapInArrow(extend, f"anchor long, window long, id {kind}, first int"), "substring-windows"
    )
    lowest = single.groupBy("anchor", "window").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("k"))
    met = materialise(lowest.filter("low < high").select("anchor", "window", "low", "k"), "substring-met")
    alike = join_spread(single, met, ["anchor", "window"], "k", place).filter("low < id").select("id", "first", F.lit(1).alias("n"))
    return whole.unionByName(alike).groupBy("id").agg(F.collect_list(F.struct("first", "n")).alias("ranges"))


def covered(count: int, ranges, window: int) -> np.ndarray:
    """Which of ``count`` words lie in a window of the ranges."""
    change = np.zeros(count + 1, np.int64)
    if ranges is not None:
        first = ranges.field("first").to_numpy()
        last = np.minimum(first + ranges.field("n").to_numpy() + window - 1, count)
        np.add.at(change, np.minimum(first, count), 1)
        np.add.at(change, last, -1)
    return np.cumsum(change[:-1]) > 0


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                   digest: bool = False) -> DataFrame:
    """One row per document: id, n_words, n_removed and the kept words joined by one space.

    The kept text is the column ``kept``, or with ``digest`` its SHA-256 as ``kept_sha256``.
    """
    kind = dict(docs.dtypes)[id_col]
    ranges = repeated_ranges(docs, window, id_col, text_col).withColumnRenamed("id", "range_id")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    name = "kept_sha256" if digest else "kept"

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            counts, gone, texts = [], [], []
            for text, found in zip(batch.column(1), batch.column(2), strict=True):
                words = _words(text.as_py())
                counts.append(len(words))
                if found.is_valid:
                    out = covered(len(words), found.values, window)
                    gone.append(int(out.sum()))
                    words = [w for w, o in zip(words, out.tolist(), strict=True) if not o]
                else:
                    gone.append(0)
                kept = b" ".join(words)
                texts.append(hashlib.sha256(kept).hexdigest() if digest else kept.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.string())],
                names=["id", "n_words", "n_removed", name],
            )

    placed = rows.join(ranges, F.col("id") == F.col("range_id"), "left").select("id", "text", "ranges")
    return placed.mapInArrow(strip, f"id {kind}, n_words long, n_removed long, {name} string").withColumnRenamed("id", id_col)
