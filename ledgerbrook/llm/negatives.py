"""Hard negatives: rows of another label that score just below an anchor's positives.

Scores are integer inner products of vectors whose components were scaled and floored. Anchors and rows
meet in tiles, a block of anchors beside a block of rows, so a tile's size is fixed and no task sees a whole
anchor. A tile gives what can be of use outside of it: of the rows of an anchor's label the first ones, then,
once the positives are known, of the other rows the first ones of each positive's window. Rows that come after
these in their own tile come after them everywhere, so nothing is lost.

Secondary sort. Pairs are packed into keys (anchor, descending score, id), dealt by anchor and sorted inside
the partitions; an iterator passes over them once. It opens a window at each positive and emits negatives into
all open windows, with a handful of numbers in memory, however many pairs an anchor has.

Defined results: rows with a null id, label or vector or with a null or non-finite component take no part. Ids
are expected to be unique; of rows that repeat an id the least by (label, vector) counts. A vector that is
shorter than another counts as filled up with zeros, an empty one scores 0. Components and scores beyond the range of
a long are held at its ends. Ties in the score go to the smaller id. Anchors without a positive, and
positives without a negative, give no rows, nor does an empty table. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ledgerbrook.session import materialise

#: Rows and anchors of a tile at most; tables of fewer rows are cut finer, to give every core a tile.
ROWS, ANCHORS, LEAST_ROWS = 32_768, 8_192, 1_024
#: Scores of a tile that are held at once.
CELLS = 4 << 20
LONG = (1 << 63) - 1
#: Below this bound floating-point products and their sums are exact.
EXACT = 1 << 53


def matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of whole numbers as rows, shorter ones filled up with zeros."""
    lists = vectors.combine_chunks()
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = pc.list_flatten(lists).to_numpy()
    return out


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All inner products as whole numbers, exact, held inside the range of a long."""
    def top(x: np.ndarray) -> int:
        return max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0

    if left.shape[1] * top(left) * top(right) < EXACT:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return np.clip(left.astype(object) @ right.astype(object).T, -LONG, LONG).astype(np.int64)


def first(scores: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` of ascending places that have the highest scores; ties to the smaller place."""
    if len(places) > k:
        least = np.partition(scores[places], len(places) - k)[len(places) - k]
        places = places[scores[places] >= least]
    return places[np.argsort(-scores[places], kind="stable")[:k]]


def _tile(anchors: pa.Table, rows: pa.Table) -> Iterator[tuple]:
    """Per anchor: its place, the scores of all rows, which share its label, and which are not itself.

    Rows are in ascending order of their ids, which ``rows`` must be sorted by.
    """
    width = max(pc.max(pc.list_value_length(t["q"])).as_py() or 0 for t in (anchors, rows))
    labels = pa.chunked_array([*anchors["label"].chunks, *rows["label"].chunks]).combine_chunks()
    codes = labels.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    own, other = codes[: anchors.num_rows], codes[anchors.num_rows :]
    self_at = pc.index_in(anchors["id"], rows["id"].combine_chunks()).to_numpy(zero_copy_only=False)
    left, right = matrix(anchors["q"], width), matrix(rows["q"], width)
    step = max(1, CELLS // max(1, rows.num_rows))
    for start in range(0, anchors.num_rows, step):
        scores = products(left[start : start + step], right)
        for i in range(len(scores)):
            at = start + i
            different = np.ones(rows.num_rows, bool)
            if not np.isnan(self_at[at]):
                different[int(self_at[at])] = False
            yield at, scores[i], other == own[at], different


def _pairs(anchors: pa.Table, rows: pa.Table, found: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.Table:
    """(anchor, score, id) of the places found for each anchor."""
    counts = [len(places) for _, places, _ in found]
    at = np.repeat(np.array([a for a, _, _ in found], np.int64), counts)
    places = np.concatenate([p for _, p, _ in found]) if found else np.zeros(0, np.int64)
    scores = np.concatenate([s for _, _, s in found]) if found else np.zeros(0, np.int64)
    return pa.table({"anchor": anchors["id"].take(pa.array(at)), "score": pa.array(scores, pa.int64()),
                     "id": rows["id"].take(pa.array(places, pa.int64()))})


def lowest_of(score: int, percent: int) -> int:
    """The least whole number n with ``percent`` * score <= 100 * n."""
    return -(-percent * score // 100)


def _same_label(positives: int, nothing: pa.Table):
    def tile(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        if not anchors.num_rows or not rows.num_rows:
            return nothing
        rows = rows.take(pc.sort_indices(rows["id"]))
        found = []
        for at, scores, same, different in _tile(anchors, rows):
            places = first(scores, np.flatnonzero(same & different), positives)
            found.append((at, places, scores[places]))
        return _pairs(anchors, rows, found)

    return tile


def _in_windows(negatives: int, percent: int, nothing: pa.Table):
    def tile(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        if not anchors.num_rows or not rows.num_rows:
            return nothing
        rows = rows.take(pc.sort_indices(rows["id"]))
        opened, found = anchors["opened"].to_pylist(), []
        for at, scores, same, different in _tile(anchors, rows):
            others = np.flatnonzero(~same & different)
            kept = [
                first(scores, others[(scores[others] >= lowest_of(top, percent)) & (scores[others] <= top)], negatives)
                for top in set(opened[at])
            ]
            places = np.unique(np.concatenate(kept))
            found.append((at, places, scores[places]))
        return _pairs(anchors, rows, found)

    return tile


def _first_pairs(k: int):
    """The first ``k`` pairs of every anchor of sorted pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, count = None, 0
        for batch in batches:
            taken = []
            for i, now in enumerate(batch.column(0).to_pylist()):
                anchor, count = now, count + 1 if now == anchor else 1
                if count <= k:
                    taken.append(i)
            yield batch.take(pa.array(taken, pa.int64()))

    return run


class Windows:
    """The open windows of the anchor at hand: positives passed so far and what came after each."""

    def __init__(self, negatives: int, percent: int):
        self.negatives, self.percent = negatives, percent
        self.anchor, self.open, self.ties, self.at = None, [], [], None

    def emit(self, window: list, score: int, row) -> tuple:
        window[2] += 1
        return self.anchor, window[0], window[2], row, window[1], score

    def take(self, anchor, score: int, row, positive: bool) -> Iterator[tuple]:
        """What the next pair adds: (anchor, positive, rank, negative, positive's and negative's score)."""
        if anchor != self.anchor:
            self.anchor, self.open, self.at = anchor, [], None
        if score != self.at:
            self.at, self.ties = score, []
        if positive:
            window = [row, score, 0]
            if self.percent * score <= 100 * score:
                yield from [self.emit(window, score, tie) for tie in self.ties]
            self.open.append(window)
        else:
            # Negatives of a positive's own score may come before it.
            if len(self.ties) < self.negatives:
                self.ties.append(row)
            self.open = [w for w in self.open if w[2] < self.negatives and self.percent * w[1] <= 100 * score]
            yield from [self.emit(w, score, row) for w in self.open]


def _stream(negatives: int, percent: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(negatives, percent)
        for batch in batches:
            out = []
            for pair in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out += windows.take(*pair)
            columns = zip(*out, strict=True) if out else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def _sorted(pairs: DataFrame) -> DataFrame:
    """Pairs dealt by anchor, in the order of their packed keys."""
    key = F.struct("anchor", (-F.col("score")).alias("down"), "id")
    return pairs.withColumn("key", key).repartition("anchor").sortWithinPartitions("key").drop("key")


def hard_negatives(rows: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   scale: int = 256, positives: int = 5, negatives: int = 5, percent: int = 80) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor's positives are its ``positives`` first other rows of the same label. For each, the ``negatives``
    first rows of other labels that score at most as high and at least ``percent`` per cent of it.
    """
    spark = rows.sparkSession
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    scaled = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale))
    usable = rows.select(F.col(id_col).alias("id"), label.alias("label"), F.when(finite, scaled).alias("q"), is_anchor.alias("asks"))
    one = usable.dropna(subset=["id", "label", "q"]).groupBy("id").agg(
        F.min(F.struct("label", "q")).alias("v"), F.max("asks").alias("asks")
    )
    vectors = materialise(one.select("id", "v.label", "v.q", "asks"), "negatives-vectors")
    n, asked = vectors.agg(F.count("*"), F.count_if("asks")).first()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row_blocks = max(-(-n // ROWS), min(parts, -(-n // LEAST_ROWS)), 1)
    anchor_blocks = max(-(-asked // ANCHORS), 1)
    kind = dict(vectors.dtypes)["id"]
    pair_schema = f"anchor {kind}, score long, id {kind}"
    nothing = to_arrow_schema(StructType.fromDDL(pair_schema)).empty_table()

    def everywhere(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    def block(blocks: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")

    # Columns of their own: a cogroup loses a column that both of its sides take from one table.
    own = [F.col(c).alias(c) for c in ("id", "label", "q")]
    tiled_rows = vectors.select(*own, block(row_blocks).alias("row_block"), everywhere(anchor_blocks).alias("anchor_block"))

    def meet(anchors: DataFrame, tile) -> DataFrame:
        dealt = anchors.select("*", block(anchor_blocks).alias("anchor_block")).select("*", everywhere(row_blocks).alias("row_block"))
        keys = ["row_block", "anchor_block"]
        return dealt.groupBy(*keys).cogroup(tiled_rows.groupBy(*keys)).applyInArrow(tile, pair_schema)

    anchors = vectors.filter("asks").select("id", "label", "q")
    near = _sorted(meet(anchors, _same_label(positives, nothing))).mapInArrow(_first_pairs(positives), pair_schema)
    near = materialise(near, "negatives-positives")
    opened = near.groupBy("anchor").agg(F.collect_list("score").alias("opened"))
    anchors = anchors.join(opened, F.col("id") == F.col("anchor")).drop("anchor")
    others = meet(anchors, _in_windows(negatives, percent, nothing)).withColumn("positive", F.lit(False))
    both = near.withColumn("positive", F.lit(True)).unionByName(others)
    schema = f"anchor_id {kind}, positive_id {kind}, rank int, negative_id {kind}, positive_score long, negative_score long"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return _sorted(both).select("anchor", "score", "id", "positive").mapInArrow(_stream(negatives, percent, arrow), schema)

