"""N-gram Jaccard join with count-vector R-trees.

Every document's distinct shingles are hashed into GROUPS groups; the group sizes are its point. For two
documents the coordinate minima add up to at least their overlap, so a pair can only be linked if that
sum is large enough for the threshold, and the same holds for a tree node whose box holds the largest
coordinates below it. Surviving pairs are verified on the shingle sets.

Points of unrelated texts of one length lie close together in any number of dimensions, so one tree
over all documents would compare all pairs. The points are therefore dealt into tiles first and every
tile has its tree. Documents of equal sets are one class and its smallest id stands for it. Links are
found in two rounds.

The first round is quick and need not be complete: documents with equal bands of min-hashes share a
tile, each point asks its tree for the smallest id within the bound, and these links form components.

The second round is exact. All shingles have one order, from rare to common by a sketch of counts and
then by hash. Of n shingles, a linked document shares at least ceil(PERCENT n / 100), so two linked
documents share one of their first n - ceil(PERCENT n / 100) + 1. Of these shingles only those that
several components hold matter. A group of texts that are alike, yet not enough to be linked, shares
many of them, so the holders of all shingles with the same smallest holder make one tile: a row per
document and tile, whatever number of shingles and pairs it stands for. A tile keeps its members that
some other component comes near, by their points and, for long texts, by finer ones; these meet again
with their sets, and a tile gives the links that join its components, less than it has members. So no
pair is moved or stored before it is known to be linked, and no link is lost. The sketch has a fixed
size; it decides how large tiles are, not what is found. Tiles over TILE points or SHINGLES shingles are
cut; the first round ties the pieces together by the tile's smallest id, the second compares all pairs
of pieces. All draws are fixed, so reruns agree.

Defined results: a null text, or one without words, has no shingles and is a component of its own; with
fewer words than a shingle the whole sequence is the only one; repeated words and rows count once in
sets; ids are expected to be unique and not null: a null id is its own component, rows that repeat an
id fall together; an empty table gives no rows; texts are read whole. Other columns are ignored.
Shingles are compared by 64-bit hash.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerbrook.llm.common import bounded_batches, few_rows, shuffles_cleared
from ledgerbrook.llm.components import components
from ledgerbrook.llm.hashing import joined, mixed, signed, windows, word_hashes
from ledgerbrook.session import materialise

SHINGLE = 5
#: Links need 100 * overlap >= PERCENT * union.
PERCENT = 75
GROUPS = 256
BANDS, ROWS = 12, 4
TILE = 20_000
#: Shingles of the sets that one piece of a tile holds.
SHINGLES = 4_000_000
#: Places of a set of marks, which tells most rows apart that a join would drop.
MARKS = 1 << 23
#: Counters of the shingle sketch, and those in one row of it.
SKETCH, CHUNK = 1 << 20, 1 << 14
#: Points of a leaf and children of a node.
FAN = 16

_DRAWS = np.random.default_rng(20240601)
_FLIP, _SCALE = (_DRAWS.integers(1, 1 << 32, (BANDS * ROWS, 1), np.uint32) for _ in range(2))
_SCALE |= np.uint32(1)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a text, A-Z in lower case."""
    words = text.encode().lower().split() if text else []
    hashes = word_hashes(words)
    if len(words) >= size:
        return np.unique(windows(hashes, size))
    if not words:
        return hashes
    # A short sequence differs from every other one by its length and its words.
    out = mixed(hashes[:1] + np.uint64(len(words)))
    for h in hashes[1:]:
        out = joined(out, np.array([h]))
    return out


def point(found: np.ndarray) -> bytes:
    """Group sizes as little-endian integers of the least width that holds them."""
    sizes = np.bincount((found >> np.uint64(56)).astype(np.int64), minlength=GROUPS)
    return sizes.astype("<u1" if sizes.max() < 256 else "<u2" if sizes.max() < 65536 else "<u4").tobytes()


def coordinates(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // GROUPS}").astype(np.int64)


def fine(found: np.ndarray) -> bytes:
    """Sizes, 255 at most, of so many groups that some four shingles fall into each; none where ``point`` has as many."""
    bits = len(found).bit_length() - 2
    if len(found) <= 4 * GROUPS:
        return b""
    sizes = np.bincount((found >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(sizes, 255).astype("<u1").tobytes()


def may_link(a: bytes, b: bytes, sizes: int) -> bool:
    """Whether two sets with so many shingles together can be linked: fine sizes differ by no more than the sets do."""
    x, y = (np.frombuffer(d, "<u1").astype(np.int64) for d in (a, b))
    least = min(len(x), len(y))
    if not least:
        return True
    x, y = x.reshape(least, -1).sum(axis=1), y.reshape(least, -1).sum(axis=1)
    return (100 + PERCENT) * int(np.abs(x - y).sum()) <= (100 - PERCENT) * sizes


def bands(found: np.ndarray) -> np.ndarray:
    """One 64-bit key per band: the least values of ROWS hash functions."""
    low = (found ^ (found >> np.uint64(32))).astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 512):
        x = (low[at : at + 512] ^ _FLIP) * _SCALE
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        least = np.minimum(least, x.min(axis=1))
    rows = least.astype(np.uint64).reshape(BANDS, ROWS)
    key = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))
    for r in range(ROWS):
        key = joined(key, rows[:, r])
    return key


class RTree:
    """Packed R-tree over points (rows of counts) in the order of their sizes."""

    def __init__(self, counts: np.ndarray, ids: np.ndarray, components: np.ndarray | None = None):
        sizes = counts.sum(axis=1)
        labels = np.arange(len(ids)) if components is None else components
        # The members of a large component lie together, so that it can pass them by at once.
        _, which, members = np.unique(labels, return_inverse=True, return_counts=True)
        self.order = np.lexsort((*counts[:, 3::-1].T, sizes, np.where(members[which] > FAN, which, -1)))
        self.counts, self.sizes, self.ids = counts[self.order], sizes[self.order], ids[self.order]
        self.levels = []  # from leaves to root: (largest coordinates, smallest size, smallest id)
        top, size, least = self.counts, self.sizes, self.ids
        self.labels = labels[self.order]
        self.spans = []  # smallest and largest component per node
        low = high = self.labels
        while True:
            cuts = np.arange(0, len(size), FAN)
            top, size, least = np.maximum.reduceat(top, cuts), np.minimum.reduceat(size, cuts), np.minimum.reduceat(least, cuts)
            low, high = np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)
            self.levels.append((top, size, least))
            self.spans.append((low, high))
            if len(size) == 1:
                break

    def _passing(self, level: int, lo: int, hi: int, counts: np.ndarray, size: int) -> np.ndarray:
        """Entries lo..hi of a level (-1: points) whose summed minima allow a link."""
        top, least = (self.counts, self.sizes) if level < 0 else self.levels[level][:2]
        overlap = np.minimum(top[lo:hi], counts).sum(axis=1)
        return lo + np.flatnonzero((100 + PERCENT) * overlap >= PERCENT * (size + least[lo:hi]))

    def smallest(self, counts: np.ndarray, size: int, below: int) -> int | None:
        """The smallest id under ``below`` within the bound, going to nodes of small ids first."""
        queue = [(int(self.levels[-1][2][0]), len(self.levels) - 1, 0)]
        while queue:
            least, level, at = heapq.heappop(queue)
            if least >= below:
                return None
            if level < 0:
                return least
            lo = at * FAN
            hi = min(lo + FAN, len(self.ids) if level == 0 else len(self.levels[level - 1][1]))
            ids = self.ids if level == 0 else self.levels[level - 1][2]
            for child in self._passing(level - 1, lo, hi, counts, size):
                heapq.heappush(queue, (int(ids[child]), level - 1, int(child)))
        return None

    def all(self, counts: np.ndarray, size: int, component: int = -1) -> np.ndarray:
        """Places in tree order of all points within the bound, but for those of one component."""
        found, stack = [], [(len(self.levels) - 1, 0)]
        while stack:
            level, at = stack.pop()
            lo = at * FAN
            hi = min(lo + FAN, len(self.ids) if level == 0 else len(self.levels[level - 1][1]))
            passing = self._passing(level - 1, lo, hi, counts, size)
            low, high = (self.labels, self.labels) if level == 0 else self.spans[level - 1]
            passing = passing[(low[passing] != component) | (high[passing] != component)]
            if level == 0:
                found.append(passing)
            else:
                stack += [(level - 1, int(c)) for c in passing]
        return np.concatenate(found) if found else np.empty(0, np.int64)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes.view(np.uint64) >> np.uint64(44)).astype(np.int64)


def commonness(docs: DataFrame, text_col: str) -> bytes:
    """One byte per counter of the sketch: the bits of the number of shingles that fall into it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(SKETCH, np.int64)
        for batch in few_rows(batches):
            found = [_bucket(shingles(text.as_py())) for text in batch.column(0)]
            sums += np.bincount(np.concatenate(found), minlength=SKETCH)
        chunks = sums.reshape(-1, CHUNK)
        some = np.flatnonzero(chunks.any(axis=1))
        width = "<u4" if sums.max() < 1 << 32 else "<u8"
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int64()), pa.array([chunks[c].astype(width).tobytes() for c in some], pa.binary())], names=["chunk", "counts"]
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(counts, f"<u{len(counts) // CHUNK}").astype(np.int64)
        bits = [np.frexp(c.astype(np.float64))[1].astype(np.uint8).tobytes() for c in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(bits, pa.binary())], names=["chunk", "counts"])

    kind = "chunk long, counts binary"
    out = np.zeros((SKETCH // CHUNK, CHUNK), np.uint8)
    # One row per chunk, whatever the table's size.
    for row in docs.select(text_col).mapInArrow(count, kind).repartition("chunk").mapInArrow(add, kind).collect():
        out[row["chunk"]] = np.frombuffer(row["counts"], np.uint8)
    return out.tobytes()


def prefix(found: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The shingles of a set of which every linked set has one among its own."""
    keep = len(found) + 1 + (-PERCENT * len(found)) // 100 if len(found) else 0
    return found[np.lexsort((found, common[_bucket(found)]))[:keep]]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate(arrays) if arrays else np.empty(0, np.int64))


def features(docs: DataFrame, id_col: str, text_col: str, bits: bytes) -> DataFrame:
    """id, n, a 128-bit hash of the set (s1, s2), its points, its band keys and its prefix."""
    kind = dict(docs.dtypes)[id_col]
    salt = np.uint64(0x51)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = np.frombuffer(bits, np.uint8)
        for batch in few_rows(batches):
            n, s1, s2, points, finer, keys, firsts = [], [], [], [], [], [], []
            for text in batch.column(1):
                found = shingles(text.as_py())
                n.append(len(found))
                s1.append(int(signed(mixed(found).sum(dtype=np.uint64, keepdims=True))[0]))
                s2.append(int(signed(mixed(found + salt).sum(dtype=np.uint64, keepdims=True))[0]))
                points.append(point(found))
                finer.append(fine(found))
                keys.append(signed(bands(found)) if len(found) else np.empty(0, np.int64))
                firsts.append(prefix(signed(found), common))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
                 pa.array(points, pa.binary()), pa.array(finer, pa.binary()), _lists(keys), _lists(firsts)],
                names=["id", "n", "s1", "s2", "point", "fine", "bands", "prefix"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n long, s1 long, s2 long, point binary, fine binary, bands array<long>, prefix array<long>")


def _tiles(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[np.ndarray]]:
    """The rows of each tile, from batches sorted by the first two columns (the tile's key)."""
    rest: list[np.ndarray] | None = None
    for batch in batches:
        columns = [batch.column(batch.schema.names.index(c)).to_numpy(zero_copy_only=False) for c in names]
        if rest is not None:
            columns = [np.concatenate(pair) for pair in zip(rest, columns, strict=True)]
        cuts = 1 + np.flatnonzero((columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1]))
        start = 0
        for cut in cuts.tolist():
            yield [c[start:cut] for c in columns]
            start = cut
        rest = [c[start:] for c in columns]
    if rest is not None and len(rest[0]):
        yield rest


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First round: each point with the smallest id in its tile within the bound."""
    a, b = [], []
    for _, _, ids, points in _tiles(batches, ["key", "piece", "id", "point"]):
        keep = np.unique(ids, return_index=True)[1]
        ids, points = ids[keep], points[keep]
        if len(ids) < 2:
            continue
        counts = np.stack([coordinates(p) for p in points])
        sizes = counts.sum(axis=1)
        if len(ids) <= FAN:
            overlap = np.minimum(counts[:, None, :], counts[None, :, :]).sum(axis=2)
            fits = np.tril((100 + PERCENT) * overlap >= PERCENT * (sizes[:, None] + sizes[None, :]), -1)
            for i in np.flatnonzero(fits.any(axis=1)):
                a.append(int(ids[i]))
                b.append(int(ids[fits[i].argmax()]))
        else:
            tree = RTree(counts, ids)
            for i in range(1, len(ids)):
                found = tree.smallest(counts[i], sizes[i], int(ids[i]))
                if found is not None:
                    a.append(int(ids[i]))
                    b.append(found)
        if len(a) > 50_000:
            yield _pairs(a, b)
            a, b = [], []
    yield _pairs(a, b)


def _between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Second round: the members of a tile that another component's point comes near, each once.

    A piece that meets another one only looks at pairs across.
    """
    names = ["key", "piece", "id", "point", "fine", "component", "part", "alone"]
    for key, _, ids, points, finer, component, part, alone in _tiles(batches, names):
        keep = np.unique(ids, return_index=True)[1]
        ids, points, finer, component, part = ids[keep], points[keep], finer[keep], component[keep], part[keep]
        if (component == component[0]).all():
            continue
        counts = np.stack([coordinates(p) for p in points])
        sizes = counts.sum(axis=1)
        tree = RTree(counts, ids, component)
        near = np.zeros(len(ids), bool)
        for i in range(len(ids)):
            if near[i]:
                continue
            found = tree.order[tree.all(counts[i], sizes[i], component[i])]
            found = found[component[found] != component[i]]
            if not alone[0]:
                found = found[part[found] != part[i]]
            for j in found.tolist():
                if may_link(finer[i], finer[j], int(sizes[i] + sizes[j])):
                    near[[i, j]] = True
                    break
        if near.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.astype(np.int64)) for x in (key[: near.sum()], ids[near], component[near], sizes[near])], names=["key", "id", "component", "n"]
            )


def _joining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a tile between components that none of its links has joined so far, by the members' sets."""
    a, b = [], []
    for _, _, ids, component, part, alone, sets in _tiles(batches, ["key", "piece", "id", "component", "part", "alone", "set"]):
        keep = np.unique(ids, return_index=True)[1]
        ids, part, sets = ids[keep], part[keep], sets[keep]
        label = np.unique(component[keep], return_inverse=True)[1]
        sizes = np.array([len(x) for x in sets])
        holders = np.repeat(np.arange(len(ids)), sizes)
        _, shingle = np.unique(np.concatenate(sets), return_inverse=True)
        order, starts = np.argsort(shingle, kind="stable"), np.concatenate(([0], np.cumsum(np.bincount(shingle))))
        holders, own = holders[order], np.split(shingle, np.cumsum(sizes)[:-1])
        for i in range(1, len(ids)):
            if (label == label[i]).all():
                continue
            lists = [holders[starts[x] : starts[x + 1]] for x in own[i].tolist()]
            both = np.bincount(np.concatenate(lists), minlength=len(ids))[:i]
            fits = 100 * both >= PERCENT * (sizes[i] + sizes[:i] - both)
            if not alone[0]:
                fits &= part[:i] != part[i]
            for j in np.flatnonzero(fits).tolist():
                if label[j] != label[i]:
                    label[label == label[j]] = label[i]
                    a.append(int(ids[i]))
                    b.append(int(ids[j]))
        if len(a) > 50_000:
            yield _pairs(a, b)
            a, b = [], []
    yield _pairs(a, b)


def _pairs(a: list[int], b: list[int]) -> pa.RecordBatch:
    """The different pairs of a list; most repeat from tile to tile."""
    pairs = list({*zip(a, b, strict=True)})
    return pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"]
    )


def _in_tiles(rows: DataFrame, *extra: str) -> DataFrame:
    columns = ["key", "piece", "id", *extra]
    return rows.select(*columns).repartition("key", "piece").sortWithinPartitions("key", "piece")


def _marks(at: DataFrame) -> bytes:
    """A bit for each of MARKS places, set for those in the only column: one size whatever the number of rows."""
    column = F.col(at.columns[0]) + 1
    found = at.groupBy(F.bitmap_bucket_number(column).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(column)).alias("bits"))
    out = np.zeros((MARKS >> 15, 4096), np.uint8)
    for row in found.collect():
        out[row["bucket"] - 1] = np.frombuffer(row["bits"], np.uint8)
    return out.tobytes()


def _marked(bits: bytes, at: np.ndarray) -> np.ndarray:
    return (np.frombuffer(bits, np.uint8)[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _place(id_col: str) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(MARKS))


def _sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, set) of the documents of some ids. No text is moved, and few sets of other documents."""
    kind, bits = dict(docs.dtypes)[id_col], _marks(ids.select(_place("id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            some = batch.filter(pa.array(_marked(bits, batch.column(2).to_numpy())))
            yield pa.RecordBatch.from_arrays([some.column(0), _lists([signed(shingles(t.as_py())) for t in some.column(1)])], names=["id", "set"])

    rows = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), _place(id_col).alias("at"))
    found = rows.mapInArrow(run, f"id {kind}, set array<long>")
    return materialise(found.join(ids, "id", "left_semi").dropDuplicates(["id"]), "jaccard-sets")


def _parted(found: DataFrame, moved: DataFrame) -> tuple[DataFrame, bytes]:
    """(id, component, prefix, at) of the classes' smallest ids, ``at`` being -1 where ``moved`` has been joined, and marks: a row whose
    place ``at`` is marked is left out, see ``_settled``. Rows that ``moved`` does not name, but for few, go around the join, and
    the others are joined once, so no prefix is moved that keeps its label."""
    rows = found.filter("n > 0 and id is not null").select("id", "n", "s1", "s2", "prefix", _place("id").alias("at"))
    bits = _marks(moved.select(_place("id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            yield batch.filter(pa.array(_marked(bits, batch.column(5).to_numpy())))

    named = rows.mapInArrow(run, rows.schema).drop("at").join(moved, ["id", "n", "s1", "s2"], "left").filter("class_id is null or class_id = id")
    named = materialise(named.select("id", F.coalesce("component", "id").alias("component"), "prefix"), "jaccard-labelled")
    kind = dict(named.dtypes)["component"]
    around = rows.select("id", F.col("id").cast(kind).alias("component"), "prefix", "at")
    return around.unionByName(named.withColumn("at", F.lit(-1).cast("long"))), bits


def _settled(batches: Iterator[pa.RecordBatch], bits: bytes) -> Iterator[pa.RecordBatch]:
    """The rows of ``_parted``'s frame that are not left out, in small batches; what a task does next with them needs no second Python worker."""
    for batch in few_rows(batches):
        at = batch.column(3).to_numpy()
        yield batch.filter(pa.array((at < 0) | ~_marked(bits, np.maximum(at, 0))))


def _rows(parted: DataFrame, bits: bytes) -> DataFrame:
    return parted.mapInArrow(lambda batches: _settled(batches, bits), parted.schema).drop("at")


def _labelled(found: DataFrame, moved: DataFrame) -> DataFrame:
    """(id, component, prefix) of the classes' smallest ids."""
    return _rows(*_parted(found, moved))


def _holders(parted: DataFrame, bits: bytes, several: DataFrame) -> DataFrame:
    """(shingle, id, component) of the prefixes, for few shingles but those of ``several``."""
    common = _marks(several.select(F.col("shingle").bitwiseAND(MARKS - 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _settled(batches, bits):
            found = batch.column(2).flatten().to_numpy()
            keep = _marked(common, found & (MARKS - 1))
            held = np.repeat(np.arange(batch.num_rows), batch.column(2).value_lengths().to_numpy())[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[keep]), *[batch.column(c).take(pa.array(held)) for c in (0, 1)]], names=["shingle", "id", "component"]
            )

    kind = dict(parted.dtypes)
    return parted.mapInArrow(run, f"shingle long, id {kind['id']}, component {kind['component']}")


def verified(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough; only texts that a pair names are moved."""
    pairs = materialise(pairs.distinct(), "jaccard-pairs")
    named = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    sets = _sets(docs, named, id_col, text_col)
    left = sets.select(F.col("id").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("id").alias("b"), F.col("set").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - both
    return pairs.join(left, "a").join(right, "b").filter(100 * both >= PERCENT * union).select("a", "b")


def _part() -> Column:
    return F.when(F.col("cut") > 1, F.pmod(F.xxhash64("id"), F.col("cut"))).otherwise(0).cast("long")


def _cut(members: DataFrame, pieces: Column) -> DataFrame:
    """Members of tiles (key) in pieces. Every pair of a tile's parts meets once: a part is sent to itself and to its pairs with all others."""
    other = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("cut").cast("long") - 1),
        lambda j: F.struct((F.least("part", j) * F.col("cut") + F.greatest("part", j)).alias("piece"), (j == F.col("part")).alias("alone")),
    )
    tiles = members.groupBy("key").agg(pieces.cast("int").alias("cut"))
    return members.join(tiles, "key").withColumn("part", _part()).withColumn("other", F.explode(other)).select(*members.columns, "other.*", "part")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, class_id (smallest id of its equal sets), component_id."""
    bounded_batches(docs.sparkSession)
    with shuffles_cleared(docs.sparkSession):
        return _near_duplicates(docs, id_col, text_col)


def _near_duplicates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    found = materialise(features(docs, id_col, text_col, commonness(docs, text_col)), "jaccard-features")
    classes = materialise(
        found.filter("n > 0 and id is not null").groupBy("n", "s1", "s2")
        .agg(F.min("id").alias("class_id"), F.first("point").alias("point"), F.first("fine").alias("fine"), F.first("bands").alias("bands")),
        "jaccard-classes",
    )
    keys = classes.select(F.explode("bands").alias("key"), F.col("class_id").alias("id"))
    shared = keys.groupBy("key").agg(F.count("*").alias("k"), F.min("id").alias("pivot")).filter("k > 1")
    tiled = keys.join(shared, "key").withColumn("cut", F.ceil(F.col("k") / TILE).cast("int"))
    points = classes.select(F.col("class_id").alias("id"), "point", "fine")

    # The pieces of a cut tile all get the tile's smallest id.
    piece = _part()
    pieces = F.when(F.col("id") == F.col("pivot"), F.sequence(F.lit(0).cast("long"), F.col("cut").cast("long") - 1)).otherwise(F.array(piece))
    first = tiled.withColumn("piece", F.explode(pieces)).join(points, "id")
    links = materialise(verified(_in_tiles(first, "point").mapInArrow(_near, "a long, b long"), docs, id_col, text_col), "jaccard-links")
    linked = components(links)

    # Most documents are their class's smallest id and not linked yet; only the others have a row here.
    known = classes.select("n", "s1", "s2", "class_id").join(linked, F.col("class_id") == F.col("node"), "left").drop("node")
    moved = materialise(
        found.filter("id is not null").select("id", "n", "s1", "s2").distinct().join(known, ["n", "s1", "s2"])
        .filter("id <> class_id or component is not null"),
        "jaccard-labels",
    )
    parted, bits = _parted(found, moved)
    keys = _rows(parted, bits).select("id", "component", F.explode("prefix").alias("shingle"))
    several = keys.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("id").alias("key"))
    several = materialise(several.filter("low < high").select("shingle", "key"), "jaccard-keys")
    members = materialise(_holders(parted, bits, several).join(several, "shingle").select("key", "id", "component").distinct(), "jaccard-members")
    second = _cut(members, F.ceil(F.count("*") / TILE)).join(points, "id")
    kind = "key long, id long, component long, n long"
    near = _in_tiles(second, "point", "fine", "component", "part", "alone").mapInArrow(_between, kind)
    near = materialise(near.distinct(), "jaccard-near")
    third = _cut(near, F.ceil(F.sum("n") / SHINGLES)).join(_sets(docs, near.select("id").distinct(), id_col, text_col), "id")
    more = _in_tiles(third, "component", "part", "alone", "set").mapInArrow(_joining, "a long, b long")
    more = materialise(more.distinct(), "jaccard-joining")
    joined_up = components(links.unionByName(more))

    grouped = classes.select("n", "s1", "s2", "class_id").join(joined_up, F.col("class_id") == F.col("node"), "left")
    grouped = grouped.select("n", "s1", "s2", "class_id", F.coalesce("component", "class_id").alias("component"))
    members = found.select("id", "n", "s1", "s2").join(grouped, ["n", "s1", "s2"], "left")
    alone = F.col("id").isNull() | F.col("component").isNull()
    return members.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("id")).otherwise(F.col("component")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose id is the smallest of its component, with all columns; rows with a null id stay."""
    found = near_duplicates(docs, id_col, text_col)
    stay = found.filter(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias("__stay")).distinct()
    rows = docs.filter(F.col(id_col).isNotNull()).join(stay, F.col(id_col) == F.col("__stay"), "left_semi")
    return rows.unionByName(docs.filter(F.col(id_col).isNull()))
