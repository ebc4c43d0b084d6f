"""Approximate nearest neighbours by largest inner product: NN-descent and greedy graph search.

The graph holds up to K neighbours per different vector. It starts from a few random partitions, whose
pieces are compared inside, and then improves in rounds of joins until the lists have settled: every
vector gathers its neighbours and all vectors it is a neighbour of, compares them with each other, and
tells each of them of closer ones; a pair meets again only if one of it is new. A vector in more than
REVERSE lists does so in parts, each with its neighbours and so many of those vectors. A search starts at
the query's own node, expands the best unexpanded candidates of its list of BEAM, and ends when the whole
list is expanded. The number of partitions grows with the logarithm of that of the vectors. Graph and search compare 8-bit copies of the vectors; results are scored on the originals in
double precision.

Equal vectors are one node, so a vector that is very common costs as much as any other, and results
name its smallest ids. All vectors are indexed; of the data, only PLANE_SAMPLE vectors reach the driver,
to lay random planes. Pieces and gathered lists are bounded, so no task holds a hot group.

Defined results: vectors that are null, zero, or hold null or non-finite numbers take no part, and
neither do those whose length is not the table's most frequent one (the shorter, on a tie); a null id
takes no part; repeated rows count once; ties go to the smaller id; a query has all candidates if there
are fewer than asked for; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerbrook.llm.common import join_spread
from ledgerbrook.session import materialise

#: Neighbours per node, and reverse neighbours that meet in one part of it, at most.
K, REVERSE = 40, 40
#: Random partitions at least, vectors per piece, and vectors sampled to lay the planes.
TREES, PIECE, PLANE_SAMPLE = 8, 800, 512
#: Rounds of improvement end when fewer than this share of all neighbours changed.
SETTLED = 0.02
#: Candidates a search keeps, those it expands at once, and those scored exactly.
BEAM, EXPAND, EXACT = 160, 64, 64
SEED = 7

LISTS = "id long, ids array<long>, scores array<float>, fresh array<boolean>"


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part, once each."""
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector")).filter(
        "vec_id is not null and vector is not null"
    )
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    return rows.filter((F.size("vector") == (sizes["size"] if sizes else 0)) & finite & some).distinct()


def nodes_of(rows: DataFrame) -> DataFrame:
    """One row per different vector: id (its smallest vec_id), vector, its 8-bit copy and that copy's scale."""

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
            scale = np.abs(x).max(axis=1) / 127
            small = np.rint(x / scale[:, None]).astype(np.int8)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([r.tobytes() for r in small], pa.binary()), pa.array(scale.astype(np.float32))],
                names=["id", "vector", "small", "scale"],
            )

    kind = dict(rows.dtypes)["vector"]
    distinct = rows.groupBy("vector").agg(F.min("vec_id").alias("id")).select("id", "vector")
    return materialise(distinct.mapInArrow(shrink, f"id long, vector {kind}, small binary, scale float"), "ann-nodes")


def _matrix(small: np.ndarray, scale: np.ndarray) -> np.ndarray:
    x = np.frombuffer(b"".join(small), np.int8).reshape(len(small), -1).astype(np.float32)
    return x * scale[:, None]


def _groups(batches: Iterator[pa.RecordBatch], keys: int = 1) -> Iterator[dict]:
    """Rows of one key after the other, as columns, from batches sorted by their first ``keys`` columns."""
    rest: dict | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        if rest is not None:
            now = {n: pa.concat_arrays([rest[n], c]) for n, c in now.items()}
        head = [now[n].to_numpy(zero_copy_only=False) for n in list(now)[:keys]]
        change = np.zeros(len(head[0]) - 1, bool)
        for h in head:
            change |= h[1:] != h[:-1]
        start = 0
        for cut in (1 + np.flatnonzero(change)).tolist():
            yield {n: c.slice(start, cut - start) for n, c in now.items()}
            start = cut
        rest = {n: c.slice(start) for n, c in now.items()}
    if rest is not None:
        yield rest


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best different ids, best first, ties to the smaller id."""
    order = np.lexsort((ids, -scores))
    _, first = np.unique(ids[order], return_index=True)
    return order[np.sort(first)[:k]]


def _list_batch(rows: list[tuple]) -> pa.RecordBatch:
    ids, lists, scores, fresh = zip(*rows, strict=True) if rows else ([], [], [], [])
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
    flat = lambda parts, kind: np.concatenate([np.asarray(p, kind) for p in parts]) if parts else np.empty(0, kind)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(flat(lists, np.int64))),
         pa.ListArray.from_arrays(offsets, pa.array(flat(scores, np.float32))), pa.ListArray.from_arrays(offsets, pa.array(flat(fresh, bool)))],
        names=["id", "ids", "scores", "fresh"],
    )


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The K best of all lists of a node. An entry stays fresh unless some list holds it as known."""
    out = []
    for g in _groups(batches):
        node = g["id"][0].as_py()
        ids, scores = g["ids"].flatten().to_numpy(), g["scores"].flatten().to_numpy()
        fresh = g["fresh"].flatten().to_numpy(zero_copy_only=False)
        known = ids[~fresh]
        place = _best(ids, scores, K)
        out.append((node, ids[place], scores[place], ~np.isin(ids[place], known)))
        if len(out) >= 5000:
            yield _list_batch(out)
            out = []
    yield _list_batch(out)


def _merged(lists: DataFrame, name: str) -> DataFrame:
    by_node = lists.select("id", "ids", "scores", "fresh").repartition("id").sortWithinPartitions("id")
    return materialise(by_node.mapInArrow(_merge, LISTS), name)


def first_graph(nodes: DataFrame, count: int) -> DataFrame:
    """Lists from random partitions: vectors on the same side of all planes are compared."""
    bits = max(0, math.ceil(math.log2(max(1, count / PIECE))))
    trees = max(TREES, 2 * bits)
    share = min(1.0, 2 * PLANE_SAMPLE / max(1, count))
    sample = nodes.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))).select("id", "vector").limit(4 * PLANE_SAMPLE)
    points = np.array([r["vector"] for r in sorted(sample.collect(), key=lambda r: r["id"])], np.float32)
    draws = np.random.default_rng(SEED)
    if bits and len(points) > 1:
        a, b = (draws.integers(0, len(points), trees * bits) for _ in range(2))
        planes = (points[a] - points[b]).T
        offsets = ((points[a] + points[b]) / 2 * (points[a] - points[b])).sum(axis=1)
    else:
        bits, planes, offsets = 0, None, None

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ids, small, scale = (batch.column(i) for i in range(3))
            code = np.zeros((n, trees), np.int64)
            if bits:
                side = _matrix(small.to_numpy(zero_copy_only=False), scale.to_numpy()) @ planes > offsets
                code = side.reshape(n, trees, bits) @ (1 << np.arange(bits, dtype=np.int64))
            code += np.arange(trees, dtype=np.int64) << bits
            again = pa.array(np.repeat(np.arange(n), trees))
            yield pa.RecordBatch.from_arrays(
                [pa.array(code.ravel()), ids.take(again), small.take(again), scale.take(again)], names=["leaf", "id", "small", "scale"]
            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches, 2):
            ids = g["id"].to_numpy()
            if len(ids) < 2:
                continue
            x = _matrix(g["small"].to_numpy(zero_copy_only=False), g["scale"].to_numpy())
            scores = x @ x.T
            np.fill_diagonal(scores, -np.inf)
            k = min(K, len(ids) - 1)
            best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
            value = np.take_along_axis(scores, best, 1)
            yield _list_batch([(int(i), ids[b], v, np.ones(k, bool)) for i, b, v in zip(ids, best, value, strict=True)])

    leaves = materialise(nodes.select("id", "small", "scale").mapInArrow(place, "leaf long, id long, small binary, scale float"), "ann-leaves")
    sizes = leaves.groupBy("leaf").agg(F.count("*").alias("n"))
    cut = leaves.join(sizes, "leaf").withColumn("piece", F.pmod(F.xxhash64("id", "leaf"), F.ceil(F.col("n") / (2 * PIECE))))
    pieces = cut.select("leaf", "piece", "id", "small", "scale").repartition("leaf", "piece").sortWithinPartitions("leaf", "piece")
    return _merged(pieces.mapInArrow(compare, LISTS), "ann-graph")


def improve(graph: DataFrame, nodes: DataFrame, step: int) -> DataFrame:
    """One round: neighbours of one node meet, and each learns of the closer ones."""
    edges = graph.select(F.col("id").alias("v"), F.explode(F.arrays_zip("ids", "fresh")).alias("e"))
    back = edges.select(
        F.col("e.ids").alias("center"), F.xxhash64("v", "e.ids", F.lit(step)).alias("draw"),
        F.array(F.struct(F.col("v").alias("m"), F.col("e.fresh").alias("fresh"))).alias("near"),
    )
    own = graph.select(
        F.col("id").alias("center"), F.lit(None).cast("long").alias("draw"),
        F.transform(F.arrays_zip("ids", "fresh"), lambda e: F.struct(e["ids"].alias("m"), e["fresh"].alias("fresh"))).alias("near"),
    )
    # A node's own list comes after all vectors that it is a neighbour of, so its place tells how many parts there are.
    place = F.row_number().over(Window.partitionBy("center").orderBy(F.col("draw").asc_nulls_last())).cast("long")
    part = lambda r: F.floor((r - 1) / REVERSE)
    parts = F.when(F.col("draw").isNotNull(), F.array(part(F.col("r")))).otherwise(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), part(F.col("r") - 1))))
    members = materialise(
        back.unionByName(own).withColumn("r", place).select("center", F.explode(parts).alias("part"), "near")
        .select("center", "part", F.explode("near").alias("e")).select("center", "part", "e.*"), "ann-members",
    )
    bound = F.when(F.size("scores") < K, F.lit(float("-inf"))).otherwise(F.array_min("scores")).cast("float")
    known = nodes.select("id", "small", "scale").join(graph.select("id", bound.alias("bound")), "id").withColumnRenamed("id", "m")
    known = materialise(known.join(members.groupBy("m").agg(F.count("*").alias("times")), "m"), "ann-known")
    gathered = join_spread(members, known, ["m"], "times", [F.col("center"), F.col("part")])
    gathered = gathered.select("center", "part", "m", "small", "scale", "bound", "fresh")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to, of, value, held = [], [], [], 0

        def flush():
            node, other, score = np.concatenate(to), np.concatenate(of), np.concatenate(value)
            order = np.lexsort((other, node))
            node, other, score = node[order], other[order], score[order]
            once = np.concatenate(([True], (node[1:] != node[:-1]) | (other[1:] != other[:-1])))
            node, other, score = node[once], other[once], score[once]
            order = np.lexsort((-score, node))
            node, other, score = node[order], other[order], score[order]
            starts = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
            ends = np.append(starts[1:], len(node))
            return _list_batch([
                (int(node[s]), other[s : min(e, s + K)], score[s : min(e, s + K)], np.ones(min(e - s, K), bool))
                for s, e in zip(starts.tolist(), ends.tolist(), strict=True)
            ])

        for g in _groups(batches, 2):
            ids, keep = np.unique(g["m"].to_numpy(), return_index=True)
            if len(ids) < 2:
                continue
            fresh = np.zeros(len(ids), bool)
            np.logical_or.at(fresh, np.searchsorted(ids, g["m"].to_numpy()), g["fresh"].to_numpy(zero_copy_only=False))
            x = _matrix(g["small"].to_numpy(zero_copy_only=False)[keep], g["scale"].to_numpy()[keep])
            scores = x @ x.T
            new = (scores > g["bound"].to_numpy()[keep][:, None]) & (fresh[:, None] | fresh[None, :])
            np.fill_diagonal(new, False)
            i, j = np.nonzero(new)
            to.append(ids[i])
            of.append(ids[j])
            value.append(scores[i, j])
            held += len(i)
            if held > 2_000_000:
                yield flush()
                to, of, value, held = [], [], [], 0
        if held:
            yield flush()

    met = gathered.repartition("center", "part").sortWithinPartitions("center", "part").mapInArrow(meet, LISTS)
    seen = graph.withColumn("fresh", F.transform("ids", lambda _: F.lit(False)))
    return _merged(seen.unionByName(met), "ann-graph")


def build(nodes: DataFrame) -> DataFrame:
    """The neighbour graph of all nodes."""
    count = nodes.count()
    graph = first_graph(nodes, count)
    for step in itertools.count():
        graph = improve(graph, nodes, step)
        news = graph.agg(F.sum(F.size(F.filter("fresh", lambda f: f)))).first()[0] or 0
        if news <= SETTLED * K * count:
            break
    return graph


def search(queries: DataFrame, graph: DataFrame, nodes: DataFrame) -> DataFrame:
    """(query, id): the EXACT best candidates of greedy searches from the queries' own nodes."""
    linked = graph.select("id", F.explode("ids").alias("m")).join(nodes.select(F.col("id").alias("m"), "small", "scale"), "m")
    linked = linked.groupBy("id").agg(F.collect_list(F.struct("m", "small", "scale")).alias("near"))
    linked = materialise(linked, "ann-linked")
    # The search state has the same columns as a node's list; fresh means not expanded.
    own = F.struct(F.col("id").alias("i"), F.lit(float("inf")).cast("float").alias("s"))
    state = queries.select("id").join(graph, "id", "left").withColumn("own", own).select(
        "id", F.concat(F.array("own.i"), F.coalesce("ids", F.array().cast("array<long>"))).alias("ids"),
        F.concat(F.array("own.s"), F.coalesce("scores", F.array().cast("array<float>"))).alias("scores"),
        F.concat(F.array(F.lit(False)), F.transform(F.coalesce("ids", F.array().cast("array<long>")), lambda _: F.lit(True))).alias("fresh"),
    )
    # The first row of a query carries its vector from step to step.
    asking = nodes.select("id", F.col("small").alias("q_small"), F.col("scale").alias("q_scale"))
    state = materialise(state.join(asking, "id"), "ann-beam")
    kind = f"{LISTS}, q_small binary, q_scale float"

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                near = batch.column(3)[i].values
                q = np.frombuffer(batch.column(1)[i].as_py(), np.int8).astype(np.float32) * batch.column(2)[i].as_py()
                x = _matrix(near.field("small").to_numpy(zero_copy_only=False), near.field("scale").to_numpy())
                ids = near.field("m").to_numpy()
                out.append((batch.column(0)[i].as_py(), ids, x @ q, np.ones(len(ids), bool)))
            yield _list_batch(out)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, vectors = [], []
        for g in _groups(batches):
            ids, scores = g["ids"].flatten().to_numpy(), g["scores"].flatten().to_numpy()
            fresh = g["fresh"].flatten().to_numpy(zero_copy_only=False)
            known = ids[~fresh]
            place = _best(ids, scores, BEAM + 1)
            out.append((g["id"][0].as_py(), ids[place], scores[place], ~np.isin(ids[place], known)))
            with_vector = g["q_small"].is_valid().index(True).as_py()
            vectors.append((g["q_small"][with_vector].as_py(), g["q_scale"][with_vector].as_py()))
        lists = _list_batch(out)
        small, scale = zip(*vectors, strict=True) if vectors else ([], [])
        yield pa.RecordBatch.from_arrays(
            [*lists.columns, pa.array(small, pa.binary()), pa.array(scale, pa.float32())], names=[*lists.schema.names, "q_small", "q_scale"]
        )

    while True:
        todo = F.slice(F.filter(F.arrays_zip("ids", "fresh"), lambda e: e["fresh"]), 1, EXPAND)
        frontier = state.select(F.col("id").alias("query"), "q_small", "q_scale", F.explode(F.transform(todo, lambda e: e["ids"])).alias("id"))
        if frontier.isEmpty():
            break
        asked = frontier.join(linked, "id")
        found = asked.select("query", "q_small", "q_scale", "near").mapInArrow(expand, LISTS)
        done = F.transform(F.arrays_zip("ids", "fresh"), lambda e: e["fresh"] & ~F.array_contains(F.transform(todo, lambda t: t["ids"]), e["ids"]))
        both = state.withColumn("fresh", done).unionByName(found, allowMissingColumns=True)
        state = materialise(both.repartition("id").sortWithinPartitions("id").mapInArrow(keep, kind), "ann-beam")
    return state.select(F.col("id").alias("query"), F.explode(F.slice("ids", 1, EXACT + 1)).alias("id"))


def inner_product(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def nearest(rows: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query row among all other rows."""
    valid = materialise(usable(rows, id_col, vector_col).join(
        rows.filter(is_query).select(F.col(id_col).cast("long").alias("vec_id"), F.lit(True).alias("query")).distinct(), "vec_id", "left"
    ), "ann-rows")
    nodes = nodes_of(valid)
    graph = build(nodes)
    members = materialise(valid.join(nodes.select("id", "vector"), "vector").select("id", "vec_id", "query"), "ann-ids")
    # A result needs no more members of a vector than it has places, and one for the query itself.
    first = Window.partitionBy("id").orderBy("vec_id")
    few = members.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k + 1).select("id", "vec_id")
    asking = members.filter("query").select(F.col("id").alias("query"), F.col("vec_id").alias("query_id"))
    found = search(asking.select(F.col("query").alias("id")).distinct(), graph, nodes)
    pairs = (
        found.join(nodes.select("id", F.col("vector").alias("b")), "id")
        .join(nodes.select(F.col("id").alias("query"), F.col("vector").alias("a")), "query")
        .select("query", "id", inner_product("a", "b").alias("score"))
    )
    near = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        pairs.join(few, "id").join(asking, "query").filter("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
