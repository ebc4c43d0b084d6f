"""Conversation repair: the cheapest edits after which the roles read system?, (user, assistant)+ or nothing.

Edits are Keep (0), Rerole to user or assistant (1), Delete (2) and Insert of an empty user or assistant turn (5);
blank and duplicate turns must go, a truncated turn that stays costs 5 more. The lattice has one layer per turn and
one node per layer for what was emitted last (nothing, system, user, assistant). Two Dijkstra searches, from its start and from
its ends, carry the cost and the audit, which is the initials of the edits. They stop once no path through the
heaps can be as cheap as the best meeting; of all meetings of that cost the least joined audit counts. An
audit fixes what a Rerole or an Insert makes, since only one of user and assistant can follow.

Turns are range-partitioned by conversation and turn and pass through a task as a sorted stream. A conversation that
lies inside one partition and is short is solved at once. Of others each piece of at most ``PIECE`` turns gives
the cheapest audits from every node before it to every node after it; a second stream puts the pieces together and
forgets what all nodes agree on; a third one writes audit and digest. So a conversation of any length is searched by many
tasks, and no task holds one: only the digest, which is one sequential computation, passes over its text in order.

Defined results: a null role or text is one space; turns of one number are ordered by role and text, nulls come first;
repeated rows are duplicates; a null conversation id is a conversation of its own; rows with 0 copies only name
their conversation; without rows all numbers are 0, the audit is empty and the digest that of the empty text; an empty
table gives no rows; texts are read whole. Other columns are ignored. Equal role and text means equal md5.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ledgerbrook.llm.common import hinted
from ledgerbrook.session import materialise

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Turns and bytes of text of a piece at most, unless one turn alone has more.
PIECE, PIECE_BYTES = 256, 1 << 20
#: From any node two inserts, or a deletion and an insert, are enough to go on like from any other.
BEHIND = 2 * INSERT
#: Pieces that wait for a decision before the stream looks whether there is one.
LOOK = 64
SPACES = " \t\n\x0b\x0c\r"
#: Nodes of a layer: nothing emitted yet, or the last emitted role.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NODES = (NOTHING, SYSTEM, USER, ASSISTANT)
#: Where a user or assistant turn leads; only one of them can follow a node.
FOLLOWS = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}

#: A turn for the search: initial of its role, and whether it must go, is truncated or is neither ("-").
Turn = tuple[str, str]


def kept(turn: Turn, node: int) -> int | None:
    """Where keeping the turn leads from a node, if the roles allow it."""
    to = INITIAL.get(turn[0])
    if to == SYSTEM:
        return to if node == NOTHING else None
    return to if to is not None and FOLLOWS[node] == to else None


def edges(turns: list[Turn], tail: bool) -> tuple[list, list]:
    """Per place (layer * 4 + node) the edges out of it and into it: (place, cost, letter)."""
    out: list = [[] for _ in range(4 * len(turns) + 4)]
    into: list = [[] for _ in out]

    def edge(a: int, b: int, cost: int, letter: str) -> None:
        out[a].append((b, cost, letter))
        into[b].append((a, cost, letter))

    for layer in range(len(turns) + 1):
        here, there = 4 * layer, 4 * layer + 4
        last = layer == len(turns)
        for node in NODES:
            if not last or tail:
                edge(here + node, here + FOLLOWS[node], INSERT, "I")
            if last:
                continue
            edge(here + node, there + node, DELETE, "D")
            if turns[layer][1] == "x":
                continue
            more = TRUNCATED if turns[layer][1] == "t" else 0
            if (to := kept(turns[layer], node)) is not None:
                edge(here + node, there + to, KEEP + more, "K")
            edge(here + node, there + FOLLOWS[node], REROLE + more, "R")
    return out, into


def cheapest(turns: list[Turn], start: int, ends: tuple[int, ...], tail: bool) -> tuple[int, str] | None:
    """Cost and least audit of the cheapest edits from node ``start`` to one of ``ends``.

    With ``tail`` turns may be inserted after the last one. Equal costs are taken layer by layer, since the only
    edges without a cost lead to the next layer; so a place that leaves the heap has its final label.
    """
    out, into = edges(turns, tail)
    last = 4 * len(turns)
    sides = []
    for graph, begin, sign in ((out, [start], 1), (into, [last + e for e in ends], -1)):
        sides.append((graph, {p: (0, "") for p in begin}, [(0, sign * (p // 4), p) for p in begin], set(), sign))
        sides[-1][2].sort()
    forward, backward = sides[0][1], sides[1][1]
    best = min((0 for p in forward if p in backward), default=None)
    while sides[0][2] and sides[1][2] and (best is None or sides[0][2][0][0] + sides[1][2][0][0] <= best):
        graph, labels, heap, done, sign = min(sides, key=lambda s: s[2][0][0])
        other = backward if sign > 0 else forward
        cost, _, place = heappop(heap)
        if place in done:
            continue
        done.add(place)
        audit = labels[place][1]
        for to, more, letter in graph[place]:
            label = (cost + more, audit + letter if sign > 0 else letter + audit)
            if to not in labels or label < labels[to]:
                if to not in labels or label[0] < labels[to][0]:
                    heappush(heap, (label[0], sign * (to // 4), to))
                labels[to] = label
                if to in other and (best is None or label[0] + other[to][0] < best):
                    best = label[0] + other[to][0]
    if best is None:
        return None
    return best, min(a + backward[p][1] for p, (c, a) in forward.items() if p in backward and c + backward[p][0] == best)


def repaired(audit: str, roles: list[str], texts: list[str], node: int = NOTHING) -> tuple[list[str], int]:
    """The lines ``role:text`` after the edits, and the node they end in."""
    lines, at = [], 0
    for letter in audit:
        role, text = ("", "") if letter == "I" else (roles[at], texts[at])
        at += letter != "I"
        if letter == "D":
            continue
        node = INITIAL[role[:1]] if letter == "K" else FOLLOWS[node]
        lines.append(f"{role if letter == 'K' else ROLE[node]}:{text}")
    return lines, node


class Piece:
    """Neighbouring turns of one conversation, and what is counted about them."""

    def __init__(self, conversation, most: int) -> None:
        self.conversation, self.most = conversation, most
        self.turns: list[Turn] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.bytes = self.blank = self.duplicate = self.truncated = self.illegal = self.numbers = 0
        self.low = self.high = None

    @property
    def full(self) -> bool:
        return len(self.turns) >= self.most or self.bytes >= PIECE_BYTES

    def add(self, number, role: str, text: str, again: bool) -> None:
        body = text.strip(SPACES)
        fault = "b" if not body else "d" if again else "t" if body[-1] not in ".!?" else "-"
        self.blank += fault == "b"
        self.duplicate += fault == "d"
        self.truncated += fault == "t"
        if self.turns:
            self.illegal += (self.turns[-1][0], role[:1]) not in LEGAL
        self.turns.append((role[:1], "x" if fault in "bd" else fault))
        self.roles.append(role)
        self.texts.append(text)
        self.bytes += len(text)
        if number is not None:
            self.numbers += number != self.high
            self.low = number if self.low is None else self.low
            self.high = number

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.numbers


COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long"
RESULT = f"{COUNTS}, cost long, audit string, repaired_sha256 string"
#: What a piece adds to a result: see ``_piece_row``.
PIECES = "part int, piece int, ends array<string>, low long, high long, numbers long, costs array<long>, audits array<string>"


def _done_row(piece: Piece) -> dict:
    cost, audit = cheapest(piece.turns, NOTHING, (NOTHING, ASSISTANT), True)
    digest = hashlib.sha256("\n".join(repaired(audit, piece.roles, piece.texts)[0]).encode()).hexdigest()
    return {
        "id": piece.conversation, "done": True, "gaps": piece.gaps, "blank": piece.blank, "duplicate": piece.duplicate,
        "truncated": piece.truncated, "illegal": piece.illegal, "cost": cost, "audit": audit, "repaired_sha256": digest,
    }


def _piece_row(piece: Piece, part: int, number: int, first: bool) -> dict:
    """Counts and texts of a piece, and cost and audit from each node before it to each node after it."""
    found = [
        cheapest(piece.turns, start, (end,), False) if start == NOTHING or not first else None for start in NODES for end in NODES
    ]
    return {
        "id": piece.conversation, "done": False, "part": part, "piece": number, "blank": piece.blank, "duplicate": piece.duplicate,
        "truncated": piece.truncated, "illegal": piece.illegal, "ends": [t[0] for t in piece.turns[:1] + piece.turns[-1:]],
        "low": piece.low, "high": piece.high, "numbers": piece.numbers, "costs": [f and f[0] for f in found],
        "audits": [f and f[1] for f in found], "roles": piece.roles, "texts": piece.texts,
    }


def _pieces(schema: pa.Schema, most: int):
    """From sorted turns: results of the conversations that are whole and short, pieces of the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The partition's first conversation may have begun, and its last one may go on, in another partition.
        piece, part, number, opening, cut = None, 0, 0, True, False
        out: list[dict] = []

        def flush(ended: bool) -> None:
            nonlocal number, cut
            begun_here = not cut and not opening
            if ended and begun_here:
                out.append(_done_row(piece))
            else:
                out.append(_piece_row(piece, part, number, begun_here))
                number, cut = number + 1, True

        for batch in batches:
            for part, conversation, turn, role, text, copies, later in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if piece is None:
                    piece = Piece(conversation, most)
                elif conversation != piece.conversation:
                    flush(True)
                    piece, opening, cut = Piece(conversation, most), False, False
                for copy in range(copies):
                    if piece.full:
                        flush(False)
                        piece = Piece(conversation, most)
                    piece.add(turn, role, text, later or copy > 0)
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out.clear()
        if piece is not None:
            flush(False)
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


class Joined:
    """Best ways to every node after the pieces so far: cost, place in the order of audits, and the way there."""

    def __init__(self) -> None:
        self.at = {NOTHING: (0, 0)}
        self.waiting: list[tuple[tuple, dict]] = []

    def add(self, name: tuple, costs: list, audits: list) -> None:
        ways = {}
        for end in NODES:
            choices = [
                (cost + costs[4 * start + end], rank, start) for start, (cost, rank) in self.at.items() if costs[4 * start + end] is not None
            ]
            if choices:
                cost, rank, start = min(choices)
                ways[end] = (cost, rank, audits[4 * start + end], start)
        least = min(cost for cost, *_ in ways.values())
        ways = {end: way for end, way in ways.items() if way[0] <= least + BEHIND}
        # Audits that end in a turn's edit are never the beginning of one another, so ranks decide.
        order = sorted(ways, key=lambda end: ways[end][1:3])
        self.at = {end: (ways[end][0], order.index(end)) for end in ways}
        self.waiting.append((name, {end: (way[3], way[2]) for end, way in ways.items()}))

    def back(self, end: int, count: int) -> list[tuple[tuple, str]]:
        """(piece, audit) of the first ``count`` waiting pieces on the way to ``end``."""
        out = []
        for name, ways in reversed(self.waiting[:count]):
            end, audit = ways[end]
            out.append((name, audit))
        return out[::-1]

    def agreed(self) -> list[tuple[tuple, str]]:
        """Take out the waiting pieces on which all ways agree; the last one stays."""
        ends = set(self.at)
        for count in range(len(self.waiting) - 1, 0, -1):
            ends = {self.waiting[count][1][e][0] for e in ends}
            if len(ends) == 1:
                out = self.back(ends.pop(), count)
                self.waiting = self.waiting[count:]
                return out
        return []

    def finish(self) -> list[tuple[tuple, str, int]]:
        """(piece, audit, cost) of what still waits: the cost of the whole, and turns inserted at the end, with the last piece."""
        tail = {NOTHING: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}
        cost, _, end = min((cost + INSERT * len(tail[e]), rank, e) for e, (cost, rank) in self.at.items())
        *before, (name, audit) = self.back(end, len(self.waiting))
        return [*((n, a, 0) for n, a in before), (name, audit + tail[end], cost)]


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the pieces of each conversation in order: the audit of each, and the cost at the last one."""
    joined, at = None, None

    def batch_of(rows: list) -> pa.RecordBatch:
        columns = list(zip(*[(*name, audit, cost) for name, audit, cost in rows], strict=True)) or [[]] * 4
        types = (pa.int32(), pa.int32(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                          names=["part", "piece", "audit", "cost"])

    for batch in batches:
        out = []
        for conversation, part, piece, costs, audits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if joined is None or conversation != at:
                out += joined.finish() if joined else []
                joined, at = Joined(), conversation
            joined.add((part, piece), costs, audits)
            if len(joined.waiting) % LOOK == 0:
                out += [(name, audit, 0) for name, audit in joined.agreed()]
        yield batch_of(out)
    if joined:
        yield batch_of(joined.finish())


def _written(schema: pa.Schema):
    """From the pieces of each conversation in order, with their audits: its result."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, digest, audits, node, last, low, high, numbers, written = None, None, [], NOTHING, None, None, None, 0, False

        def result() -> pa.RecordBatch:
            gaps = 0 if low is None else high - low + 1 - numbers
            whole = {**row, "gaps": gaps, "audit": "".join(audits), "repaired_sha256": digest.hexdigest()}
            return pa.RecordBatch.from_pylist([whole], schema=schema)

        for batch in batches:
            for piece in batch.to_pylist():
                if row is None or piece["id"] != row["id"]:
                    if row is not None:
                        yield result()
                    row = {"id": piece["id"], "cost": 0, **dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)}
                    digest, audits, node, last, low, high, numbers, written = hashlib.sha256(), [], NOTHING, None, None, None, 0, False
                for name in ("blank", "duplicate", "truncated", "illegal", "cost"):
                    row[name] += piece[name]
                if piece["ends"]:
                    row["illegal"] += last is not None and (last, piece["ends"][0]) not in LEGAL
                    last = piece["ends"][-1]
                if piece["low"] is not None:
                    numbers += piece["numbers"] - (piece["low"] == high)
                    low, high = piece["low"] if low is None else low, piece["high"]
                lines, node = repaired(piece["audit"], piece["roles"], piece["texts"], node)
                if lines:
                    digest.update(("\n" * written + "\n".join(lines)).encode())
                    written = True
                audits.append(piece["audit"])
        if row is not None:
            yield result()

    return run


def repair(rows: DataFrame, copies: Column | None = None, id_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text", piece: int = PIECE) -> DataFrame:
    """One row per conversation: id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256.

    ``copies`` says how often a row stands in its conversation, once unless given. ``piece`` is the number of turns
    that are searched at once; the result does not depend on it.
    """
    copies = F.lit(1) if copies is None else copies
    there = rows.select(
        F.col(id_col).alias("id"), copies.cast("long").alias("copies"), F.col(turn_col).cast("long").alias("turn"),
        *[F.coalesce(F.col(c), F.lit(" ")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))],
    )
    some = F.col("copies") > 0
    there = there.select("id", "copies", F.when(some, F.col("turn")).alias("turn"), F.when(some, F.col("role")).alias("role"),
                         F.when(some, F.col("text")).alias("text"))
    alike = there.groupBy("id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    spelt = F.concat_ws(":", F.col("id").cast("string"), F.col("id").isNull().cast("string"), F.md5("role"), F.md5("text"))
    turns = materialise(alike.withColumn("sign", F.md5(spelt)), "repair-turns")
    signs = turns.filter("copies > 0").groupBy("sign").agg(
        F.count("*").alias("n"), F.min("turn").alias("first"), F.max(F.col("turn").isNull()).alias("unnumbered"))
    again = materialise(signs.filter("n > 1").select("sign", "first", "unnumbered"), "repair-again")
    later = F.coalesce(F.col("turn").isNotNull() & (F.col("unnumbered") | (F.col("turn") > F.col("first"))), F.lit(False))
    marked = turns.join(hinted(again), "sign", "left").select(
        "id", "turn", *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")], "copies", later.alias("later"))
    # A range bound holds the head of a text only, which agrees with the order of whole texts.
    dealt = marked.repartitionByRange("id", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions("id", "turn", "role", "text")
    kind = dict(rows.dtypes)[id_col]
    schema = f"id {kind}, done boolean, {RESULT}, {PIECES}, roles array<string>, texts array<string>"
    stream = dealt.select(F.spark_partition_id().alias("part"), "id", "turn", "role", "text", "copies", "later")
    pieces = materialise(stream.mapInArrow(_pieces(_arrow(schema), piece), schema), "repair-pieces")

    parts = pieces.filter("NOT done")
    ordered = parts.select("id", "part", "piece", "costs", "audits").repartition("id").sortWithinPartitions("id", "part", "piece")
    chosen = materialise(ordered.mapInArrow(_chosen, "part int, piece int, audit string, cost long"), "repair-chosen")
    counted = parts.drop("done", "gaps", "cost", "audit", "repaired_sha256", "costs", "audits").join(chosen, ["part", "piece"])
    sorted_parts = counted.repartition("id").sortWithinPartitions("id", "part", "piece")
    result = f"id {kind}, {RESULT}"
    long_ones = sorted_parts.mapInArrow(_written(_arrow(result)), result)
    names = [f.name for f in StructType.fromDDL(result)]
    return pieces.filter("done").select(*names).unionByName(long_ones).withColumnRenamed("id", id_col)


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))


def damage(conversations: DataFrame) -> DataFrame:
    """Conversations with seeded faults and how often each row stands there, as ``copies``."""
    spelt = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(spelt.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )
