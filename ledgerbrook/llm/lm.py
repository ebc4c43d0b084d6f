"""Language-model scores from a probabilistic suffix tree over words.

Symbols are the words seen in training, the end of a text, and one symbol for all unknown words. The
tree's root is the distribution of all tokens, with the share of words seen once set aside for unknown
ones. A context of up to DEPTH known words (the start of a text counts as one) becomes a state if it was
seen CONTEXT_LEAST times and if the distribution of what follows diverges from that of its longest
shorter state; it lists the tokens that follow it GRAM_LEAST times, and is smoothed into that shorter
distribution. Every token is scored by the longest state that fits, so a text's score is the log10
probability of its token sequence. The two bounds are counts, not shares, so the tree grows with the input.

Every task packs its documents into blocks of bounded size: the block's own words, and the texts as places
among them. Words and then, level by level, grams are counted per block and meet in buckets, ranges of their
hashes: a block sends each bucket one packed row of its sorted grams and counts, and gets back a row of the
sums in the same order, so no gram returns; so it is with the states, by their context. There are as many
buckets as blocks, so a bucket's share is bounded like a block. A block finds its grams again from its texts and what it was told,
and scores its documents with its own words, grams and states. So neither the vocabulary, nor the corpus, nor
the tree is ever in one place. A gram is counted only where its two shorter grams are frequent enough, which
loses none.

Defined results: a null text counts as empty and has one token, its end; words are counted in whole
texts; documents held out by the fold teach nothing; without training documents all counts are 0; a
null id folds like the empty id; repeated rows are scored and counted each; an empty table gives no
rows. Other columns are ignored. Words and grams are matched by 64-bit hash.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerbrook.llm.common import fold, shuffles_cleared
from ledgerbrook.session import materialise

#: Bytes of text in a block, and what a row adds to it; its distinct words and grams are held by one task.
BLOCK_BYTES, ROW_BYTES = 8 << 20, 16
#: Longest context in words.
DEPTH = 3
#: Least counts of a context, and of a context with its next token.
CONTEXT_LEAST, GRAM_LEAST = 4, 2
#: Nats by which a context's distribution has to differ from its shorter state's.
DIVERGENCE = 0.02
ADD = 0.1

#: What a block asks of a bucket, and what it is told.
ASKED = "bucket int, block long, level int, state boolean, grams binary, n binary, more binary"
TOLD = "block long, level int, state boolean, bucket int, n binary, more binary, sums array<long>"


def tokens(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case; bytes.split() knows exactly the six ASCII white-space characters."""
    return text.encode().lower().split() if text else []


def word_key(word: bytes) -> int:
    key = xxhash.xxh3_64_intdigest(word)
    return key - (1 << 64) if key >= 1 << 63 else key


#: The start and the end of a text; no word has a space.
EDGE = word_key(b" ")


def packed(values: np.ndarray) -> bytes:
    """Values by the place of their bytes, compressed; most high bytes are zero."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def blocks(docs: DataFrame, id_col: str, text_col: str, folds: int) -> DataFrame:
    """One stored row per block. A task's rows fill its blocks as they come, so no id can fill one."""
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), (fold(F.col(id_col), folds) == 0).alias("held_out"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32

        def numbered() -> dict[bytes, int]:
            index = defaultdict(None, {b" ": 0})
            index.default_factory = index.__len__
            return index

        def close():
            keys = np.fromiter(map(word_key, index), np.int64, len(index))
            found = pa.concat_arrays(ids)
            one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), one(found), one(pa.array(held, pa.bool_())), one(pa.array(sizes, pa.int32())),
                 pa.array([keys.tobytes()], pa.binary()), pa.array([packed(np.frombuffer(seq, np.int32))], pa.binary())],
                names=["block", "ids", "held", "sizes", "words", "places"],
            )

        index, ids, held, sizes, seq, size = numbered(), [], [], [], array("i"), 0
        for batch in batches:
            start = 0
            for i, (text, out) in enumerate(zip(batch.column(1), batch.column(2), strict=True), 1):
                words = tokens(text.as_py())
                seq.append(0)
                seq.extend(map(index.__getitem__, words))
                seq.append(0)
                held.append(out.as_py())
                sizes.append(len(words) + 1)
                size += ROW_BYTES + sum(map(len, words)) + len(words)
                if size >= BLOCK_BYTES:
                    ids.append(batch.column(0).slice(start, i - start))
                    yield close()
                    block += 1
                    start, index, ids, held, sizes, seq, size = i, numbered(), [], [], [], array("i"), 0
            if start < batch.num_rows:
                ids.append(batch.column(0).slice(start))
        if sizes:
            yield close()

    schema = f"block long, ids array<{kind}>, held array<boolean>, sizes array<int>, words binary, places binary"
    return materialise(rows.mapInArrow(pack, schema), "lm-blocks")


def _find(sorted_codes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether found, where) of codes in a sorted array."""
    if not len(sorted_codes):
        return np.zeros(len(codes), bool), np.zeros(len(codes), np.int64)
    at = np.minimum(np.searchsorted(sorted_codes, codes), len(sorted_codes) - 1)
    return sorted_codes[at] == codes, at


def extend(codes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Codes of the grams one word longer; a single word is its own code."""
    x = codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + keys.view(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))).view(np.int64)


class Level:
    """What is known of grams of one length: count, whether the block reports it, and which of the states it is, if any."""

    def __init__(self, gram: np.ndarray, n: np.ndarray, mine: np.ndarray):
        self.gram, self.n, self.mine = gram, n, mine
        self.state, self.remainder, self.whole = None, np.empty(0), np.empty(0)

    def contexts(self) -> np.ndarray:
        """Whether each gram may be a state."""
        return self.n >= CONTEXT_LEAST

    def become(self, at: np.ndarray, remainder: np.ndarray, whole: np.ndarray) -> None:
        """The grams in some places are states."""
        self.state, self.remainder, self.whole = np.full(len(self.n), -1, np.int32), remainder, whole
        self.state[at] = np.arange(len(at))

    def by_gram(self, values: np.ndarray) -> np.ndarray:
        """Values of states; 0 for other grams."""
        return np.append(values, 0.0)[np.full(len(self.n), -1) if self.state is None else self.state]


class Told:
    """The buckets' answers to one block, in the order of its grams."""

    def __init__(self, rows: pa.Table):
        kinds = ("level", "state", "bucket", "n", "more")
        self.parts: dict[tuple, list] = {}
        for level, state, _, n, more in sorted(zip(*(rows.column(c).to_pylist() for c in kinds), strict=True), key=lambda r: r[:3]):
            self.parts.setdefault((level, state), []).append((n, more))

    def _read(self, level: int, state: bool, place: int, kind: type) -> np.ndarray:
        return np.concatenate([np.empty(0, kind), *(unpacked(part[place], kind) for part in self.parts.get((level, state), []))])

    def level(self, k: int, grams: np.ndarray) -> Level:
        level = Level(grams, self._read(k, False, 0, np.int64), self._read(k, False, 1, np.uint8).astype(bool))
        if (k, True) in self.parts:
            entries, listed = self._read(k, True, 0, np.int64), self._read(k, True, 1, np.int64)
            some = entries > 0
            at = np.flatnonzero(level.contexts())[some]
            whole = (level.n[at] + entries[some] + 1).astype(float)
            level.become(at, whole - listed[some], whole)
        return level


class Walk:
    """Texts as keys, each after its start; all arrays are by position but those of the levels, which are by gram."""

    def __init__(self, words: np.ndarray, places: np.ndarray, depth: np.ndarray):
        self.keys, self.depth = words[places], depth
        self.grams, owner = np.unique(words, return_inverse=True)
        self.at, self.owner = None, owner.astype(np.int32)[places]
        self.levels: list[Level] = []
        self.where: list[np.ndarray] = []  # of the word, then of longer grams, in their level; -1 if not known

    def learn(self, level: Level) -> None:
        """What is known of ``grams``; one not counted is not known."""
        where = np.where(level.n > 0, np.arange(len(level.n), dtype=np.int32), np.int32(-1))[self.owner]
        if self.at is not None:
            found, where = where, np.full(len(self.keys), -1, np.int32)
            where[self.at] = found
        self.levels.append(level)
        self.where.append(where)
        self.grams = None
        for before in self.levels[:-2]:  # of these only counts and states are needed from here on
            before.gram = before.mine = None

    def count(self, level: int, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        return np.append(self.levels[level].n, 0)[self.where[level][at]]

    def longer(self) -> None:
        """Find the grams one word longer than the last level's that may be frequent."""
        of, where = self.levels[-1], self.where[-1]
        context, gram = (np.append(of.n >= least, False)[where] for least in (CONTEXT_LEAST, GRAM_LEAST))
        self.at = 1 + np.flatnonzero(context[:-1] & gram[1:] & (self.depth[1:] >= len(self.levels)))
        self.grams, owner = np.unique(extend(of.gram[where[self.at - 1]], self.keys[self.at]), return_inverse=True)
        self.owner = owner.astype(np.int32)

    def probabilities(self, root: np.ndarray, depth: int) -> np.ndarray:
        """Of every token after states of at most ``depth`` words; those of starts mean nothing."""
        p = root.copy()
        for k in range(1, depth + 1):
            of = self.levels[k - 1]
            if of.state is None:
                continue
            state = np.append(of.state, np.int32(-1))[self.where[k - 1][:-1]]
            at = 1 + np.flatnonzero((state >= 0) & (self.depth[1:] >= k))
            state = state[at - 1]
            p[at] = (self.count(k, at) + of.remainder[state] * p[at]) / of.whole[state]
        return p


def opened(row: pa.Table) -> tuple[Walk, np.ndarray, np.ndarray]:
    """(the texts of a block, their numbers of tokens, whether each is held out)."""
    sizes = row.column("sizes")[0].values.to_numpy()
    held = row.column("held")[0].values.to_numpy(zero_copy_only=False)
    places = unpacked(row.column("places")[0].as_py(), np.int32)
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    depth = (np.arange(len(places)) - np.repeat(starts, sizes + 1)).astype(np.int32)
    return Walk(np.frombuffer(row.column("words")[0].as_py(), np.int64), places, depth), sizes, held


def walked(walk: Walk, told: Told, levels: int) -> None:
    """Learn the first ``levels`` levels."""
    for k in range(levels):
        if k:
            walk.longer()
        walk.learn(told.level(k, walk.grams))


def roots(walk: Walk, totals: dict) -> np.ndarray:
    n, count = totals["words"] + totals["texts"], walk.count(0)
    return np.where(count > 0, count / max(n, 1) * (1 - totals["unknown"]), totals["unknown"])


def _edges(buckets: int) -> np.ndarray:
    """The hash after the last one of each bucket but the last."""
    return np.array([((b << 64) // buckets) - (1 << 63) for b in range(1, buckets)], np.int64)


def _asked(block: int, level: int, state: bool, grams: np.ndarray, n: np.ndarray, more: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    """One row per bucket that has some of a block's sorted grams."""
    cuts = np.concatenate(([0], np.searchsorted(grams, _edges(buckets)), [len(grams)]))
    rows = [
        (b, block, level, state, packed(np.diff(grams[i:j].view(np.uint64), prepend=np.uint64(0))), packed(n[i:j]), b"" if not state else packed(np.concatenate([m[i:j] for m in more])))
        for b, (i, j) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if i < j
    ]
    names = ["bucket", "block", "level", "state", "grams", "n", "more"]
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)], names=names)


def _ask(row: pa.Table, told: Told, level: int, totals: dict, buckets: int) -> list[pa.RecordBatch]:
    """A block's training counts of its grams of ``level`` words and one more; and of its contexts one word shorter
    than the last level's grams, what the grams that this block reports add to their distributions."""
    block, out = row.column("block")[0].as_py(), []
    walk, sizes, held = opened(row)
    walked(walk, told, level)
    train = np.repeat(~held, sizes + 1)
    if level > 1:
        k, of, context = level - 1, walk.levels[level - 1], walk.levels[level - 2]
        q = walk.probabilities(roots(walk, totals), k - 1)
        first = np.full(len(of.n), -1, np.int64)
        at = np.flatnonzero(walk.where[k] >= 0)
        first[walk.where[k][at[::-1]]] = at[::-1]
        at = first[(first >= 0) & of.mine]
        n, total, q = walk.count(k, at), walk.count(k - 1, at - 1), q[at]
        mine = context.contexts()
        owner, size = (np.cumsum(mine) - 1)[walk.where[k - 1][at - 1]], int(mine.sum())
        p, several = n / total, lambda x: np.bincount(owner, x, size).astype(float)
        more = [several(p * np.log(p / q)), several(n), several(q), several(np.ones(len(at)))]
        out.append(_asked(block, level - 2, True, context.gram[mine], context.n[mine], more, buckets))
    if level <= DEPTH:
        if level:
            walk.longer()
            n = np.bincount(walk.owner[train[walk.at]], minlength=len(walk.grams)).astype(np.int64)
        else:
            # An edge stands at both ends of a text, and counts once.
            n = np.bincount(walk.owner[train], minlength=len(walk.grams)).astype(np.int64)
            n[np.searchsorted(walk.grams, EDGE)] = (~held).sum()
        out.append(_asked(block, level, False, walk.grams, n, [], buckets))
    return out


def _answer(rows: pa.Table) -> pa.Table:
    """Sums over the blocks of one bucket, and the contexts that become states, for every block in its own order."""
    out = []
    for state in (False, True):
        some = rows.filter(pa.array(rows.column("state").to_numpy(zero_copy_only=False) == state)).sort_by("block")
        if not some.num_rows:
            continue
        grams = [np.cumsum(unpacked(g.as_py(), np.uint64), dtype=np.uint64).view(np.int64) for g in some.column("grams")]
        cuts = np.cumsum([len(g) for g in grams])[:-1]
        gram, n = np.concatenate(grams), np.concatenate([unpacked(x.as_py(), np.int64) for x in some.column("n")])
        order = np.argsort(gram, kind="stable")
        starts = np.flatnonzero(np.concatenate(([True], gram[order][1:] != gram[order][:-1])))
        level, sums = some.column("level")[0].as_py(), None

        def each(values: np.ndarray) -> list[np.ndarray]:
            """Values of different grams, as the blocks hold them."""
            by_row = np.empty(len(gram), values.dtype)  # noqa: B023
            by_row[order] = np.repeat(values, np.diff(np.append(starts, len(gram))))  # noqa: B023
            return np.split(by_row, cuts)  # noqa: B023

        if state:
            total = n[order][starts].astype(float)
            parts = [unpacked(x.as_py(), np.float64).reshape(4, -1) for x in some.column("more")]
            gain, listed, q, entries = (np.add.reduceat(x[order], starts) for x in np.concatenate(parts, axis=1))
            # What is not listed counts as one symbol.
            rest, rest_q = 1 - listed / total, 1 - q
            left = (rest > 1e-9) & (rest_q > 1e-9)
            gain[left] += rest[left] * np.log(rest[left] / rest_q[left])
            kept = (gain >= DIVERGENCE) & (entries > 0)
            told = zip(each(np.where(kept, entries, 0).astype(np.int64)), each(np.where(kept, listed, 0).astype(np.int64)), strict=True)
        else:
            n = np.add.reduceat(n[order], starts)
            mine = np.zeros(len(gram), np.uint8)
            mine[order[starts]] = 1
            if level == 0:
                edge = gram[order[starts]] == EDGE
                sums = [int(n[~edge].sum()), int((n[~edge] > 0).sum()), int((n[~edge] == 1).sum()), int(n[edge].sum())]
            told = zip(each(np.where(n >= (GRAM_LEAST if level else 1), n, 0)), np.split(mine, cuts), strict=True)
        bucket = some.column("bucket")[0].as_py()
        for i, (block, (a, b)) in enumerate(zip(some.column("block").to_pylist(), told, strict=True)):
            out.append((block, level, state, bucket, packed(a), packed(b), sums if i == 0 else None))
    kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
    names = ["block", "level", "state", "bucket", "n", "more", "sums"]
    return pa.table([pa.array(list(c), kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


PARTS = ("held", "sizes", "words", "places")


def _with_told(blocked: DataFrame, answers: list[DataFrame], run, schema: str, columns: tuple[str, ...] = PARTS) -> DataFrame:
    """``run`` of each block and what it was told."""
    if not answers:

        def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    yield from run(pa.Table.from_batches([batch.slice(i, 1)]), None).to_batches()

        return blocked.select("block", *columns).mapInArrow(alone, schema)
    told = reduce(DataFrame.unionByName, answers).drop("sums")
    return blocked.select("block", *columns).groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        lambda row, rows: run(row, Told(rows)), schema
    )


class Tree:
    """The tree, as the stored answers to the blocks. Only ``digits`` and ``score``, which are there to look
    into small trees, read it on the driver. A digit is a word's place among the known ones."""

    def __init__(self, blocked: DataFrame, answers: list[DataFrame]):
        self.blocked, self.answers = blocked, answers

    @cached_property
    def levels(self) -> list[DataFrame]:
        """Known grams by block, from single words on."""

        def rows(k: int) -> DataFrame:
            def run(row: pa.Table, told: Told) -> pa.Table:
                walk = opened(row)[0]
                walked(walk, told, k + 1)
                of, some = walk.levels[k], walk.levels[k].n > 0
                return pa.table({
                    "block": pa.array(np.full(some.sum(), row.column("block")[0].as_py(), np.int64)), "gram": of.gram[some],
                    "n": of.n[some], "mine": of.mine[some], "remainder": of.by_gram(of.remainder)[some], "whole": of.by_gram(of.whole)[some],
                })

            return _with_told(self.blocked, self.answers, run, "block long, gram long, n long, mine boolean, remainder double, whole double")

        return [rows(k) for k in range(DEPTH + 1)]

    @cached_property
    def _tables(self) -> list[Level]:
        out = []
        for rows in self.levels:
            found = rows.dropDuplicates(["gram"]).orderBy("gram").toArrow()
            gram, n, mine, remainder, whole = (found.column(c).to_numpy() for c in ("gram", "n", "mine", "remainder", "whole"))
            level, at = Level(gram, n, mine), np.flatnonzero(whole)
            level.become(at, remainder[at], whole[at])
            out.append(level)
        return out

    @cached_property
    def heavy(self) -> np.ndarray:
        return self._tables[0].gram[self._tables[0].gram != EDGE]

    @property
    def edge(self) -> int:
        return len(self.heavy)

    def digits(self, keys: np.ndarray) -> np.ndarray:
        found, at = _find(self.heavy, keys)
        return np.where(found, at, -1)

    def score(self, digits: np.ndarray, root: np.ndarray) -> np.ndarray:
        """log10 probabilities of the tokens after the first digit, the edge; ``root`` are those of the root."""
        words = np.concatenate((self.heavy, [EDGE, word_key(b"unknown words")]))
        walk = Walk(words, np.asarray(digits), np.arange(len(digits)))
        for k, of in enumerate(self._tables):
            if k:
                walk.longer()
            found, at = _find(of.gram, walk.grams)
            here = Level(walk.grams, np.zeros(len(at), np.int64), np.zeros(len(at), bool))
            here.n[found] = of.n[at[found]]
            remainder, whole = (np.where(found, np.append(of.by_gram(x), 0.0)[np.where(found, at, -1)], 0.0) for x in (of.remainder, of.whole))
            states = np.flatnonzero(whole)
            here.become(states, remainder[states], whole[states])
            walk.learn(here)
        return np.log10(walk.probabilities(np.append(1.0, 10.0**root), DEPTH)[1:])


def train(blocked: DataFrame) -> tuple[Tree, DataFrame, dict]:
    """(tree, training counts by block and word, totals) of documents in blocks."""
    with shuffles_cleared(blocked.sparkSession):
        return _train(blocked)


def _train(blocked: DataFrame) -> tuple[Tree, DataFrame, dict]:
    buckets, totals, answers = max(1, blocked.count()), {}, []
    for level in range(DEPTH + 2):
        known = dict(totals)

        def ask(row: pa.Table, told: Told | None, level: int = level, known: dict = known) -> pa.Table:
            return pa.Table.from_batches(_ask(row, told, level, known, buckets))

        asked = _with_told(blocked, answers, ask, ASKED)
        answers = [*answers, materialise(asked.groupBy("bucket").applyInArrow(_answer, TOLD), "lm-told")]
        if level == 0:
            words, distinct, once, texts = (x or 0 for x in answers[0].agg(*[F.sum(F.col("sums")[i]) for i in range(4)]).first())
            totals = {"texts": texts, "words": words, "distinct": distinct, "unknown": (once + 1) / (words + texts + 2)}
    tree = Tree(blocked, answers)
    known = tree.levels[0].filter(F.col("gram") != EDGE).select("block", F.col("gram").alias("word"), F.col("n").alias("c"))
    return tree, known, totals


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10) -> DataFrame:
    """Train on the documents whose fold is not 0 and score all: one row per document."""
    kind = dict(docs.dtypes)[id_col]
    blocked = blocks(docs, id_col, text_col, folds)
    tree, _, totals = train(blocked)
    n, v = totals["words"] + totals["texts"], totals["distinct"] + (totals["texts"] > 0)
    whole = n + ADD * (v + 1)

    def run(row: pa.Table, told: Told) -> pa.Table:
        walk, sizes, held = opened(row)
        walked(walk, told, DEPTH + 1)
        counted = walk.count(0)
        token, starts = walk.depth > 0, np.cumsum(sizes) - sizes
        each = lambda x: np.add.reduceat(x[token], starts)
        ids = row.column("ids")[0].values
        return pa.table({
            "id": ids, "held_out": pa.array(held, pa.bool_()), "n_tokens": pa.array(sizes.astype(np.int64)),
            "n_known": pa.array(each((counted > 0).astype(np.int64))), "train_tokens": pa.array([n] * len(ids), pa.int64()),
            "base_score": pa.array(each(np.log10((counted + ADD) / whole))),
            "score": pa.array(each(np.log10(walk.probabilities(roots(walk, totals), DEPTH)))),
        })

    schema = f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return _with_told(blocked, tree.answers, run, schema, ("ids", *PARTS)).withColumnRenamed("id", id_col)
