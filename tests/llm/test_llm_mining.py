"""Hard negatives, conversation repair and decontamination against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import cases
import pytest
from pyspark.sql import functions as F

from ledgerbrook.llm import decontaminate, negatives, queries, repair

# Hard negatives

VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(seed: int = 1, n: int = 260) -> list[tuple]:
    draws = random.Random(seed)
    hot = [draws.gauss(0, 1) for _ in range(6)]
    rows = []
    for i in range(n):
        v = list(hot) if i % 5 == 0 else [round(draws.gauss(0, 1), 2) for _ in range(6)]
        rows.append((i, v, 1 if i % 3 == 0 else i % 4))
    rows += [
        (1000, None, 1), (1001, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (1002, [float("nan")] * 6, 2), (1003, [float("inf")] + [0.0] * 5, 2),
        (1004, hot, None), (1005, [0.0] * 6, 0), (1006, [], 0), (1007, [2.0, 1.0], 3), (None, hot, 1), (1008, [9.0] * 8, 2),
        (3, [5.0] * 6, 0), (1100, hot, 2), (1200, [], 1), (1300, [0.0] * 6, 2),
    ]
    return rows


def brute_negatives(rows: list[tuple], positives: int = 5, count: int = 5, percent: int = 80) -> set[tuple]:
    known: dict = {}
    for vec_id, vector, label in rows:
        if vec_id is None or vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        row = (label, [min(max(math.floor(256 * x), -(2**63)), 2**63 - 1) for x in vector])
        known[vec_id] = min(known.get(vec_id, row), row)
    out = set()
    for anchor, (label, vector) in known.items():
        if anchor % 100:
            continue
        scored = sorted(
            (-max(min(sum(a * b for a, b in zip(vector, v)), negatives.LONG), -negatives.LONG), i, other) for i, (other, v) in known.items() if i != anchor
        )
        for down, positive, _ in [s for s in scored if s[2] == label][:positives]:
            inside = [(d, i) for d, i, other in scored if other != label and percent * -down <= 100 * -d <= 100 * -down]
            out |= {(anchor, positive, rank, i, -down, -d) for rank, (d, i) in enumerate(inside[:count], 1)}
    return out


def mined(spark, rows, extra: bool = True, **options):
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    if extra:
        df = df.withColumns({c: F.lit("extra") for c in ("id", "q", "asks", "score", "anchor", "rank", "key", "row_block")})
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, label, **options)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("blocks", [(32_768, 8_192, 1_024), (40, 2, 16)])
def test_hard_negatives(spark, monkeypatch, blocks):
    for name, value in zip(("ROWS", "ANCHORS", "LEAST_ROWS"), blocks, strict=True):
        monkeypatch.setattr(negatives, name, value)
    rows = vectors()
    got = [tuple(r) for r in mined(spark, [*rows, rows[5], rows[5], rows[100]]).select(*COLUMNS).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_negatives(rows) and got


def test_hard_negatives_of_huge_components_and_of_nothing(spark):
    rows = [(i, [1e17 * (i % 3 - 1), 3e18 if i == 7 else float(i)], i % 2) for i in range(0, 330, 3)] + [(100, [3e38, 1.0], 1), (200, [2e37, 5.0], 1)]
    got = {tuple(r) for r in mined(spark, rows, extra=False).select(*COLUMNS).collect()}
    assert got == brute_negatives(rows) and got
    assert mined(spark, []).count() == 0


def test_windows_take_negatives_that_tie_with_a_positive():
    windows = negatives.Windows(2, 80)
    pairs = [(1, 10, 2, False), (1, 10, 3, False), (1, 10, 4, False), (1, 10, 5, True), (1, 9, 6, False), (1, 8, 7, True), (1, 8, 8, False),
             (2, -4, 1, True), (2, -4, 2, False), (3, 0, 1, False), (3, 0, 2, True)]
    assert [x for p in pairs for x in windows.take(*p)] == [(1, 5, 1, 2, 10, 10), (1, 5, 2, 3, 10, 10), (1, 7, 1, 8, 8, 8), (3, 2, 1, 1, 0, 0)]


# Conversation repair

TURNS = "conv_id long, turn long, role string, text string"


def brute_cheapest(turns: list[tuple[str, str]]) -> tuple[int, str]:
    """All states turn by turn, whole audits kept."""
    def inserted(best: dict) -> dict:
        for _ in range(2):
            for at, (cost, audit) in list(best.items()):
                label = (cost + 5, audit + "I")
                to = "a" if at == "u" else "u"
                best[to] = min(best.get(to, label), label)
        return best

    best = {"": (0, "")}
    for initial, fault in turns:
        new: dict = {}

        def offer(to, cost, audit):
            new[to] = min(new.get(to, (cost, audit)), (cost, audit))

        late = 5 if fault == "t" else 0
        for at, (cost, audit) in inserted(best).items():
            offer(at, cost + 2, audit + "D")
            if fault == "x":
                continue
            if initial in ("a" if at == "u" else "su" if at == "" else "u") and initial:
                offer(initial, cost + late, audit + "K")
            offer("a" if at == "u" else "u", cost + 1 + late, audit + "R")
        best = new
    ends = [best[""]] if "" in best else []
    ends += [inserted(best)["a"]] if "a" in inserted(best) else []
    return min(ends)


def test_search_finds_the_least_of_the_cheapest_audits():
    draws = random.Random(5)
    for _ in range(1500):
        turns = [(draws.choice("suuaaax "), draws.choice("---tx")) for _ in range(draws.randint(0, 9))]
        assert repair.cheapest(turns, repair.NOTHING, (repair.NOTHING, repair.ASSISTANT), True) == brute_cheapest(turns)


def conversations(seed: int = 2) -> list[tuple]:
    draws = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "ursula"]
    texts = ["yes.", "no", "what?", " \t\n", "", None, "go on!\x0b", "end\x1c", "a. b", "Σ é ü."]
    rows = []
    for conv in [*range(40), None]:
        for turn in range(draws.choice((0, 1, 2, 5, 9))):
            rows.append((conv, turn * draws.choice((1, 1, 2)) if draws.random() > 0.1 else None, draws.choice(roles[:2] + roles), draws.choice(texts)))
    for turn in range(150):  # a long one, with much in common
        rows.append((77, turn, ("user", "assistant")[turn % 2], draws.choice(texts)))
    rows += [(78, 1, "user", "x" * 300_000), (78, 2, "assistant", "y. " * 100_000), (79, None, None, None)]
    rows += [(80, t, "user", "same.") for t in range(60)] + [(81, 5, "assistant", "once more")] * 30
    return rows + rows[:3]


def damaged(rows: list[tuple]) -> dict:
    out: dict = {r[0]: [] for r in rows}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute_repair(turns: list[tuple]) -> tuple:
    turns = sorted(turns, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in turns:
        body = text.strip(" \t\n\x0b\x0c\r")
        faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "-")
        seen.add((role, text))
    cost, audit = brute_cheapest([(r[1][:1], "x" if f in "bd" else f) for r, f in zip(turns, faults, strict=True)])
    lines, at, before = [], 0, ""
    for edit in audit:
        role, text = ("", "") if edit == "I" else turns[at][1:]
        at += edit != "I"
        if edit != "D":
            role = role if edit == "K" else "assistant" if before == "u" else "user"
            before = role[0]
            lines.append(f"{role}:{text}")
    assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))
    numbers = [r[0] for r in turns if r[0] is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum((a[1][:1], b[1][:1]) not in {("s", "u"), ("u", "a"), ("a", "u")} for a, b in zip(turns, turns[1:]))
    return (gaps, *(faults.count(f) for f in "bdt"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


@pytest.mark.parametrize("piece", [256, 3, 1])
def test_repair(spark, piece):
    rows = conversations()
    df = spark.createDataFrame(rows, TURNS).repartition(3)
    expected = {conv: brute_repair(turns) for conv, turns in damaged(rows).items()}
    got = repair.repair(repair.damage(df), F.col("copies"), piece=piece).collect()
    assert len(got) == len(expected)
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == expected


def test_repair_of_clashing_columns_and_of_nothing(spark):
    rows = conversations()[:30]
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("extra") for c in ("id", "sign", "n", "first", "copies", "later", "part")})
    expected: dict = {}
    for conv, turn, role, text in rows:
        expected.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    got = repair.repair(df).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == {c: brute_repair(t) for c, t in expected.items()}
    assert repair.repair(df.limit(0)).count() == 0


def test_stream_forgets_pieces_on_which_all_ways_agree():
    draws = random.Random(3)
    turns = [(draws.choice("uuaaas"), draws.choice("----tx")) for _ in range(900)]
    joined, audits, most = repair.Joined(), [], 0
    for number in range(0, 900, 5):
        found = [repair.cheapest(turns[number : number + 5], a, (b,), False) for a in repair.NODES for b in repair.NODES]
        joined.add((0, number), [f and f[0] for f in found], [f and f[1] for f in found])
        audits += [a for _, a in joined.agreed()]
        most = max(most, len(joined.waiting))
    rest = joined.finish()
    assert ("".join(audits) + "".join(a for _, a, _ in rest), rest[-1][2]) == brute_cheapest(turns)[::-1]
    assert most < 40


# Decontamination

def plain(text) -> list[str]:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def leaks(seed: int = 4) -> tuple[list[tuple], list[tuple]]:
    draws = random.Random(seed)
    items = [(i, cases.sentence(draws, ("en", "de", "fr")[i % 3], draws.choice((10, 11, 25, 60)))) for i in range(12)]
    shared = items[3][1]
    items += [(20, f"begin {shared} end"), (21, shared), (22, "Um, zu"), (23, "eins zwei drei vier fünf sechs sieben"), (24, None), (25, " ...\n"),
              (None, items[5][1] + " mehr"), (3, shared), (100, "ab " * 14), (9, "Solo")]
    docs = cases.rows(n=40)
    for k in range(50):
        words = items[draws.randrange(12)][1].split()
        first = draws.randrange(len(words))
        part = " ".join(words[first : first + draws.choice((4, 8, 9, 10, 11, 30))])
        docs.append((500 + k, f"{cases.sentence(draws, 'en', 6)}, {part.upper()}! {cases.sentence(draws, 'en', 30)}", "en", "hot", 1))
    docs += [(600, f"{items[0][1]} {items[1][1]}", "en", "x", 1), (601, "um ZU", "de", "x", 1), (602, "ab-ab " * 30, "en", "x", 1), (603, "solo solo", "en", "x", 1)]
    docs += [(700 + k, f"x {shared}", "en", "hot", 1) for k in range(30)] + [docs[-1]] * 3
    return docs, items


def brute_leaks(docs, items, window: int = 10) -> list[tuple]:
    found: dict = {}
    for item, text in items:
        words = plain(text)
        n = min(len(words), window)
        for i in range(len(words) - n + 1 if n else 0):
            found.setdefault(tuple(words[i : i + n]), set()).add("" if item is None else str(item))
    lengths = {len(w) for w in found}
    out = []
    for doc_id, text, *_ in docs:
        words, hit, names = plain(text), set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if here := found.get(tuple(words[i : i + n])):
                    hit |= set(range(i, i + n))
                    names |= here
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(names), digest, bool(hit)))
    return out


@pytest.mark.parametrize("broadcast", [True, False])
def test_decontamination(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(decontaminate, "small", lambda df: False)
        monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", -1)
    docs, items = leaks()
    extra = {c: F.lit("extra") for c in ("h1", "words", "runs", "len", "class", "item", "set", "spans")}
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumns(extra)
    got = decontaminate.report(cases.table(spark, docs).withColumns(extra), benchmark)
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=key) == sorted(brute_leaks(docs, items), key=key)


def test_clean_keeps_rows_without_a_window_and_all_their_columns(spark):
    docs, items = leaks()
    df = cases.table(spark, docs)
    benchmark = spark.createDataFrame([i for i in items if i[0] != 9], "item_id long, text string")
    kept = decontaminate.clean(df, benchmark)
    assert kept.columns == df.columns
    bad = {(r[0], r[1]) for r, found in zip(docs, brute_leaks(docs, [i for i in items if i[0] != 9]), strict=True) if found[-1]}
    expected = [(r[0], r[1]) for r in docs if (r[0], r[1]) not in bad]
    order = lambda r: (r[0] is not None, r[0] or 0, r[1] or "")
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=order) == sorted(expected, key=order)
    assert decontaminate.clean(df, benchmark.limit(0)).count() == len(docs)
    assert decontaminate.report(df.limit(0), benchmark).count() == 0


def test_shared_spans_of_a_window_always_meet(spark):
    """Each window of a text alone is found in it."""
    draws = random.Random(9)
    words = [draws.choice("abcdef") for _ in range(60)]
    benchmark = spark.createDataFrame([(i, " ".join(words[i : i + 10])) for i in range(51)], "item_id long, text string")
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    base, found = decontaminate.find(docs, benchmark)
    row = found.first()
    assert row["n_hit"] == 60 and len(row["items"]) == 51 and len(row["spans"]) == 51
    assert base.first()["n_words"] == 60


def test_native_plan_has_no_python(spark):
    """Documents and benchmark are joined by SQL functions alone."""
    df = queries.QUERIES["op13_decontaminate"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
