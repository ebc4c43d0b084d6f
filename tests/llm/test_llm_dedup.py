"""Exact copies, repeated passages and near copies against brute force."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import cases
import numpy as np
import pyarrow as pa
import pytest

from ledgerbrook.llm import exact_dedup, jaccard, substring
from ledgerbrook.llm.components import components


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_groups(spark, keep):
    data = cases.rows()
    groups = defaultdict(list)
    for r in data:
        groups[r[1] or ""].append(r[0])
    order = (lambda ids: max(ids, key=lambda i: (i is not None, i))) if keep == "largest" else (lambda ids: min(i for i in ids if i is not None))
    got = exact_dedup.duplicate_groups(cases.table(spark), keep=keep).collect()
    expected = Counter()
    for r in data:
        ids = groups[r[1] or ""]
        stays = order(ids) if any(i is not None for i in ids) else None
        expected[(r[0], stays, len(ids), r[0] == stays, hashlib.sha256((r[1] or "").encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in got) == expected


def test_exact_dedup_keeps_whole_rows(spark):
    df = cases.table(spark)
    got = exact_dedup.deduplicate(df)
    assert got.columns == df.columns
    stays = {}
    for r in cases.rows():
        key = r[1] or ""
        if key not in stays or (r[0] is not None and (stays[key] is None or r[0] > stays[key])):
            stays[key] = r[0]
    kept = got.collect()
    assert Counter((r["text"] or "", r["doc_id"]) for r in kept) == Counter(stays.items())
    assert {r["id"] for r in kept} <= {f"extra {r[3] or '-'}" for r in cases.rows()}


def test_exact_dedup_of_nothing(spark):
    empty = cases.table(spark, [])
    assert exact_dedup.deduplicate(empty).count() == exact_dedup.duplicate_groups(empty).count() == 0


def brute_substring(data: list[tuple], window: int) -> dict:
    first: dict = {}
    for r in data:
        w = cases.words(r[1])
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, r[0]), r[0])
    out = {}
    for r in data:
        w = cases.words(r[1])
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < r[0]:
                gone.update(range(i, i + window))
        out[r[0]] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


@pytest.mark.parametrize("window", [7, 50])
def test_substring_dedup(spark, window):
    data = cases.unique(cases.rows())
    got = substring.remove_repeats(cases.table(spark, data), window).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in got} == brute_substring(data, window)
    digests = substring.remove_repeats(cases.table(spark, data), window, digest=True).collect()
    assert {r["doc_id"]: r["kept_sha256"] for r in digests} == {r["doc_id"]: hashlib.sha256(r["kept"].encode()).hexdigest() for r in got}


def test_substring_overlaps_at_every_offset(spark):
    """Pieces of one long text cut at many offsets, periodic text, and repeats inside one document."""
    import random

    draws = random.Random(5)
    base = [f"w{draws.randint(0, 40)}" for _ in range(400)]
    data = [(k, " ".join(base[draws.randint(0, 200) :][: draws.randint(10, 200)]), None, None, None) for k in range(30)]
    data += [(40, "a b c " * 60, None, None, None), (41, "b c a " * 50, None, None, None), (42, " ".join(base[:120] * 2), None, None, None)]
    got = substring.remove_repeats(cases.table(spark, data, extra=False), 20).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in got} == brute_substring(data, 20)


def test_substring_null_and_repeated_ids(spark):
    data = cases.rows()
    got = substring.remove_repeats(cases.table(spark)).collect()
    assert len(got) == len(data)
    assert all(r["n_removed"] == 0 for r in got if r["doc_id"] is None)
    assert substring.remove_repeats(cases.table(spark, [])).count() == 0


def brute_jaccard(data: list[tuple]) -> dict:
    sets = {}
    for r in data:
        w = cases.words((r[1] or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[r[0]] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_jaccard_components(spark):
    data = cases.unique(cases.rows())
    got = jaccard.near_duplicates(cases.table(spark, data)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_jaccard(data)


def chain(n: int = 150) -> list[tuple]:
    """Near copies that drift, so that far members are linked only through others; and a large cluster."""
    import random

    draws = random.Random(8)
    words = [f"w{i}" for i in range(120)]
    data = []
    for k in range(n):
        words = list(words)
        words[draws.randrange(120)] = f"n{k}"
        data.append((k, " ".join(words), None, None, None))
    for k in range(n):
        copy = [f"c{i}" for i in range(90)]
        copy[draws.randrange(90)] = f"m{k}"
        data.append((1000 + k, " ".join(copy), None, None, None))
    return data


def test_jaccard_chains_and_cut_tiles(spark, monkeypatch):
    data = chain()
    expected = brute_jaccard(data)
    for tile in (20_000, 25):
        monkeypatch.setattr(jaccard, "TILE", tile)
        got = jaccard.near_duplicates(cases.table(spark, data, extra=False)).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected


def test_jaccard_awkward_rows(spark):
    df = cases.table(spark)
    got = jaccard.near_duplicates(df).collect()
    assert len(got) == len(cases.rows())
    assert all(r["component_id"] is None for r in got if r["doc_id"] is None)
    one = jaccard.one_of_each(df)
    assert one.columns == df.columns
    ids = [r["doc_id"] for r in one.select("doc_id").collect()]
    assert set(ids) - {None} == {r["component_id"] for r in got} - {None}
    assert jaccard.near_duplicates(cases.table(spark, [])).count() == 0


def test_rtree_bound_finds_what_a_scan_finds():
    draws = np.random.default_rng(2)
    counts = draws.poisson(3, (300, jaccard.GROUPS))
    counts[150:] = counts[:150] + (draws.random((150, jaccard.GROUPS)) < 0.1)
    ids = draws.permutation(300)
    tree = jaccard.RTree(counts, ids)
    sizes = counts.sum(axis=1)
    for i in range(300):
        overlap = np.minimum(counts, counts[i]).sum(axis=1)
        fits = set(ids[175 * overlap >= 75 * (sizes + sizes[i])].tolist())
        assert set(tree.ids[tree.all(counts[i], sizes[i])].tolist()) == fits
        below = {x for x in fits if x < ids[i]}
        assert tree.smallest(counts[i], sizes[i], int(ids[i])) == (min(below) if below else None)


def test_rtree_leaves_out_one_component():
    draws = np.random.default_rng(4)
    counts = draws.poisson(3, (1, jaccard.GROUPS)) + (draws.random((400, jaccard.GROUPS)) < 0.05)
    ids = draws.permutation(400)
    component = np.where(ids % 3 > 0, 7, ids)
    tree, sizes = jaccard.RTree(counts, ids, component), counts.sum(axis=1)
    for i in range(0, 400, 7):
        fits = 175 * np.minimum(counts, counts[i]).sum(axis=1) >= 75 * (sizes + sizes[i])
        expected = set(ids[fits & (component != component[i])].tolist())
        assert set(tree.ids[tree.all(counts[i], sizes[i], component[i])].tolist()) == expected


def test_jaccard_links_without_a_common_band(spark):
    """Pairs at exactly 75 %: 30 shingles shared, five more on each side."""
    data = []
    for k in range(400):
        common = " ".join(f"p{k}w{i}" for i in range(34))
        for side in "ab":
            data.append((len(data), common + " " + " ".join(f"{side}{k}x{i}" for i in range(5)), None, None, None))
    bands = [set(jaccard.bands(jaccard.shingles(r[1])).tolist()) for r in data]
    apart = [k for k in range(400) if not bands[2 * k] & bands[2 * k + 1]]
    assert apart
    got = jaccard.near_duplicates(cases.table(spark, data, extra=False)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {i: (35, i - i % 2) for i in range(800)}


def alike(n: int, size: int, changed: int, seed: int = 5) -> list[str]:
    """Texts that share most of their words with one text, yet less with each other."""
    draws = np.random.default_rng(seed)
    texts = []
    for k in range(n):
        words = [f"b{i}" for i in range(size)]
        for at in draws.choice(size, changed, replace=False):
            words[at] = f"n{k}x{at}"
        texts.append(" ".join(words))
    return texts


def tile_batch(texts: list[str], **more) -> pa.RecordBatch:
    found = [jaccard.shingles(t) for t in texts]
    n = len(texts)
    columns = {"key": np.zeros(n, np.int64), "piece": np.zeros(n, np.int64), "id": np.arange(n), "component": np.arange(n),
               "part": np.zeros(n, np.int64), "alone": np.ones(n, bool), "point": [jaccard.point(f) for f in found],
               "fine": [jaccard.fine(f) for f in found], "set": [f.view(np.int64) for f in found]}
    return pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})


def test_jaccard_rows_of_a_tile_do_not_grow_with_its_pairs():
    """60 texts that are alike give a row each, not one per pair; 60 linked ones the links that join them."""
    tile = tile_batch(alike(60, 400, 8))
    near = [b for b in jaccard._between(iter([tile]))]
    assert sum(b.num_rows for b in near) == 60
    links = [b for b in jaccard._joining(iter([tile_batch(alike(60, 400, 2))]))]
    assert sum(b.num_rows for b in links) == 59
    assert sum(b.num_rows for b in jaccard._joining(iter([tile_batch(alike(20, 400, 20))]))) == 0


def test_fine_sizes_lose_no_link_and_tell_long_texts_apart():
    draws = np.random.default_rng(9)
    for n in (1000, 1400, 5000, 20_000):
        whole = draws.integers(0, 1 << 64, n, np.uint64)
        for gone in (0, 1, n // 8, n // 4):
            part = whole[gone:]
            assert jaccard.may_link(jaccard.fine(whole), jaccard.fine(part), len(whole) + len(part))
        other = draws.integers(0, 1 << 64, n, np.uint64)
        assert jaccard.may_link(jaccard.fine(whole), jaccard.fine(other), 2 * n) == (n <= 1024)
    assert jaccard.may_link(jaccard.fine(np.full(3000, 7, np.uint64)), jaccard.fine(np.full(2900, 7, np.uint64)), 5900)


def test_jaccard_moves_prefixes_of_few_documents(spark, monkeypatch):
    """Only rows whose label changes, and few others, go through the join that labels them."""
    stored, real = {}, jaccard.materialise
    monkeypatch.setattr(jaccard, "materialise", lambda df, name: stored.setdefault(name, real(df, name)))
    found = spark.createDataFrame([(i, 3, i % 2, i, [i, -i]) for i in range(2000)], "id long, n long, s1 long, s2 long, prefix array<long>")
    moved = [(i, 3, i % 2, i, i if i < 30 else 0, 5 if i < 30 else None) for i in range(40)]
    moved = spark.createDataFrame(moved, "id long, n long, s1 long, s2 long, class_id long, component long")
    got = {r["id"]: (r["component"], r["prefix"]) for r in jaccard._labelled(found, moved).collect()}
    assert got == {i: (5 if i < 30 else i, [i, -i]) for i in range(2000) if not 30 <= i < 40}
    assert stored["jaccard-labelled"].count() <= 40


def test_jaccard_holders_take_one_python_worker_a_task(spark):
    """Rows are told apart and their shingles picked in one Python pass, on the way round the join too."""
    found = spark.createDataFrame([(i, 3, 0, i, [i % 5, 100 + i]) for i in range(50)], "id long, n long, s1 long, s2 long, prefix array<long>")
    moved = spark.createDataFrame([(i, 3, 0, i, 0, 7) for i in range(10)], "id long, n long, s1 long, s2 long, class_id long, component long")
    several = spark.createDataFrame([(1, 1), (2, 2)], "shingle long, key long")
    got = jaccard._holders(*jaccard._parted(found, moved), several)
    rows = sorted((r["shingle"], r["id"], r["component"]) for r in got.collect())
    assert rows == sorted((i % 5, i, 7 if i == 0 else i) for i in [0, *range(10, 50)] if i % 5 in (1, 2))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_jaccard_of_texts_alike_and_long(spark, monkeypatch):
    """Families on either side of the bound, short and long, in whole and in cut tiles."""
    texts = [t for size, changed in ((400, 6), (400, 8), (150, 2), (2500, 40), (2500, 50)) for t in alike(12, size, changed, size + changed)]
    data = [(i, t, None, None, None) for i, t in enumerate(texts)]
    expected = brute_jaccard(data)
    assert len({c for _, c in expected.values()}) > 5
    for limits in ({}, {"TILE": 5, "SHINGLES": 2000}):
        for name, value in limits.items():
            monkeypatch.setattr(jaccard, name, value)
        got = jaccard.near_duplicates(cases.table(spark, data, extra=False)).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected


def test_marks_hold_every_place(spark):
    places = [0, 1, 7, 8, 32767, 32768, 70_000, jaccard.MARKS - 1]
    bits = jaccard._marks(spark.createDataFrame([(p,) for p in places], "at long"))
    some = np.unique([max(0, p - 1) for p in places] + places + [5, 99])
    assert some[jaccard._marked(bits, some)].tolist() == places
    assert not any(jaccard._marks(spark.createDataFrame([], "at long")))


def test_prefixes_of_linked_sets_meet():
    draws = np.random.default_rng(6)
    common = draws.integers(0, 9, jaccard.SKETCH).astype(np.uint8)
    for n in (1, 2, 3, 4, 7, 8, 40, 333):
        for gone in range(n // 4 + 1):
            whole = draws.integers(-(1 << 63), (1 << 63) - 1, n)
            part = whole[draws.permutation(n)[gone:]]
            if 100 * len(part) >= 75 * n:
                assert np.intersect1d(jaccard.prefix(whole, common), jaccard.prefix(part, common)).size
    assert len(jaccard.prefix(np.empty(0, np.int64), common)) == 0


def test_components_of_paths_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    expected = {i: 0 for i in range(41)} | {100: 100} | {k: 100 for k in range(101, 160)} | {k: 200 for k in (200, 201, 202)} | {300: 300}
    assert {r["node"]: r["component"] for r in got} == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
