"""Benchmark decontamination by winnowing, with SQL functions alone.

A benchmark window is a run of ``window`` words of an item; an item of fewer words is one window. Every window
of a text has a fingerprint: the least hash of the half-length runs inside it. Equal windows have equal fingerprints
wherever they stand, so a shared span of a window's length or more always meets, and neighbouring windows mostly share a
fingerprint, so only about two of seven are kept: for each run of neighbouring windows with one fingerprint
the value, the first window and the one after the last. Documents' fingerprints are joined with the benchmark's, hits are
extended to their whole windows, and those are compared word by word.

Documents are told apart by two 64-bit hashes of id and text, so rows that are alike share a result. The
items that hold a window are never listed per document: windows in the same items form a class, documents with the
same set of classes share one list. Joins broadcast a table only after its size was measured; beyond that a key that
many rows hold is dealt over parts of average size.

Defined results: a null or empty text has no words and is clean; an item without words is in no document; a null
item id counts as the empty text, and rows that repeat an item id are one item; rows that repeat a document stay, each with the
same result; null and repeated document ids are allowed; ties cannot occur, all windows count; texts are read
whole whatever their length; an empty table of documents gives no rows, an empty benchmark finds nothing.
``clean`` passes all columns through, whatever their names; other columns are ignored elsewhere.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerbrook.llm.common import BROADCAST_BYTES, empty_if_null, join_spread, small
from ledgerbrook.session import materialise

#: Letters and digits of ASCII and everything beyond it.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
KEY = ["h1", "h2"]


def words(text: Column) -> Column:
    """Words in order, A-Z lower-cased."""
    lower = F.translate(empty_if_null(text), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def _rolled(df: DataFrame, source: str, name: str, length: int, fold) -> DataFrame:
    """Add ``name``: the fold of every run of ``length`` neighbours, in doubling steps.

    Values whose run leaves the array are at its end and mean nothing; the caller cuts them off.
    """
    now, df = 1, df.withColumn(name, F.col(source))
    while now < length:
        step = min(now, length - now)
        shifted = F.slice(F.col(name), step + 1, F.greatest(F.size(name), F.lit(1)))
        df = df.withColumn(name, F.zip_with(F.col(name), shifted, fold))
        now += step
    return df


def fingerprints(df: DataFrame, length: int, name: str) -> DataFrame:
    """Add ``name``: the fingerprint of every window of ``length`` words of ``hashes``."""
    half = (length + 1) // 2
    df = _rolled(df, "hashes", "__grams", half, lambda a, b: F.xxhash64(a, b))
    df = _rolled(df, "__grams", name, length - half + 1, lambda a, b: F.least(a, b))
    return df.withColumn(name, F.slice(name, 1, F.greatest(F.size("hashes") - (length - 1), F.lit(0)))).drop("__grams")


def _runs(values: str, length: int, starts: str) -> Column:
    """(length, fingerprint, first window, the one after the last) of each run of equal fingerprints."""
    following = F.slice(F.col(starts), 2, F.greatest(F.size(starts), F.lit(1)))
    return F.zip_with(starts, following, lambda s, e: F.struct(
        F.lit(length).alias("len"), F.get(values, s).alias("f"), s.alias("s"), F.coalesce(e, F.size(values)).alias("e")))


def _starts(values: str) -> Column:
    places = F.when(F.size(values) > 0, F.sequence(F.lit(0), F.size(values) - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(places, lambda i: (i == 0) | (F.get(values, i) != F.get(values, i - 1)))


def _text_of(all_words: Column, start: Column, length: Column | int) -> Column:
    return F.array_join(F.slice(all_words, start + 1, length), " ")


def item_windows(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """(len, f, text, item): the distinct windows of every item with their fingerprints, stored."""
    rows = items.select(empty_if_null(F.col(id_col).cast("string")).alias("item"), words(F.col(text_col)).alias("words"))
    rows = rows.withColumn("len", F.least(F.size("words"), F.lit(window))).filter("len > 0")
    rows = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    parts = []
    for length in range(1, window + 1):
        one = fingerprints(rows.filter(F.col("len") == length), length, "f")
        both = F.transform("f", lambda f, i: F.struct(f.alias("f"), _text_of(F.col("words"), i, length).alias("text")))
        parts.append(one.select("len", "item", F.inline(both)))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return materialise(union.groupBy("len", "f", "text", "item").agg(F.lit(1).alias("one")).drop("one"), "leaks-windows")


def _probe(rows: DataFrame, unique: DataFrame, keys: list[str], place: list[str]) -> DataFrame:
    """Join stored ``rows`` with stored ``unique`` rows, one per key; keys of many rows are cut into parts."""
    if small(unique):
        return rows.join(F.broadcast(unique), keys)
    counts = rows.groupBy(*keys).agg(F.count("*").alias("__n"))
    counted = materialise(counts.join(unique, keys), "leaks-counted")
    return join_spread(rows, counted, keys, "__n", [F.col(c) for c in place])


def _key(id_col: str, text_col: str) -> list[Column]:
    pair = [F.col(id_col), empty_if_null(F.col(text_col))]
    return [F.xxhash64(*pair).alias("h1"), F.xxhash64(F.lit(1), *pair).alias("h2")]


def find(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
         item_id_col: str = "item_id", item_text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(all documents, what was found), both keyed by h1 and h2.

    The first has the id as ``id`` and n_words, one row per document; the second one row per key with hits: spans, the
    sorted array of (s, len) of all windows found, n_hit, and the array ``items``, sorted as text.
    """
    known = item_windows(items, window, item_id_col, item_text_col)
    lengths = sorted(r[0] for r in known.select("len").distinct().collect())
    rows = docs.select(F.col(id_col).alias("id"), *_key(id_col, text_col), words(F.col(text_col)).alias("words"))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    rows = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))).drop("words")
    for length in lengths:
        rows = fingerprints(rows, length, f"f{length}").withColumn(f"s{length}", _starts(f"f{length}"))
    runs = [_runs(f"f{n}", n, f"s{n}") for n in lengths]
    none = F.array().cast("array<struct<len:int,f:bigint,s:int,e:int>>")
    base = materialise(rows.select("id", *KEY, "n_words", F.concat(none, *runs).alias("runs")), "leaks-documents")

    wanted = materialise(known.select("len", "f").distinct(), "leaks-fingerprints")
    met = _probe(base.select(*KEY, F.inline("runs")), wanted, ["len", "f"], [*KEY, "s"])
    hits = materialise(met.groupBy(*KEY).agg(F.collect_set(F.struct("len", "s", "e")).alias("runs")), "leaks-hits")

    # Hits are extended to whole windows, whose words are then compared.
    texts = docs.select(*_key(id_col, text_col), F.col(text_col).alias("text"))
    held = hits.agg(F.sum(F.size("runs") * 16 + 32)).first()[0] or 0
    if held <= BROADCAST_BYTES:
        again = texts.join(F.broadcast(hits), KEY)
    else:
        counts = base.groupBy(*KEY).agg(F.count("*").alias("__n"))
        counted = materialise(counts.join(hits, KEY), "leaks-counted-hits")
        again = join_spread(texts, counted, KEY, "__n", [F.monotonically_increasing_id()])
    again = again.withColumn("words", words(F.col("text"))).drop("text")
    whole = F.flatten(F.transform("runs", lambda r: F.transform(
        F.sequence(r["s"], r["e"] - 1),
        lambda s: F.struct(r["len"].alias("len"), s.alias("s"), _text_of(F.col("words"), s, r["len"]).alias("text")))))
    candidates = materialise(again.select(*KEY, F.inline(whole)), "leaks-candidates")

    # Windows of the same items form a class, named by a hash of its set of items.
    signs = [F.count("*").cast("string"), F.bit_xor(F.xxhash64("item")).cast("string"), F.bit_xor(F.xxhash64(F.lit(1), "item")).cast("string")]
    classed = known.groupBy("len", "text").agg(F.md5(F.concat_ws(":", *signs)).alias("class"))
    classed = materialise(classed, "leaks-classes")
    one_of = classed.groupBy("class").agg(F.min(F.struct("len", "text")).alias("w")).select("class", "w.len", "w.text")
    members = _probe(known.select("len", "text", "item"), materialise(one_of, "leaks-class-windows"), ["len", "text"], ["item"])
    members = materialise(members.select("class", "item"), "leaks-members")

    found = _probe(candidates, classed, ["len", "text"], [*KEY, "s"])
    spans = F.sort_array(F.collect_set(F.struct("s", "len")))
    per = found.groupBy(*KEY).agg(spans.alias("spans"), F.sort_array(F.collect_set("class")).alias("classes"))
    per = materialise(per.withColumn("set", F.md5(F.concat_ws(":", "classes"))), "leaks-found")
    sets = per.groupBy("set").agg(F.first("classes").alias("classes")).select("set", F.explode("classes").alias("class"))
    lists = sets.join(members, "class").groupBy("set").agg(F.sort_array(F.collect_set("item")).alias("items"))
    lists = materialise(lists, "leaks-sets")
    per = _probe(per.drop("classes"), lists, ["set"], KEY)
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, x: F.struct(
            F.greatest(acc["end"], x["s"] + x["len"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), x["s"] + x["len"] - F.greatest(acc["end"], x["s"]))).alias("n")),
        lambda acc: acc["n"])
    return base.drop("runs"), materialise(per.select(*KEY, "spans", covered.alias("n_hit"), "items"), "leaks-result")


def report(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
           item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256 and contaminated."""
    base, found = find(docs, items, window, id_col, text_col, item_id_col, item_text_col)
    short = found.select(*KEY, "n_hit", F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"))
    short = materialise(short, "leaks-short")
    rows = base.join(F.broadcast(short) if small(short) else short, KEY, "left")
    none = F.sha2(F.lit(""), 256)
    return rows.select(
        F.col("id").alias(id_col), "n_words", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_hit", "n_items")],
        F.coalesce("items_sha256", none).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
          item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, that hold no window of any item."""
    _, found = find(docs, items, window, id_col, text_col, item_id_col, item_text_col)
    inner = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    names = dict(zip(docs.columns, inner.columns, strict=True))
    keyed = inner.select("*", *_key(names[id_col], names[text_col]))
    keys = materialise(found.select(*KEY), "leaks-keys")
    kept = keyed.join(F.broadcast(keys) if small(keys) else keys, KEY, "left_anti")
    return kept.select(*[F.col(c).alias(name) for name, c in names.items()])
