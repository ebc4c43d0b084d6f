"""Language ID, BPE, the language model, page texts and nearest neighbours."""

from __future__ import annotations

import gc
import hashlib
import math
import random
import struct
import zlib
from collections import Counter

import cases
import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerbrook.llm import ann, bpe, common, html, langid, lm
from ledgerbrook.llm.common import fold
from ledgerbrook.llm.queries import VOCABULARY

# ---- language ID


def languages(n: int = 240) -> list[tuple]:
    draws = random.Random(4)
    return [(i, cases.sentence(draws, lang, 60), lang, "s", None) for i in range(n) for lang in [("en", "de", "fr")[i % 3]]]


def test_language_id_on_held_out_texts(spark):
    docs = cases.table(spark, languages(), extra=False)
    held_out = fold(F.col("doc_id"), 3) == 1
    found = langid.identify(docs, langid.fit(docs.filter(~held_out))).join(docs.filter(held_out), "doc_id").collect()
    assert len(found) > 50
    assert sum(r["lang_pred"] == r["lang"] for r in found) >= 0.97 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_id_awkward_rows(spark):
    docs = cases.table(spark)
    dictionaries = langid.fit(cases.table(spark, languages(), extra=False))
    found = langid.identify(docs, dictionaries).collect()
    assert len(found) == len(cases.rows())
    no_letters = {300, 301, 302, 303}
    for r in found:
        if r["doc_id"] in no_letters:
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        elif r["doc_id"] is not None:
            assert r["lang_pred"] in dictionaries
    kept = langid.keep_identified(docs, dictionaries)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in found if not r["rejected"])


def test_language_id_capitals_repetition_and_length():
    draws = random.Random(6)
    classifier = langid.Classifier({k: langid.letters(cases.sentence(draws, k, 3000)) for k in cases.SYLLABLES})
    for lang in cases.SYLLABLES:
        text = cases.sentence(draws, lang, 40)
        assert classifier.predict(text.upper() + "!!!")[0] == lang
        assert classifier.predict((text + " ") * 400)[0] == lang
        assert classifier.predict(cases.sentence(draws, lang, 30_000))[0] == lang


def test_language_of_most_words_wins_over_that_of_most_different_words():
    draws = random.Random(8)
    classifier = langid.Classifier({k: langid.letters(cases.sentence(draws, k, 20_000)) for k in cases.SYLLABLES})
    few = cases.sentence(draws, "en", 100).split()
    text = " ".join(draws.choices(few, k=810)) + " " + " ".join(dict.fromkeys(cases.sentence(draws, "de", 160).split()))
    assert classifier.predict(text)[0] == "en"
    assert langid.letters("Ab ab, 1 AB") == b"ab ab ab"


def test_prediction_equals_plain_compression():
    """Sizes with each dictionary, added up piece by piece in plain Python."""
    draws = random.Random(9)
    dictionaries = {k: langid.letters(cases.sentence(draws, k, 4000)) for k in cases.SYLLABLES}
    classifier = langid.Classifier(dictionaries)
    for lang in [*cases.SYLLABLES] * 4:
        text = cases.sentence(draws, lang, draws.choice((3, 20, 400))) + " " + cases.sentence(draws, "en", draws.choice((0, 10)))
        words = " ".join(langid.LETTERS.findall(text.lower())).encode()
        for level in langid.LEVELS:
            sizes = {}
            for name, content in dictionaries.items():
                raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                packer = zstandard.ZstdCompressor(level=level, dict_data=raw, write_content_size=False, write_dict_id=False)
                sizes[name] = sum(len(packer.compress(words[i : i + langid.PIECE])) for i in range(0, len(words), langid.PIECE))
            (least, best), (following, _) = sorted((n, name) for name, n in sizes.items())[:2]
            if 1 - least / following > langid.MARGIN:
                break
        found = classifier.predict(text)
        assert found[0] == best and abs(found[1] - following / (following + least)) < 1e-12


def test_letter_salad_is_rejected_and_clean_texts_are_not(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    classifier = langid.Classifier(langid.fit(docs.filter(fold(F.col("doc_id"), 3) != 1)))
    clean = docs.filter((fold(F.col("doc_id"), 15) == 1) & F.col("text").rlike(r"[A-Za-z]{3}.*[A-Za-z]{3}")).select("text", "lang").collect()
    found = [classifier.predict(r["text"]) for r in clean]
    assert len(found) > 400 and sum(f[3] for f in found) < 0.01 * len(found)
    assert sum(f[0] == r["lang"] for f, r in zip(found, clean, strict=True)) >= 0.985 * len(found)
    draws = random.Random(2)
    words = lambda n: ["".join(draws.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draws.randint(2, 9))) for _ in range(n)]
    salad = [" ".join(words(draws.choice((5, 20, 80, 300)))) for _ in range(200)]
    assert sum(classifier.predict(t)[3] for t in salad) >= 0.95 * len(salad)


def test_draw_of_rows_without_an_id_is_bounded(spark):
    """A third of the rows are one row, another third have no id: the drawn pieces stay near the bound."""
    data = [(i, cases.sentence(random.Random(i), "en", 300), "en", "s", None) for i in range(900)]
    data += [(None, cases.sentence(random.Random(-i), "en", 300), "en", "s", None) for i in range(1, 901)] + [(5, data[5][1], "en", "s", None)] * 900
    dictionaries = langid.fit(cases.table(spark, data, extra=False))
    assert 0.5 * langid.DICT_BYTES < len(dictionaries["en"]) <= langid.DICT_BYTES


def test_language_id_without_labels(spark):
    assert langid.fit(cases.table(spark, [])) == {}
    found = langid.identify(cases.table(spark), {}).collect()
    assert {r["lang_pred"] for r in found} == {"und"}
    assert langid.Classifier({"en": b"the"}).predict("anything")[:2] == ("en", 1.0)
    assert langid.identify(cases.table(spark, []), {"en": b"the"}).count() == 0


def test_language_id_leaves_nothing_in_a_worker_and_bounds_its_batches(spark):
    """Batches are cut by their bytes, and no classifier waits in a worker for its next task."""
    dictionaries = langid.fit(cases.table(spark, languages(), extra=False))
    docs = cases.table(spark, [(i, cases.sentence(random.Random(i), "en", 50_000), "en", "s", None) for i in range(24)], extra=False).coalesce(1)
    before = spark.conf.get(common.BATCHES, None)
    spark.conf.unset(common.BATCHES)
    try:
        assert langid.keep_identified(docs, dictionaries).count() == 24
        assert spark.conf.get(common.BATCHES) == str(common.BATCH_BYTES)

        def seen(batches):
            kept = sum(type(x).__name__ == "Classifier" for x in gc.get_objects())
            yield from (pa.RecordBatch.from_pydict({"bytes": [b.nbytes], "kept": [kept]}) for b in batches)

        found = docs.select("text").mapInArrow(seen, "bytes long, kept long").collect()
        longest = max(r["n"] for r in docs.select(F.octet_length("text").alias("n")).collect())
        assert len(found) > 1 and max(r["bytes"] for r in found) < common.BATCH_BYTES + 2 * longest
        assert not any(r["kept"] for r in found)
        spark.conf.set(common.BATCHES, "1m")
        langid.identify(docs, dictionaries)
        assert spark.conf.get(common.BATCHES) == "1m"
    finally:
        spark.conf.unset(common.BATCHES) if before is None else spark.conf.set(common.BATCHES, before)


# ---- BPE


def odd_texts() -> list[str]:
    draws = random.Random(9)
    alphabet = "abcdeABC 's'tll'd.,!?-_*%1234½²٣é ÀßΣςİıǅﬁ你好世界🙂👍🏽नमस्ते\t\n\x85\xa0 ​\x1c\x00́"
    texts = ["".join(draws.choice(alphabet) for _ in range(draws.randint(0, 60))) for _ in range(1500)]
    texts += ["a" * n for n in range(1, 60)] + ["ab" * 40, "!?" * 30, "the" * 25, "<|endoftext|>", "<|startoftext|>a<|endoftext|>B", "<|endoftext", "x<|ENDOFTEXT|>"]
    return texts


def test_bpe_equals_the_library():
    library, codec = Tokenizer.from_file(VOCABULARY), bpe.Codec(VOCABULARY)
    for text in odd_texts() + [r[1] for r in cases.rows() if r[1]]:
        expected = library.encode(text, add_special_tokens=False).ids
        ids = codec.encode(text)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == expected, text
        assert codec.decode(ids) == library.decode(expected, skip_special_tokens=False)


def test_bpe_word_memory_is_bounded(monkeypatch):
    codec = bpe.Codec(VOCABULARY)
    monkeypatch.setattr(bpe, "CACHE", 5)
    texts = odd_texts()[:200]
    assert [codec.encode(t) for t in texts] == [bpe.Codec(VOCABULARY).encode(t) for t in texts[:1]] + [codec.encode(t) for t in texts[1:]]


def test_bpe_frames(spark):
    df = cases.table(spark)
    library = Tokenizer.from_file(VOCABULARY)
    expected = Counter()
    for r in cases.rows():
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected[(r[0], tuple(ids), decoded)] += 1
    encoded = bpe.encode(df, VOCABULARY)
    decoded = bpe.decode(encoded, VOCABULARY)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in encoded.collect()) == Counter(k[:2] for k in expected.elements())
    assert Counter((r["doc_id"], r["decoded"]) for r in decoded.collect()) == Counter((k[0], k[2]) for k in expected.elements())
    trip = bpe.round_trip(df, VOCABULARY, with_ids=True).collect()
    for r in trip:
        raw = struct.pack(f"<{len(r['ids'])}I", *r["ids"])
        assert r["n_tokens"] == len(r["ids"]) and r["ids_sha256"] == hashlib.sha256(raw).hexdigest()
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded_sha256"]) for r in trip) == Counter(
        (k[0], k[1], hashlib.sha256(k[2].encode()).hexdigest()) for k in expected.elements()
    )
    assert bpe.round_trip(cases.table(spark, []), VOCABULARY).count() == 0


# ---- language model


def tokens(text):
    return cases.words((text or "").translate({c: c + 32 for c in range(65, 91)}))


def held(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def test_lm_counts_and_base(spark, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 20_000)  # several blocks
    data = cases.rows()
    counts, texts = Counter(), 0
    for r in data:
        if not held(r[0]):
            counts.update(tokens(r[1]))
            texts += 1
    n, v = sum(counts.values()) + texts, len(counts) + 1
    got = lm.score(cases.table(spark)).collect()
    assert len(got) == len(data)
    by_text = {(r[0], len(tokens(r[1]))): r for r in data}
    for r in got:
        words = tokens(by_text[(r["doc_id"], r["n_tokens"] - 1)][1])
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words) + math.log10((texts + 0.1) / (n + 0.1 * (v + 1)))
        assert r["held_out"] == held(r["doc_id"]) and r["train_tokens"] == n
        assert r["n_known"] == sum(counts[w] > 0 for w in words) + 1
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert r["score"] < 0 and math.isfinite(r["score"])


def phrases(n: int = 600) -> list[tuple]:
    """Texts in which what follows depends on the one or two words before."""
    draws = random.Random(12)
    rows = []
    for i in range(n):
        words = []
        for _ in range(30):
            words += draws.choice((["a", "x", "p"], ["b", "x", "q"], ["c"], [f"r{draws.randint(0, 400)}"]))
        rows.append((i, " ".join(words), None, None, None))
    return rows


def test_lm_beats_its_base_and_adds_up(spark):
    data = phrases()
    got = [r for r in lm.score(cases.table(spark, data, extra=False)).collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > 0.85 * sum(r["base_score"] for r in got)
    blocked = lm.blocks(cases.table(spark, data, extra=False), "doc_id", "text", 10)
    tree, known, totals = lm.train(blocked)
    assert len(tree.levels) >= 2
    # After every context the probabilities of all symbols add up to 1.
    counts = {r["word"]: r["c"] for r in known.select("word", "c").distinct().collect()}
    n = totals["words"] + totals["texts"]
    keys = np.array([*counts])
    root = np.log10(np.append(np.array([*counts.values()]) / n * (1 - totals["unknown"]), [totals["texts"] / n * (1 - totals["unknown"]), totals["unknown"]]))
    last = np.append(tree.digits(keys), [tree.edge, -1])
    place = {k: i for i, k in enumerate(tree.heavy.tolist())}
    digit = lambda w: place[lm.word_key(w.encode())]
    for context in ([tree.edge], [tree.edge, digit("a")], [tree.edge, digit("a"), digit("x")], [tree.edge, digit("b"), digit("x")], [tree.edge, digit("x"), -1]):
        total = sum(10 ** tree.score(np.array([*context, d]), np.append(np.zeros(len(context) - 1), r))[-1] for d, r in zip(last, root, strict=True))
        assert math.isclose(total, 1.0, rel_tol=1e-6)


def test_lm_learns_what_follows_rare_words(spark):
    """Pairs of words that each make up some 0.01 % of the tokens are states with their followers listed."""
    draws = random.Random(8)
    rows = [(i, [f"c{draws.randint(0, 300)}" for _ in range(200)]) for i in range(400) if not held(i)]
    for k in range(0, 240):
        rows[k][1][50:50] = [f"u{k % 40}", f"v{k % 40}"]
    blocked = lm.blocks(cases.table(spark, [(i, " ".join(w), None, None, None) for i, w in rows], extra=False), "doc_id", "text", 10)
    tree, known, totals = lm.train(blocked)
    n = totals["words"] + totals["texts"]
    counts = {r["word"]: r["c"] for r in known.select("word", "c").distinct().collect()}
    for k in range(40):
        pair = np.array([lm.word_key(f"{x}{k}".encode()) for x in "uv"])
        assert [counts[x] for x in pair.tolist()] == [6, 6] and 6 < 2e-4 * n
        root = np.log10(np.array([6, 6]) / n)
        assert 10 ** tree.score(np.append(tree.edge, tree.digits(pair)), root)[-1] > 0.5


def test_lm_blocks_of_one_id(spark, monkeypatch):
    """Rows that share an id, or have none, fill several blocks."""
    monkeypatch.setattr(lm, "BLOCK_BYTES", 2_000)
    rows = [(None if i % 2 else 5, f"some words of row {i} " * 10, None, None, None) for i in range(200)]
    docs = cases.table(spark, rows, extra=False)
    assert lm.blocks(docs, "doc_id", "text", 10).select("block").distinct().count() >= 10
    assert lm.score(docs).count() == 200


def test_lm_moves_rows_of_grams_packed(spark, monkeypatch):
    """Blocks send buckets a row each, not one per gram, and where texts are cut into blocks changes no score."""
    docs = cases.table(spark, phrases(200), extra=False).coalesce(1)
    whole = {r["doc_id"]: r["score"] for r in lm.score(docs).collect()}
    monkeypatch.setattr(lm, "BLOCK_BYTES", 4_000)
    blocked = lm.blocks(docs, "doc_id", "text", 10)
    tree, known, _ = lm.train(blocked)
    several = blocked.count()
    assert several >= 4 and known.count() > 2 * several**2
    assert all(told.count() <= 2 * several**2 for told in tree.answers)
    cut = {r["doc_id"]: r["score"] for r in lm.score(docs).collect()}
    assert cut.keys() == whole.keys() and all(math.isclose(cut[i], whole[i], rel_tol=1e-9) for i in whole)


def test_lm_without_training_texts(spark):
    only_held = [(i, "some words here", None, None, None) for i in range(200) if held(i)][:5]
    got = lm.score(cases.table(spark, only_held)).collect()
    assert {(r["train_tokens"], r["n_known"], r["base_score"]) for r in got} == {(0, 0, 0.0)}
    assert lm.score(cases.table(spark, [])).count() == 0


# ---- page texts

PAGE = (
    "<!doctype html><html><head><title>T</title><style>p{{}}</style><script>if (a<b) document.write('<p>no</p>')</script></head><body>"
    "<header><a href=/>Home</a></header><nav><ul><li><a href='/a'>One<li><a href='/b'>Two</ul></nav><!-- <p>gone</p> -->"
    "<div class=\"cookie-notice\">We use cookies.</div><article><h1>Head&amp;line {n}</h1><p><b>First &eacute;&#233;   part<br>goes\n on.<p>{text}"
    "<table><tr><td>a<td>b</table></article><aside>Related things</aside><div id='comments'><p>I liked it.</p></div>"
    "<form><label>Mail</label><button>Send</button></form><footer>&copy; me</footer></body></html>"
)


def pages(n: int = 120) -> list[tuple]:
    draws = random.Random(3)
    texts = [". ".join(cases.sentence(draws, "en", draws.randint(4, 30)) for _ in range(draws.randint(1, 6))) + "." for _ in range(n)]
    return [(i, f"u{i}", PAGE.format(n=i, text=t), f"Head&line {i} First éé part goes on. {t} a b") for i, t in enumerate(texts)]


def test_leaves_of_broken_markup():
    cut = [(path, text) for path, text, _ in html.leaves("<p>a<b>b</b>c<div class='x Side-bar2'>d &lt;e&gt;</i> f<p>g<p>h</div>tail<br/>end <script>x</script")]
    assert [t for _, t in cut] == ["abc", "d <e> f", "g", "h", "tail end"]
    assert cut[1][0] == ("div", ".x", ".side", ".bar", ".2")
    assert html.leaves(None) == html.leaves("") == html.leaves("<p> &nbsp; </p><script>x") == []
    assert [t for _, t, _ in html.leaves("1 < 2 <3 <a href=\"x>y\">z")] == ["1 < 2 <3 z"]


def test_page_texts(spark):
    data = pages()
    data_frame = spark.createDataFrame([r[:3] for r in data], "page_id long, url string, html string").repartition(3)
    weights = html.fit(data_frame)
    odd = [(900, None, None), (901, "u", ""), (902, None, "<p>" + "x" * 70_000), (None, "u", data[0][2]), (0, "u0", data[0][2]), (903, "u", "<<<>&&;</p></div>")]
    frame = data_frame.unionByName(spark.createDataFrame(odd, data_frame.schema)).withColumns({c: F.lit("z") for c in ("id", "text", "k0", "n_chars")})
    got = html.extract(frame, weights, keep=("url",)).collect()
    assert len(got) == len(data) + len(odd)
    expected = {r[0]: r[3] for r in data}
    right = sum(r["text"] == expected[r["page_id"]] for r in got if r["page_id"] in expected)
    assert right >= 0.97 * (len(data) + 1)
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert {r["page_id"]: r["text"] for r in got if r["page_id"] in (900, 901)} == {900: "", 901: ""}


def test_page_texts_of_other_forms(spark):
    """Pages whose article has no article element, after training on pages that have one."""
    data = pages()
    frame = spark.createDataFrame([r[:3] for r in data], "page_id long, url string, html string")
    weights = html.fit(frame)
    other = [(r[0], r[1], r[2].replace("<article>", "<div class=content>").replace("</article>", "</div>")) for r in data]
    got = html.extract(spark.createDataFrame(other, frame.schema), weights).collect()
    assert sum(r["text"] == data[r["page_id"]][3] for r in got) >= 0.9 * len(data)


def test_page_texts_of_articles_with_other_blocks(spark):
    """Heads, lists, quotes and code in articles, which no training page has; comments inside them go."""
    data = pages()
    frame = spark.createDataFrame([r[:3] for r in data], "page_id long, url string, html string")
    weights = html.fit(frame)
    more = "<h2>Second head</h2><p>Some words that follow it.<ul><li>first thing<li>second thing</ul><blockquote>what they said</blockquote><pre>x = 1</pre>"
    gone = "<section class=comments><p>nice read</p></section><table>"
    other = [(r[0], r[1], r[2].replace("<table>", more + gone)) for r in data]
    got = html.extract(spark.createDataFrame(other, frame.schema), weights).collect()
    added = " Second head Some words that follow it. first thing second thing what they said x = 1 a b"
    assert sum(r["text"] == data[r["page_id"]][3].removesuffix(" a b") + added for r in got) >= 0.9 * len(data)


def test_formulas_and_fallbacks_are_read():
    page = "<p>a <math><mi>x</mi> = <mn>1</mn></math> b</p><noscript><p>n</p></noscript><object>o</object><svg><text>no</text></svg>"
    assert [text for _, text, _ in html.leaves(page)] == ["a x = 1 b", "n", "o"]
    assert "noscript" in html.leaves(page)[1][0]
    deep = "<div>" * 3000 + "<a>x</a> y " * 3000
    assert html.leaves(deep)[0][2] == pytest.approx(3000 / len(" ".join(["x y"] * 3000)))


def test_labeller_keeps_formulas_of_an_article(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    weights = html.fit(pages)
    plain = {r["page_id"]: r["text"] for r in html.extract(pages, weights).collect()}
    marked = pages.withColumn("html", F.regexp_replace("html", r"(<p[^>]*>)(\w+) (\w+)", "$1$2 <math><mi>$3</mi></math>"))
    assert marked.filter("html LIKE '%<math>%'").count() > 0.5 * len(plain)
    for r in html.extract(marked, weights).collect():
        assert r["text"].replace(" ", "") == plain[r["page_id"]].replace(" ", "")


def test_page_texts_without_training_pages(spark):
    frame = spark.createDataFrame([(1, "<p>a</p><p>b")], "page_id long, html string")
    assert html.fit(frame) is None
    assert html.extract(frame, None).first()["text"] == "a b"
    assert html.extract(frame.limit(0), None).count() == 0


def test_labeller_gradients():
    """Back-propagated gradients against differences."""
    draws = np.random.default_rng(1)
    network = html.Labeller()
    size = html.PATH_DIMS + html.WORD_DIMS + html.SHAPE_DIMS
    x, lengths = draws.normal(size=(5, 3, size)), np.array([5, 2, 4])
    y = (draws.random((5, 3)) < 0.5).astype(float)
    network.w = {k: v.astype(np.float64) for k, v in network.w.items()}

    def loss():
        z = network.logits(x, lengths)
        mask = np.arange(5)[:, None] < lengths
        return np.where(mask, np.logaddexp(0, z) - y * z, 0).sum() / mask.sum()

    found = network.gradients(x, y, lengths)
    for k in network.w:
        flat = network.w[k].reshape(-1)
        for at in draws.integers(0, flat.size, 4):
            keep = flat[at]
            flat[at] = keep + 1e-4
            up = loss()
            flat[at] = keep - 1e-4
            down = loss()
            flat[at] = keep
            assert math.isclose(found[k].reshape(-1)[at], (up - down) / 2e-4, rel_tol=2e-2, abs_tol=1e-5)


# ---- nearest neighbours


def vectors(n: int = 700, dims: int = 12) -> list[tuple]:
    draws = np.random.default_rng(5)
    x = draws.normal(size=(n, dims)).astype(np.float32)
    x[100:160] = x[100]  # one common vector
    x[200:240] = x[200] + draws.normal(size=(40, dims)).astype(np.float32) * 0.01
    rows: list[tuple] = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    nan = [float("nan")] + [0.0] * (dims - 1)
    rows += [(2000, None), (2020, [0.0] * dims), (2040, nan), (2060, [None] + [1.0] * (dims - 1)), (2080, [1.0, 2.0]),
             (2100, [float("inf")] + [0.0] * (dims - 1)), (None, rows[0][1]), rows[20], rows[21]]
    return rows


def test_nearest_recall_ties_and_awkward_rows(spark):
    data = vectors()
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(4)
    frame = frame.withColumns({c: F.lit(1) for c in ("id", "vector", "query", "label", "score", "rank")})
    got = ann.nearest(frame, F.col("vec_id") % 20 == 0).collect()
    ids = np.arange(700)
    x = np.array([r[1] for r in data[:700]], np.float64)
    lists: dict = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        lists.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    assert set(lists) == {i for i in range(0, 700, 20)}
    hits = 0
    for q, found in lists.items():
        scores = x @ x[q]
        order = [i for i in np.lexsort((ids, -scores)) if i != q][:20]
        hits += len({i for i, _, _ in found} & set(order))
        assert [r for _, _, r in found] == list(range(1, 21))
        assert [(-s, i) for i, s, _ in found] == sorted((-s, i) for i, s, _ in found)
        assert all(math.isclose(s, scores[i], rel_tol=1e-12) for i, s, _ in found)
    assert hits >= 0.9 * 20 * len(lists)


def test_nearest_recall_with_many_pieces(spark, monkeypatch):
    """Some 40 pieces a partition, and one vector near the direction of most others, so in most lists."""
    monkeypatch.setattr(ann, "PIECE", 60)
    draws = np.random.default_rng(17)
    x = draws.normal(size=(2400, 16)).astype(np.float32)
    x[7] = 4 * x[:1200].mean(axis=0) / np.linalg.norm(x[:1200].mean(axis=0))
    x[:1200] += x[7] / 4
    frame = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    got = ann.nearest(frame, F.col("vec_id") % 20 == 0).collect()
    hits = 0
    for q in range(0, 2400, 20):
        scores = x.astype(np.float64) @ x[q].astype(np.float64)
        hits += len({i for i in np.argsort(-scores, kind="stable") if i != q and scores[i] >= np.sort(scores[np.arange(2400) != q])[-20]} & {r["vec_id"] for r in got if r["query_id"] == q})
    assert len(got) == 20 * 120 and hits >= 0.95 * 20 * 120


def test_nearest_deals_its_rows_out_few_times(spark, monkeypatch):
    """A round's members take one exchange, a step of the search three: the query's vector goes along."""
    dealt, real = {}, ann.materialise

    def counted(df, name):
        dealt.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return real(df, name)

    monkeypatch.setattr(ann, "materialise", counted)
    x = np.random.default_rng(3).normal(size=(300, 8)).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = ann.nearest(rows, F.col("vec_id") % 20 == 0).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(got) == 15 * 20
    assert max(dealt["ann-members"]) == 1
    assert len(dealt["ann-beam"]) > 1 and max(dealt["ann-beam"][1:]) <= 3


@pytest.mark.parametrize("n", [0, 1, 2, 9])
def test_nearest_in_tiny_tables(spark, n):
    data = [(i * 20, [float(i), 1.0]) for i in range(n)]
    got = ann.nearest(spark.createDataFrame(data, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).collect()
    assert len(got) == n * (n - 1)
