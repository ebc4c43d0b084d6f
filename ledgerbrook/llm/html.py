"""Main text of web pages: a bidirectional LSTM labels the leaf blocks of a page in sequence.

A page is cut into leaf blocks, the runs of text between the borders of block elements. A block is
read as two vectors: its tag path (hashed tags, class and id words) and its words (hashed, with length,
link share and the like). The network reads the whole sequence in both directions, so every block is
labelled in the context of the page, and blocks labelled as main text are joined.

The network is trained here, on at most about TRAIN_PAGES pages of at most TRAIN_BYTES that mark their
article up; that mark-up, less the parts that are plainly something else, gives the labels. Each
training page is also read in changed forms (other or no article container, foreign blocks put in), so
that the network has to weigh paths, words and neighbours and not a single tag. Everything else, all
pages and all blocks, goes through the network.

Defined results: null html counts as empty and has an empty text; a page without a block of main text
has an empty text; character references are decoded, white space inside a block is one space, blocks are
trimmed and joined in page order by one space; text is never cut; unclosed and stray tags end where
their parents do; of elements only scripts, styles, templates, form fields, drawings and foreign frames are left
out unread, while formulas and the contents of ``noscript`` and ``object`` are blocks to be labelled; without a page to learn from all blocks outside raw-text elements are kept; repeated
pages give equal rows; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerbrook.llm.common import uniform

#: Bounds of the fit: pages, bytes of a page, and blocks of a page.
TRAIN_PAGES, TRAIN_BYTES, TRAIN_BLOCKS = 240, 64 << 10, 160
EPOCHS, BATCH, RATE = 10, 24, 0.02
#: Hidden units a direction; sizes of the two input vectors.
HIDDEN, PATH_DIMS, WORD_DIMS, SHAPE_DIMS = 16, 64, 16, 6
SEED = 11

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)/?>|[^<]+|<", re.DOTALL
)
NAMES = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.IGNORECASE)
SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")

# Elements of HTML by how they take part in a page.
RAW = frozenset("script style template iframe svg canvas textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "html head body title article section main aside nav header footer address div p pre blockquote h1 h2 h3 h4 h5 h6 ul ol li "
    "dl dt dd table caption thead tbody tfoot tr td th form fieldset legend figure figcaption details summary dialog hr menu "
    "option select button label center hgroup search".split()
)
#: What an article is made of besides plain paragraphs, and what foreign blocks are made of.
OWN_FORMS = (
    "p", "div", "h2", "h3", "h4", "ul li", "ul li", "ol li", "ul li p", "blockquote", "blockquote p", "pre", "pre code", "table tr td", "table tbody tr td",
    "table thead tr th", "figure figcaption", "dl dt", "dl dd", "section h2", "section p", "div p",
)
FOREIGN_FORMS = ("", "", "p", "p", "li", "div", "ul li", "h1", "h2", "h3", "h4", "table tr td", "a", "span")
#: Opening one of these ends an open element of the same set.
CLOSES = {t: s for s in ({"li"}, {"dt", "dd"}, {"tr"}, {"td", "th"}, {"option"}, {"thead", "tbody", "tfoot"}) for t in s}
# Names that mark an article, and names that mark what is not the article.
ARTICLE = frozenset("article main articlebody".split())
OTHER_TAGS = frozenset("nav aside footer form button select option label fieldset dialog menu head title".split())
OTHER_NAMES = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo promotion banner nav navigation navbar menu breadcrumb breadcrumbs "
    "sidebar footer masthead comment comments reply replies disqus cookie cookies consent notice popup modal overlay share sharing "
    "social related recommended newsletter subscribe signup login search pagination pager tags widget toolbar".split()
)

Leaf = tuple[tuple[str, ...], str, float]


def leaves(page: str | None) -> list[Leaf]:
    """(path, text, share of the text inside links) of each leaf block with text.

    A path entry is a tag or, after its tag, ``.name`` for each word of class, id, role or itemprop.
    """
    out: list[Leaf] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    text: list[str] = []
    linked, skip, links = 0, None, 0

    def flush():
        nonlocal linked
        joined = " ".join("".join(text).split())
        if joined:
            path = tuple(x for _, names in stack for x in names)
            out.append((path, joined, min(1.0, linked / len(joined))))
        text.clear()
        linked = 0

    def close(upto: int):
        nonlocal links
        links -= sum(t == "a" for t, _ in stack[upto:])
        if any(t in BLOCK for t, _ in stack[upto:]):
            flush()
        del stack[upto:]

    at, page = 0, page or ""
    while at < len(page):
        if skip:
            end = re.compile(rf"</{skip}\b[^>]*>", re.IGNORECASE).search(page, at)
            skip, at = None, end.end() if end else len(page)
            continue
        m = TOKEN.match(page, at)
        at = m.end()
        tag = m[2]
        if tag is None:
            if not m[0].startswith(("<!", "<?")):
                part = html.unescape(m[0])
                text.append(part)
                if links:
                    linked += len(part.strip())
            continue
        tag = tag.lower()
        if m[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
            continue
        if tag in RAW:
            skip = tag if not m[0].endswith("/>") else None
            continue
        if tag == "br" or tag == "hr":
            text.append(" ")
        if tag in VOID:
            if tag in BLOCK:
                flush()
            continue
        if tag in BLOCK:
            flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p" or stack[i][0] in CLOSES.get(tag, ()):
                    close(i)
                    break
                if stack[i][0] in BLOCK:
                    break
        names = [".".join(("", w)) for v in NAMES.findall(m[3]) for w in SPLIT.split("".join(v).lower()) if w]
        links += tag == "a"
        stack.append((tag, (tag, *names)))
    flush()
    return out


def marked(path: tuple[str, ...]) -> bool:
    """Whether the mark-up places a block in the article and in nothing else."""
    inside = False
    for x in path:
        if x.lstrip(".") in ARTICLE:
            inside = True
        elif x in OTHER_TAGS or x[0] == "." and x[1:] in OTHER_NAMES or x == "header" and not inside:
            return False
    return inside


_PLACES: dict[str, int] = {}


def _place(word: str, dims: int) -> int:
    """The dimension a word is hashed to; the last answers are remembered."""
    found = _PLACES.get(word)
    if found is None:
        if len(_PLACES) > 300_000:
            _PLACES.clear()
        found = _PLACES[word] = zlib.crc32(word.encode("utf-8", "surrogatepass"))
    return found % dims


def vectors(page: list[Leaf]) -> np.ndarray:
    """One row per leaf: hashed tag path, hashed words, shape."""
    x = np.zeros((len(page), PATH_DIMS + WORD_DIMS + SHAPE_DIMS), np.float32)
    for i, (path, text, linked) in enumerate(page):
        for p in path:
            x[i, _place(p, PATH_DIMS)] = 1.0
        words = text.split(" ")
        counts = np.bincount([_place(w, WORD_DIMS) for w in words], minlength=WORD_DIMS)
        x[i, PATH_DIMS : PATH_DIMS + WORD_DIMS] = counts / len(words)
        x[i, PATH_DIMS + WORD_DIMS :] = (
            np.log1p(len(text)) / 8, linked, i / len(page), np.log1p(len(words)) / 6,
            text[-1] in ".!?。", 1.0,
        )
    return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Labeller:
    """A bidirectional LSTM with one logistic output a block. Sequences are padded at the end."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None):
        if weights is None:
            draws = np.random.default_rng(SEED)
            size = PATH_DIMS + WORD_DIMS + SHAPE_DIMS
            weights = {}
            for way in ("f", "b"):
                weights[f"{way}x"] = draws.normal(0, 0.1, (size, 4 * HIDDEN))
                weights[f"{way}h"] = draws.normal(0, 0.1, (HIDDEN, 4 * HIDDEN))
                bias = np.zeros(4 * HIDDEN)
                bias[HIDDEN : 2 * HIDDEN] = 1.0
                weights[f"{way}c"] = bias
            weights["o"] = draws.normal(0, 0.1, 2 * HIDDEN)
            weights["oc"] = np.zeros(1)
        self.w = {k: v.astype(np.float32) for k, v in weights.items()}

    def _forward(self, x: np.ndarray, way: str) -> list[tuple]:
        """States of one direction over (time, page, input); gates in the order in, forget, out, new."""
        gates_x = x @ self.w[f"{way}x"] + self.w[f"{way}c"]
        h = c = np.zeros((x.shape[1], HIDDEN), np.float32)
        steps = []
        for t in range(len(x)):
            z = gates_x[t] + h @ self.w[f"{way}h"]
            i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            before, h_before = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            steps.append((i, f, o, g, before, h_before, tc, h))
        return steps

    @staticmethod
    def _reverse(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Every page's own blocks in reverse; padding stays at the end."""
        t = np.arange(len(x))[:, None]
        at = np.where(t < lengths, lengths - 1 - t, t)
        return x[at, np.arange(x.shape[1])]

    def logits(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        forward = np.stack([s[-1] for s in self._forward(x, "f")])
        backward = np.stack([s[-1] for s in self._forward(self._reverse(x, lengths), "b")])
        return forward @ self.w["o"][:HIDDEN] + self._reverse(backward, lengths) @ self.w["o"][HIDDEN:] + self.w["oc"]

    def gradients(self, x: np.ndarray, y: np.ndarray, lengths: np.ndarray) -> dict[str, np.ndarray]:
        mask = np.arange(len(x))[:, None] < lengths
        ways = {"f": (x, self._forward(x, "f"))}
        turned = self._reverse(x, lengths)
        ways["b"] = (turned, self._forward(turned, "b"))
        h = {"f": np.stack([s[-1] for s in ways["f"][1]]), "b": self._reverse(np.stack([s[-1] for s in ways["b"][1]]), lengths)}
        z = h["f"] @ self.w["o"][:HIDDEN] + h["b"] @ self.w["o"][HIDDEN:] + self.w["oc"]
        dz = np.where(mask, _sigmoid(z) - y, 0.0) / mask.sum()
        out = {"o": np.concatenate([np.einsum("tp,tph->h", dz, h[w]) for w in "fb"]), "oc": np.array([dz.sum()])}
        for n, (way, (inputs, steps)) in enumerate(ways.items()):
            dh_out = dz[:, :, None] * self.w["o"][n * HIDDEN : (n + 1) * HIDDEN]
            if way == "b":
                dh_out = self._reverse(dh_out, lengths)
            dz_all = np.zeros((*inputs.shape[:2], 4 * HIDDEN), np.float32)
            dh = dc = 0.0
            recurrent = np.zeros_like(self.w[f"{way}h"])
            for t in range(len(inputs) - 1, -1, -1):
                i, f, o, g, before, h_before, tc, _ = steps[t]
                dh = dh_out[t] + dh
                dc = dh * o * (1 - tc * tc) + dc
                d = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
                dz_all[t] = d
                recurrent += h_before.T @ d
                dh, dc = d @ self.w[f"{way}h"].T, dc * f
            out[f"{way}x"] = np.einsum("tpi,tpg->ig", inputs, dz_all)
            out[f"{way}h"] = recurrent
            out[f"{way}c"] = dz_all.sum(axis=(0, 1))
        return out

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Adam over batches of pages (vectors, labels)."""
        draws = np.random.default_rng(SEED)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        step = 0
        for _ in range(EPOCHS):
            order = draws.permutation(len(pages))
            for at in range(0, len(order), BATCH):
                x, y, lengths = padded([pages[i] for i in order[at : at + BATCH]])
                step += 1
                for k, g in self.gradients(x, y, lengths).items():
                    g = np.clip(g, -1, 1)
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                    self.w[k] = (self.w[k] - RATE * move).astype(np.float32)


def padded(pages: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(time, page, input) vectors, (time, page) labels and the pages' lengths."""
    lengths = np.array([len(x) for x, _ in pages])
    x = np.zeros((lengths.max(), len(pages), pages[0][0].shape[1]), np.float32)
    y = np.zeros((lengths.max(), len(pages)), np.float32)
    for i, (values, labels) in enumerate(pages):
        x[: len(values), i], y[: len(values), i] = values, labels
    return x, y, lengths


def changed(page: list[tuple[Leaf, bool]], words: list[str], draws: np.random.Generator) -> list[tuple[Leaf, bool]]:
    """The page in another form: its article in another container and with blocks of other kinds, foreign blocks put in."""
    containers = (("main",), ("div", ".content"), ("div", ".post", ".body"), ("div", ".entry"), ("section", ".story"), ("div",), ("article",), ())
    container = containers[draws.integers(len(containers))]

    def some(least: int, most: int) -> str:
        start, size = int(draws.integers(0, len(words))), int(draws.integers(least, most))
        return " ".join(words[start : start + size]) or "x"

    out = []
    for (path, text, linked), label in page:
        new = tuple(y for x in path for y in (container if x in ("article", "main") else (x,)))
        out.append(((new, text, linked), label))
        if label and draws.random() < 0.2:
            form = str(draws.choice(OWN_FORMS)).split()
            for _ in range(draws.integers(1, 4)):
                out.append(((("html", "body", *container, *form), some(1, 30), float(draws.random() < 0.1)), True))
    others = sorted(OTHER_NAMES)
    for _ in range(draws.integers(0, 4)):
        inner = container if draws.random() < 0.5 else ()
        name = (draws.choice(("div", "section", "ul")), "." + others[draws.integers(len(others))])
        if draws.random() < 0.3:
            name = (str(draws.choice(("aside", "form", "nav", "footer"))),)
        linked = float(draws.random() < 0.4)
        run = []
        for _ in range(draws.integers(1, 6)):
            form = str(draws.choice(FOREIGN_FORMS)).split()
            run.append(((("html", "body", *inner, *map(str, name), *form), some(1, 40), linked), False))
        at = int(draws.integers(0, len(out) + 1))
        out[at:at] = run
    if draws.random() < 0.4:
        # The site's own header comes before everything else of the body.
        run = [((("html", "body", "header", *str(draws.choice(FOREIGN_FORMS)).split()), some(1, 8), 0.0), False) for _ in range(draws.integers(1, 4))]
        at = next((i for i, ((path, _, _), _) in enumerate(out) if "body" in path), len(out))
        out[at:at] = run
    if container and draws.random() < 0.3:
        # An article's header holds its heads.
        out = [((_in_header(leaf[0]), *leaf[1:]), label) if label else (leaf, label) for leaf, label in out]
    return out


def _in_header(path: tuple[str, ...]) -> tuple[str, ...]:
    """The path of a head of the article, put into a header."""
    return (*path[:-1], "header", path[-1]) if path[-1] == "h1" else path


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> dict[str, np.ndarray] | None:
    """Weights of a labeller trained on a seeded draw of pages that mark their article up."""
    rows = pages.select(F.col(html_col).alias("html"), uniform(F.col(id_col), "html").alias("u")).filter(
        F.octet_length("html").between(1, TRAIN_BYTES) & F.lower("html").rlike("<(article|main)\\b")
    )
    count = rows.count()
    drawn = rows.filter(F.col("u") < min(1.0, 2 * TRAIN_PAGES / max(1, count))).orderBy("u", "html").limit(TRAIN_PAGES).collect()
    cut = [[(leaf, marked(leaf[0])) for leaf in leaves(r["html"])] for r in drawn]
    cut = [p for p in cut if len(p) <= TRAIN_BLOCKS and any(label for _, label in p)]
    if not cut:
        return None
    draws = np.random.default_rng(SEED)
    words = [w for p in cut for (_, text, _), _ in p for w in text.split(" ")]
    forms = cut + [changed(p, words, draws) for p in cut for _ in range(3)]
    labeller = Labeller()
    labeller.train([(vectors([leaf for leaf, _ in p]), np.array([label for _, label in p], np.float32)) for p in forms])
    return labeller.w


def extract(pages: DataFrame, weights: dict[str, np.ndarray] | None, id_col: str = "page_id", html_col: str = "html",
            keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per page: id, the columns of ``keep``, text and n_chars. No shuffle."""
    kinds = dict(pages.dtypes)

    def main_texts(blocks: list[list[Leaf]]) -> list[str]:
        texts = [""] * len(blocks)
        order = sorted((i for i, b in enumerate(blocks) if b), key=lambda i: len(blocks[i]))
        if weights is None:
            return [" ".join(t for _, t, _ in b) for b in blocks]
        labeller, at = Labeller(weights), 0
        while at < len(order):
            # Pages of like length together; at most about 60,000 blocks of padding and pages at once.
            n = max(1, min(len(order) - at, 60_000 // len(blocks[order[min(at + 63, len(order) - 1)]]), 64))
            part = order[at : at + n]
            x, _, lengths = padded([(vectors(blocks[i]), np.zeros(len(blocks[i]), np.float32)) for i in part])
            main = labeller.logits(x, lengths) > 0
            for k, i in enumerate(part):
                texts[i] = " ".join(t for (_, t, _), m in zip(blocks[i], main[: len(blocks[i]), k], strict=True) if m)
            at += n
        return texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            # Parsed pages take several times their bytes, so few are held at once.
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                texts = main_texts([leaves(h.as_py()) for h in batch.column(1)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *[batch.column(2 + i) for i in range(len(keep))], pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    names=["id", *[f"k{i}" for i in range(len(keep))], "text", "n_chars"],
                )

    rows = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)])
    schema = ", ".join([f"id {kinds[id_col]}", *[f"k{i} {kinds[c]}" for i, c in enumerate(keep)], "text string", "n_chars long"])
    return rows.mapInArrow(run, schema).select(
        F.col("id").alias(id_col), *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "text", "n_chars"
    )
