"""BPE encoding and decoding by dynamic programming over prefixes.

For every prefix of a word there is exactly one token that ends its encoding: the token t with last
token u of the prefix before it such that nothing merges across the border of u and t. An automaton
over the vocabulary names the tokens that end at each position, a test on pairs of tokens picks the
one, and back-pointers from the whole word give the ids. No merge is ever replayed on a text.

The vocabulary is a JSON file of the public tokenizers kind (NFC, white space to one space, lower
case; words split by pattern; bytes written as visible characters; words end in ``</w>``). Its path is
a parameter and only tasks read it.

Defined results: a null text counts as empty and has no ids; the ids' decoding joins the token strings
by one space; special tokens written out in a text are special tokens; texts are encoded whole; an
unpaired surrogate cannot occur in Spark strings; equal texts have equal ids; an empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerbrook.llm.common import bounded_batches, few_rows

#: The pattern that splits normalised text into words, a fixed value of the vocabulary.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
END = "</w>"
#: Stands for the end of a word inside the automaton; no byte is written as this character.
MARK = "\x00"
#: Distinct words whose ids a task keeps, and tokens pairs whose test; memory bounds only.
CACHE, PAIRS = 250_000, 250_000


def byte_letters() -> list[str]:
    """The visible character that stands for each byte: printable ones themselves, others from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, free = [], 256
    for b in range(256):
        if b in own:
            letters.append(chr(b))
        else:
            letters.append(chr(free))
            free += 1
    return letters


class Vocabulary:
    """Tokens, how each one came about, and the automaton over them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text_of = {i: t for t, i in (ids | self.special).items()}
        self.letters = byte_letters()
        self.rank: dict[int, int] = {}  # of the merge that makes a token; base tokens have none
        self.parts: dict[int, tuple[int, int]] = {}
        self.merge_rank: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            made = ids.get(left + right)
            if made is None or left not in ids or right not in ids:
                continue
            self.merge_rank.setdefault((ids[left], ids[right]), rank)
            if made not in self.parts:
                self.parts[made], self.rank[made] = (ids[left], ids[right]), rank
        self._apart: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for token, i in ids.items():
            marked = token[: -len(END)] + MARK if token.endswith(END) else token
            if i not in self.parts or self._arises(i):
                self.automaton.add_word(marked, (len(marked), i))
        self.automaton.make_automaton()

    def _spine(self, token: int, side: int) -> list[tuple[int, int, int]]:
        """The pieces that touch one edge of a token while it grows: (piece, born at, consumed at)."""
        out, until = [], 1 << 60
        while True:
            born = self.rank.get(token, -1)
            out.append((token, born, until))
            if token not in self.parts:
                return out
            token, until = self.parts[token][side], born

    def _crossing(self, left: int, right: int, below: int) -> int | None:
        """Rank of the first merge over the border of two neighbours, of those under ``below``."""
        first = None
        for a, a_born, a_until in self._spine(left, 1):
            for b, b_born, b_until in self._spine(right, 0):
                if max(a_born, b_born) < min(a_until, b_until):
                    rank = self.merge_rank.get((a, b))
                    # Equal ranks mean a run of one piece: the leftmost pair merges first.
                    if rank is not None and rank < a_until and rank <= b_until and rank < below and (first is None or rank < first):
                        first = rank
        return first

    def _arises(self, token: int) -> bool:
        """Whether encoding the token's own text gives the token."""
        left, right = self.parts[token]
        return self._crossing(left, right, self.rank[token]) is None

    def apart(self, left: int, right: int) -> bool:
        """Whether two neighbouring tokens stay two tokens."""
        key = left << 32 | right
        found = self._apart.get(key)
        if found is None:
            if len(self._apart) > PAIRS:
                self._apart.clear()
            found = self._apart[key] = self._crossing(left, right, 1 << 60) is None
        return found

    def word_ids(self, word: str) -> list[int]:
        """Ids of one word, given as it stands in normalised text."""
        if word.isascii() and word.isprintable():
            marked = word + MARK  # printable ASCII stands for itself
        else:
            letters = self.letters
            marked = "".join([letters[b] for b in word.encode("utf-8", "surrogatepass")]) + MARK
        last = [0] * (len(marked) + 1)  # last token of each prefix
        length = [0] * (len(marked) + 1)  # and its length; 0: no token ends here yet
        known, apart = self._apart, self.apart
        for end, (size, token) in self.automaton.iter(marked):
            end += 1
            if length[end]:
                continue
            start = end - size
            if start:
                if not length[start]:
                    continue
                free = known.get(last[start] << 32 | token)
                if free is None:
                    free = apart(last[start], token)
                if not free:
                    continue
            last[end], length[end] = token, size
        out, at = [], len(marked)
        while at:
            if not length[at]:
                raise ValueError(f"the vocabulary cannot spell {word!r}")
            out.append(last[at])
            at -= length[at]
        out.reverse()
        return out


class Codec:
    """Encoder and decoder of whole texts, with a bounded memory of words."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.pattern = regex.compile(WORDS)
        self.spaces = regex.compile(r"\p{White_Space}+")
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.vocabulary.special, key=len, reverse=True))) or r"(?!)")
        self.seen: dict[str, bytes] = {}

    def normalise(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            # Lower case letter by letter, so a final sigma is not told apart.
            text = text.replace("Σ", "σ")
        return self.spaces.sub(" ", text).lower()

    def _words(self, text: str) -> bytes:
        words = self.pattern.findall(self.normalise(text))
        seen = self.seen
        if len(seen) > CACHE:
            seen.clear()
        for word in {*words}.difference(seen):
            seen[word] = array("I", self.vocabulary.word_ids(word)).tobytes()
        return b"".join(map(seen.__getitem__, words))

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        special = self.vocabulary.special
        if "<|" not in text or not self.special.search(text):
            return self._words(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [self._words(text[at : m.start()]), array("I", [special[m[0]]]).tobytes()]
            at = m.end()
        return b"".join([*out, self._words(text[at:])])

    def decode(self, ids: bytes) -> str:
        """Token strings joined by one space; unknown ids are left out."""
        name = self.vocabulary.text_of
        return " ".join([name[i] for i in array("I", ids) if i in name])


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's codec of a vocabulary file."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and ids (array of int)."""
    bounded_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [array("I", codec(path).encode(t.as_py())).tolist() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["id", "ids"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per list of ids: id and the decoded text; a null list decodes to the empty text."""
    bounded_batches(encoded.sparkSession)
    kind = dict(encoded.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [codec(path).decode(array("I", [i for i in ids.as_py() or () if i is not None]).tobytes()) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "decoded"])

    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"id {kind}, decoded string").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode, then decode the ids, in one pass: id, n_tokens, ids_sha256, decoded_sha256, and ids if asked. No shuffle."""
    bounded_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]

    def digests(text: str | None) -> tuple:
        ids = codec(path).encode(text)
        decoded = codec(path).decode(ids)
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), ids if with_ids else b""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            found = [digests(t.as_py()) for t in batch.column(1)]
            columns = list(zip(*found, strict=True)) if found else [[], [], [], []]
            arrays = [batch.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())]
            if with_ids:
                flat = array("i", b"".join(columns[3]))
                offsets = array("i", [0, *accumulate(columns[0])])
                arrays.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(arrays)])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
