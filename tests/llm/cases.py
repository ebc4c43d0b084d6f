"""Small tables with every awkward case, and helpers of the tests in this folder."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use inside, under names that must not clash with a table's own.
EXTRA = ("id", "h", "t", "row", "rank", "size", "block", "component", "c0", "__copies", "node")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

SYLLABLES = {
    "en": ["th", "er", "on", "nd", "ing", "wh", "sh", "ou", "ly", "ea"],
    "de": ["sch", "ung", "ei", "ü", "ver", "ge", "ich", "tz", "ß", "au"],
    "fr": ["eau", "oi", "é", "que", "ment", "è", "tion", "ç", "re", "ai"],
}


def sentence(draws: random.Random, lang: str, n: int) -> str:
    return " ".join("".join(draws.choice(SYLLABLES[lang]) for _ in range(draws.randint(1, 3))) for _ in range(n))


def rows(seed: int = 3, n: int = 60) -> list[tuple]:
    """Documents of three languages with copies, near copies, shared passages and awkward texts."""
    draws = random.Random(seed)
    passage = sentence(draws, "en", 70)
    out: list[tuple] = []
    for i in range(n):
        lang = ("en", "en", "de", "fr")[i % 4]
        text = sentence(draws, lang, draws.choice((3, 8, 40, 120, 300)))
        if i % 9 == 4:
            text = f"{text}\n{passage} {sentence(draws, lang, 5)}"
        out.append((i, text, lang, f"s{i % 4}" if i % 3 else "hot", len(text)))
    base = out[7][1] + " " + sentence(draws, "en", 60)
    for k in range(6):  # near copies
        words = base.split()
        words[k * 7 + 3] = f"X{k}"
        out.append((100 + k, " ".join(words), "en", "hot", 1))
    out += [(200 + k, out[9][1], "de", None, None) for k in range(4)]  # copies
    out += [
        (300, None, None, None, None), (301, "", "en", "hot", 0), (302, " \t\n", None, "hot", 3), (303, "123 !!! 456", "en", "s1", 11),
        (304, "one", "en", "s1", 3), (305, "ONE", "en", "s1", 3), (306, "a b\x0bc\x0cd\re\x1cf g   <|endoftext|> Σας İ é", None, "s2", 9),
        (307, "x " * 30_000, "fr", "s2", 60_000), (308, sentence(draws, "fr", 15_000), "fr", "long", None),
        (309, "of " * 200, "en", "s3", 600), (None, "no id here at all", "en", "s1", 5), (None, None, "de", None, None),
    ]
    out += [out[3], out[3], out[12]]  # repeated rows
    return out


def table(spark: SparkSession, data: list[tuple] | None = None, extra: bool = True) -> DataFrame:
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(5)
    return df.withColumns({c: F.concat(F.lit("extra "), F.coalesce(F.col("source"), F.lit("-"))) for c in EXTRA}) if extra else df


def unique(data: list[tuple]) -> list[tuple]:
    """One row per non-null id, for operators that expect unique ids."""
    seen: dict = {}
    for r in data:
        if r[0] is not None:
            seen.setdefault(r[0], r)
    return list(seen.values())


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")
