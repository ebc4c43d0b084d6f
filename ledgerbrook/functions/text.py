"""Text cleaning and splitting as column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Characters up to U+0020, stripped from both ends by trim_ws.
BLANKS = "".join(chr(c) for c in range(0x21))

# Company tags that are published as status.
STATUS_TAGS = [
    "存续", "在业", "经营异常", "注销", "高新技术企业", "吊销", "严重违法", "有失信被执行人",
    "天使轮", "新四板", "A轮", "并购", "B轮", "Pre-A轮", "新三板", "种子轮", "C轮", "A+轮",
    "已退市(新三板)", "B+轮", "D轮", "E轮及以后", "C+轮", "Pre-B轮", "D+轮",
]


def java_split(text: Column, delimiter: str) -> Column:
    """Split on one character; trailing empty pieces are dropped, inner and leading ones kept.

    ``''`` gives ``['']``, a text of delimiters only gives ``[]``, null gives null.
    """
    if len(delimiter) != 1:
        raise ValueError("java_split takes a one-character delimiter")
    body = F.rtrim(text, F.lit(delimiter))
    return (
        F.when(text == "", F.array(F.lit("")))
        .when(body == "", F.array().cast("array<string>"))
        .otherwise(F.split(body, re.escape(delimiter)))
    )


def trim_ws(text: Column) -> Column:
    """Strip every leading and trailing character up to U+0020 (Spark's trim strips spaces only)."""
    return F.trim(text, F.lit(BLANKS))


def drop_newlines(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(""))


def null_token(text: Column) -> Column:
    """Null and empty cells become the literal token ``null``."""
    return F.when(text.isNull() | (text == ""), "null").otherwise(text)


def longest(pieces: Column) -> Column:
    """The longest element of a string array; the first one wins a tie, none gives ``''``."""
    ranked = F.transform(
        pieces, lambda x, i: F.struct(F.length(x).alias("length"), (-i).alias("early"), x.alias("piece"))
    )
    return F.coalesce(F.array_max(ranked)["piece"], F.lit(""))


def longest_token(text: Column, delimiters: str = ",|，") -> Column:
    """The longest piece of a cell that is split on any of ``delimiters``; null gives ``''``."""
    return longest(F.split(F.coalesce(text, F.lit("")), f"[{re.escape(delimiters)}]"))


def default_if_short(text: Column, longer_than: int, default: str = "-") -> Column:
    return F.when(F.length(text) > longer_than, text).otherwise(default)


def fallback_text(
    candidates: Sequence[Column], longer_than: int = 5, default: str = "-", cut: int | None = None
) -> Column:
    """The first candidate longer than ``longer_than``, else ``default``; optionally cut."""
    first, *rest = candidates
    chosen = F.when(F.length(first) > longer_than, first)
    for c in rest:
        chosen = chosen.when(F.length(c) > longer_than, c)
    chosen = chosen.otherwise(default)
    return F.substring(chosen, 1, cut) if cut else chosen


def tag_allowlist(tags: Column, allowed: Sequence[str] = STATUS_TAGS, delimiter: str = "|") -> Column:
    """Keep the allowed tags, in order and with repeats, joined by commas; none gives ``''``."""
    pieces = F.split(F.coalesce(tags, F.lit("")), re.escape(delimiter))
    return F.array_join(F.filter(pieces, lambda t: t.isin(*allowed)), ",")


def first_match(text: Column, pattern: str) -> Column:
    """The first match of ``pattern``; ``''`` when there is none, null for null."""
    return F.regexp_extract(text, pattern, 0)


def first_number(text: Column) -> Column:
    """The first run of digits as text; ``''`` when there is none."""
    return first_match(text, r"\d+")


def number(text: Column, kind: str, pattern: str = r"\d+", group: int = 0) -> Column:
    """A group of the first match as a number; null without a match or when it does not fit.

    The empty text of a missing match is made null first, as a failing cast is slow.
    """
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit("")).try_cast(kind)


def like_flag(text: Column, part: str) -> Column:
    """1 when ``text`` contains ``part``, else 0 (also for null)."""
    return F.when(text.contains(part), 1).otherwise(0)


def space_words(text: Column) -> Column:
    return java_split(text, " ")


def lower_words(text: Column) -> Column:
    """Lower-cased ASCII words, no empty ones."""
    return F.filter(F.split(F.lower(text), r"\W+"), lambda w: w != "")


def whole_number(text: Column) -> Column:
    """Text as int, with any fraction cut off; null when it is not a number or too large."""
    return number(trim_ws(text), "int", r"\A([+-]?\d+)(\.\d*)?\z", 1)
