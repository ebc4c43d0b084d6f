"""Record formats: page views, log lines, prefixed keys."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F, types as T

from ledgerbrook.functions.text import number

PAGE_VIEW = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("zip_code", T.IntegerType()),
    T.StructField("user_id", T.LongType()),
])

VIEW_LINE = r"(?s)\A[^\t]*(\t[+-]?\d+){3}(\t.*)?\z"

# Severities in the order they are looked for, and the label of other lines.
SEVERITIES = ["ERROR", "INFO", "WARNING"]
OTHER_SEVERITY = "any"


def page_view(line: Column) -> Column:
    """Parse a tab-separated page view; a cell that is missing or malformed becomes null."""
    cells = F.split(line, "\t")
    return F.struct(*[
        F.get(cells, i).try_cast(f.dataType).alias(f.name) for i, f in enumerate(PAGE_VIEW.fields)
    ])


def is_page_view(line: Column) -> Column:
    """True for a line with a text and three whole numbers that fit their types.

    The pattern comes first: it is cheap, and spares the casts the malformed lines.
    """
    view = page_view(line)
    return line.rlike(VIEW_LINE) & reduce(and_, [view[f.name].isNotNull() for f in PAGE_VIEW.fields])


def page_view_line(url: Column, status: Column, zip_code: Column, user_id: Column) -> Column:
    return F.concat_ws("\t", url, status.cast("string"), zip_code.cast("string"), user_id.cast("string"))


def severity(line: Column) -> Column:
    """The first known severity contained in a log line."""
    label = F.when(line.contains(SEVERITIES[0]), SEVERITIES[0])
    for s in SEVERITIES[1:]:
        label = label.when(line.contains(s), s)
    return label.otherwise(OTHER_SEVERITY)


def severity_value(line: Column) -> Column:
    """The first number of a line with a known severity; 0 without number or severity."""
    zero = F.lit(0).cast("bigint")
    found = F.coalesce(number(line, "bigint"), zero)
    return F.when(severity(line) == OTHER_SEVERITY, zero).otherwise(found)


def strip_salt(key: Column) -> Column:
    """Drop everything up to and including the first dash."""
    return F.regexp_replace(key, r"\A[^-]*-", "")
