"""Rule scores. Range tables are data; every score is one column expression.

A range ``(low, high, mark)`` covers ``low < x <= high``. Zero, negatives and
values above the last range score 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from ledgerbrook.functions.text import first_match, number

Range = tuple[float, float, float]

# Score ranges and marks.
CAPITAL_RANGES = [(0, 100, 2.4), (100, 500, 4.8), (500, 1000, 7.2), (1000, 10000, 9.6), (10000, 1000000, 12.0)]
HEADCOUNT_RANGES = [(0, 100, 0.8), (100, 500, 1.6), (500, 1000, 2.4), (1000, 10000, 3.2), (10000, 1000000, 4.0)]
YEARS_RANGES = [(0, 3, 0.8), (3, 5, 1.6), (5, 10, 2.4), (10, 20, 3.2), (20, 1000000, 4.0)]
COUNT_RANGES = [(0, 5, 1.6), (5, 10, 3.2), (10, 20, 4.8), (20, 50, 6.4), (50, 1000000, 8.0)]
FLAG_MARKS = {
    "tag_gaoxin": 12.0, "prod_name_num": 8.0, "works_total": 8.0, "software_total": 8.0,
    "patent_total": 8.0, "brand_total": 4.0, "finance_total": 12.0, "has_recruit": 12.0,
}

# Factor from a capital unit to 10,000 yuan; any other unit counts 1.0.
CAPITAL_UNITS = {
    "元人民币": 0.001, "万加元": 5.3382, "万日元": 0.06474, "万欧元": 7.8305, "万澳大利亚元": 4.8355,
    "万德国马克": 12.0571, "万美元": 7.0304, "万港元": 0.9007, "万新加坡元": 5.1843,
    "万瑞士法郎": 7.0052, "万元人民币": 1.0, "万瑞典克朗": 0.7492, "万澳门元": 0.8744,
    "万丹麦克朗": 1.048, "万英镑": 9.2886,
}

# The one headcount text without a range.
FEW_STAFF = "少于50人"
FEW_STAFF_MARK = 0.8


def range_bucket(number: Column, ranges: Sequence[Range]) -> Column:
    """The mark of the range that holds ``number``; ranges ascend without gaps.

    Meant for a stored or projected column, as every range looks at ``number``.
    """
    if any(low != before for (_, before, _), (low, _, _) in zip(ranges, ranges[1:])):
        raise ValueError("ranges must follow each other without gaps")
    mark = F.when(number.isNull() | (number <= float(ranges[0][0])), 0.0)
    for _, high, value in ranges:
        mark = mark.when(number <= float(high), float(value))
    return mark.otherwise(0.0)


def _bucket_once(number: Column, ranges: Sequence[Range]) -> Column:
    """``range_bucket`` of an expression, which is worked out once and not per range."""
    marks = F.transform(F.array(number.cast("double")), lambda x: range_bucket(x, ranges))
    return F.get(marks, F.lit(0))


def capital_amount(text: Column) -> Column:
    """First number times the factor of the first non-digit run."""
    factors = F.create_map(*[F.lit(x) for pair in CAPITAL_UNITS.items() for x in pair])
    factor = F.coalesce(F.try_element_at(factors, first_match(text, r"\D+")), F.lit(1.0))
    return number(text, "bigint") * factor


def score_capital(text: Column) -> Column:
    return _bucket_once(capital_amount(text), CAPITAL_RANGES)


def lenient_date(text: Column) -> Column:
    """The first ``yyyy-MM-dd``; months and days beyond their range roll over."""
    pattern = r"(\d{4})-(\d{2})-(\d{2})"
    year, month, day = (number(text, "int", pattern, i) for i in (1, 2, 3))
    return F.date_add(F.add_months(F.make_date(year, F.lit(1), F.lit(1)), month - 1), day - 1)


def years_old(text: Column, as_of: Column) -> Column:
    """Age in 365-day years on ``as_of``; negative for dates in the future."""
    return F.datediff(as_of, lenient_date(text)) / F.lit(365.0)


def score_years(text: Column, as_of: Column) -> Column:
    return _bucket_once(years_old(text, as_of), YEARS_RANGES)


def score_count(text: Column) -> Column:
    return _bucket_once(number(text, "double"), COUNT_RANGES)


def headcount_middle(text: Column) -> Column:
    """Midpoint of the first ``a-b`` range."""
    pattern = r"(\d+)-(\d+)"
    low = number(text, "double", pattern, 1)
    return low + (number(text, "double", pattern, 2) - low) / 2


def few_staff_or(text: Column, mark: Column) -> Column:
    return F.when(text == FEW_STAFF, FEW_STAFF_MARK).otherwise(mark)


def score_headcount(text: Column) -> Column:
    return few_staff_or(text, _bucket_once(headcount_middle(text), HEADCOUNT_RANGES))


def score_flag(text: Column, mark: float) -> Column:
    """``mark`` when the first number is above zero, else 0."""
    return F.when(number(text.cast("string"), "double") > 0, float(mark)).otherwise(0.0)
