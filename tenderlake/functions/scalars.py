"""Column functions of the clean layer. All are built-in expressions, so they stay in codegen.

Every function takes a column (or its name) and returns a column. Unreadable
text becomes NULL, never an error.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_SENTINEL = "0001-01-01"
VAT_SENTINEL = "00000000000"

# Shapes are tested before casting: a failing cast costs an exception per row.
_WHOLE = r"^\s*[+-]?\d+\s*$"
_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"
_ISO_DAY = r"^\d{4}-\d{1,2}-\d{1,2}(\s*|[ T]\d.*)$"
_OTHER_DAY = r"^\d{4}([/ ])\d{1,2}\1\d{1,2}(\s*|[ T]\d.*)$"
_DAY_PARTS = r"^(\d{4})[/ ](\d{1,2})[/ ](\d{1,2})"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c: Column | str) -> Column:
    return as_column(c).cast("string")


# --- reading text -----------------------------------------------------------


def normalize_string(c: Column | str, upper: bool = False) -> Column:
    """Trimmed text, '' as NULL; optionally upper-cased."""
    text = F.trim(as_text(c))
    return F.nullif(F.upper(text) if upper else text, F.lit(""))


def _cast_whole(c: Column | str, kind: str) -> Column:
    # '12.5' and '1e3' are whole numbers after rounding half away from zero.
    text = as_text(c)
    return F.when(text.rlike(_WHOLE), text.try_cast(kind)).when(
        text.rlike(_NUMBER), F.round(text.try_cast("decimal(38,9)")).try_cast(kind)
    )


def cast_int(c: Column | str) -> Column:
    return _cast_whole(c, "int")


def cast_bigint(c: Column | str) -> Column:
    return _cast_whole(c, "bigint")


def cast_double(c: Column | str) -> Column:
    """Text to double; the Java literals '1.5d' and '1f' are not numbers."""
    text = as_text(c)
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def safe_date(c: Column | str, first_year: int = 1800, last_year: int = 2100) -> Column:
    """Text to date; NULL when it is no calendar day or falls outside the year window.

    The year is compared as text, so the day is parsed once.
    """
    text = F.trim(as_text(c))
    plausible = F.substring(text, 1, 4).between(f"{first_year:04d}", f"{last_year:04d}")
    iso = F.regexp_replace(text, _DAY_PARTS, "$1-$2-$3")
    return F.when(plausible & text.rlike(_ISO_DAY), text.try_cast("date")).when(
        plausible & text.rlike(_OTHER_DAY), iso.try_cast("date")
    )


def decode_flag(c: Column | str, yes: str) -> Column:
    """TRUE only for the given trimmed text; NULL reads as FALSE."""
    return F.coalesce(F.trim(as_text(c)) == F.lit(yes), F.lit(False))


def null_if(c: Column | str, *sentinels: object) -> Column:
    column = as_column(c)
    return reduce(lambda acc, s: F.nullif(acc, F.lit(s)), sentinels, column)


def not_blank(c: Column | str) -> Column:
    """Predicate: neither NULL nor blank."""
    return F.coalesce(F.trim(as_text(c)) != "", F.lit(False))


# --- dates ------------------------------------------------------------------


def domain_date(c: Column | str, floor_year: int = 1990) -> Column:
    """Drop days before the domain starts; they are typing errors."""
    day = as_column(c)
    return F.when(F.year(day) >= floor_year, day)


def clamp_date(c: Column | str, first: Column, last: Column) -> Column:
    day = as_column(c)
    return F.when(day.between(first, last), day)


def in_years(day: Column | str, years: tuple[int, int | None]) -> Column:
    """Is the day's year in the range? Without an upper year, up to the year of today."""
    first, last = years
    upper = F.year(F.current_date()) if last is None else F.lit(last)
    return F.year(day).between(F.lit(first), upper)


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(as_column(end), as_column(start))


def guarded_days(start: Column | str, end: Column | str, low: int, high: int) -> Column:
    """Day difference, NULL outside [low, high]."""
    days = days_between(start, end)
    return F.when(days.between(low, high), days)


# --- numbers ----------------------------------------------------------------


def rounded(c: Column | str, digits: int = 0) -> Column:
    """Half away from zero on the scaled double, as ROUND does in the published figures."""
    scale = float(10**digits)
    value = as_column(c).cast("double")
    return F.round(value * scale, 0) / scale if digits else F.round(value, 0)


def ratio(num: Column | str, den: Column | str) -> Column:
    """Double division, NULL on a zero denominator."""
    return as_column(num).cast("double") / F.nullif(as_column(den).cast("double"), F.lit(0.0))


def pct(num: Column | str, den: Column | str, digits: int) -> Column:
    return rounded(ratio(as_column(num).cast("double") * 100.0, den), digits)


def billions(c: Column | str, digits: int) -> Column:
    return rounded(as_column(c).cast("double") / 1e9, digits)


def sum_or_zero(*cols: Column | str) -> Column:
    """Row-wise sum with missing parts read as 0."""
    return reduce(add, [F.coalesce(as_column(c), F.lit(0.0)) for c in cols])


def count_positive(*cols: Column | str) -> Column:
    return reduce(add, [F.coalesce((as_column(c) > 0).cast("int"), F.lit(0)) for c in cols])


def row_max(*cols: Column | str) -> Column:
    return F.greatest(*[as_column(c) for c in cols])


def label_of_max(labels: dict[str, str], maximum: Column, residual: str) -> Column:
    """Label of the first column (in dict order) that equals the row maximum; NULL when it is 0."""
    rule = F.when(maximum == 0, F.lit(None).cast("string"))
    for name, label in labels.items():
        rule = rule.when(F.col(name) == maximum, F.lit(label))
    return rule.otherwise(F.lit(residual))


def suspect_amount(
    lot: Column | str, tender: Column | str, ceiling: float = 1e9, factor: float = 10.0
) -> Column:
    """A lot of at least `ceiling`, or more than `factor` times its own tender."""
    lot, tender = as_column(lot), as_column(tender)
    too_large = lot >= ceiling
    above_tender = (tender > 0) & (lot > tender * factor)
    return F.coalesce(too_large | above_tender, F.lit(False))


def near_multiple(num: Column | str, den: Column | str, multiple: float, tolerance: float) -> Column:
    """Is num/den the given multiple, up to the tolerance?"""
    return F.abs(ratio(num, den) - multiple) < tolerance


def first_reason(reasons: list[tuple[Column, str]]) -> Column:
    """Text of the first condition that holds, NULL when none does."""
    rule = F.when(reasons[0][0], F.lit(reasons[0][1]))
    for condition, text in reasons[1:]:
        rule = rule.when(condition, F.lit(text))
    return rule


# --- text and keys ----------------------------------------------------------


def series_key(award_id: Column | str, cig: Column | str, award_prefix: str = "agg:") -> Column:
    """Key of a payment series: the award where known, else the lot itself."""
    by_award = F.concat(F.lit(award_prefix), as_text(award_id))
    return F.coalesce(by_award, F.concat(F.lit("cig:"), as_column(cig)))


def contains_ci(c: Column | str, fragment: str) -> Column:
    return F.upper(as_column(c)).contains(fragment.upper())


def strip_prefix(c: Column | str, prefix: str) -> Column:
    return F.trim(F.regexp_replace(as_column(c), rf"^{prefix}\s+", ""))


def bucket_values(c: Column | str, buckets: dict[str, list[str]], other: str) -> Column:
    """Map listed values to their bucket name, everything else (NULL too) to `other`."""
    value = as_column(c)
    rule = F.lit(other)
    for name, members in reversed(buckets.items()):
        rule = F.when(value.isin(members), F.lit(name)).otherwise(rule)
    return rule


def present(c: Column | str) -> Column:
    """After an outer join: did the other side match?"""
    return as_column(c).isNotNull()
