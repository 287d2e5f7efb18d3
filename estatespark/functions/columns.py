"""Column-expression helpers. All return native Catalyst expressions (no Python UDFs)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import SURROGATE_KEY_NULL, SURROGATE_KEY_SEPARATOR


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def upper_trim(c: str | Column) -> Column:
    """UPPER(TRIM(x))."""
    return F.upper(F.trim(col(c)))


def code_map(c: str | Column, mapping: Iterable[tuple[Any, Any]], default: Any = None) -> Column:
    """Simple CASE: code -> label, ``default`` for anything else (NULL input included)."""
    c = col(c)
    expr = None
    for code, label in mapping:
        expr = (F.when(c == F.lit(code), F.lit(label)) if expr is None
                else expr.when(c == F.lit(code), F.lit(label)))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default)) if default is not None else expr


def bucketize(c: str | Column, bounds: Sequence[tuple[Any, str]], top_label: str) -> Column:
    """Searched CASE over ordered upper bounds (exclusive); ``top_label`` above the last.

    ``bounds`` is a list of (upper_bound, label); bounds may be Columns (ratios to a
    per-row reference value) or literals.
    """
    c = col(c)
    expr = None
    for bound, label in bounds:
        b = bound if isinstance(bound, Column) else F.lit(bound)
        expr = F.when(c < b, F.lit(label)) if expr is None else expr.when(c < b, F.lit(label))
    return expr.otherwise(F.lit(top_label)) if expr is not None else F.lit(top_label)


def flag(cond: Column) -> Column:
    """Two-state boolean: NULL conditions become FALSE (CASE WHEN cond THEN TRUE ELSE FALSE)."""
    return F.coalesce(cond, F.lit(False))


def flag_in(c: str | Column, values: Iterable[Any]) -> Column:
    return flag(col(c).isin(list(values)))


def tri_state(c: str | Column, mapping: Iterable[tuple[Any, bool]]) -> Column:
    """Simple CASE to boolean with NULL for unknown codes."""
    return code_map(c, mapping, default=None)


def pct_change(new: str | Column, old: str | Column, digits: int) -> Column:
    """ROUND((new - old) * 100 / NULLIF(old, 0), digits), computed in DOUBLE."""
    new_d = col(new).cast("double")
    old_d = col(old).cast("double")
    return F.round((new_d - old_d) * F.lit(100.0) / F.nullif(old_d, F.lit(0.0)), digits)


def surrogate_key(*cols: str | Column) -> Column:
    """MD5 over the '-'-joined text of the parts, NULL parts replaced by a placeholder."""
    parts = [F.coalesce(col(c).cast("string"), F.lit(SURROGATE_KEY_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_KEY_SEPARATOR, *parts))


def regex_first(c: str | Column, pattern: str) -> Column:
    """First match of ``pattern``; NULL when there is none."""
    return F.regexp_substr(col(c), F.lit(pattern))


def postcode_area(postcode: str | Column) -> Column:
    """Leading capital letters of the postcode ('SW1A 1AA' -> 'SW'); NULL if none."""
    return regex_first(postcode, "^[A-Z]+")


def postcode_district(postcode: str | Column) -> Column:
    """Outward code: text before the first space."""
    return F.split_part(col(postcode), F.lit(" "), F.lit(1))


def try_date(c: str | Column, prefix_chars: int = 10) -> Column:
    """Lenient date parse of the leading ISO characters; NULL when unparseable."""
    return F.try_to_date(F.left(col(c), F.lit(prefix_chars)))


def rounded_mean(c: str | Column, digits: int) -> Column:
    """Mean of values carrying at most ``digits`` decimals, rounded half away from zero to
    ``digits``, computed exactly: sum and count in integer units of 10^-digits, so that a
    tie (x.xx5) rounds the same way whatever the summation order."""
    scale = 10 ** digits
    units = F.round(col(c) * F.lit(scale)).cast("bigint")
    s = F.sum(units)
    n = F.count(units)
    num = F.abs(s) * F.lit(2) + n
    den = n * F.lit(2)
    q = (num - F.pmod(num, den)) / den
    return (F.signum(s) * q / F.lit(float(scale))).cast("double")
