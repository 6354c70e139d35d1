"""Column helpers that keep the source system's number, date and text rules in one place.

Sums stay exact decimals. Every quotient (mean, ratio, percentage) is a double taken once, from exact operands.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE = {
    ">=": lambda c, t: c >= t,
    ">": lambda c, t: c > t,
    "<=": lambda c, t: c <= t,
    "<": lambda c, t: c < t,
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band(c: Column | str, steps: Sequence[tuple], default: str | None, op: str = ">=") -> Column:
    """Label of the first step whose threshold the value meets; nulls fall to the default."""
    c, test = _col(c), _COMPARE[op]
    out = None
    for threshold, label in steps:
        cond = test(c, threshold)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(F.lit(default))


def value_map(c: Column | str, mapping: dict, default) -> Column:
    c, out = _col(c), None
    for key, label in mapping.items():
        out = F.when(c == key, label) if out is None else out.when(c == key, label)
    return out.otherwise(default)


def is_deleted(c: Column | str = "IsDeleted") -> Column:
    """A missing flag counts as not deleted. Accepts boolean and 0/1 flags."""
    return F.coalesce(_col(c).cast("boolean"), F.lit(False))


def is_active(c: Column | str = "IsDeleted") -> Column:
    return ~is_deleted(c)


def flag_is(c: Column | str, value: bool) -> Column:
    """Plain flag equality, as a filter without a null default: a missing flag matches neither value."""
    return _col(c).cast("boolean") == F.lit(value)


def ratio(num: Column, den: Column) -> Column:
    """Double quotient; null where the denominator is zero or null."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def mean(c: Column | str) -> Column:
    """Aggregate: exact sum over the count of non-null values, as a double."""
    c = _col(c)
    return ratio(F.sum(c), F.count(c))


def int_div(num: Column, den: Column) -> Column:
    """Integer quotient cut towards zero; null for a zero denominator."""
    return F.call_function("div", num.cast("bigint"), F.nullif(den.cast("bigint"), F.lit(0).cast("bigint")))


def avg_int(c: Column | str) -> Column:
    """Aggregate: mean of an integer column, cut to an integer."""
    c = _col(c)
    return int_div(F.sum(c), F.count(c))


def half_up(c: Column | str, digits: int) -> Column:
    """Round half away from zero. Doubles are read at ten decimals first, so 1.005 rounds to 1.01."""
    return F.round(_col(c).cast("decimal(28,10)"), digits)


def percent(num: Column, den: Column, digits: int = 2) -> Column:
    return half_up(ratio(num, den) * 100, digits)


def pct_change(new: Column, old: Column, digits: int = 2) -> Column:
    """Growth in percent; null unless the old value is positive."""
    return F.when(old > 0, half_up(ratio(new - old, old) * 100, digits))


def margin_ratio(price: Column | str, cost: Column | str) -> Column:
    """Mark-up over cost in percent as a double, 0 where the cost is not positive."""
    price, cost = _col(price), _col(cost)
    return F.when(cost > 0, ratio(price - cost, cost) * 100).otherwise(F.lit(0.0))


def line_total(qty: str = "OrderQty", price: str = "UnitPrice", discount: str = "UnitPriceDiscount") -> Column:
    return F.col(qty) * F.col(price) * (F.lit(1).cast("decimal(3,2)") - F.col(discount))


def total_due() -> Column:
    return F.col("SubTotal") + F.col("TaxAmt") + F.col("Freight")


def datediff_sql(unit: str, start: Column, end: Column) -> Column:
    """Number of unit boundaries crossed between two times, not elapsed whole units."""
    unit = unit.lower()
    if unit == "day":
        return F.datediff(end, start)
    if unit in ("hour", "minute", "second"):
        return F.timestamp_diff(unit.upper(), F.date_trunc(unit, start), F.date_trunc(unit, end))
    years = F.year(end) - F.year(start)
    if unit == "year":
        return years
    if unit == "quarter":
        return years * 4 + F.quarter(end) - F.quarter(start)
    if unit == "month":
        return years * 12 + F.month(end) - F.month(start)
    if unit == "week":  # Sunday-based
        sunday = lambda d: F.date_sub(F.to_date(d), F.dayofweek(d) - 1)
        return (F.datediff(sunday(end), sunday(start)) / 7).cast("int")
    raise ValueError(f"unknown unit {unit}")


def shift(base: Column, **parts: int) -> Column:
    """Calendar shift; month and year steps clamp to the end of the month."""
    out = base
    if parts.get("years") or parts.get("months"):
        out = out + F.make_ym_interval(F.lit(parts.get("years", 0)), F.lit(parts.get("months", 0)))
    if any(parts.get(p) for p in ("days", "hours", "minutes", "seconds")):
        out = out + F.make_dt_interval(F.lit(parts.get("days", 0)), F.lit(parts.get("hours", 0)),
                                       F.lit(parts.get("minutes", 0)), F.lit(parts.get("seconds", 0)))
    return out


def at(ts) -> Column:
    """The fixed 'now' as a timestamp literal, so all arithmetic on it folds before the scan."""
    return F.lit(ts).cast("timestamp")


def concat_nullable(*parts: Column) -> Column:
    """Text concatenation in which a null part counts as empty."""
    return F.concat(*[F.coalesce(p, F.lit("")) for p in parts])


def full_name(first: str = "FirstName", middle: str | None = "MiddleName", last: str = "LastName") -> Column:
    parts = [F.col(first), F.lit(" ")]
    if middle:
        parts.append(F.concat(F.col(middle), F.lit(" ")))
    return concat_nullable(*parts, F.col(last))


def matches_any(c: Column | str, patterns: Iterable[str], ci: bool = False) -> Column:
    """True where any LIKE pattern matches. Case-sensitive unless ``ci``."""
    c = _col(c)
    tests = [c.ilike(p) if ci else c.like(p) for p in patterns]
    return reduce(or_, tests) if tests else F.lit(False)


def is_blank(c: Column | str) -> Column:
    c = _col(c)
    return c.isNull() | (F.rtrim(c) == "")


def format_n0(c: Column) -> Column:
    """Thousands-grouped whole number, halves rounded away from zero."""
    return F.format_number(half_up(c, 0), 0)


def week_of_year_sql(d: Column) -> Column:
    """Week number with Sunday-started weeks, where week 1 holds January 1."""
    jan1 = F.trunc(d, "year")
    return (F.floor((F.dayofyear(d) + F.dayofweek(jan1) - 2) / 7) + 1).cast("int")


def fiscal_year(d: Column, first_month: int = 7) -> Column:
    return F.year(d) + F.when(F.month(d) >= first_month, 1).otherwise(0)


def days_old(c: Column | str, as_of) -> Column:
    return datediff_sql("day", _col(c), at(as_of))
