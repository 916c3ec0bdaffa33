"""Column expressions shared by the checks.

All of these are built-in Catalyst expressions (no Python UDF), so they stay
inside whole-stage codegen and, where they compare a column with a literal,
reach the Parquet scan as pushed filters.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_date(value: dt.date | str | None) -> dt.date:
    """Normalise an ``as_of`` argument; ``None`` means today (run-time clock)."""
    if value is None:
        return dt.date.today()
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


def as_timestamp(value: dt.datetime | dt.date | str | None) -> dt.datetime:
    if value is None:
        return dt.datetime.now().replace(microsecond=0)
    if isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.date):
        return dt.datetime.combine(value, dt.time())
    return dt.datetime.fromisoformat(str(value))


def date_lit(value: dt.date | str | None) -> Column:
    """DATE literal (no time-zone involvement); ``None`` is today."""
    return F.lit(as_date(value))


def ts_lit(value: dt.datetime | dt.date | str) -> Column:
    """TIMESTAMP_NTZ literal built from its text, so the driver's local zone
    never shifts it; Catalyst folds the cast into a constant."""
    return F.lit(as_timestamp(value).isoformat(sep=" ")).cast("timestamp_ntz")


def money(value) -> Column:
    """Exact decimal literal; a Python float would turn the comparison into
    floating point and break the cent boundaries."""
    return F.lit(Decimal(str(value)))


def days_between(later: Column, earlier: Column) -> Column:
    """PostgreSQL ``date - date``: signed whole days."""
    return F.date_diff(later, earlier)


def age_years(birth: Column, as_of: Column) -> Column:
    """PostgreSQL ``EXTRACT(YEAR FROM AGE(as_of, birth))``.

    Whole years on the ordered pair, one less when the later date's
    month-day falls before the earlier one's (so 2000-02-29 → 2001-02-28 is
    0), sign restored when the birth date lies in the future.
    """
    lo = F.least(birth, as_of)
    hi = F.greatest(birth, as_of)
    md = lambda d: F.month(d) * 100 + F.dayofmonth(d)
    years = F.year(hi) - F.year(lo) - F.when(md(hi) < md(lo), 1).otherwise(0)
    return F.when(birth > as_of, -years).otherwise(years)


def missing_fields(checks: list[tuple[str, Column]]) -> Column:
    """``ARRAY_REMOVE(ARRAY[CASE WHEN cond THEN label END, ...], NULL)``.

    ``array_remove(arr, NULL)`` is NULL in Spark, so NULLs are dropped with
    ``array_compact``; the labels keep the given order.
    """
    return F.array_compact(F.array(*[F.when(cond, F.lit(label)) for label, cond in checks]))


def any_of(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def all_of(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def is_true(col: Column) -> Column:
    """SQL ``col = TRUE``; NULL is not selected by a filter. Written as an
    equality so Parquet receives it as a pushed filter."""
    return col == F.lit(True)


def is_false(col: Column) -> Column:
    """SQL ``col = FALSE``; NULL is not selected by a filter."""
    return col == F.lit(False)


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """``ROUND(part / whole * 100, digits)`` on counts, computed as double;
    NULL instead of a division-by-zero error when ``whole`` is 0."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")) * 100, digits)


def money_text(amount: Column) -> Column:
    """Python's ``f"{x:.2f}"`` of an amount: two decimals, no grouping."""
    return amount.cast("decimal(20,2)").cast("string")


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
