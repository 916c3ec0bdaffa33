"""Taking raw rows in: accepted rows typed, rejected rows kept with reasons.

A database refuses a row that its declared schema cannot hold and goes on with
the next. ``take_in`` does that for a whole table in one pass: every declared
column of every row is tested (NOT NULL, type, decimal range, VARCHAR length,
CHECK domain) *before* anything is cast, so a value that does not fit is
reported with its text instead of failing the job or turning NULL. Rows without
a reason are cast and get the schema's defaults (``conform``); the others keep
their raw values, as JSON, beside their reasons. Tests between rows (keys,
references) stay checks of their own, on the accepted rows.

The tested rows are written once (a reliable checkpoint), so the raw source is
read once although accepted and rejected rows are two outputs.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import fresh_name
from ..session import checkpoint_dir
from .readers import conform
from .schemas import TABLES, ColumnSpec, TableSpec

VIOLATION = T.StructType([T.StructField(n, T.StringType()) for n in ("constraint_type", "column_name", "detail")])
ABSENT_COLUMN = "column is absent"
# A number of any size: what overflows DECIMAL(10,2) still is one.
_WIDE = T.DecimalType(38, 10)


def _violation(kind: str, column: str, detail: Column) -> Column:
    return F.struct(F.lit(kind).alias("constraint_type"), F.lit(column).alias("column_name"),
                    detail.cast("string").alias("detail"))


def _column_tests(c: ColumnSpec, raw: Column, domains: dict[str, tuple]) -> list[tuple[Column, Column]]:
    """(violated?, violation) of a column that is present; only a domain's NULL passes unseen."""
    text = raw.cast("string")
    tests = []
    if not c.nullable:
        tests.append((raw.isNull(), _violation("not_null", c.name, F.lit(None))))
    if isinstance(c.dtype, T.DecimalType):
        number = raw.try_cast(_WIDE)
        tests.append((raw.isNotNull() & number.isNull(), _violation("type", c.name, text)))
        tests.append((number.isNotNull() & number.try_cast(c.dtype).isNull(), _violation("decimal_range", c.name, text)))
    elif not isinstance(c.dtype, (T.StringType, T.ArrayType)):
        tests.append((raw.isNotNull() & raw.try_cast(c.dtype).isNull(), _violation("type", c.name, text)))
    if c.max_length:
        tests.append((F.char_length(text) > c.max_length, _violation("max_length", c.name, F.char_length(text))))
    if c.name in domains:
        tests.append((~text.isin(*domains[c.name]), _violation("domain", c.name, text)))
    return tests


def violations(raw: DataFrame, table: str | TableSpec) -> Column:
    """Array of the row-local constraints each row of ``raw`` breaks, in the
    order of the declared columns. A NOT NULL column that is absent and has no
    default is missing in every row."""
    spec = table if isinstance(table, TableSpec) else TABLES[table]
    present, domains, tests = set(raw.columns), dict(spec.domains), []
    for c in spec.columns:
        if c.name in present:
            tests += _column_tests(c, F.col(c.name), domains)
        elif not c.nullable and c.default is None:
            tests.append((F.lit(True), _violation("not_null", c.name, F.lit(ABSENT_COLUMN))))
    return F.array_compact(F.array(*[F.when(F.coalesce(cond, F.lit(False)), v) for cond, v in tests]))


@dataclass(frozen=True)
class Intake:
    accepted: DataFrame    # the declared schema
    rejected: DataFrame    # table_name, record_id, reasons, raw
    violations: DataFrame  # table_name, constraint_type, column_name, record_id, detail


def take_in(raw: DataFrame, table: str | TableSpec, now: dt.datetime | str | None = None, materialize: bool = True) -> Intake:
    """Split ``raw`` into accepted and rejected rows; see the module. Columns
    outside the declared schema stay in ``raw`` of rejected rows only."""
    spec = table if isinstance(table, TableSpec) else TABLES[table]
    name = fresh_name(raw, "_violations")
    tested = raw.withColumn(name, violations(raw, spec))
    if materialize:
        checkpoint_dir(raw.sparkSession)
        tested = tested.checkpoint(eager=True)
    good = tested.filter(F.size(name) == 0).select(*[
        F.col(c.name) if isinstance(c.dtype, T.ArrayType) else F.col(c.name).try_cast(c.dtype).alias(c.name)
        for c in spec.columns if c.name in raw.columns])
    bad = tested.filter(F.size(name) > 0)
    record = F.col(spec.primary_key).cast("string") if spec.primary_key in raw.columns else F.lit(None).cast("string")
    reasons = F.transform(name, lambda v: F.concat(v["column_name"], F.lit(": "), v["constraint_type"],
                                                   F.coalesce(F.concat(F.lit(" "), v["detail"]), F.lit(""))))
    rejected = bad.select(F.lit(spec.name).alias("table_name"), record.alias("record_id"), reasons.alias("reasons"),
                          F.to_json(F.struct(*raw.columns), {"ignoreNullFields": "false"}).alias("raw"))
    exploded = bad.select(record.alias("record_id"), F.explode(name).alias("v")).select(
        F.lit(spec.name).alias("table_name"), "v.constraint_type", "v.column_name", "record_id", "v.detail")
    return Intake(conform(good, spec, now=now), rejected, exploded)
