"""Declared-schema constraints as checks (K1–K7).

PostgreSQL enforces these on insert; Spark tables do not, so each becomes a
check returning the violating keys or rows. ``check_table`` runs all of a
table's constraints from its ``TableSpec`` and returns one uniform frame
(table_name, constraint_type, column_name, record_id, detail).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import any_of
from ..sources.schemas import TABLES, TableSpec
from .core import orphans

ABSENT_COLUMN = "column is absent"
VIOLATION_COLUMNS = ["table_name", "constraint_type", "column_name", "record_id", "detail"]


def check_primary_key(df: DataFrame, key: str) -> DataFrame:
    """K1: key values that repeat, and the NULL key if present, with their
    row counts. Partially aggregated count per key: a hot key costs one row
    per map task."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter((F.col("occurrences") > 1) | F.col(key).isNull())
    )


def check_not_null(df: DataFrame, columns: list[str], id_col: str) -> DataFrame:
    """K2: one row per (record, NOT NULL column holding NULL); a column that
    ``df`` lacks holds NULL in every record. One pass: the violated column names
    are gathered per row and exploded."""
    missing = {c: F.col(c).isNull() if c in df.columns else F.lit(True) for c in columns}
    names = F.array_compact(F.array(*[F.when(m, F.lit(c)) for c, m in missing.items()]))
    return df.filter(any_of(list(missing.values()))).select(id_col, F.explode(names).alias("column_name"))


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """K3: non-NULL values held by more than one row (NULLs are exempt)."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )


def check_foreign_key(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None,
                      id_col: str) -> DataFrame:
    """K4: child rows whose non-NULL key has no parent. Unlike the orphan
    checks C15/C16, a NULL foreign key passes, as in SQL."""
    return orphans(child.select(id_col, key), parent, key, parent_key, null_passes=True)


def check_domain(df: DataFrame, column: str, values, id_col: str) -> DataFrame:
    """K5: rows whose value lies outside ``values``; NULL passes (a CHECK
    constraint is satisfied by NULL)."""
    return df.filter(~F.col(column).isin(*values)).select(id_col, column)


def check_max_length(df: DataFrame, lengths: dict[str, int], id_col: str) -> DataFrame:
    """K6: one row per (record, VARCHAR(n) column longer than n characters)."""
    present = {c: n for c, n in lengths.items() if c in df.columns}
    over = [
        F.when(F.char_length(F.col(c)) > n,
               F.struct(F.lit(c).alias("column_name"), F.char_length(F.col(c)).alias("length"),
                        F.lit(n).alias("max_length")))
        for c, n in present.items()
    ]
    if not over:
        return df.filter(F.lit(False)).select(
            id_col, F.lit(None).cast("string").alias("column_name"),
            F.lit(None).cast("int").alias("length"), F.lit(None).cast("int").alias("max_length"))
    cond = F.lit(False)
    for c, n in present.items():
        cond = cond | (F.char_length(F.col(c)) > n)
    return (
        df.filter(cond)
        .select(id_col, F.explode(F.array_compact(F.array(*over))).alias("v"))
        .select(id_col, "v.column_name", "v.length", "v.max_length")
    )


def check_decimal_range(df: DataFrame, columns: list[str], precision: int, scale: int, id_col: str) -> DataFrame:
    """K7: values that would overflow DECIMAL(precision, scale).

    PostgreSQL rejects such a value and rounds extra scale half-up; Spark's
    ``try_cast`` yields NULL on overflow and rounds the same way, so a value
    that is non-NULL but casts to NULL is exactly a rejected one.
    """
    target = T.DecimalType(precision, scale)
    parts = [
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(target).isNull(),
               F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")))
        for c in columns
    ]
    cond = F.lit(False)
    for c in columns:
        cond = cond | (F.col(c).isNotNull() & F.col(c).try_cast(target).isNull())
    return (
        df.filter(cond)
        .select(id_col, F.explode(F.array_compact(F.array(*parts))).alias("v"))
        .select(id_col, "v.column_name", "v.value")
    )


def _uniform(df: DataFrame, table: str, kind: str, column, record_id, detail) -> DataFrame:
    as_col = lambda x: x if not isinstance(x, str) else F.lit(x)
    return df.select(
        F.lit(table).alias("table_name"), F.lit(kind).alias("constraint_type"),
        as_col(column).cast("string").alias("column_name"),
        record_id.cast("string").alias("record_id"), detail.cast("string").alias("detail"),
    )


def row_violations(df: DataFrame, table: str | TableSpec) -> DataFrame:
    """The row-local constraints of ``table`` (NOT NULL, domains, VARCHAR
    lengths, decimal ranges) in ONE pass over ``df``.

    Each row yields an array of (constraint_type, column_name, detail)
    structs for the rules it breaks, exploded into uniform rows; the table
    is scanned once however many columns and rules it has.
    """
    spec = table if isinstance(table, TableSpec) else TABLES[table]
    pk = spec.primary_key
    present = set(df.columns)
    rules: list[tuple[Column, str, str, Column]] = []   # (violated?, type, column, detail)
    for c in spec.not_null:
        if c in present:
            rules.append((F.col(c).isNull(), "not_null", c, F.lit(None).cast("string")))
        elif spec.column(c).default is None:
            rules.append((F.lit(True), "not_null", c, F.lit(ABSENT_COLUMN)))
    for c, values in spec.domains:
        if c in present:
            rules.append((~F.col(c).isin(*values), "domain", c, F.col(c).cast("string")))
    for c, n in spec.max_lengths.items():
        if c in present:
            rules.append((F.char_length(F.col(c)) > n, "max_length", c, F.char_length(F.col(c)).cast("string")))
    for c in spec.decimal_columns:
        if c in present:
            t = spec.column(c).dtype
            bad = F.col(c).isNotNull() & F.col(c).try_cast(T.DecimalType(t.precision, t.scale)).isNull()
            rules.append((bad, "decimal_range", c, F.col(c).cast("string")))
    if not rules:
        return df.filter(F.lit(False)).select(*[F.lit(None).cast("string").alias(n) for n in VIOLATION_COLUMNS])
    # A NULL predicate (e.g. NULL not in a domain) is not a violation.
    hits = [F.when(F.coalesce(cond, F.lit(False)),
                   F.struct(F.lit(kind).alias("constraint_type"), F.lit(col).alias("column_name"),
                            detail.alias("detail")))
            for cond, kind, col, detail in rules]
    any_hit = F.lit(False)
    for cond, _, _, _ in rules:
        any_hit = any_hit | F.coalesce(cond, F.lit(False))
    return (
        df.filter(any_hit)
        .select(F.col(pk).cast("string").alias("record_id"), F.explode(F.array_compact(F.array(*hits))).alias("v"))
        .select(F.lit(spec.name).alias("table_name"), "v.constraint_type", "v.column_name", "record_id",
                "v.detail")
    )


def check_table(df: DataFrame, table: str | TableSpec, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """Every declared constraint of ``table`` over ``df``, as uniform rows.

    Keys need their own plans (a count per key for PRIMARY KEY and UNIQUE,
    an anti join per FOREIGN KEY); every row-local rule comes from the single
    pass of ``row_violations``. ``parents`` maps parent table names to
    DataFrames for the foreign keys. What can't be checked is reported too: an
    absent NOT NULL column in every row, a foreign key whose parent is not
    given once, without a record.
    """
    spec = table if isinstance(table, TableSpec) else TABLES[table]
    pk = spec.primary_key
    parts = [
        _uniform(check_primary_key(df, pk), spec.name, "primary_key", pk, F.col(pk),
                 F.concat(F.lit("occurrences="), F.col("occurrences").cast("string")))
    ]
    for col in spec.unique:
        if col in df.columns:
            parts.append(_uniform(check_unique(df, col), spec.name, "unique", col, F.col(col),
                                  F.concat(F.lit("occurrences="), F.col("occurrences").cast("string"))))
    for col, parent, parent_col in spec.foreign_keys:
        if col not in df.columns:
            continue                                 # NULL in every row, which satisfies it
        if parent not in (parents or {}):
            parts.append(df.sparkSession.createDataFrame(
                [(spec.name, "foreign_key", col, None, f"not checked: {parent} is not given")],
                ", ".join(f"{c} string" for c in VIOLATION_COLUMNS)))
        else:
            parts.append(_uniform(check_foreign_key(df, parents[parent], col, parent_col, pk), spec.name,
                                  "foreign_key", col, F.col(pk), F.col(col)))
    parts.append(row_violations(df, spec).select(*VIOLATION_COLUMNS))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
