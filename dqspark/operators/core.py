"""Generic cores the check operators are built from.

* ``incomplete``  — rows with at least one missing field, and which ones.
* ``duplicates``  — groups of rows sharing a key, with their ids.
* ``orphans``     — child rows whose key has no parent row (anti join).
* ``before``      — "older than N days" cut-off on a date column.

Skew: a single key may hold a large share of all rows (the fixture's hot
patient ``P7`` holds a third of the claims). Counting, min/max and sums are
partially aggregated map-side, so a hot key costs one row per map task. A
duplicate group's ids are rows of a member table, numbered across range
partitions: no task and no row holds a whole group, whatever its size. Only
where the result is the list itself (``listed``) does a row hold a group.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import any_of, date_lit, fresh_name, missing_fields
from .numbering import ordered

def incomplete(
    df: DataFrame,
    checks: list[tuple[str, Column]],
    columns: list[str],
    out: str = "missing_fields",
) -> DataFrame:
    """Rows of ``df`` failing at least one of ``checks`` (label, condition).

    The filter is the disjunction of the conditions (pushed to the scan as
    ``IsNull`` filters where the conditions are plain null tests); the label
    array is computed only for surviving rows.
    """
    cond = any_of([c for _, c in checks])
    return df.filter(cond).select(*columns, missing_fields(checks).alias(out))


@dataclass(frozen=True)
class DuplicateGroups:
    """Result of ``duplicates``.

    ``groups``: one row per duplicated key with ``count_col`` and ``first_id``,
    the group's smallest id, by which findings point to the members.
    ``rows``: the ungrouped key and id columns.
    """

    keys: list[str]
    id_col: str
    count_col: str
    groups: DataFrame
    rows: DataFrame

    def members(self) -> DataFrame:
        """One row per member: the keys, ``count_col``, ``first_id``, the id and
        ``member_no`` (1 for the smallest id).

        The duplicated keys are joined back to the rows (null-safe, so NULL
        keys meet again), and rows numbered in the order of keys and ids across
        range partitions; a member's number is its row's less its group's
        first. Sorting on the id too spreads a large group over many tasks.
        """
        named = self.groups.select(*[F.col(k).alias(f"_g_{k}") for k in self.keys], self.count_col, "first_id")
        meets = [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in self.keys]
        rows = self.rows.join(named, meets).select(*self.keys, self.count_col, "first_id", self.id_col)
        placed = ordered(rows, [*self.keys, self.id_col], "_row")
        firsts = placed.groupBy(*self.keys).agg(F.min("_row").alias("_first_row")).select(
            *[F.col(k).alias(f"_g_{k}") for k in self.keys], "_first_row")
        return placed.join(firsts, meets).select(
            *self.keys, self.count_col, "first_id", (F.col("_row") - F.col("_first_row") + 1).alias("member_no"), self.id_col)

    def listed(self, ids_out: str) -> DataFrame:
        """One row per group with ``ids_out``, all its ids in order (NULL ids
        are counted, not listed). A list is one value, so a row holds a whole
        group; only the rows of duplicated keys are gathered."""
        named = self.groups.select(*[F.col(k).alias(f"_g_{k}") for k in self.keys], self.count_col, "first_id")
        meets = [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in self.keys]
        return self.rows.join(named, meets).groupBy(*self.keys, self.count_col, "first_id").agg(
            F.sort_array(F.collect_list(self.id_col)).alias(ids_out))


def duplicates(df: DataFrame, keys: list[str], id_col: str, count_col: str = "duplicate_count") -> DuplicateGroups:
    """``GROUP BY keys HAVING COUNT(*) > 1``; NULL keys form one group. One
    partially aggregated count per key."""
    rows = df.select(*keys, id_col)
    groups = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(count_col), F.min(id_col).alias("first_id")
    ).filter(F.col(count_col) > 1)
    return DuplicateGroups(list(keys), id_col, count_col, groups, rows)


# NULL keys of a child are dealt to this many buckets; a bucket is a hash, not a task.
NULL_BUCKETS = 4096


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None,
            null_passes: bool = False, salt_buckets: int = 0) -> DataFrame:
    """Child rows with no parent row on ``key``, from one scan of the child.

    ``LEFT JOIN parent ... WHERE parent.key IS NULL`` is written as a
    ``left_anti`` join (Spark does not rewrite the outer-join form). NULL child
    keys are reported unless ``null_passes`` (foreign-key semantics): they
    match nothing, so they go through the same join under a second join column
    that spreads them, instead of meeting in one task. Only the parent's key
    column is read. No side is hinted: Spark broadcasts the parent keys when
    their measured bytes allow it, else shuffles and splits a skewed child key
    (AQE splits the left side of an anti join).

    ``salt_buckets=n`` salts the join explicitly, for clusters where AQE's
    skew handling is off: each child row takes bucket ``hash(row) mod n``
    and each parent key is replicated to all ``n`` buckets, so a hot key is
    spread over ``n`` tasks at the price of ``n`` copies of the parent keys.
    The result is the same rows.
    """
    pk, salt = parent_key or key, fresh_name(child, "_salt")
    parent_keys = parent.select(F.col(pk).alias("_pk")).filter(F.col("_pk").isNotNull())
    rows = child.filter(F.col(key).isNotNull()) if null_passes else child
    n = max(salt_buckets or 1, 1)
    dealt = F.xxhash64(*rows.columns)
    keys = parent_keys.select("_pk", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_psalt")) if n > 1 else \
        parent_keys.withColumn("_psalt", F.lit(0))
    salted = rows.withColumn(salt, F.when(F.col(key).isNull(), n + F.pmod(dealt, F.lit(NULL_BUCKETS)))
                             .otherwise(F.pmod(dealt, F.lit(n)) if n > 1 else F.lit(0)).cast("int"))
    return salted.join(keys, (salted[key] == keys["_pk"]) & (salted[salt] == keys["_psalt"]), "left_anti").select(*child.columns)


def before(col: str | Column, as_of: dt.date | str | None, days: int) -> Column:
    """``col < as_of - INTERVAL 'days days'`` on a DATE column; the bound is a
    literal, so the comparison is pushed to the Parquet scan."""
    c = F.col(col) if isinstance(col, str) else col
    return c < F.date_sub(date_lit(as_of), days)
