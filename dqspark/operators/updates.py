"""``apply_updates`` (W3): UPDATE with the ``updated_at`` trigger.

The reference keeps ``updated_at`` current with a BEFORE UPDATE trigger on
patient_records, claims and encounters: every updated row gets the current
timestamp, even when no value changed; inserted rows keep their default.
Here the update is a join of the base table with the update rows, and the
trigger is a column expression on matched rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.exprs import ts_lit
from ..sources.readers import conform

# Tables carrying the reference's updated_at trigger.
TOUCHED_TABLES = ("patient_records", "claims", "encounters")


def _once_per_key(updates: DataFrame, key: str) -> DataFrame:
    """``updates`` without NULL keys, which match nothing; its plan fails on a
    key that occurs twice."""
    message = F.concat(F.lit(f"repeated update key {key}="), F.col(key).cast("string"))
    return (updates.filter(F.col(key).isNotNull()).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(key)))
            .filter(F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
            .drop("_n"))


def apply_updates(base: DataFrame, updates: DataFrame, key: str, now: dt.datetime | str,
                  touch_column: str | None = "updated_at", insert_missing: bool = False,
                  table: str | None = None) -> DataFrame:
    """Return ``base`` with ``updates`` applied on ``key``.

    * Matched rows take every non-key column present in ``updates`` (an
      explicit NULL there sets NULL, as ``UPDATE ... SET col = NULL``) and
      ``touch_column`` = ``now``.
    * Update rows whose key is absent from ``base`` are ignored, unless
      ``insert_missing``: then they are appended, conformed to ``table``'s
      DDL defaults (``updated_at`` = ``now`` by default, not by trigger).
    * ``updates`` must hold each key at most once: a repeated key fails the
      job, as MERGE does. Rows with a NULL key match nothing and are not inserted.
    * When ``table`` is given, only the tables with the trigger
      (``TOUCHED_TABLES``) stamp ``touch_column``.

    Plan: ``base`` LEFT JOIN ``updates``. Only the update rows are
    counted per key beforehand; Spark broadcasts them to ``base`` when their
    measured bytes allow it, else both sides shuffle on ``key``.
    """
    if table is not None and table not in TOUCHED_TABLES:
        touch_column = None          # no updated_at trigger on this table
    updates = _once_per_key(updates, key)
    upd_cols = [c for c in updates.columns if c != key and c in base.columns]
    u = updates.select(key, *[F.col(c).alias(f"_u_{c}") for c in upd_cols], F.lit(True).alias("_matched"))
    joined = base.join(u, key, "left")
    matched = F.coalesce(F.col("_matched"), F.lit(False))
    cols = []
    for c in base.columns:
        if c == key:
            cols.append(F.col(key))
        elif c == touch_column:
            cols.append(F.when(matched, ts_lit(now).cast(base.schema[c].dataType)).otherwise(F.col(c)).alias(c))
        elif c in upd_cols:
            cols.append(F.when(matched, F.col(f"_u_{c}").cast(base.schema[c].dataType)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    out = joined.select(*cols)
    if insert_missing:
        # Keys of base that the update set touches.
        hit = base.select(key).join(u.select(key), key, "left_semi")
        new_rows = updates.join(hit, key, "left_anti")
        if table is not None:
            new_rows = conform(new_rows, table, now=now)
        new_rows = new_rows.select(
            *[F.col(c) if c in new_rows.columns else F.lit(None).cast(base.schema[c].dataType).alias(c)
              for c in base.columns]
        )
        out = out.unionByName(new_rows)
    return out


# --- stored tables -----------------------------------------------------------

BUCKET = "key_bucket"


def key_bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def store_by_key(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Store ``df`` as Parquet in folders by a hash of ``key``, so that an
    update finds a key's folder without an index."""
    (df.withColumn(BUCKET, key_bucket(key, buckets)).repartition(buckets, BUCKET)
     .write.mode("overwrite").partitionBy(BUCKET).parquet(path))


def touched_rows(spark: SparkSession, path: str, updates: DataFrame, key: str, buckets: int) -> DataFrame:
    """The stored rows of the folders that hold an updated key; the others are
    pruned. At most ``buckets`` folder numbers reach the driver."""
    hit = [r[0] for r in updates.filter(F.col(key).isNotNull()).select(key_bucket(key, buckets)).distinct().collect()]
    return spark.read.parquet(path).filter(F.col(BUCKET).isin(hit) if hit else F.lit(False))


def update_stored(spark: SparkSession, path: str, updates: DataFrame, key: str, buckets: int, now: dt.datetime | str,
                  **options) -> None:
    """``apply_updates`` on a table stored by ``store_by_key``: only folders
    that hold an updated key are read, and only they are replaced (dynamic
    partition overwrite; a failed job leaves them as they were). ``options``
    are those of ``apply_updates``."""
    base = touched_rows(spark, path, updates, key, buckets)
    after = apply_updates(base.drop(BUCKET), updates, key, now, **options)
    (after.withColumn(BUCKET, key_bucket(key, buckets)).repartition(buckets, BUCKET)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path))
