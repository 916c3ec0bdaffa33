"""Key counts kept between arrivals (K1, K3, C13, C14 as batches arrive).

Each batch adds its own partial counts per key (``batch_id`` partition of the
store), and only the batch's keys are looked up among the earlier partials: a
key violates from the batch on in which its rows first number two or more.
Replaying a batch replaces its partition and gives the same result; batches
are numbered in the order they arrive. ``compact`` joins the partials of
finished batches, so that the store grows with the keys, not the batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def batch_counts(batch: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """``keys``, ``n`` and ``first_id`` of a batch; NULL keys are keys."""
    return batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("first_id"))


def merge_counts(*parts: DataFrame) -> DataFrame:
    """Partial counts added up."""
    keys = [c for c in parts[0].columns if c not in ("n", "first_id", "batch_id")]
    every = parts[0].select(*keys, "n", "first_id")
    for p in parts[1:]:
        every = every.unionByName(p.select(*keys, "n", "first_id"))
    return every.groupBy(*keys).agg(F.sum("n").alias("n"), F.min("first_id").alias("first_id"))


def newly_repeated(earlier: DataFrame, counts: DataFrame) -> DataFrame:
    """Keys of a batch's ``counts`` that ``earlier`` partials held at most once
    and that now occur more often, with their total and smallest id."""
    keys = [c for c in counts.columns if c not in ("n", "first_id", "batch_id")]
    meets = [F.col(f"_e_{k}").eqNullSafe(F.col(k)) for k in keys]
    named = earlier.select(*[F.col(k).alias(f"_e_{k}") for k in keys], F.col("n").alias("_n"), F.col("first_id").alias("_first"))
    # Only the batch's keys are looked up; the earlier partials of one key may be several.
    known = named.join(counts.select(*keys), meets, "left_semi").groupBy(*[f"_e_{k}" for k in keys]).agg(
        F.sum("_n").alias("_n"), F.min("_first").alias("_first"))
    total = F.coalesce(F.col("_n"), F.lit(0)) + F.col("n")
    return (counts.join(known, meets, "left").filter((F.coalesce(F.col("_n"), F.lit(0)) <= 1) & (total > 1))
            .select(*keys, total.alias("n"), F.least("first_id", "_first").alias("first_id")))


def _store(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _partials(counts: DataFrame) -> T.StructType:
    return T.StructType([*[T.StructField(f.name, f.dataType) for f in counts.schema.fields], T.StructField("batch_id", T.LongType())])


def add_batch(spark: SparkSession, path: str, batch: DataFrame, batch_id: int, keys: list[str], id_col: str) -> DataFrame:
    """Add a batch to the store at ``path`` and return the keys that violate
    from this batch on (``keys``, ``n``, ``first_id``)."""
    counts = batch_counts(batch, keys, id_col)
    schema = _partials(counts)
    (counts.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))
    store = _store(spark, path, schema)
    return newly_repeated(store.filter(F.col("batch_id") < batch_id), store.filter(F.col("batch_id") == batch_id).drop("batch_id"))


def compact(spark: SparkSession, path: str, target: str, up_to: int, keys: list[str]) -> None:
    """Write the store to ``target`` with the partials of batches up to
    ``up_to`` joined into one (under that batch's number)."""
    store = spark.read.parquet(path)
    old = merge_counts(store.filter(F.col("batch_id") <= up_to)).withColumn("batch_id", F.lit(up_to).cast("bigint"))
    later = store.filter(F.col("batch_id") > up_to).select(*keys, "n", "first_id", F.col("batch_id").cast("bigint"))
    old.unionByName(later).write.mode("overwrite").partitionBy("batch_id").parquet(target)
