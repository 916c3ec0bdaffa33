"""Readers for the source tables and ``conform`` (the DDL defaults, W2).

Sources are checked against the declared schema: Parquet by default, CSV for
the sample-file layout, JDBC for a live PostgreSQL database. Columns are taken
by name, file by file; a type that could lose value is refused when the plan
is built, a text that is no value of its type fails the read (or is set aside:
``intake``). Reading is lazy; filters and projections of the checks reach the
Parquet scan.
"""

from __future__ import annotations

import csv
import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import as_date, as_timestamp, date_lit, ts_lit
from .schemas import TABLES, TableSpec


def read_source(spark: SparkSession, directory: str, name: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One of the driver's Parquet tables, ``{directory}/{name}.parquet``.
    With a declared ``schema`` no footer-reading job is needed to infer it."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(os.path.join(directory, f"{name}.parquet"))


def _spec(table: str | TableSpec) -> TableSpec:
    return table if isinstance(table, TableSpec) else TABLES[table]


def read_table(
    spark: SparkSession,
    path: str,
    table: str | TableSpec,
    fmt: str = "parquet",
    **options,
) -> DataFrame:
    """Read one healthcare table with its declared schema.

    ``fmt`` is ``parquet``, ``csv`` or ``json``. Each file's columns are taken
    by the names in its own header or footer; a file may lack columns others
    have (NULL there; pass the result through ``conform`` for columns that no
    file has). A malformed value or record fails the read, as an INSERT would;
    arrays are not representable in CSV.
    """
    spec = _spec(table)
    reader = spark.read.options(**options)
    if fmt == "csv":
        raw = read_csv_text(spark, path, spec, mode="FAILFAST", **options)
        return raw.select(*[strict_cast(F.col(c), spec.column(c).dtype, c).alias(c) for c in raw.columns])
    if fmt == "json":
        # A malformed record fails the read instead of becoming NULL fields.
        return reader.option("mode", "FAILFAST").schema(spec.schema).json(path)
    return check_types(reader.option("mergeSchema", "true").parquet(path), spec)


class SchemaMismatch(ValueError):
    """A source column's type does not fit the declared one."""


def _fits(actual: T.DataType, declared: T.DataType) -> bool:
    """Whether every value of ``actual`` is one of ``declared``."""
    if actual == declared or isinstance(actual, T.NullType):
        return True
    whole = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
    digits = whole.get(type(actual))
    if isinstance(declared, T.DecimalType):
        if isinstance(actual, T.DecimalType):   # more digits before the point are tested row by row (K7)
            return actual.scale <= declared.scale
        return digits is not None
    if digits and type(declared) in whole:
        return digits <= whole[type(declared)]
    if isinstance(declared, T.ArrayType) and isinstance(actual, T.ArrayType):
        return _fits(actual.elementType, declared.elementType)
    if isinstance(declared, T.TimestampNTZType):
        return isinstance(actual, (T.TimestampType, T.DateType))
    return isinstance(declared, T.StringType) and isinstance(actual, (T.VarcharType, T.CharType))


def check_types(df: DataFrame, table: str | TableSpec) -> DataFrame:
    """``df`` itself; raises ``SchemaMismatch`` naming every declared column
    whose type there could lose value (``double`` amounts, timestamps as dates,
    numbers as text). Only the schema is looked at."""
    spec = _spec(table)
    wrong = [f"{f.name} is {f.dataType.simpleString()}, declared {spec.column(f.name).dtype.simpleString()}"
             for f in df.schema.fields if f.name in spec.column_names and not _fits(f.dataType, spec.column(f.name).dtype)]
    if wrong:
        raise SchemaMismatch(f"{spec.name}: " + "; ".join(wrong))
    return df


def strict_cast(value: Column, dtype: T.DataType, name: str) -> Column:
    """``value`` as ``dtype``; a value that is none fails the job in every ANSI mode."""
    cast = value.try_cast(dtype)
    message = F.concat(F.lit(f"{name} is no {dtype.simpleString()}: "), value.cast("string"))
    return F.when(value.isNotNull() & cast.isNull(), F.raise_error(message).cast(dtype)).otherwise(cast)


def csv_headers(spark: SparkSession, path: str, **options) -> dict[tuple[str, ...], list[str]]:
    """The CSV files under ``path`` by their header. One line of each file is
    read, through the file's own file system; nothing else reaches the driver."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    # The listing (with globs, without contents) is Spark's own.
    files = [r.path for r in spark.read.format("binaryFile").load(path).select("path", "length").filter("length > 0").collect()]

    def header(file: str) -> tuple[str, ...]:
        p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        stream = p.getFileSystem(conf).open(p)
        try:
            codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
            raw = codec.createInputStream(stream) if codec is not None else stream
            line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(raw, "UTF-8")).readLine()
        finally:
            stream.close()
        row = next(csv.reader([line.lstrip("\ufeff")], delimiter=options.get("sep", ",")), [])
        return tuple(c.strip() for c in row)

    with ThreadPoolExecutor(16) as pool:
        found = list(pool.map(header, files))
    out: dict[tuple[str, ...], list[str]] = {}
    for file, names in zip(files, found):
        out.setdefault(names, []).append(file)
    return out


def read_csv_text(spark: SparkSession, path: str, table: str | TableSpec, mode: str = "PERMISSIVE", **options) -> DataFrame:
    """The declared columns (arrays left out) of CSV files as text, each file
    by its own header. ``mode`` is Spark's: ``FAILFAST`` refuses a line whose
    fields don't match its header, ``PERMISSIVE`` fills up with NULL."""
    spec = _spec(table)
    wanted = [c.name for c in spec.columns if not isinstance(c.dtype, T.ArrayType)]
    out = None
    for names, files in sorted(csv_headers(spark, path, **options).items()):
        lower = [n.lower() for n in names]
        if len(set(lower)) < len(lower):
            raise SchemaMismatch(f"{spec.name}: repeated column in the header {', '.join(names)}")
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        part = (spark.read.options(**options).option("header", "true").option("enforceSchema", "false").option("mode", mode)
                .schema(schema).csv(files)).select(*[F.col(n) for n in names if n in wanted])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        return spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in wanted]))
    return out.select(*[n for n in wanted if n in out.columns])


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str | TableSpec,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Read a table from a live database (the reference's PostgreSQL store).

    For large tables give a numeric ``partition_column`` and bounds so the
    read is split over ``num_partitions`` parallel range queries instead of
    one connection.
    """
    spec = _spec(table)
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", spec.name)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions or 8))
        )
    return check_types(reader.load(), spec)


def _default_value(spec_default: str, dtype: T.DataType, now: dt.datetime):
    if spec_default == "now":
        return ts_lit(now)
    if spec_default == "today":
        return date_lit(now.date())
    return F.expr(spec_default).cast(dtype)


def conform(
    df: DataFrame,
    table: str | TableSpec,
    now: dt.datetime | str | None = None,
) -> DataFrame:
    """Bring ``df`` to the declared schema of ``table``.

    A column that is absent takes the DDL default (timestamps = ``now``,
    ``is_active`` = TRUE, ``adjustment_amount`` = 0, ``quantity`` = 1, flags
    FALSE, audit ``status`` = 'OPEN', ``metric_date`` = today) or NULL. An
    explicit NULL in a present column is kept, as in PostgreSQL. Present
    columns are cast to the declared type; columns outside the schema are
    dropped. Pure projection: no shuffle, no action.
    """
    spec = _spec(table)
    now_ts = as_timestamp(now)
    present = set(df.columns)
    cols = []
    for c in spec.columns:
        if c.name in present:
            cols.append(F.col(c.name).cast(c.dtype).alias(c.name))
        elif c.default is not None:
            cols.append(_default_value(c.default, c.dtype, now_ts).cast(c.dtype).alias(c.name))
        else:
            cols.append(F.lit(None).cast(c.dtype).alias(c.name))
    return df.select(*cols)


__all__ = ["read_source", "read_table", "read_jdbc", "conform", "as_date"]


def store_bucketed(df: DataFrame, table_name: str, key: str, buckets: int, path: str | None = None) -> None:
    """Save ``df`` as a catalog table bucketed and sorted on ``key``.

    Tables that are joined or grouped on the same key every run (claims and
    their line items on ``claim_id``) stored with the same bucket count let
    Spark aggregate the lines per claim and join them to the claims without
    any shuffle: each bucket pair is processed by one task. ``path`` keeps
    the files in a chosen (shared) folder; the catalog holds the metadata.
    """
    writer = df.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table_name)


def read_stored(spark: SparkSession, table_name: str) -> DataFrame:
    """A table saved with ``store_bucketed`` (bucketing kept in the plan)."""
    return spark.table(table_name)
