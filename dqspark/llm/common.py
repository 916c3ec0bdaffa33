"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dqspark.session import apply_defaults, checkpoint_dir

def new_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the session's shared checkpoint folder, named with
    its file system: a path without scheme means Hadoop's default one."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/dqspark-{label}-{uuid.uuid4().hex}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toUri().toString()


def open_fs(uri: str):
    """pyarrow's file system and path of a qualified folder, for tasks that
    write or read raw files: local, S3 (whatever Hadoop calls it), GCS, HDFS."""
    from pyarrow import fs

    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"s3:{rest}" if scheme in ("s3a", "s3n") else uri)


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet into the shared folder and read back:
    lineage is cut, and the rows survive the loss of any executor."""
    spark = df.sparkSession
    path = new_dir(spark, label)
    _SAVED.add(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SAVED: set[str] = set()


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_all_saved(spark: SparkSession) -> None:
    """Delete every ``saved`` table of this application; for the end of a job,
    when all results that read them are written."""
    while _SAVED:
        _delete(spark, _SAVED.pop())


def drop_saved(df: DataFrame) -> None:
    """Delete the files behind a ``saved`` table nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _delete(spark, folder)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold(doc_id: str, n: int) -> Column:
    """crc32 of the id's text, modulo ``n``; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % n


def scan_partitions(df: DataFrame) -> int:
    """Tasks for work that follows the input: its scan's splits, at least the
    session's shuffle partitions."""
    return max(df.rdd.getNumPartitions(), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def text_slices(batch, column: str = "text", most: int = 5_000_000):
    """Row ranges ``(from, to)`` of an Arrow batch with about ``most`` bytes of
    text each (one row at least), so that long texts don't pile up in memory."""
    import numpy as np
    import pyarrow.compute as pc

    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(size)]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]


_SHIPPED: set[str] = set()


def release_memory() -> None:
    """Give memory that was freed back to the system: Spark's Python workers
    live on between tasks, next to those of later stages."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):    # no glibc
        pass


def tidy(run):
    """``run`` (batches to batches) that releases memory when it is done."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            release_memory()

    return tidied


ROWS_PER_BATCH = "1000"
"""Texts are long: Arrow batches of Spark's default 10,000 rows would hold tens of megabytes."""


def ship(spark: SparkSession) -> None:
    """Give this package to the application's Python workers, once, through
    the shared folder (for sessions started without ``--py-files``), and keep
    Arrow batches small unless the submitter has set their size."""
    sc = spark.sparkContext
    apply_defaults(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": ROWS_PER_BATCH})
    if sc.applicationId in _SHIPPED:
        return
    import io
    import zipfile
    from pathlib import Path

    package, data = Path(__file__).resolve().parent.parent, io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    file = f"{new_dir(spark, 'code')}/dqspark.zip"
    path = sc._jvm.org.apache.hadoop.fs.Path(file)
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
    out.write(data.getvalue())
    out.close()
    sc.addPyFile(file)
    _SHIPPED.add(sc.applicationId)


def split_words(texts):
    """Of an Arrow text column, lower-cased in A-Z: the words (runs without
    ASCII white space) of all texts in order, and the row each comes from."""
    import pyarrow as pa
    import pyarrow.compute as pc

    text = pc.fill_null(texts.cast(pa.large_string()), "")
    for ch in "\t\n\x0b\f\r":
        text = pc.replace_substring(text, ch, " ")
    lists = pc.split_pattern(text, " ")
    doc, flat = pc.list_parent_indices(lists), pc.list_flatten(lists)
    full = pc.not_equal(flat, "")
    # Lower-cased last: Arrow's kernel needs an array that is no slice.
    return pc.ascii_lower(flat.filter(full)), doc.filter(full).to_numpy(zero_copy_only=False)
