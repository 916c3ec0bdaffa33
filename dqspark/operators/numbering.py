"""Serial numbers without one task that sees all rows.

Rows are written, sorted across range partitions and written again (reliable
checkpoints in ``spark.checkpoint.dir``), which fixes every row's partition and
place in it. A row's number is its place plus the rows of all partitions
before its own: prefix sums over one count per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import fresh_name
from ..session import checkpoint_dir

_PLACE_BITS = 33  # monotonically_increasing_id: partition, then place in it


def ordered(df: DataFrame, order: list[str | Column], number: str, start: int | Column = 1) -> DataFrame:
    """``df`` with the column ``number``: ``start``, ``start + 1``, ... in
    ``order``, without gaps. Rows equal in ``order`` are numbered in any order."""
    checkpoint_dir(df.sparkSession)
    # Range partitioning reads its input twice, first to sample it: what made the rows runs once.
    once = df.checkpoint(eager=True)
    rows = once.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint(eager=True)
    return in_place(rows, number, start)


def in_place(rows: DataFrame, number: str, start: int | Column = 1) -> DataFrame:
    """Number the rows of a checkpointed DataFrame in the order they lie in."""
    place, part, before = (fresh_name(rows, n) for n in ("_place", "_part", "_before"))
    placed = rows.withColumn(place, F.monotonically_increasing_id())
    sizes = placed.groupBy(F.shiftright(place, _PLACE_BITS).alias(part)).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition of ``rows``: as many as there are tasks, so this may be sent to all of them.
    bases = sizes.select(part, (F.sum("_n").over(Window.orderBy(part)) - F.col("_n")).alias(before))
    first = start if isinstance(start, Column) else F.lit(start)
    numbered = placed.join(F.broadcast(bases), F.shiftright(place, _PLACE_BITS) == F.col(part))
    local = F.col(place).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return numbered.select(*rows.columns, (first + F.col(before) + local).cast("bigint").alias(number))
