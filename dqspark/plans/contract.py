"""Projection applied at the comparison edge (``__spark_entry__.queries``).

Values are exposed in types both Spark and DuckDB render identically:
decimals as DOUBLE, integers as BIGINT, dates as ``yyyy-MM-dd`` text,
timestamps as ``yyyy-MM-dd HH:mm:ss[.f]`` text (fraction without trailing
zeros, as both engines print it) and arrays as comma-joined text (element
order kept; id lists are already sorted by the operators). A pure per-row
projection: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_contract(df: DataFrame) -> DataFrame:
    cols = []
    for field in df.schema.fields:
        c = F.col(field.name)
        t = field.dataType
        if isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            # Dates and zone-less timestamps cast to text without passing
            # through the session time zone (a DST gap cannot shift them).
            c = c.cast("string")
        elif isinstance(t, T.ArrayType):
            c = F.array_join(c, ",")
        cols.append(c.alias(field.name))
    return df.select(*cols)
