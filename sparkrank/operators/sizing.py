"""Size checks that decide what may be broadcast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest table, in bytes of row content, that is sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024
# Rows in a broadcast or handed to a Python task, for tables with many narrow rows.
BROADCAST_ROWS = 2_000_000
# Cost of a row beyond its content (hash table entry, object headers).
ROW_OVERHEAD = 32


def row_bytes(df: DataFrame) -> Column:
    """Measured width of a row: fixed-size columns by type, strings and arrays by content."""
    parts = [F.lit(ROW_OVERHEAD)]
    for field in df.schema.fields:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(column), F.lit(0)))
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
            parts.append(F.coalesce(F.size(column), F.lit(0)) * 8)
        elif isinstance(kind, T.ArrayType):
            text = F.to_json(F.struct(column.alias("v")))
            parts.append(F.coalesce(F.octet_length(text), F.lit(0)))
        else:
            parts.append(F.lit(16))
    return reduce(lambda a, b: a + b, parts).cast("bigint")


def measured_size(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df``; one aggregation, one row to the driver."""
    found = df.select(row_bytes(df).alias("b")).agg(
        F.count("*").alias("rows"), F.coalesce(F.sum("b"), F.lit(0)).alias("bytes")
    ).first()
    return int(found["rows"]), int(found["bytes"])


def fits(df: DataFrame, max_bytes: int | None = None, max_rows: int | None = None) -> bool:
    rows, size = measured_size(df)
    return rows <= (max_rows or BROADCAST_ROWS) and size <= (max_bytes or BROADCAST_BYTES)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
