"""Small shared pieces: safe column picking and worker code shipping."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package

# White space of the contracts: space and the controls from tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"
# Stands for a null id inside an operator: one document that comes after all others.
LAST_ID = 2**63 - 1


def named(df: DataFrame, column: str) -> Column:
    """A column by its exact name, dots and all."""
    return df[f"`{column}`"]


def ids_and_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, text)`` and nothing else, null texts as empty ones.

    All other columns are left behind, so none of them can clash with names used later on.
    """
    return docs.select(
        named(docs, id_col).cast("bigint").alias("id"),
        F.coalesce(named(docs, text_col).cast("string"), F.lit("")).alias("text"),
    )


def ids_and_bytes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, text)`` with the text as its UTF-8 bytes and null ids as :data:`LAST_ID`."""
    return docs.select(
        known_id(named(docs, id_col)).alias("id"),
        F.coalesce(named(docs, text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
    )


def known_id(column: Column) -> Column:
    return F.coalesce(column.cast("bigint"), F.lit(LAST_ID))


def outer_id(column: str | Column) -> Column:
    """The id as it came in: :data:`LAST_ID` becomes null again."""
    return F.nullif(F.col(column) if isinstance(column, str) else column, F.lit(LAST_ID))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


# Most rows and bytes of whole texts that go to a Python worker at once.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": 1000,
    "spark.sql.execution.arrow.maxBytesPerBatch": 16 * 1024 * 1024,
}


def for_workers(spark: SparkSession) -> None:
    """Make this package importable in the workers, and bound the batches that they get.

    Texts are wide rows: the session's batch sizes are lowered to :data:`BATCH` if they are larger.
    """
    ship_package(spark)
    for key, most in BATCH.items():
        size = spark.conf.get(key).lower().removesuffix("b")
        if not size.isdigit() or not 0 < int(size) <= most:
            spark.conf.set(key, str(most))


def release() -> None:
    """Give freed memory back to the system; workers live on after a task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not glibc


Batches = Iterator[pa.RecordBatch]


def map_arrow(df: DataFrame, function: Callable[[Batches], Batches], schema) -> DataFrame:
    """``mapInArrow`` for whole texts; see :func:`for_workers` and :func:`release`."""
    for_workers(df.sparkSession)

    def run(batches: Batches) -> Batches:
        try:
            yield from function(batches)
        finally:
            release()

    return df.mapInArrow(run, schema)


def shuffle_parts(df: DataFrame) -> int:
    """Partitions of a shuffle in this session: the user's statement of the scale."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
