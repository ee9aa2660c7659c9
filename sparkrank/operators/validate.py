"""Checks of inputs before a retrieval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_details(ids: DataFrame, details: DataFrame, on: str, column: str) -> DataFrame:
    """Ids without a row in ``details``, or with null in its ``column``."""
    return ids.select(on).distinct().join(details.filter(F.col(column).isNotNull()), on, "left_anti")


def malformed_vectors(vectors: DataFrame, id_column: str) -> DataFrame:
    """``(id, size, problem)`` of vectors that are null, lack an id, or differ in length.

    The expected length is the commonest one, the smaller of equally common ones.
    """
    sizes = vectors.select(F.size("embedding").alias("size")).filter("size > 0")
    counted = sizes.groupBy("size").agg(F.count("*").alias("n"))
    usual = counted.agg(F.max_by("size", F.struct("n", -F.col("size")))).scalar()
    problem = (
        F.when(F.col(id_column).isNull(), "no id")
        .when(F.col("embedding").isNull(), "no vector")
        .when(F.size("embedding") != usual, "other length")
    )
    checked = vectors.select(id_column, F.size("embedding").alias("size"), problem.alias("problem"))
    return checked.filter(F.col("problem").isNotNull())


def load_report(
    collection: DataFrame, vectors: DataFrame | None = None, id_column: str = "doc_id"
) -> DataFrame:
    """``(item, n)``: passages, vectors, and ids that have only one of both."""
    counts = [collection.agg(F.lit("passages").alias("item"), F.count("*").alias("n"))]
    if vectors is not None:
        usable = vectors.filter(F.col("embedding").isNotNull())
        alone = collection.join(usable, id_column, "left_anti")
        bare = usable.join(collection, id_column, "left_anti")
        counts += [
            usable.agg(F.lit("vectors").alias("item"), F.count("*").alias("n")),
            alone.agg(F.lit("passages without vector").alias("item"), F.count("*").alias("n")),
            bare.agg(F.lit("vectors without passage").alias("item"), F.count("*").alias("n")),
        ]
    report = counts[0]
    for part in counts[1:]:
        report = report.unionByName(part)
    return report


def input_checks(**tables: DataFrame) -> DataFrame:
    """``(item, usable)`` per table: whether it has a row."""
    rows = [
        table.agg(F.lit(name).alias("item"), (F.count("*") > 0).alias("usable"))
        for name, table in tables.items()
    ]
    report = rows[0]
    for row in rows[1:]:
        report = report.unionByName(row)
    return report


def require_rows(df: DataFrame, what: str) -> None:
    if df.isEmpty():
        raise ValueError(f"no {what} found")


def with_required(ids: DataFrame, details: DataFrame, on: str, column: str) -> DataFrame:
    """``(id, column)`` of all ids; the job fails on an id that has none.

    The check is part of the plan and reads nothing twice.
    """
    found = ids.select(on).join(details.select(on, column), on, "left")
    return found.select(on, required(F.col(column), F.col(on)).alias(column))


def required(value: Column, key: Column) -> Column:
    """``value``; the job fails where it is null, naming the key."""
    message = F.concat(F.lit("nothing found for id "), key.cast("string"))
    return F.when(value.isNull(), F.raise_error(message)).otherwise(value)
