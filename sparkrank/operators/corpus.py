"""Assembling collections, queries and vectors from their parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from .joins import hinted
from .sizing import fits


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the last by ``order``. Partial maxima run before the shuffle."""
    others = [c for c in df.columns if c not in keys and c not in order]
    last = F.max_by(F.struct(*others), F.struct(*order))
    return df.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*")


def keep_last_sparse(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """As ``keep_last``, for wide rows with few repeated keys.

    Only keys are shuffled to find the repeated ones; rows with a key of their own stay where
    they were read. Without repeated keys the table is given back as it is.
    """
    repeated = df.groupBy(*keys).count().filter(F.col("count") > 1).select(*keys)
    repeated = materialize(repeated, "repeated")
    if repeated.isEmpty():
        return df.drop(*order)
    listed = hinted(repeated, fits(repeated))
    single = df.join(listed, keys, "left_anti").drop(*order)
    last = keep_last(df.join(listed, keys, "left_semi"), keys, order)
    return single.unionByName(last)


def restrict(collection: DataFrame, subset: DataFrame | None, on: str = "doc_id") -> DataFrame:
    """Rows whose id is listed in ``subset``; everything when there is no list."""
    return collection if subset is None else collection.join(subset.select(on), on, "left_semi")


def with_vectors(embedded: DataFrame) -> DataFrame:
    return embedded.filter(F.col("embedding").isNotNull())


def attach(ids: DataFrame, details: DataFrame, on: str) -> DataFrame:
    """Look up text or vector by id; ids without one stay, with null."""
    return ids.join(details, on, "left")


def assemble(collection: DataFrame, vectors: DataFrame, on: str = "doc_id") -> DataFrame:
    """Every id that has a text or a vector, with both."""
    return collection.join(vectors, on, "full_outer")


def all_ids(*tables: DataFrame, on: str = "doc_id") -> DataFrame:
    ids = tables[0].select(on)
    for table in tables[1:]:
        ids = ids.union(table.select(on))
    return ids.distinct()
