"""Ranks within a query's list, and the k best of each list."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import materialize

# Shuffle width from which the k best are found in two rounds.
TWO_ROUND_PARTITIONS = 512
# Longest list that one task numbers on its own.
MAX_LIST = 5_000_000


def ranking_order(df: DataFrame, doc: str = "doc_id") -> list[Column]:
    """Best score first, then the rank given by the previous stage if any, then the id."""
    order = [F.desc_nulls_last("score")]
    if "prev_rank" in df.columns:
        order.append(F.asc_nulls_last("prev_rank"))
    return order + [F.asc(doc)]


def with_rank(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(*order)))


def top_k(
    df: DataFrame, by: list[str], order: list[Column], k: int, salts: int | None = None
) -> DataFrame:
    """The ``k`` first rows of every group, numbered from 1 in ``rank``.

    Each input partition keeps at most k rows per group before anything is shuffled. On wide
    shuffles a first round over (group, salt) keeps the final round at salts * k rows per
    group, however many partitions the scan had.
    """
    if salts is None:
        width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salts = math.isqrt(width) if width >= TWO_ROUND_PARTITIONS else 1
    if salts > 1:
        salted = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        first = with_rank(salted, [*by, "_salt"], order).filter(F.col("rank") <= k)
        df = first.drop("_salt", "rank")
    return with_rank(df, by, order).filter(F.col("rank") <= k)


def cut(ranked: DataFrame, n: int) -> DataFrame:
    """The first ``n`` of every ranked list."""
    return ranked.filter(F.col("rank") <= n)


def numbered(
    df: DataFrame,
    by: list[str],
    order: list[Column],
    longest: int | None = None,
    max_list: int | None = None,
    running: dict[str, Column] | None = None,
) -> DataFrame:
    """Number whole lists of any length in ``rank``, keeping every row.

    ``running`` adds sums of whole numbers over a list up to and with each row, by name.

    ``longest`` is a known bound of the list length; without it the longest list is counted.
    Lists up to ``max_list`` rows are numbered by a window. Beyond that one list may hold a
    large part of the table, so rows are range-partitioned by list and order, written, and
    numbered by position: a row's rank is its position in its partition plus the rows its
    list has in earlier partitions. No task then holds a whole list.
    """
    max_list = max_list or MAX_LIST
    if longest is None:
        longest = df.groupBy(*by).count().agg(F.max("count")).first()[0] or 0
    df, running = df.withColumns(running or {}), list(running or {})
    so_far = lambda w: w.rowsBetween(W.unboundedPreceding, 0)
    if longest <= max_list:
        whole = so_far(W.partitionBy(*by).orderBy(*order))
        ranked = with_rank(df, by, order)
        return ranked.withColumns({c: F.sum(c).over(whole) for c in running})
    keys = [F.col(c) for c in by]
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(
        df.repartitionByRange(width, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_pos", F.monotonically_increasing_id())
        .withColumn("_part", F.spark_partition_id()),
        "numbered",
    )
    parts = placed.groupBy(*by, "_part").agg(
        F.min("_pos").alias("_first"),
        F.count("*").alias("_rows"),
        *[F.sum(c).alias(f"_all_{c}") for c in running],
    )
    earlier = W.partitionBy(*by).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    starts = parts.select(
        *by,
        "_part",
        "_first",
        before("_rows").alias("_before"),
        *[before(f"_all_{c}").alias(f"_all_{c}") for c in running],
    )
    inside = so_far(W.partitionBy(*by, "_part").orderBy("_pos"))
    return (
        placed.join(starts, [*by, "_part"])
        .withColumn("rank", (F.col("_pos") - F.col("_first") + F.col("_before") + 1).cast("int"))
        .withColumns({c: F.sum(c).over(inside) + F.col(f"_all_{c}") for c in running})
        .select(*df.columns, "rank")
    )
