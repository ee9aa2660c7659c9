"""Equi-joins that pick their strategy from a measured size."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Copies of a hot key's rows are spread over this many sub-keys at least.
SALTS = 32


def hinted(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def salted_join(big: DataFrame, small: DataFrame, key: str, spread: str, salts: int | None = None):
    """Shuffled inner join on ``key`` where one key may hold much of ``big``.

    Rows of ``big`` get a sub-key from ``spread``; rows of ``small`` are repeated per sub-key.
    Sub-keys grow with the width of shuffles.
    """
    if salts is None:
        width = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salts = max(SALTS, 2 * math.isqrt(width))
    left = big.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [key, "_salt"]).drop("_salt")
