"""Exact duplicates by skew-safe combining of full contents.

Rows are combined in three stages, and every stage groups by the content itself, so equal
digests of different contents never merge:

1. inside each task (the partial aggregation that runs where the text is read),
2. per (digest, salt), the salt being the task, so that a group holding a third of all rows
   meets in ``salts`` places and not in one,
3. per digest, over the few winners that the salts left.

Members find their winner by digest. A digest shared by different contents is noticed in stage
3, and only for such digests the members' contents are compared again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from .columns import ids_and_texts

# Places in which one group meets before its last merge.
SALTS = 32


def normalised(text: Column) -> Column:
    """Every run of blanks as one space."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, text_sha256``.

    Null texts are empty texts, and all empty texts are one group. The smallest id of a group
    stays. Rows that repeat an id and its text are counted each and all get the verdict of
    their id. A null id is never the smallest; a group of null ids only has a null ``keep_id``
    and nothing of it is kept. An empty table gives an empty result. Columns beside id and
    text are not read.
    """
    plain = ids_and_texts(docs, id_col, text_col).select("id", normalised(F.col("text")).alias("text"))
    rows = plain.withColumn("digest", digest(F.col("text")))
    salted = (
        rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .groupBy("digest", "salt", "text")
        .agg(F.min("id").alias("id"), F.count("*").alias("n"))
    )
    # Dealt by digest alone: the winners of one digest meet, and are compared by content.
    winners = (
        salted.repartition("digest")
        .groupBy("digest", "text")
        .agg(F.min("id").alias("keep_id"), F.sum("n").alias("group_size"))
        .withColumn("variants", F.count("*").over(W.partitionBy("digest")))
    )
    found = materialize(
        winners.select(
            "digest",
            "keep_id",
            "group_size",
            sha256(F.col("text")).alias("text_sha256"),
            F.when(F.col("variants") > 1, F.col("text")).alias("variant"),
        ),
        "exact-winners",
    )
    out = _verdicts(
        rows.select("id", "digest").join(found.filter("variant IS NULL"), "digest"), id_col
    )
    shared = found.filter("variant IS NOT NULL")
    if not shared.isEmpty():
        meant = shared.withColumnRenamed("digest", "_digest")
        same = (F.col("digest") == F.col("_digest")) & (F.col("text") == F.col("variant"))
        out = out.unionByName(_verdicts(rows.join(meant, same), id_col))
    return out


def _verdicts(matched: DataFrame, id_col: str) -> DataFrame:
    kept = F.coalesce(F.col("id") == F.col("keep_id"), F.lit(False))
    return matched.select(
        F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), "text_sha256"
    )
