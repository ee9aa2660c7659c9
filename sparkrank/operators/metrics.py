"""Recall, average precision, NDCG and reciprocal rank of runs against judgments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ranking import SCORE_DECIMALS, discount, round_score
from ..functions.sums import exact_sum
from .topk import MAX_LIST, numbered

# Depths at which recall is reported.
RECALL_CUTOFFS = (5, 10, 15, 20, 30, 100, 200, 500, 1000)
# The measures and the lowest judgment that counts as relevant.
MEASURES = ("map", "ndcg", "recip_rank", "recall")
RELEVANT = 1
# Ranks summed at once.
CHUNK = 100_000


def run_keys(run: DataFrame) -> list[str]:
    """Columns that identify one query's list in one run."""
    named = [c for c in ("run_name", "qrels_name", "cutoff") if c in run.columns]
    return [*named, "query_id"]


def run_order(order: str = "score") -> list[Column]:
    """``'score'`` sorts as the usual evaluation tool does, ties by descending id as text;
    ``'rank'`` trusts the rank of the run."""
    if order == "rank":
        return [F.asc("rank")]
    return [F.desc_nulls_last(round_score(F.col("score"))), F.desc(F.col("doc_id").cast("string"))]


def with_judgments(run: DataFrame, qrels: DataFrame) -> DataFrame:
    """``run`` with ``rel``; unjudged documents count as not relevant."""
    on = [c for c in ("qrels_name",) if c in run.columns and c in qrels.columns]
    judged = qrels.select(*on, "query_id", "doc_id", "rel")
    return run.join(judged, [*on, "query_id", "doc_id"], "left").withColumn(
        "rel", F.coalesce("rel", F.lit(0))
    )


def relevant_hits(
    judged: DataFrame, order: str = "score", depth: int | None = None, max_list: int = MAX_LIST
) -> DataFrame:
    """Judged rows with ``rank`` and ``hits``, the relevant documents up to that rank.

    ``depth`` bounds the length of a list. Without a bound the longest list is measured, and
    lists too long for one task are numbered across tasks.
    """
    keys, given = run_keys(judged), order == "rank"
    kept = [c for c in judged.columns if c != "rank"]
    rows = judged.withColumnRenamed("rank", "_given") if given else judged.select(*kept)
    by = [F.asc("_given")] if given else run_order(order)
    hit = (F.col("rel") >= RELEVANT).cast("bigint")
    found = numbered(rows, keys, by, depth, max_list, {"hits": hit})
    rank = F.col("_given" if given else "rank").alias("rank")
    return found.select(*kept, rank, "hits")


def ideal_gains(qrels: DataFrame) -> DataFrame:
    """``(query_id, n_rel, ideal)``: relevant documents and the best reachable gain.

    Judgments are counted per level first; a level then fills the ranks after all higher ones,
    so no list of judged documents is sorted.
    """
    keys = [c for c in ("qrels_name", "query_id") if c in qrels.columns]
    levels = (
        qrels.groupBy(*keys, "rel")
        .agg(F.count("*").alias("n"))
        .withColumn("n", F.when(F.col("rel") >= RELEVANT, F.col("n")).otherwise(F.lit(0)))
    )
    higher = W.partitionBy(*keys).orderBy(F.desc("rel")).rowsBetween(W.unboundedPreceding, -1)
    placed = levels.withColumn("before", F.coalesce(F.sum("n").over(higher), F.lit(0)))
    # A level is summed in chunks, since one query may hold most of the judgments.
    chunks = F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / CHUNK) - 1, F.lit(0)))
    parts = placed.withColumn("chunk", F.explode(chunks))
    start = F.col("chunk") * CHUNK
    size = F.least(F.col("n") - start, F.lit(CHUNK))
    ranks = F.when(
        size > 0, F.sequence(F.col("before") + start + 1, F.col("before") + start + size)
    ).otherwise(F.array().cast("array<bigint>"))
    gain = F.aggregate(ranks, F.lit(0.0), lambda s, r: s + discount(r))
    return parts.groupBy(*keys).agg(
        F.sum(size).alias("n_rel"), exact_sum(F.col("rel") * gain).alias("ideal")
    )


def evaluate(
    run: DataFrame,
    qrels: DataFrame,
    measures: Sequence[str] = MEASURES,
    recall_cutoffs: Sequence[int] = RECALL_CUTOFFS,
    order: str = "score",
    depth: int | None = None,
    max_list: int = MAX_LIST,
) -> DataFrame:
    """``([run_name, ...,] query_id, measure, value)`` of queries in both run and judgments."""
    unknown = set(measures) - set(MEASURES)
    if unknown:
        raise ValueError(f"unknown measures: {sorted(unknown)}")
    keys = run_keys(run)
    columns = [*keys, "doc_id", *(c for c in ("score", "rank") if c in run.columns)]
    rows = relevant_hits(with_judgments(run.select(*columns), qrels), order, depth, max_list)
    hit = F.col("rel") >= RELEVANT
    sums = rows.groupBy(*keys).agg(
        exact_sum(F.when(hit, F.col("hits") / F.col("rank"))).alias("precision"),
        exact_sum(F.when(hit, F.col("rel") * discount(F.col("rank")))).alias("gain"),
        F.min(F.when(hit, F.col("rank"))).alias("first"),
        *[F.count(F.when(hit & (F.col("rank") <= c), 1)).alias(f"r{c}") for c in recall_cutoffs],
    )
    on = [c for c in ("qrels_name", "query_id") if c in run.columns and c in qrels.columns]
    ideal = ideal_gains(qrels.select(*on, "doc_id", "rel"))
    both = sums.join(ideal, on)

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(part / F.nullif(whole.cast("double"), F.lit(0.0)), F.lit(0.0))

    values = []
    if "map" in measures:
        values.append(("map", share(F.col("precision"), F.col("n_rel"))))
    if "ndcg" in measures:
        values.append(("ndcg", share(F.col("gain"), F.col("ideal"))))
    if "recip_rank" in measures:
        values.append(("recip_rank", F.coalesce(F.lit(1.0) / F.col("first"), F.lit(0.0))))
    if "recall" in measures:
        values += [(f"recall_{c}", share(F.col(f"r{c}"), F.col("n_rel"))) for c in recall_cutoffs]
    listed = F.array(
        *[F.struct(F.lit(n).alias("measure"), round_score(v).alias("value")) for n, v in values]
    )
    return both.select(*keys, F.explode(listed).alias("m")).select(*keys, "m.measure", "m.value")


def mean_over_queries(metrics: DataFrame) -> DataFrame:
    """``([run_name, ...,] measure, value)``: mean over the queries that were evaluated."""
    keys = [c for c in run_keys(metrics) if c != "query_id"]
    # Values have six decimals, so their mean is often just between two of them. Whole numbers
    # of millionths round the same way in whatever order they are added.
    scale = 10**SCORE_DECIMALS
    total = F.sum(F.round(F.col("value") * scale).cast("bigint"))
    count = F.count("value")
    mean = F.floor((2 * total + count) / (2 * count)) / scale
    return metrics.groupBy(*keys, "measure").agg(mean.alias("value"))


def with_qrels_name(runs: DataFrame) -> DataFrame:
    """A run belongs to the judgments its name starts with, up to the first dash."""
    return runs.withColumn("qrels_name", F.regexp_extract("run_name", "^([^-]*)", 1))


def runs_without_qrels(runs: DataFrame, qrels: DataFrame) -> DataFrame:
    """``(run_name, qrels_name)`` of runs whose judgments are missing."""
    named = with_qrels_name(runs.select("run_name").distinct())
    return named.join(qrels.select("qrels_name").distinct(), "qrels_name", "left_anti").select(
        "run_name", "qrels_name"
    )


def evaluate_runs(runs: DataFrame, qrels: DataFrame, **options) -> DataFrame:
    """Metrics per run and query of many runs, each against the judgments of its name.

    ``qrels(qrels_name, query_id, doc_id, rel)`` holds all judgment sets.
    """
    return evaluate(with_qrels_name(runs), qrels, **options)
