"""Runs of rankings over judged query sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import hinted
from ..operators.sizing import fits, union_all
from ..operators.validate import missing_details, with_required
from ..sources.writers import at_cutoffs, run_name
from .stages import Ranking

# Depths of the two stages, and cutoffs of the written runs.
DEPTHS = (1000, 100)
CUTOFFS = (100, 10)


def judged_queries(query_sets: Mapping[str, DataFrame]) -> DataFrame:
    """``(qrels_name, query_id)``: the query ids of every judgment set."""
    return union_all(
        [
            ids.select(F.lit(name).alias("qrels_name"), "query_id").distinct()
            for name, ids in query_sets.items()
        ]
    )


def evaluated_queries(asked: DataFrame, queries: DataFrame, on_missing: str) -> DataFrame:
    """Queries to evaluate, with their text. Unknown ids are an error or are dropped."""
    ids = asked.select("query_id").distinct()
    if on_missing == "error":
        return with_required(ids, queries, "query_id", "text")
    if on_missing != "drop":
        raise ValueError("on_missing is 'error' or 'drop'")
    return ids.join(queries.filter(F.col("text").isNotNull()), "query_id")


def make_run(
    ranked: DataFrame,
    asked: DataFrame,
    label: str,
    depths: Sequence[int],
    cutoffs: Sequence[int] = CUTOFFS,
    run_id: str = "run_1",
) -> DataFrame:
    """``(run_name, qrels_name, cutoff, query_id, doc_id, rank, score, run_id)``.

    One ranked list serves every judgment set its query is in, and every cutoff.
    """
    if any(c.isspace() for c in run_id):
        raise ValueError("a run id holds no whitespace")
    cut = at_cutoffs(ranked, list(cutoffs))
    named = cut.join(hinted(asked, fits(asked)), "query_id")
    depth_list = F.array(*[F.lit(int(d)) for d in depths])
    name = run_name(F.col("qrels_name"), F.lit(label), depth_list, F.col("cutoff"))
    return named.select(
        name.alias("run_name"),
        "qrels_name",
        "cutoff",
        "query_id",
        "doc_id",
        "rank",
        "score",
        F.lit(run_id).alias("run_id"),
    )


def run_experiments(
    rankings: Sequence[Ranking],
    depths: Sequence[int],
    query_sets: Mapping[str, DataFrame],
    queries: DataFrame,
    cutoffs: Sequence[int] = CUTOFFS,
    run_id: str = "run_1",
    on_missing: str = "error",
) -> DataFrame:
    """Runs of all rankings over all judgment sets.

    Every ranking retrieves once for the union of the judged queries, and is written once. First
    stages that rankings have in common, with equal depths, run once for all of them.
    """
    asked = judged_queries(query_sets)
    wanted = evaluated_queries(asked, queries, on_missing)
    if on_missing == "drop":
        unknown = missing_details(asked, queries, "query_id", "text")
        asked = asked.join(unknown, "query_id", "left_anti")
    runs, known = [], []
    for ranking in rankings:
        ranked = ranking.retrieve(wanted, depths, known=known)
        runs.append(make_run(ranked, asked, ranking.label, depths, cutoffs, run_id))
    return union_all(runs)
