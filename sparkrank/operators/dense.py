"""Exact cosine search over vector columns, and re-ranking of candidates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import round_score
from ..functions.vectors import cosine
from .corpus import with_vectors
from .joins import hinted
from .scan import TILE, best_rows, unit_rows, vector_matrix
from .sizing import fits
from .topk import ranking_order, top_k


def collect_block(part: DataFrame):
    """One measured part of the query side as an Arrow table."""
    return part.toArrow().combine_chunks()


def cosine_search(doc_vectors: DataFrame, query_vectors: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest documents of the whole collection for every query.

    ``doc_vectors(doc_id, embedding)``, ``query_vectors(query_id, embedding)``. Documents
    without a vector are skipped; vectors without direction score null and rank last.
    """
    queries = with_vectors(query_vectors).select("query_id", "embedding")
    documents = with_vectors(doc_vectors).select("doc_id", "embedding")
    found = nearest(documents, queries, k, None)
    return top_k(found, ["query_id"], ranking_order(found), k).select(
        "query_id", "doc_id", "score", "rank"
    )


def nearest(
    documents: DataFrame, queries: DataFrame, k: int, zero_score: float | None
) -> DataFrame:
    """Candidates of the ``k`` nearest by cosine; vectors without direction score ``zero_score``."""

    def prepare(table: pa.Table) -> np.ndarray:
        return unit_rows(vector_matrix(table.column("embedding")), zero_score)

    def score(units: np.ndarray, batch: pa.RecordBatch):
        rows = np.arange(batch.num_rows)
        docs = unit_rows(vector_matrix(batch.column("embedding")), zero_score)
        step = max(1, TILE // max(1, len(docs)))
        for at in range(0, len(units), step):
            some = units[at : at + step]
            yield np.arange(at, at + len(some)), rows, some @ docs.T

    return best_rows(documents, queries, k, prepare, score)


def pair_vectors(
    candidates: DataFrame, doc_vectors: DataFrame, query_vectors: DataFrame
) -> DataFrame:
    """Candidates with both vectors and the document's other columns.

    Candidates whose document has no vector drop out.
    """
    pairs = candidates.select(
        "query_id",
        "doc_id",
        *([F.col("rank").alias("prev_rank")] if "rank" in candidates.columns else []),
    )
    queries = query_vectors.select("query_id", F.col("embedding").alias("query_embedding"))
    documents = with_vectors(doc_vectors)
    return documents.join(hinted(pairs, fits(pairs)), "doc_id").join(
        hinted(queries, fits(queries)), "query_id"
    )


def cosine_rerank(
    candidates: DataFrame, doc_vectors: DataFrame, query_vectors: DataFrame, k: int
) -> DataFrame:
    """The ``k`` best of ``candidates(query_id, doc_id[, rank])`` by cosine similarity."""
    documents = doc_vectors.select("doc_id", "embedding")
    pairs = pair_vectors(candidates, documents, query_vectors)
    score = round_score(cosine(F.col("query_embedding"), F.col("embedding")))
    scored = pairs.withColumn("score", score).drop("query_embedding", "embedding")
    return top_k(scored, ["query_id"], ranking_order(scored), k).select(
        "query_id", "doc_id", "score", "rank"
    )
