"""Hooks for user models: text encoders and pairwise scorers.

A model is given as a *loader*: a picklable callable without arguments that returns the model
function. Each Python worker loads it once and keeps it for later tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.cloudpickle import dumps
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ranking import round_score
from ..session import ship_package
from .joins import hinted
from .scan import TILE, best_rows
from .sizing import fits
from .topk import ranking_order, top_k

Encoder = Callable[[Sequence[str]], np.ndarray]
PairScorer = Callable[[Sequence[str], Sequence[str]], Sequence[float]]

# Texts handed to a model at once.
BATCH = 64

_loaded: dict[str, Callable] = {}


def loader_key(loader: Callable[[], Callable]) -> str:
    return hashlib.sha256(dumps(loader)).hexdigest()


def loaded(key: str, loader: Callable[[], Callable]) -> Callable:
    """The loader's model, loaded on first use in this worker."""
    if key not in _loaded:
        _loaded[key] = loader()
    return _loaded[key]


def encode(
    texts: DataFrame,
    loader: Callable[[], Encoder],
    id_column: str = "doc_id",
    batch_size: int = BATCH,
) -> DataFrame:
    """``(id, embedding)`` of ``texts(id, text)``; null text is encoded as empty.

    Restrict the texts before encoding: a filter on the result cannot move below the model.
    """
    ship_package(texts.sparkSession)
    key = loader_key(loader)
    schema = T.StructType(
        [
            texts.schema[id_column],
            T.StructField("embedding", T.ArrayType(T.FloatType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(key, loader)
        for batch in batches:
            for at in range(0, batch.num_rows, batch_size):
                some = batch.slice(at, batch_size)
                passages = [t or "" for t in some.column("text").to_pylist()]
                vectors = np.asarray(model(passages), dtype=np.float32)
                width = vectors.shape[1]
                ends = np.arange(0, (len(vectors) + 1) * width, width, dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(vectors.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [some.column(id_column), lists], names=[id_column, "embedding"]
                )

    return texts.select(id_column, "text").mapInArrow(run, schema)


def pair_scorer(loader: Callable[[], PairScorer], batch_size: int = BATCH):
    """The model as a Column function of (query text, passage text)."""
    key = loader_key(loader)

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = loaded(key, loader)
        for queries, passages in batches:
            queries, passages = queries.fillna(""), passages.fillna("")
            parts = [
                np.asarray(
                    model(
                        queries.iloc[at : at + batch_size].tolist(),
                        passages.iloc[at : at + batch_size].tolist(),
                    ),
                    dtype=np.float64,
                )
                for at in range(0, len(queries), batch_size)
            ]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return score


def model_rerank(
    collection: DataFrame,
    queries: DataFrame,
    candidates: DataFrame,
    loader: Callable[[], PairScorer],
    k: int,
    batch_size: int = BATCH,
) -> DataFrame:
    """The ``k`` best of ``candidates(query_id, doc_id[, rank])`` by a pairwise model.

    Only texts of candidates move. Pairs are spread evenly over the cluster before the model
    runs, since they lie where their documents were.
    """
    pairs = candidates.select(
        "query_id",
        "doc_id",
        *([F.col("rank").alias("prev_rank")] if "rank" in candidates.columns else []),
    )
    asked = queries.select("query_id", F.col("text").alias("query_text"))
    passages = collection.select("doc_id", F.col("text").alias("passage"))
    texts = passages.join(hinted(pairs, fits(pairs)), "doc_id").join(
        hinted(asked, fits(asked)), "query_id"
    )
    ship_package(texts.sparkSession)
    width = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    score = pair_scorer(loader, batch_size)(F.col("query_text"), F.col("passage"))
    scored = (
        texts.repartition(width, "query_id", "doc_id")
        .withColumn("score", round_score(score))
        .drop("query_text", "passage")
    )
    return top_k(scored, ["query_id"], ranking_order(scored), k).select(
        "query_id", "doc_id", "score", "rank"
    )


def model_search(
    collection: DataFrame,
    queries: DataFrame,
    loader: Callable[[], PairScorer],
    k: int,
    batch_size: int = BATCH,
) -> DataFrame:
    """Score every passage of the collection against every query; keep the ``k`` best.

    The number of model calls is queries times passages by definition; pairs are formed inside
    the tasks and never become rows.
    """
    key = loader_key(loader)

    def prepare(table: pa.Table) -> list[str]:
        return [t or "" for t in table.column("text").to_pylist()]

    def score(asked: list[str], batch: pa.RecordBatch):
        model = loaded(key, loader)
        texts = [t or "" for t in batch.column("text").to_pylist()]
        step = max(1, TILE // batch_size)
        # A few passages meet all queries before the next ones, so that what a model keeps of a
        # passage is still there for the next query.
        for at in range(0, len(texts), batch_size):
            some = texts[at : at + batch_size]
            rows = np.arange(at, at + len(some))
            for first in range(0, len(asked), step):
                scores = [
                    np.asarray(model([query] * len(some), some), dtype=np.float64)
                    for query in asked[first : first + step]
                ]
                yield np.arange(first, first + len(scores)), rows, np.stack(scores)

    asked = queries.select("query_id", "text")
    found = best_rows(collection.select("doc_id", "text"), asked, k, prepare, score)
    return top_k(found, ["query_id"], ranking_order(found), k).select(
        "query_id", "doc_id", "score", "rank"
    )
