"""BM25 over texts without saved postings, with no shuffle of postings at all.

A document is one row at the scan and stays one row: its counts of the terms asked for are found
where the text is read, and its scores for all queries are summed where the counts are. Only the
best k per query and batch leave a task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import tokenize
from ..session import ship_package
from .scan import TILE, scan_rows

# Queries scored together against a batch of documents.
QUERY_BLOCK = 512
# Documents whose tokens are looked up, and whose counts are scored, together.
DOC_BLOCK = 1024


def _list_array(values: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``DOC_BLOCK`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, DOC_BLOCK):
            yield batch.slice(at, DOC_BLOCK)


def wanted_counts(collection: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """``(doc_id, dl, terms, tfs)``: every document with its counts of the wanted terms.

    Terms are numbered by their place in ``vocabulary``. Documents without any have empty lists.
    """
    shared = ship_package(collection.sparkSession).broadcast(vocabulary)
    tokens = collection.select("doc_id", tokenize(F.col("text")).alias("tokens"))
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType(
        [
            tokens.schema["doc_id"],
            T.StructField("dl", T.IntegerType()),
            T.StructField("terms", ints),
            T.StructField("tfs", ints),
        ]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        width = max(1, len(terms))
        for batch in slices(batches):
            lists = batch.column("tokens")
            place = pc.index_in(lists.flatten(), value_set=terms)
            known = place.is_valid()
            docs = pc.list_parent_indices(lists).filter(known).to_numpy().astype(np.int64)
            pairs, tfs = np.unique(
                docs * width + place.filter(known).to_numpy(), return_counts=True
            )
            ends = np.searchsorted(pairs // width, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    lists.value_lengths().cast(pa.int32()),
                    _list_array(pairs % width, ends),
                    _list_array(tfs, ends),
                ],
                names=["doc_id", "dl", "terms", "tfs"],
            )

    return tokens.mapInArrow(count, schema)


def weight_blocks(
    query: np.ndarray, term: np.ndarray, weight: np.ndarray, n_queries: int
) -> list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Query-term weights by blocks of queries, grouped by term inside a block:
    ``(first query, queries, terms, start of each term, query within block, weight)``.

    A block holds the terms of its queries only, so all blocks are as large as the weights.
    """
    blocks = []
    for first in range(0, n_queries, QUERY_BLOCK):
        inside = (query >= first) & (query < first + QUERY_BLOCK)
        order = np.argsort(term[inside], kind="stable")
        own = term[inside][order]
        terms, starts = np.unique(own, return_index=True)
        size = min(QUERY_BLOCK, n_queries - first)
        blocks.append(
            (first, size, terms, np.append(starts, len(own)), query[inside][order] - first,
             weight[inside][order])
        )
    return blocks


def block_scores(
    known: np.ndarray,
    starts: np.ndarray,
    queries: np.ndarray,
    weights: np.ndarray,
    size: int,
    terms: np.ndarray,
    docs: np.ndarray,
    parts: np.ndarray,
    width: int,
) -> np.ndarray:
    """Scores of a block of queries for ``width`` documents, 0 where no term matches.

    ``terms``, ``docs`` and ``parts`` give, by ascending document, a posting's term, document
    and share of the score before the term's weight. Postings are unrolled per query in bounded
    runs of documents.
    """
    scores = np.zeros((size, width))
    if not len(known):
        return scores
    place = np.minimum(np.searchsorted(known, terms), len(known) - 1)
    mine = known[place] == terms
    place, docs, parts = place[mine], docs[mine], parts[mine]
    fans = starts[place + 1] - starts[place]
    ends = np.searchsorted(docs, np.arange(1, width + 1))
    total = np.concatenate([[0], np.cumsum(fans)])[ends]
    at = 0
    while at < width:
        done = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + TILE, side="right")))
        low, high = (ends[at - 1] if at else 0), ends[to - 1]
        fan = fans[low:high]
        hits = np.repeat(np.arange(low, high), fan)
        within = np.arange(len(hits)) - np.repeat(np.cumsum(fan) - fan, fan)
        entry = starts[place[hits]] + within
        cell = queries[entry] * (to - at) + docs[hits] - at
        scores[:, at:to] = np.bincount(
            cell, weights=weights[entry] * parts[hits], minlength=size * (to - at)
        ).reshape(size, to - at)
        at = to
    return scores


def best_documents(
    counts: DataFrame,
    query_ids: pa.Array,
    id_type: T.DataType,
    blocks: list,
    k: int,
    avgdl: float,
    k1: float,
    b: float,
) -> DataFrame:
    """``(query_id, doc_id, score)`` candidates of the best ``k`` with a matching term."""

    def score(blocks: list, batch: pa.RecordBatch):
        at = 0
        for some in slices([batch]):
            lists = some.column("terms")
            terms = lists.flatten().to_numpy()
            docs = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
            tf = some.column("tfs").flatten().to_numpy().astype(np.float64)
            dl = some.column("dl").to_numpy().astype(np.float64)
            parts = tf * (k1 + 1.0) / (tf + k1 * (1.0 - b + b * dl[docs] / avgdl))
            rows = np.arange(at, at + some.num_rows)
            at += some.num_rows
            for first, size, known, starts, queries, weights in blocks:
                found = block_scores(
                    known, starts, queries, weights, size, terms, docs, parts, some.num_rows
                )
                found[found == 0.0] = np.nan
                yield np.arange(first, first + size), rows, found

    return scan_rows(counts, query_ids, id_type, k, blocks, score, drop_missing=True)
