"""Best-k scans: score every document against every query where the document lies.

A query side that is measured to fit is broadcast, and documents are read in place, in Arrow
batches, without being shuffled or paired as rows. A larger query side never passes through the
driver: it is cut into parts, documents into blocks, and each (block, part) is one group of a
cogroup. Blocks and parts are of one size in bytes, so that documents (copied per part) and queries
(copied per block) move alike much, and a part has no more queries than a task can hold the lists of.
Either way a task keeps the best k per query as it goes and gives them at its end.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from decimal import ROUND_HALF_UP, Decimal
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ranking import SCORE_DECIMALS
from ..session import ship_package
from . import sizing
from .sizing import measured_size

# Scores held at once in a task: a million doubles.
TILE = 1_000_000
# Candidates a task holds before it drops what is not among the best.
HELD = 2_000_000
# Most documents of a block, where blocks meet parts of the query side.
BLOCK_ROWS = 50_000
# Documents of a block that are scored together.
BATCH_ROWS = 8192


def rounded(scores: np.ndarray) -> np.ndarray:
    """The scores as Spark's ``round`` gives them: decimal digits, halves away from zero."""
    scale = 10.0**SCORE_DECIMALS
    size = np.abs(scores) * scale
    with np.errstate(invalid="ignore"):
        out = np.copysign(np.floor(size + 0.5), scores) / scale
        # Close to a half, the shortest decimal form decides and not the product.
        close = np.abs(size - np.floor(size) - 0.5) < 1e-4
    step = Decimal(1).scaleb(-SCORE_DECIMALS)
    for at in zip(*np.nonzero(close)):
        out[at] = float(Decimal(repr(float(scores[at]))).quantize(step, ROUND_HALF_UP))
    return out


def vector_matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column as a float64 matrix; all rows must have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    sizes = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False))
    if len(sizes) and (sizes != sizes[0]).any():
        raise ValueError("vectors of different length")
    return flat.reshape(len(sizes), -1) if len(sizes) else flat.reshape(0, 0)


def unit_rows(matrix: np.ndarray, zero_score: float | None) -> np.ndarray:
    """Rows scaled to length 1. Zero rows give NaN scores, or stay zero if a score is wanted."""
    norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    norms[norms == 0.0] = np.nan if zero_score is None else 1.0
    return matrix / norms[:, None]


def positions_by_id(ids: pa.Array) -> np.ndarray:
    """Place of each row in ascending id order."""
    order = pc.sort_indices(ids).to_numpy()
    places = np.empty(len(order), dtype=np.int64)
    places[order] = np.arange(len(order))
    return places


def select_best(
    scores: np.ndarray,
    queries: np.ndarray,
    places: np.ndarray,
    k: int,
    floor: np.ndarray,
    skip_missing: bool = False,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query index, column, rounded score) of the k best columns per row of ``scores``.

    Ties go to the smaller id. ``floor[query]`` is a k-th best score seen before: rows below it
    cannot be among the best k, and it is raised by what this batch shows. NaN ranks last, or is
    left out with ``skip_missing``. Only scores that come near their floor are rounded.
    """
    width = scores.shape[1]
    reach = lambda rows: (floor[queries[rows]] - 10.0**-SCORE_DECIMALS)[:, None]
    near = scores >= reach(slice(None))
    crowded = np.flatnonzero(np.count_nonzero(near, axis=1) > k)
    if len(crowded):
        some = np.where(np.isnan(scores[crowded]), -np.inf, scores[crowded])
        kth = rounded(np.partition(some, width - k, axis=1)[:, width - k])
        floor[queries[crowded]] = np.maximum(floor[queries[crowded]], kth)
        near[crowded] = some >= reach(crowded)
    if not skip_missing:
        # Missing scores are candidates only where nothing better is known.
        unknown = np.flatnonzero(np.isneginf(floor[queries]))
        near[unknown] |= np.isnan(scores[unknown])
    rows, cols = np.nonzero(near)
    values = rounded(scores[rows, cols])
    values[np.isnan(values)] = -np.inf
    good = values >= floor[queries[rows]]
    rows, cols, values = rows[good], cols[good], values[good]
    order = np.lexsort((places[cols], -values, rows))
    rows, cols, values = rows[order], cols[order], values[order]
    first = np.searchsorted(rows, rows, side="left")
    keep = np.arange(len(rows)) - first < k
    return queries[rows[keep]], cols[keep], values[keep]


class Best:
    """The best k candidates per query of one task, in bounded memory."""

    def __init__(self, n_queries: int, k: int):
        self.k, self.floor = k, np.full(n_queries, -np.inf)
        self.queries: list[np.ndarray] = []
        self.values: list[np.ndarray] = []
        self.ids: list[pa.Array] = []
        self.held = 0

    def add(self, queries: np.ndarray, ids: pa.Array, values: np.ndarray) -> None:
        self.queries.append(queries.astype(np.int32))
        self.ids.append(ids)
        self.values.append(values)
        self.held += len(queries)

    def taken(self) -> tuple[np.ndarray, pa.Array, np.ndarray] | None:
        """All that is held, cut to the best k per query; nothing is held afterwards."""
        if not self.held:
            return None
        queries, values = np.concatenate(self.queries), np.concatenate(self.values)
        ids = pa.concat_arrays(self.ids)
        order = np.lexsort((positions_by_id(ids), -values, queries))
        queries, values = queries[order], values[order]
        place = np.arange(len(queries)) - np.searchsorted(queries, queries, side="left")
        last = place == self.k - 1
        self.floor[queries[last]] = np.maximum(self.floor[queries[last]], values[last])
        keep = place < self.k
        self.queries, self.values, self.ids, self.held = [], [], [], 0
        return queries[keep], ids.take(pa.array(order[keep])), values[keep]


Score = Callable[[Any, pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]


def _scan(
    batches: Iterator[pa.RecordBatch],
    query_ids: pa.Array,
    state: Any,
    score: Score,
    k: int,
    drop_missing: bool,
) -> Iterator[pa.RecordBatch]:
    best = Best(len(query_ids), k)

    def rows(found: tuple) -> pa.RecordBatch:
        queries, ids, values = found
        return pa.RecordBatch.from_arrays(
            [query_ids.take(pa.array(queries)), ids, pa.array(values, mask=np.isneginf(values))],
            names=["query_id", "doc_id", "score"],
        )

    for batch in batches:
        if batch.num_rows == 0:
            continue
        ids = batch.column("doc_id")
        places = positions_by_id(ids)
        for queries, docs, scores in score(state, batch):
            if scores.size == 0:
                continue
            q, cols, values = select_best(scores, queries, places[docs], k, best.floor, drop_missing)
            best.add(q, ids.take(pa.array(docs[cols])), values)
            if best.held > HELD:
                found = best.taken()
                # With more queries than fit, what is known goes out and floors stay.
                if len(found[0]) > HELD // 2:
                    yield rows(found)
                else:
                    best.add(*found)
    found = best.taken()
    if found:
        yield rows(found)


def _schema(documents: DataFrame, id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", id_type),
            T.StructField("doc_id", documents.schema["doc_id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def scan_rows(
    documents: DataFrame,
    query_ids: pa.Array,
    id_type: T.DataType,
    k: int,
    state: Any,
    score: Score,
    drop_missing: bool = False,
) -> DataFrame:
    """Candidates of the best k, for a query side of checked size that is sent as ``state``.

    ``score(state, batch)`` yields ``(query indices, row indices, scores)`` blocks of a batch.
    NaN scores become null and rank last, or are left out with ``drop_missing``.
    """
    shared = ship_package(documents.sparkSession).broadcast((query_ids, state))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, own = shared.value
        yield from _scan(batches, ids, own, score, k, drop_missing)

    return documents.mapInArrow(run, _schema(documents, id_type))


def pieces(rows: int, size: int, most_rows: int) -> int:
    """Into how many pieces a side is cut: of half a broadcast in bytes, and of so many rows."""
    return max(1, math.ceil(2 * size / sizing.BROADCAST_BYTES), math.ceil(rows / most_rows))


def best_rows(
    documents: DataFrame,
    queries: DataFrame,
    k: int,
    prepare: Callable[[pa.Table], Any],
    score: Score,
    drop_missing: bool = False,
    order: str | None = None,
) -> DataFrame:
    """``(query_id, doc_id, score)`` candidates of the best k of ``documents`` for ``queries``.

    ``prepare(table)`` makes of rows of ``queries`` what ``score`` takes as its first argument.
    Blocks are scored in the order of the column ``order`` if there is one.
    """
    id_type = queries.schema["query_id"].dataType
    rows, size = measured_size(queries)
    # Queries whose lists a task can hold until its end.
    most = max(1, HELD // (2 * k))
    if rows <= min(sizing.BROADCAST_ROWS, most) and size <= sizing.BROADCAST_BYTES:
        table = queries.toArrow().combine_chunks()
        ids = table.column("query_id").combine_chunks()
        return scan_rows(documents, ids, id_type, k, prepare(table), score, drop_missing)
    context = ship_package(documents.sparkSession)
    blocks = pieces(*measured_size(documents), BLOCK_ROWS)
    parts = pieces(rows, size, min(sizing.BROADCAST_ROWS // 2, most))
    # A document that is copied costs less than another list of k per query.
    parts = max(parts, min(rows, math.ceil(2 * context.defaultParallelism / blocks)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    left = documents.withColumn("_block", own("doc_id", blocks)).withColumn("_part", every(parts))
    # Both sides may come from one table, so that the same column by the same name would be one to Spark.
    right = queries.select(*[F.col(c).alias(f"_q_{c}") for c in queries.columns])
    right = right.withColumn("_part", own("_q_query_id", parts)).withColumn("_block", every(blocks))
    schema = _schema(documents, id_type)

    def run(docs: pa.Table, asked: pa.Table) -> pa.Table:
        names = ["query_id", "doc_id", "score"]
        found: list[pa.RecordBatch] = []
        asked = asked.rename_columns([c.removeprefix("_q_") for c in asked.column_names])
        if docs.num_rows and asked.num_rows:
            asked = asked.combine_chunks()
            ids = asked.column("query_id").combine_chunks()
            docs = docs.sort_by(order) if order else docs
            batches = iter(docs.combine_chunks().to_batches(max_chunksize=BATCH_ROWS))
            found = list(_scan(batches, ids, prepare(asked), score, k, drop_missing))
        if not found:
            types = (asked.schema.field("query_id").type, docs.schema.field("doc_id").type)
            empty = [pa.array([], t) for t in (*types, pa.float64())]
            return pa.Table.from_arrays(empty, names=names)
        return pa.Table.from_batches(found)

    # So many shuffle partitions that few groups meet in one.
    width = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = min(max(width, 8 * context.defaultParallelism), 4 * blocks * parts)
    spread = lambda df: df.repartition(width, "_block", "_part")
    return (
        spread(left).groupBy("_block", "_part")
        .cogroup(spread(right).groupBy("_block", "_part"))
        .applyInArrow(run, schema)
    )
