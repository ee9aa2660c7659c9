"""Approximate nearest neighbours: documents in cells, queries probe the nearest cells."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ranking import round_score
from ..functions.vectors import cosine, l2_norm
from ..session import ship_package
from ..sources.scratch import materialize
from .corpus import restrict, with_vectors
from .dense import nearest, pair_vectors
from .joins import hinted
from .scan import TILE, best_rows, rounded, unit_rows, vector_matrix
from . import sizing
from .sizing import fits, union_all
from .topk import ranking_order, top_k
from .validate import require_rows

# Cells of one folder, and rows of one file, of a saved index.
SLOT_CELLS = 64
FILE_ROWS = 500_000
# Documents that serve as queries when probes are chosen for a recall, and what the recall wanted is
# raised by for their small number.
CALIBRATION, MARGIN = 200, 0.01
# Angles are given so much room, for rounding.
SLACK = 1e-6


def train_centroids(
    doc_vectors: DataFrame, cells: int, seed: int = 0, max_iter: int = 10
) -> DataFrame:
    """``(cell, centroid)`` from spherical k-means in two levels, over all vectors.

    About √cells coarse centres come first; fine centres are then moved among the vectors of their
    coarse cell only, so a round costs √cells products per vector and not cells. A round sends
    partial sums per task and centre, whatever the number of vectors.
    """
    # Cosine k-means does not accept vectors without direction.
    rows = with_vectors(doc_vectors).select("doc_id", "embedding").filter(l2_norm(F.col("embedding")) > 0)
    coarse = max(2, math.isqrt(cells))
    points = rows.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    model = KMeans(
        k=coarse, seed=seed, maxIter=max_iter, distanceMeasure="cosine", featuresCol="v"
    ).fit(points)
    spark = doc_vectors.sparkSession
    made = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    centres = spark.createDataFrame(made, "cell int, centroid array<double>")
    placed = nearest_cells(rows, centres, 1).select(
        F.get("cells", F.lit(0)).alias("coarse"), "doc_id", "embedding"
    )
    placed = materialize(placed, "coarse-cells")
    # Each coarse cell starts with its share of the fine centres, vectors chosen by a hash.
    sizes = placed.groupBy("coarse").agg(F.count("*").alias("n"))
    total = placed.count()
    share = F.greatest(F.lit(1), F.round(cells * F.col("n") / total).cast("int"))
    sizes = sizes.select("coarse", share.alias("wanted"))
    drawn = placed.withColumn("draw", F.xxhash64("doc_id", F.lit(seed)))
    first = top_k(drawn, ["coarse"], [F.asc("draw"), F.asc("doc_id")], cells)
    chosen = materialize(
        first.join(sizes, "coarse").filter(F.col("rank") <= F.col("wanted")).select("coarse", "embedding", "rank"),
        "first-centres",
    )
    # Fine centres move among their own coarse cell's vectors only, so coarse cells are trained in
    # portions whose centres are few enough to be sent.
    width = sizing.measured_size(chosen)[1]
    portions = max(1, min(coarse, math.ceil(2 * width / sizing.BROADCAST_BYTES)))
    trained, known = [], 0
    for portion in range(portions):
        own = F.col("coarse") % portions == portion
        fine = chosen.filter(own).orderBy("coarse", "rank").select("coarse", "embedding").toArrow()
        units = _trained(placed.filter(own) if portions > 1 else placed, fine, max_iter)
        numbers = pa.array(known + np.arange(len(units)), pa.int32())
        known += len(units)
        trained.append(spark.createDataFrame(pa.table({"cell": numbers, "centroid": list(units)})))
        if portions > 1:
            trained[-1] = materialize(trained[-1], "centres")
    return union_all(trained)


def _trained(placed: DataFrame, fine: pa.Table, max_iter: int) -> np.ndarray:
    """Unit vectors of the ``fine(coarse, embedding)`` centres after their rounds."""
    groups = fine.column("coarse").to_numpy()
    units = unit_rows(vector_matrix(fine.column("embedding")), 0.0)
    for _ in range(max_iter):
        sums = _moved(placed, groups, units).toArrow()
        new = units.copy()
        if sums.num_rows:
            new[sums.column("cell").to_numpy()] = unit_rows(vector_matrix(sums.column("sum")), 0.0)
        still = len(units) == 0 or np.abs(new - units).max() < 1e-6
        units = new
        if still:
            break
    return units


def _moved(placed: DataFrame, groups: np.ndarray, units: np.ndarray) -> DataFrame:
    """``(cell, sum)``: sums of the unit vectors nearest to each fine centre.

    A task gives one dense array per centre it has seen; arrays are added up where they meet, and
    in part before they are shuffled.
    """
    shared = ship_package(placed.sparkSession).broadcast((groups, units))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, centres = shared.value
        sums, seen = np.zeros_like(centres), np.zeros(len(centres), bool)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = unit_rows(vector_matrix(batch.column("embedding")), 0.0)
            coarse = batch.column("coarse").to_numpy()
            for group in np.unique(coarse):
                mine, at = np.flatnonzero(own == group), np.flatnonzero(coarse == group)
                if len(mine):
                    near = mine[(rows[at] @ centres[mine].T).argmax(1)]
                    np.add.at(sums, near, rows[at])
                    seen[near] = True
        cells = np.flatnonzero(seen)
        width = sums.shape[1] if sums.ndim == 2 else 0
        arrays = pa.ListArray.from_arrays(
            pa.array(np.arange(len(cells) + 1) * width, pa.int32()), pa.array(sums[cells].ravel())
        )
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), arrays], names=["cell", "sum"])

    parts = placed.select("coarse", "embedding").mapInArrow(run, "cell int, sum array<double>")
    summed = parts.groupBy("cell").agg(Summarizer.sum(array_to_vector("sum")).alias("sum"))
    return summed.select("cell", vector_to_array("sum").alias("sum"))


def nearest_cells(vectors: DataFrame, centroids: DataFrame, n: int) -> DataFrame:
    """``vectors(id, ...)`` with ``cells``, the ``n`` nearest of ``centroids(cell, centroid)`` in
    order; ties go to the lower cell.

    Centroids that fit are sent to where the vectors lie. More of them are searched like documents.
    """
    centroids = centroids.select("cell", "centroid")
    if fits(centroids):
        return _assigned(vectors, centroids.orderBy("cell").toArrow(), n)
    key = vectors.columns[0]
    asked = vectors.select(F.col(key).alias("query_id"), "embedding")
    known = centroids.select(F.col("cell").alias("doc_id"), F.col("centroid").alias("embedding"))
    found = nearest(known, asked, n, 0.0)
    best = top_k(found, ["query_id"], ranking_order(found), n)
    listed = F.sort_array(F.collect_list(F.struct("rank", "doc_id")))
    cells = best.groupBy("query_id").agg(F.transform(listed, lambda s: s.doc_id).alias("cells"))
    return vectors.join(cells.withColumnRenamed("query_id", key), key)


def _assigned(vectors: DataFrame, centroids: pa.Table, n: int) -> DataFrame:
    if centroids.num_rows == 0:
        raise ValueError("no centroids found")
    units = unit_rows(vector_matrix(centroids.column("centroid")), 0.0)
    cells = centroids.column("cell").to_numpy()
    shared = ship_package(vectors.sparkSession).broadcast((cells, units))
    schema = T.StructType(
        [*vectors.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))]
    )

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, units = shared.value
        width, step = min(n, len(cells)), max(1, TILE // len(cells))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                rows = unit_rows(vector_matrix(batch.column("embedding")), 0.0)
                near = rounded(rows @ units.T)
                if width == 1:
                    order = near.argmax(axis=1)[:, None]
                else:
                    order = np.argsort(-near, axis=1, kind="stable")[:, :width]
                chosen = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, (len(rows) + 1) * width, width), pa.int32()),
                    pa.array(cells[order].ravel(), pa.int32()),
                )
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, chosen], names=[*batch.schema.names, "cells"]
                )

    return vectors.mapInArrow(assign, schema)


def cell_angles(cells: DataFrame, centroids: DataFrame) -> DataFrame:
    """``centroids`` with ``low, high``: the least and the largest angle of a cell's vectors to its
    centroid, with room for rounding (null for an empty cell). One pass, partial in each task."""
    near = cells.join(hinted(centroids, fits(centroids)), "cell")
    cosines = F.coalesce(cosine(F.col("embedding").cast("array<double>"), F.col("centroid")), F.lit(0.0))
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosines)))
    spread = near.select("cell", angle.alias("angle")).groupBy("cell").agg(
        (F.min("angle") - SLACK).alias("low"), (F.max("angle") + SLACK).alias("high")
    )
    return centroids.join(spread, "cell", "left")


def _listed(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) of lists of cells of any length, in order of (cell, row)."""
    lists = column.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    order = np.argsort(flat, kind="stable")
    return rows[order], flat[order]


@dataclass(frozen=True)
class VectorIndex:
    """``cells(cell, doc_id, embedding)`` and the ``centroids(cell, centroid)`` that made them.

    Centroids also have ``low, high``, the angles between which their cell's vectors lie.
    """

    cells: DataFrame
    centroids: DataFrame
    saved: bool = False

    @classmethod
    def build(cls, doc_vectors: DataFrame, centroids: DataFrame) -> VectorIndex:
        """Assign vectors to the nearest of ``centroids(cell, centroid)``, once."""
        vectors = with_vectors(doc_vectors).select("doc_id", "embedding")
        require_rows(vectors, "vectors")
        known = materialize(centroids.select("cell", "centroid"), "centroids")
        cells = nearest_cells(vectors, known, 1)
        cells = cells.select(F.get("cells", F.lit(0)).alias("cell"), "doc_id", "embedding")
        cells = materialize(cells, "cells")
        return cls(cells, materialize(cell_angles(cells, known), "centroids"))

    def save(self, path: str) -> VectorIndex:
        """Write the cells in folders of ``SLOT_CELLS`` cells, each file sorted by cell.

        A crowded folder is written by as many tasks as its measured size asks for.
        """
        spark = self.cells.sparkSession
        slotted = self.cells.withColumn("slot", (F.col("cell") / SLOT_CELLS).cast("int"))
        files = slotted.groupBy("slot").agg(F.ceil(F.count("*") / FILE_ROWS).alias("_files"))
        spread = slotted.join(hinted(files, fits(files)), "slot").withColumn(
            "_file", F.pmod(F.xxhash64("doc_id"), F.col("_files"))
        )
        (
            spread.repartition("slot", "_file")
            .sortWithinPartitions("slot", "cell")
            .drop("_file", "_files")
            .write.partitionBy("slot")
            .parquet(f"{path}/cells")
        )
        self.centroids.write.parquet(f"{path}/centroids")
        return self.load(spark, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> VectorIndex:
        centroids = spark.read.parquet(f"{path}/centroids")
        return cls(spark.read.parquet(f"{path}/cells"), centroids, True)

    def probes(self, query_vectors: DataFrame, nprobe: int) -> DataFrame:
        """``(query_id, embedding, cells)``: the cells each query will search."""
        queries = with_vectors(query_vectors).select("query_id", "embedding")
        return nearest_cells(queries, self.centroids, nprobe)

    def search(
        self, query_vectors: DataFrame, k: int, nprobe: int, within: DataFrame | None = None
    ) -> DataFrame:
        """The ``k`` nearest documents within the probed cells, by exact cosine.

        ``within(doc_id)`` limits the documents looked at.
        """
        return self._visited(self.probes(query_vectors, nprobe), k, within)

    def reachable(self, probed: DataFrame, found: DataFrame, k: int) -> DataFrame:
        """``(query_id, embedding, cells)``: cells not in ``probed.cells`` that may hold a document
        as good as the k-th of ``found``.

        A document at angle ``a`` from its cell's centroid and a query at ``t`` from that are at
        least ``|t - a|`` apart, and a cell's documents lie between two angles. Centroids are sent
        in portions of a checked size.
        """
        spark = self.cells.sparkSession
        kth = found.filter(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
        asked = probed.join(kth, "query_id", "left").select("query_id", "embedding", "cells", "kth")
        asked = materialize(asked, "probed")
        known = self.centroids.filter("high IS NOT NULL").select("cell", "centroid", "low", "high")
        portions = max(1, math.ceil(sizing.measured_size(known)[1] / sizing.BROADCAST_BYTES))
        schema = T.StructType([f for f in asked.schema.fields if f.name != "kth"])
        out = []
        for portion in range(portions):
            table = known.filter(F.col("cell") % portions == portion).orderBy("cell").toArrow()
            units = unit_rows(vector_matrix(table.column("centroid")), 0.0)
            shared = ship_package(spark).broadcast((units, *(table.column(c).to_numpy() for c in ("cell", "low", "high"))))
            out.append(asked.mapInArrow(_in_reach(shared), schema))
        return union_all(out)

    def search_exact(self, query_vectors: DataFrame, k: int, first: int = 8) -> DataFrame:
        """The ``k`` nearest documents of all, as :func:`cosine_search`, passing over what can't matter.

        Queries search their ``first`` nearest cells, and after that every cell that may hold a
        document as good as what they have. Documents without direction score 0.
        """
        probed = materialize(self.probes(query_vectors, first), "probes")
        near = materialize(self._visited(probed, k), "first-cells")
        rest = self._visited(self.reachable(probed, near, k).filter(F.size("cells") > 0), k)
        both = near.select("query_id", "doc_id", "score").unionByName(rest.select("query_id", "doc_id", "score"))
        return top_k(both, ["query_id"], ranking_order(both), k).select("query_id", "doc_id", "score", "rank")

    def _visited(self, probed: DataFrame, k: int, within: DataFrame | None = None) -> DataFrame:
        """The ``k`` best of the cells that ``probed(query_id, embedding, cells)`` names."""
        documents = restrict(self.cells, within)
        if self.saved:
            # Folders that nobody probes are not read.
            wanted = probed.select(F.explode("cells").alias("cell")).distinct()
            wanted = materialize(wanted.withColumn("slot", (F.col("cell") / SLOT_CELLS).cast("int")), "probed")
            documents = documents.join(hinted(wanted, fits(wanted)), ["slot", "cell"], "left_semi")

        def prepare(table: pa.Table):
            rows, listed = _listed(table.column("cells"))
            cells, starts = np.unique(listed, return_index=True)
            visitors = dict(zip(cells.tolist(), np.split(rows, starts[1:])))
            return unit_rows(vector_matrix(table.column("embedding")), 0.0), visitors

        def score(state, batch: pa.RecordBatch):
            units, by_cell = state
            docs = unit_rows(vector_matrix(batch.column("embedding")), 0.0)
            cells = batch.column("cell").to_numpy()
            order = np.argsort(cells, kind="stable")
            found, starts = np.unique(cells[order], return_index=True)
            for cell, rows in zip(found, np.split(order, starts[1:]), strict=True):
                queries = by_cell.get(int(cell))
                if queries is None:
                    continue
                step = max(1, TILE // len(rows))
                for at in range(0, len(queries), step):
                    some = queries[at : at + step]
                    yield some, rows, units[some] @ docs[rows].T

        found = best_rows(documents.select("cell", "doc_id", "embedding"), probed, k, prepare, score, order="cell")
        return top_k(found, ["query_id"], ranking_order(found), k).select(
            "query_id", "doc_id", "score", "rank"
        )

    def rerank(
        self, candidates: DataFrame, query_vectors: DataFrame, k: int, nprobe: int
    ) -> DataFrame:
        """As ``search``, among ``candidates`` only."""
        probed = self.probes(query_vectors, nprobe)
        pairs = pair_vectors(candidates, self.cells, probed.select("query_id", "embedding"))
        visits = probed.select("query_id", F.explode("cells").alias("cell"))
        kept = pairs.join(hinted(visits, fits(visits)), ["query_id", "cell"], "left_semi")
        score = F.coalesce(cosine(F.col("query_embedding"), F.col("embedding")), F.lit(0.0))
        scored = kept.withColumn("score", round_score(score)).drop(
            "query_embedding", "embedding", "cell"
        )
        return top_k(scored, ["query_id"], ranking_order(scored), k).select(
            "query_id", "doc_id", "score", "rank"
        )


def _in_reach(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, cells, low, high = shared.value
        step = max(1, TILE // max(1, len(cells)))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                rows = unit_rows(vector_matrix(batch.column("embedding")), 0.0)
                angle = np.arccos(np.clip(rows @ units.T, -1.0, 1.0))
                least = np.maximum(0.0, np.maximum(angle - high, low - angle))
                # Scores are rounded, so a document may be as good as one that is a little better.
                floor = batch.column("kth").to_numpy(zero_copy_only=False).astype(np.float64) - 2e-6
                near = ~(np.cos(np.minimum(np.pi, least)) < floor[:, None])
                # Without direction, a vector scores 0 with everything.
                near |= ~rows.any(axis=1)[:, None] & ~(0.0 < floor[:, None])
                lists = batch.column("cells")
                have = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
                seen = lists.flatten().to_numpy(zero_copy_only=False)
                place = np.minimum(np.searchsorted(cells, seen), len(cells) - 1)
                hit = cells[place] == seen if len(cells) else np.zeros(0, bool)
                near[have[hit], place[hit]] = False
                row, column = np.nonzero(near)
                offsets = np.searchsorted(row, np.arange(batch.num_rows + 1))
                chosen = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(cells[column], pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("query_id"), batch.column("embedding"), chosen], names=["query_id", "embedding", "cells"]
                )

    return run


def calibrated_probes(index: VectorIndex, k: int, recall: float, sample: int = CALIBRATION, seed: int = 0) -> int:
    """The fewest probes with which ``k`` nearest documents are found with the wanted recall.

    ``sample`` documents, drawn by a hash, are searched for exactly, themselves left out; a true
    neighbour is found with as many probes as its cell's place in the query's order of cells.
    """
    drawn = index.cells.withColumn("draw", F.xxhash64("doc_id", F.lit(seed))).orderBy("draw", "doc_id").limit(sample)
    asked = materialize(drawn.select(F.col("doc_id").alias("query_id"), "embedding"), "calibration")
    found = nearest(index.cells.select("doc_id", "embedding"), asked, k + 1, 0.0)
    found = top_k(found, ["query_id"], ranking_order(found), k + 1)
    true = top_k(found.filter("query_id <> doc_id").drop("rank"), ["query_id"], ranking_order(found), k)
    total = index.centroids.count()
    order = index.probes(asked, total).select("query_id", F.posexplode("cells").alias("place", "cell"))
    homes = true.select("query_id", "doc_id").join(index.cells.select("doc_id", "cell"), "doc_id")
    places = homes.join(order, ["query_id", "cell"]).groupBy("place").agg(F.count("*").alias("n")).orderBy("place").toArrow()
    counts = places.column("n").to_numpy()
    enough = np.cumsum(counts) >= min(1.0, recall + MARGIN) * counts.sum()
    return int(places.column("place").to_numpy()[enough.argmax()]) + 1 if len(counts) else 1
