"""Approximate nearest neighbours by a neighbour graph that is built and searched in blocks.

Build. Vectors of equal content are one node. Nodes are dealt by a hash into as few blocks as have a
bounded size, and each is linked to the nearest of its block. A block's nodes are cut into parts; a
task compares one part with its block. Links are rows, turned round and cut by Spark.

Search. A task walks one block for one part of the queries: each query starts from the nearest of a few
start nodes and keeps a beam of the best nodes it knows. A round takes the nodes of the beam that are
still open, drops of their neighbours what the query has met before, and scores the rest. It ends when
no beam has an open node, or after a stated number of rounds. The best of all blocks are put together.

Blocks are copied per part, and queries per block; links, and what a query has met, are not moved.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ranking import SCORE_DECIMALS
from ..session import ship_package
from ..sources.scratch import materialize
from .approx import CALIBRATION, MARGIN
from .corpus import with_vectors
from .dense import nearest
from .joins import salted_join
from .scan import HELD, TILE, pieces, rounded, unit_rows, vector_matrix
from .sizing import fits, measured_size
from .topk import ranking_order, top_k, with_rank
from .validate import require_rows

# Links of a node to its nearest; with those that lead to it, it has at most twice as many.
DEGREE = 8
# Most nodes of a block; where nodes search for each other, and most bytes of such a block's rows.
BLOCK_NODES, OWN_NODES, BLOCK_BYTES = 65_536, 1 << 20, 512 * 1024 * 1024
# Nodes of a block that are compared with a part's at once.
LINKED = 32_768
# Nodes from which on a block's nearest are looked for in columns of so many scores.
COLUMNS, COLUMN = 4096, 16
# Fewest queries of a part, but for their end.
PART_ROWS = 100
# Start nodes used by a query, of the root of a block's nodes, or of one in so many if that is more.
STARTS, START_SHARE = 8, 64
# Nodes a query keeps open, and rounds it may take.
BEAM, ROUNDS = 16, 40
# What a beam is raised by when a recall is wanted, and beams that are tried together.
WIDER, TRIALS = 1.5, 4
# Marks of nodes met by the queries that a task walks together, and pairs scored at once.
MARKS, PAIRS = 32_000_000, 8192


def _rows(vectors: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column as a matrix of its own type; all rows must have one length."""
    if pc.count_distinct(vectors.value_lengths()).as_py() > 1:
        raise ValueError("vectors of different length")
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


class _Block:
    """The nodes of one block in a task, by their place ``at``."""

    def __init__(self, nodes: pa.Table):
        # Rows go to their places as they come; the whole table is not sorted, which would copy it.
        self.size, order = nodes.num_rows, np.argsort(nodes.column("at").to_numpy())
        self.ids = nodes.column("node").take(pa.array(order)).combine_chunks()
        at = np.empty(self.size, np.int64)
        at[order] = np.arange(self.size)
        self.vectors, done = None, 0
        for chunk in nodes.column("embedding").chunks:
            if len(chunk):
                rows = _rows(chunk)
                if self.vectors is None:
                    self.vectors = np.empty((self.size, rows.shape[1]), rows.dtype)
                if rows.shape[1] != self.vectors.shape[1]:
                    raise ValueError("vectors of different length")
                self.vectors[at[done : done + len(chunk)]] = rows
                done += len(chunk)
        # Enough to find the way; what is found is scored again.
        self.units = np.empty(self.vectors.shape, np.float32)
        for a in range(0, self.size, LINKED):
            self.units[a : a + LINKED] = np.nan_to_num(self.exact(slice(a, a + LINKED)).astype(np.float32))
        self.known = np.zeros(0, bool)
        if "near" in nodes.column_names:
            lists = nodes.column("near").combine_chunks()
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            self.near = np.full((self.size, max(1, sizes.max(initial=0))), -1, np.int32)
            self.near[np.arange(self.near.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
            self.near = self.near[order]
            order = np.lexsort((np.arange(self.size), nodes.column("draw").to_numpy()[order]))
            self.starts = order[: max(1, math.isqrt(self.size), self.size // START_SHARE)]

    def exact(self, places: np.ndarray | slice) -> np.ndarray:
        return unit_rows(self.vectors[places].astype(np.float64), 0.0)

    def marks(self, n: int) -> np.ndarray:
        """A mark for each node and each of ``n`` queries; whoever sets some takes them back."""
        if len(self.known) < n * self.size:
            self.known = np.zeros(n * self.size, bool)
        return self.known


def _most(near: np.ndarray, width: int) -> np.ndarray:
    """Columns of the ``width`` largest of each row."""
    size = near.shape[1]
    if size < COLUMNS:
        return np.argpartition(near, size - width, axis=1)[:, size - width :]
    # They are in the columns of the largest maxima, if a row is laid out as ``COLUMN`` rows below each other.
    wide = size // COLUMN
    most = near[:, : COLUMN * wide].reshape(len(near), COLUMN, wide).max(axis=1)
    some = np.argpartition(most, wide - width, axis=1)[:, wide - width :]
    places = (some[:, None, :] + wide * np.arange(COLUMN)[:, None]).reshape(len(near), -1)
    rest = np.broadcast_to(np.arange(COLUMN * wide, size), (len(near), size - COLUMN * wide))
    places = np.concatenate([places, rest], axis=1)
    values = np.take_along_axis(near, places, axis=1)
    best = np.argpartition(values, values.shape[1] - width, axis=1)[:, values.shape[1] - width :]
    return np.take_along_axis(places, best, axis=1)


def _linked(keep: int, schema: T.StructType) -> Callable:
    """The nearest ``keep`` in its block of every node of a part."""

    def run(nodes: pa.Table, part: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], [np.zeros(0)]
        if part.num_rows and nodes.num_rows > 1:
            block, mine = _Block(nodes), np.sort(part.column("at").to_numpy())
            width, step = min(keep, block.size - 1), max(1, 4 * TILE // min(LINKED, block.size))
            held = np.empty(step * min(LINKED, block.size), np.float32)
            for a in range(0, len(mine), step):
                some = mine[a : a + step]
                places, scores = [], []
                for low in range(0, block.size, LINKED):
                    other = block.units[low : low + LINKED]
                    near = held[: len(some) * len(other)].reshape(len(some), -1)
                    np.matmul(block.units[some], other.T, out=near)
                    own = np.flatnonzero((some >= low) & (some < low + len(other)))
                    near[own, some[own] - low] = -2.0
                    best = _most(near, min(width, len(other)))
                    places.append(best + low)
                    scores.append(np.take_along_axis(near, best, axis=1))
                places, near = np.concatenate(places, axis=1), np.concatenate(scores, axis=1)
                order = _most(near, width)
                best, near = np.take_along_axis(places, order, axis=1), np.take_along_axis(near, order, axis=1)
                for kept, new in zip(found, (np.repeat(some, width), best, near)):
                    kept.append(new.ravel())
        src, dst, score = (np.concatenate(x) for x in found)
        block = nodes.column("block")[0].as_py() if nodes.num_rows else 0
        columns = [np.full(len(src), block, np.int32), src.astype(np.int32), dst.astype(np.int32), score.astype(np.float64)]
        return pa.Table.from_arrays([pa.array(c) for c in columns], names=schema.names)

    return run


# An empty place of a beam: worse than all nodes, and closed.
_NONE = np.iinfo(np.int64).max


def _keys(scores: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Numbers that order nodes by falling score, then place; odd if a node is closed, and these are open."""
    bits = (scores.astype(np.float32) + np.float32(0)).view(np.int32)
    rising = (bits ^ ((bits >> 31) & 0x7FFFFFFF)).astype(np.int64)
    return (~rising << 32) | (places << 1)


def _products(units: np.ndarray, queries: np.ndarray, nodes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Scores of pairs, few at a time so that their vectors stay in the processor's cache."""
    out = np.empty(len(queries), np.float32)
    left, right = (np.empty((min(PAIRS, len(queries)), units.shape[1]), np.float32) for _ in range(2))
    for a in range(0, len(queries), PAIRS):
        n = min(PAIRS, len(queries) - a)
        np.take(units, queries[a : a + n], axis=0, out=left[:n], mode="clip")
        np.take(nodes, places[a : a + n], axis=0, out=right[:n], mode="clip")
        np.einsum("ij,ij->i", left[:n], right[:n], out=out[a : a + n])
    return out


def _walk(block: _Block, units: np.ndarray, beam: int, starts: int, rounds: int, met: list | None) -> np.ndarray:
    """Places of the beam of each query, best first (-1: none).

    ``met`` is given ``(query, place, open)`` of all nodes that were met.
    """
    n, size = len(units), block.size
    known = block.marks(n)
    near = np.rint((units @ block.units[block.starts].T).astype(np.float64) * 10**SCORE_DECIMALS).astype(np.int64)
    width = min(starts, len(block.starts))
    first = (-near << 32) | np.arange(len(block.starts))
    first = np.sort(np.partition(first, width - 1, axis=1)[:, :width], axis=1) & 0xFFFFFFFF
    keys = np.sort((np.arange(n)[:, None] * size + block.starts[first]).ravel())
    beams = np.full((n, beam), _NONE)
    every, passed = [], []
    for number in range(rounds + 1):
        known[keys] = True
        queries, new = np.divmod(keys, size)
        found = _keys(_products(units, queries, block.units, new), new)
        every.append(keys)
        # Only what is better than the last of a beam can enter it.
        good = found < beams[queries, -1]
        queries, found = queries[good], found[good]
        some, begins = np.unique(queries, return_index=True)
        if len(some):
            sizes = np.diff(np.append(begins, len(queries)))
            wide = np.full((len(some), beam + sizes.max()), _NONE)
            wide[:, :beam] = beams[some]
            column = beam + np.arange(len(queries)) - np.repeat(begins, sizes)
            wide[np.repeat(np.arange(len(some)), sizes), column] = found
            wide.sort(axis=1)
            beams[some] = wide[:, :beam]
        row, column = np.nonzero(beams & 1 == 0)
        if number == rounds or len(row) == 0:
            break
        places = (beams[row, column] & 0xFFFFFFFF) >> 1
        beams |= 1
        if met is not None:
            passed.append(row * size + places)
        around = block.near[places]
        keys = (row[:, None] * size + around)[around >= 0]
        keys = np.sort(keys[~known[keys]])
        keys = keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys
    every = np.concatenate(every)
    known[every] = False
    if met is not None:
        closed = np.concatenate(passed) if passed else every[:0]
        met.append((*np.divmod(every, size), ~np.isin(every, closed)))
    return np.where(beams == _NONE, -1, (beams & 0xFFFFFFFF) >> 1)


def _walked(beams: list[int], starts: int, rounds: int, keep: int | None, schema: T.StructType) -> Callable:
    """The ``keep`` best nodes of a block, or all that were met, for every query of a part and each of ``beams``."""

    def walks(block: _Block, asked: pa.Table, exact: np.ndarray, units: np.ndarray, trial: int) -> Iterator[pa.Table]:
        step = max(1, MARKS // block.size)
        for a in range(0, len(units), step):
            met = [] if keep is None else None
            places = _walk(block, units[a : a + step], min(beams[trial], block.size), starts, rounds, met)
            if met:
                queries, places, still = met[0]
            else:
                # Twice as many are scored again, for scores that differ in rounding only.
                some = places[:, : 2 * keep]
                queries, column = np.nonzero(some >= 0)
                places, still = some[queries, column], np.zeros(len(queries), bool)
            values = rounded(np.einsum("ij,ij->i", exact[a + queries], block.exact(places)))
            values[np.isnan(values)] = 0.0
            if keep is not None:
                order = np.lexsort((places, -values, queries))
                queries, places, values = queries[order], places[order], values[order]
                best = np.arange(len(queries)) - np.searchsorted(queries, queries) < keep
                queries, places, values, still = queries[best], places[best], values[best], still[best]
            ids = asked.column("query_id").combine_chunks().take(pa.array(a + queries))
            columns = [ids, block.ids.take(pa.array(places)), pa.array(values), pa.array(still)]
            yield pa.Table.from_arrays([*columns, pa.array(np.full(len(queries), trial, np.int32))], names=schema.names)

    def run(nodes: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        if nodes.num_rows and asked.num_rows:
            block, asked = _Block(nodes), asked.combine_chunks()
            exact = unit_rows(vector_matrix(asked.column("embedding")), 0.0)
            units = np.nan_to_num(exact.astype(np.float32))
            for trial in range(len(beams)):
                out += walks(block, asked, exact, units, trial)
        if out:
            return pa.concat_tables(out)
        kinds = asked.schema.field("query_id").type, nodes.schema.field("node").type, pa.float64(), pa.bool_(), pa.int32()
        return pa.Table.from_arrays([pa.array([], t) for t in kinds], names=schema.names)

    return run


def _met(nodes: DataFrame, asked: DataFrame, parts: int, blocks: int, run: Callable, schema: T.StructType) -> DataFrame:
    """``run`` on every block of ``nodes(block, ...)`` with every part of ``asked(block, part, ...)``."""
    spark = nodes.sparkSession
    context = ship_package(spark)
    left = nodes.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    # So many shuffle partitions that few groups meet in one.
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * context.defaultParallelism)
    width = min(width, 4 * blocks * parts)
    # Both sides may come from one table, so that the same column by the same name would be one to Spark.
    right = asked.select(*[F.col(c).alias(f"_q_{c}") for c in asked.columns])

    def named(own: pa.Table, other: pa.Table) -> pa.Table:
        return run(own, other.rename_columns([c.removeprefix("_q_") for c in other.column_names]))

    return (
        left.repartition(width, "block", "part").groupBy("block", "part")
        .cogroup(right.repartition(width, "_q_block", "_q_part").groupBy("_q_block", "_q_part"))
        .applyInArrow(named, schema)
    )


def _spread(rows: int, blocks: int, spark: SparkSession) -> int:
    """Parts that give every core some groups, and a copy of a block some work."""
    return max(1, min(math.ceil(rows / PART_ROWS), math.ceil(4 * spark.sparkContext.defaultParallelism / blocks)))


def _nearest_links(links: DataFrame, degree: int) -> DataFrame:
    """The ``degree`` best of ``links(block, src, dst, score)`` per source, each target once."""
    once = links.groupBy("block", "src", "dst").agg(F.max("score").alias("score"))
    return top_k(once, ["block", "src"], [F.desc("score"), F.asc("dst")], degree).drop("rank")


def _both_ways(links: DataFrame, degree: int) -> DataFrame:
    """Links and their reverses, at most twice ``degree`` per node; a popular node keeps its nearest."""
    back = links.select("block", F.col("dst").alias("src"), F.col("src").alias("dst"), "score")
    return _nearest_links(links.unionByName(back), 2 * degree)


@dataclass(frozen=True)
class GraphIndex:
    """``nodes(block, at, node, embedding, draw, near)`` and ``members(node, doc_id)`` of nodes that stand
    for several documents. ``near`` holds places ``at`` in the block; the least ``draw`` are its starts."""

    nodes: DataFrame
    members: DataFrame
    degree: int = DEGREE

    @classmethod
    def build(
        cls,
        doc_vectors: DataFrame,
        build_degree: int | None = None,
        degree: int = DEGREE,
        seed: int = 0,
        block_nodes: int | None = None,
    ) -> GraphIndex:
        """Link all vectors of ``doc_vectors(doc_id, embedding)``.

        Documents without a vector are skipped. Equal vectors, however many, are one node under the
        smallest id. Links are the nearest of a block, so that nothing depends on ``build_degree``,
        which callers may still give. Nodes of one block that search for each other meet their links; more
        ``block_nodes``, as ``OWN_NODES``, then take a narrower beam, and more work to link.
        """
        spark = doc_vectors.sparkSession
        ship_package(spark)
        vectors = with_vectors(doc_vectors).select("doc_id", "embedding")
        require_rows(vectors, "vectors")
        grouped = vectors.groupBy("embedding").agg(F.min("doc_id").alias("node"), F.count("*").alias("n"))
        grouped = materialize(grouped, "graph-nodes")
        points = grouped.filter("node IS NOT NULL").select("node", "embedding")
        several = grouped.filter("n > 1").select("node", "embedding")
        if fits(several):
            members = vectors.join(F.broadcast(several), "embedding")
        else:
            members = salted_join(vectors, several, "embedding", "doc_id")
        members = materialize(members.select("node", "doc_id"), "graph-members")
        rows, size = measured_size(points)
        if block_nodes:
            blocks = max(1, math.ceil(size / BLOCK_BYTES), math.ceil(rows / block_nodes))
        else:
            blocks = pieces(rows, size, BLOCK_NODES)
        block = F.pmod(F.xxhash64("node", F.lit(seed + 1)), F.lit(blocks)).cast("int")
        placed = points.select(block.alias("block"), "node", "embedding", F.xxhash64("node", F.lit(seed)).alias("draw"))
        place = F.row_number().over(W.partitionBy("block").orderBy("node", F.xxhash64("embedding"))) - 1
        placed = materialize(placed.withColumn("at", place), "graph-placed")
        parts = _spread(rows, blocks, spark)
        kinds = [("block", T.IntegerType()), ("src", T.IntegerType()), ("dst", T.IntegerType()), ("score", T.DoubleType())]
        schema = T.StructType([T.StructField(*x) for x in kinds])
        part = F.pmod(F.xxhash64("at"), F.lit(parts)).cast("int").alias("part")
        links = _met(
            placed.select("block", "at", "node", "embedding"), placed.select("block", part, "at"),
            parts, blocks, _linked(degree, schema), schema,
        )
        near = _both_ways(materialize(links, "graph-links"), degree)
        near = near.groupBy("block", "src").agg(F.sort_array(F.collect_list("dst")).alias("near"))
        nodes = placed.join(near.withColumnRenamed("src", "at"), ["block", "at"], "left")
        nodes = materialize(nodes.select("block", "at", "node", "embedding", "draw", "near"), "graph")
        return cls(nodes, members, degree)

    def save(self, path: str) -> GraphIndex:
        """Write the tables, nodes sorted by place within files."""
        spark = self.nodes.sparkSession
        nodes = self.nodes.withColumn("degree", F.lit(self.degree))
        nodes.repartition("block", "at").sortWithinPartitions("block", "at").write.parquet(f"{path}/nodes")
        self.members.write.parquet(f"{path}/members")
        return self.load(spark, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> GraphIndex:
        nodes, members = (spark.read.parquet(f"{path}/{x}") for x in ("nodes", "members"))
        return cls(nodes.drop("degree"), members, nodes.select("degree").first()[0])

    def _found(self, query_vectors: DataFrame, beams: list[int], starts: int, rounds: int, keep: int | None) -> DataFrame:
        """``(query_id, node, score, open, trial)``: the ``keep`` best of each block, or all that were met.

        ``trial`` is the place of the beam in ``beams``.
        """
        spark = self.nodes.sparkSession
        asked = with_vectors(query_vectors).filter("query_id IS NOT NULL").select("query_id", "embedding")
        asked = materialize(asked, "graph-queries")
        rows, size = measured_size(asked)
        blocks = int(self.nodes.agg(F.max("block")).first()[0] or 0) + 1
        # Queries whose rows a task can hold until its end.
        parts = pieces(rows, size, max(1, HELD // (2 * keep if keep else 64 * sum(beams))))
        parts = max(parts, _spread(rows, blocks, spark))
        part = F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
        schema = T.StructType([
            T.StructField("query_id", asked.schema["query_id"].dataType),
            T.StructField("node", self.nodes.schema["node"].dataType),
            T.StructField("score", T.DoubleType()),
            T.StructField("open", T.BooleanType()),
            T.StructField("trial", T.IntegerType()),
        ])
        run = _walked(beams, starts, rounds, keep, schema)
        return _met(self.nodes, asked.withColumn("part", part).withColumn("block", every), parts, blocks, run, schema)

    def walked(self, query_vectors: DataFrame, beam: int = BEAM, starts: int = STARTS, rounds: int = ROUNDS) -> DataFrame:
        """``(query_id, node, score, open, rank)``: all nodes each query has met, best first."""
        found = self._found(query_vectors, [beam], starts, rounds, None).drop("trial")
        return materialize(with_rank(found, ["query_id"], [F.desc("score"), F.asc("node")]), "graph-walk")

    def search(
        self, query_vectors: DataFrame, k: int, beam: int = BEAM, starts: int = STARTS, rounds: int = ROUNDS
    ) -> DataFrame:
        """The ``k`` nearest documents that a walk of the graph finds; scores are exact cosines.

        A beam below ``k`` is widened to it. Documents without direction score 0.
        """
        found = self._found(query_vectors, [max(beam, k)], starts, rounds, k).drop("open", "trial")
        return self.best(top_k(found, ["query_id"], [F.desc("score"), F.asc("node")], k), k)

    def best(self, walked: DataFrame, k: int) -> DataFrame:
        """The ``k`` best documents of what was walked; nodes stand for all their members."""
        nodes = walked.filter(F.col("rank") <= k).select("query_id", "node", "score")
        # No query needs more than the first k members of a node.
        listed = top_k(self.members, ["node"], [F.asc("doc_id")], k).select(F.col("node"), F.col("doc_id"))
        found = nodes.join(listed, "node", "left").select(
            "query_id", F.coalesce("doc_id", "node").alias("doc_id"), "score"
        )
        ranked = top_k(found, ["query_id"], [F.desc_nulls_last("score"), F.asc("doc_id")], k)
        return ranked.select("query_id", "doc_id", "score", "rank")


def calibrated_beam(
    index: GraphIndex,
    k: int,
    recall: float,
    query_vectors: DataFrame | None = None,
    least: int = BEAM,
    sample: int = CALIBRATION,
    seed: int = 0,
) -> int:
    """A beam of at least ``least`` with which ``k`` nearest nodes are found with the wanted recall.

    ``sample`` of the queries, drawn by a hash, are searched for exactly, and then by walks of ever
    wider beams. Without queries, nodes serve as such, themselves left out.
    """
    nodes = index.nodes.select("node", "embedding")
    own = query_vectors is None
    asked = nodes.withColumnRenamed("node", "query_id") if own else with_vectors(query_vectors).select("query_id", "embedding")
    drawn = asked.filter("query_id IS NOT NULL").orderBy(F.xxhash64("query_id", F.lit(seed + 2)), "query_id").limit(sample)
    asked = materialize(drawn, "calibration")
    found = nearest(nodes.withColumnRenamed("node", "doc_id"), asked, k + own, 0.0)
    found = found.filter("query_id <> doc_id") if own else found
    true = top_k(found, ["query_id"], ranking_order(found), k).select("query_id", F.col("doc_id").alias("node"))
    true = materialize(true.distinct(), "calibration")
    wanted, beam = min(1.0, recall + MARGIN) * true.count(), least
    most = index.nodes.groupBy("block").count().agg(F.max("count")).first()[0]
    # Blocks are moved once for some beams.
    while beam < most:
        tried = [beam]
        while len(tried) < TRIALS and math.ceil(tried[-1] * WIDER) < most:
            tried.append(math.ceil(tried[-1] * WIDER))
        seen = index._found(asked, [max(b, k + own) for b in tried], STARTS, ROUNDS, k + own)
        hits = seen.select("trial", "query_id", "node").distinct().join(F.broadcast(true), ["query_id", "node"], "left_semi")
        counts = {r["trial"]: r["count"] for r in hits.groupBy("trial").count().collect()}
        for trial, beam in enumerate(tried):
            if counts.get(trial, 0) >= wanted:
                return beam
        beam = math.ceil(beam * WIDER)
    return beam
