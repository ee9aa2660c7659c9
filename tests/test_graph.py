"""The neighbour graph and radius-bounded search against brute force."""

import numpy as np
import pyarrow as pa
import pytest
from conftest import ranked_lists
from pyspark.sql import functions as F

from sparkrank.operators.approx import VectorIndex, calibrated_probes, train_centroids
from sparkrank.operators import graph
from sparkrank.operators.dense import cosine_search
from sparkrank.operators.graph import BEAM, GraphIndex, calibrated_beam
from sparkrank.sources import scratch

LARGE = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def points(spark):
    rows = spark.read.parquet(f"{LARGE}/embeddings.parquet")
    return rows.select(F.col("vec_id").alias("doc_id"), "embedding").repartition(4)


@pytest.fixture(scope="module")
def exact(points):
    return ranked_lists(cosine_search(points, asked(points), 10))


def asked(points):
    return points.withColumnRenamed("doc_id", "query_id")


def recall(found, exact):
    return np.mean([len({d for d, _ in exact[q]} & {d for d, _ in found.get(q, [])}) / len(exact[q]) for q in exact])


def test_graph_recall_on_all_embeddings(points, exact, tmp_path):
    index = GraphIndex.build(points).save(str(tmp_path / "graph"))
    walked = index.walked(asked(points))
    found = ranked_lists(index.best(walked, 10))
    share = walked.count() / len(exact) ** 2
    print("recall", recall(found, exact), "share", share)
    assert recall(found, exact) >= 0.9 and share <= 0.25
    # What is found has its exact score.
    for q in list(exact)[:50]:
        true = dict(exact[q])
        assert all(true.get(d, s) == s for d, s in found[q])


def test_graph_of_copies_and_odd_vectors(spark):
    """A third of all rows are one vector; some have no direction or no vector."""
    rng = np.random.default_rng(3)
    rows = [(f"c{i:03}", [1.0, 2.0, 3.0, 4.0]) for i in range(100)]
    rows += [(f"r{i:03}", rng.normal(size=4).tolist()) for i in range(200)]
    rows += [("zero", [0.0] * 4), ("none", None)]
    docs = spark.createDataFrame(rows, "doc_id string, embedding array<float>").repartition(3)
    index = GraphIndex.build(docs, build_degree=8, degree=4)
    assert index.nodes.count() == 202
    queries = docs.filter("doc_id >= 'r'").withColumnRenamed("doc_id", "query_id")
    found = ranked_lists(index.search(queries, 12))
    true = ranked_lists(cosine_search(docs, queries.filter("query_id <> 'zero'"), 12))
    assert recall(found, true) > 0.95
    one = spark.createDataFrame([("q", [1.0, 2.0, 3.0, 4.0])], "query_id string, embedding array<float>")
    assert [d for d, _ in ranked_lists(index.search(one, 12))["q"]] == [f"c{i:03}" for i in range(12)]
    assert index.search(one.limit(0), 3).count() == 0


def test_graph_of_few_vectors(spark):
    docs = spark.createDataFrame([(1, [1.0, 0.0])], "doc_id long, embedding array<float>")
    assert ranked_lists(GraphIndex.build(docs).search(asked(docs), 3)) == {1: [(1, 1.0)]}
    with pytest.raises(ValueError):
        GraphIndex.build(docs.limit(0))


def normal(spark, n, dim=48, shift=0):
    rows = [(i + shift, v.tolist()) for i, v in enumerate(np.random.default_rng(n).normal(size=(n, dim)))]
    return spark.createDataFrame(rows, "doc_id long, embedding array<float>").repartition(4)


def test_graph_moves_no_links_of_rounds(spark):
    """Building and searching write a few tables, and not one a round."""
    docs = normal(spark, 300)
    written = len(scratch._written)
    index = GraphIndex.build(docs)
    assert len(scratch._written) - written <= 5
    assert index.search(asked(docs), 5).count() == 1500
    assert len(scratch._written) - written <= 6


def test_graph_of_several_blocks_by_recall(spark, tmp_path):
    docs = normal(spark, 1500)
    index = GraphIndex.build(docs, block_nodes=400).save(str(tmp_path / "blocks"))
    assert index.nodes.groupBy("block").count().filter("count <= 450").count() == 4
    # No link leaves its block.
    ends = index.nodes.select("block", F.explode("near").alias("at"))
    assert ends.join(index.nodes, ["block", "at"], "left_anti").count() == 0
    exact = ranked_lists(cosine_search(docs, asked(docs), 10))
    beam = calibrated_beam(index, 10, 0.9)
    assert beam >= BEAM and recall(ranked_lists(index.search(asked(docs), 10, beam)), exact) >= 0.9
    others = normal(spark, 100, shift=5000)
    beam = calibrated_beam(index, 10, 0.9, asked(others), least=20)
    exact = ranked_lists(cosine_search(docs, asked(others), 10))
    assert beam >= 20 and recall(ranked_lists(index.search(asked(others), 10, beam)), exact) >= 0.9


def test_beams_are_tried_together(spark, monkeypatch):
    """Blocks are not moved again for every beam that is too narrow."""
    index, found, tried = GraphIndex.build(normal(spark, 900), block_nodes=300), GraphIndex._found, []
    monkeypatch.setattr(GraphIndex, "_found", lambda self, *given: tried.append(given) or found(self, *given))
    beam = calibrated_beam(index, 10, 1.0)
    assert beam > 54 and len(tried) <= 3
    # The same beam as by one after the other.
    monkeypatch.setattr(graph, "TRIALS", 1, raising=False)
    assert calibrated_beam(index, 10, 1.0) == beam and len(tried) >= 5


def plain_walk(block, unit, beam, starts, rounds):
    score = lambda at: float(np.einsum("ij,ij->i", unit[None], block.units[at][None])[0])
    near = np.rint((unit @ block.units[block.starts].T).astype(np.float64) * 1e6)
    new = {int(block.starts[i]) for i in sorted(range(len(near)), key=lambda i: (-near[i], i))[:starts]}
    known, best, closed = set(), [], set()
    for number in range(rounds + 1):
        known |= new
        best = sorted(set(best) | {(-score(at), at) for at in new})[:beam]
        still = [at for _, at in best if at not in closed]
        if number == rounds or not still:
            return [at for _, at in best]
        closed |= set(still)
        new = {int(b) for at in still for b in block.near[at] if b >= 0} - known


@pytest.mark.parametrize("beam, rounds", [(4, 40), (30, 40), (30, 2)])
def test_walk_in_whole_arrays(beam, rounds):
    """Against a walk of one query at a time; some nodes score alike, some have no direction."""
    r = np.random.default_rng(beam)
    x = np.repeat(r.integers(-2, 3, (250, 6)), 2, axis=0).astype(float) * np.tile([1.0, 3.0], 250)[:, None]
    near = [r.choice(500, r.integers(0, 6), replace=False).tolist() for _ in x]
    columns = {"at": np.arange(500), "node": np.arange(500), "draw": r.permutation(500)}
    nodes = pa.table(columns | {"embedding": list(x), "near": pa.array(near, pa.list_(pa.int32()))})
    block, met = graph._Block(nodes), []
    found = graph._walk(block, block.units[:60], beam, 8, rounds, met)
    for unit, places in zip(block.units[:60], found.tolist()):
        want = plain_walk(block, unit, beam, 8, rounds)
        assert places == want + [-1] * (beam - len(want))
    queries, places, still = met[0]
    assert len(set(zip(queries.tolist(), places.tolist()))) == len(queries) and still.any()


def test_most_of_wide_rows():
    near = np.random.default_rng(4).normal(size=(7, 4103)).astype(np.float32)
    found = np.sort(graph._most(near, 9), axis=1)
    assert found.tolist() == np.sort(np.argsort(-near, axis=1)[:, :9], axis=1).tolist()
    assert np.sort(graph._most(near[:, :20], 20), axis=1).tolist() == [list(range(20))] * 7


def test_graph_of_repeated_and_missing_ids(spark):
    """Rows that come twice count twice, on both sides, as in exact search; queries without id have no list."""
    docs = normal(spark, 40)
    twice = docs.unionByName(docs.filter("doc_id < 5"))
    index = GraphIndex.build(twice)
    found = index.search(asked(twice), 6, beam=40)
    assert sorted(found.collect()) == sorted(cosine_search(twice, asked(twice), 6).collect())
    none = spark.createDataFrame([(None, [1.0] * 48)], "query_id long, embedding array<float>")
    assert index.search(none, 3).count() == 0


def test_radii_make_the_search_exact(points, exact):
    index = VectorIndex.build(points, train_centroids(points, 45, seed=1))
    assert ranked_lists(index.search_exact(asked(points), 10, first=3)) == exact


def test_radii_pass_cells_over(spark):
    """Groups far from each other: a query needs its own group's cells only."""
    rng = np.random.default_rng(5)
    rows = []
    for c in range(6):
        rows += [(c * 100 + i, (np.eye(8)[c] * 5 + rng.normal(0, 0.1, 8)).tolist()) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, embedding array<float>").repartition(4)
    index = VectorIndex.build(docs, train_centroids(docs, 18, seed=2))
    true = ranked_lists(cosine_search(docs, asked(docs), 5))
    assert ranked_lists(index.search_exact(asked(docs), 5, first=4)) == true
    first = index.search(asked(docs), 5, 4)
    more = index.reachable(index.probes(asked(docs), 4), first, 5)
    cells = index.centroids.count()
    assert more.select(F.explode("cells")).count() < 0.2 * cells * docs.count()


def test_probes_for_a_recall_target(points, exact):
    index = VectorIndex.build(points, train_centroids(points, 128, seed=1))
    probes = calibrated_probes(index, 10, 0.9)
    found = ranked_lists(index.search(asked(points), 10, probes))
    sizes = {r["cell"]: r["count"] for r in index.cells.groupBy("cell").count().collect()}
    visited = index.probes(asked(points), probes).select(F.explode("cells").alias("cell")).groupBy("cell").count()
    share = sum(r["count"] * sizes.get(r["cell"], 0) for r in visited.collect()) / len(exact) ** 2
    print("probes", probes, "recall", recall(found, exact), "share", share)
    assert recall(found, exact) >= 0.9 and share < 0.6
