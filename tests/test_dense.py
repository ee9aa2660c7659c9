import numpy as np
import pytest
from conftest import ranked_lists
from pyspark.sql import functions as F

from sparkrank.functions import cosine, dot, l2_norm, l2_normalize
from sparkrank.operators import approx, scan, sizing
from sparkrank.operators.approx import VectorIndex, train_centroids
from sparkrank.operators.dense import cosine_rerank, cosine_search, nearest
from sparkrank.operators.scan import rounded, select_best

VECTORS = [("e1", [1.0, 0.0]), ("e2", [1.0, 1.0]), ("e3", [0.0, 2.0]), ("e4", [-1.0, 0.0]),
           ("e5", [0.0, 0.0]), ("e6", None)]
WORKED = [("e2", 0.989949), ("e3", 0.8), ("e1", 0.6), ("e4", -0.6), ("e5", None)]


@pytest.fixture
def vectors(spark):
    return spark.createDataFrame(VECTORS, "doc_id string, embedding array<float>").repartition(3)


@pytest.fixture
def query(spark):
    return spark.createDataFrame([("q", [3.0, 4.0])], "query_id string, embedding array<float>")


def test_worked_cosines(vectors, query):
    assert ranked_lists(cosine_search(vectors, query, 10)) == {"q": WORKED}
    assert ranked_lists(cosine_search(vectors, query, 2)) == {"q": WORKED[:2]}


def test_rerank_uses_only_candidates(spark, vectors, query):
    rows = [("q", "e5", 1), ("q", "e1", 2), ("q", "e6", 3), ("q", "e3", 4)]
    candidates = spark.createDataFrame(rows, "query_id string, doc_id string, rank int")
    found = ranked_lists(cosine_rerank(candidates, vectors, query, 10))
    assert found == {"q": [("e3", 0.8), ("e1", 0.6), ("e5", None)]}


def test_vector_expressions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [1.0, 0.0], [0.0, 0.0])],
                               "a array<float>, b array<float>, z array<float>")
    row = df.select(
        dot(F.col("a"), F.col("b")).alias("dot"), l2_norm(F.col("a")).alias("norm"),
        l2_normalize(F.col("a")).alias("unit"), l2_normalize(F.col("z")).alias("none"),
        l2_normalize(F.col("z"), "keep").alias("kept"),
        cosine(F.col("a"), F.col("b")).alias("cos"), cosine(F.col("a"), F.col("z")).alias("null"),
    ).first()
    assert (row["dot"], row["norm"], row["cos"], row["null"]) == (3.0, 5.0, 0.6, None)
    assert row["unit"] == [0.6, 0.8] and row["none"] == [None, None] and row["kept"] == [0.0, 0.0]


def test_rounding_is_that_of_spark(spark):
    assert list(rounded(np.array([0.5e-6, -0.5e-6, 1.4e-6, 0.25]))) == [1e-6, -1e-6, 1e-6, 0.25]
    rng = np.random.default_rng(4)
    values = np.concatenate([
        (rng.integers(0, 10**8, 20_000) * 10 + 5) / 1e7 * rng.choice([-1, 1], 20_000),
        rng.normal(0, 3, 2000), [0.0, np.nan, np.inf, -np.inf],
    ])
    table = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double")
    expected = [r[0] for r in table.orderBy("i").select(F.round("v", 6)).collect()]
    assert np.array_equal(rounded(values), np.array(expected), equal_nan=True)
    assert rounded(np.array([[0.1234565], [2.0]])).shape == (2, 1)


def test_a_task_gives_k_rows_per_query(spark, monkeypatch):
    """Also where blocks are narrower than k, and where less is held than there are pairs."""
    rng = np.random.default_rng(8)
    docs = spark.createDataFrame(
        [(i, [float(x) for x in rng.normal(size=4)]) for i in range(600)],
        "doc_id long, embedding array<float>").coalesce(1)
    queries = docs.filter("doc_id < 20").select(F.col("doc_id").alias("query_id"), "embedding")
    monkeypatch.setattr(scan, "HELD", 1500)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "30")
    try:
        found = nearest(docs, queries, 40, None)
        assert found.count() == 20 * 40
        assert ranked_lists(cosine_search(docs, queries, 40)) == brute(docs, queries, 40)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_select_best_against_sorting():
    rng = np.random.default_rng(0)
    for k in (1, 3, 50):
        floor = np.full(4, -np.inf)
        seen = {q: [] for q in range(4)}
        kept = {q: [] for q in range(4)}
        for block in range(5):
            scores = np.round(rng.random((4, 12)), 1)
            scores[:, 3] = np.nan
            places = rng.permutation(12)
            for q in range(4):
                seen[q] += [(-np.nan_to_num(s, nan=-np.inf), block * 12 + p)
                            for s, p in zip(scores[q], places, strict=True)]
            q, cols, values = select_best(scores, np.arange(4), places, k, floor)
            for a, c, v in zip(q, cols, values, strict=True):
                kept[a].append((-v, block * 12 + places[c]))
        for q in range(4):
            assert sorted(kept[q])[:k] == sorted(seen[q])[:k]


@pytest.fixture
def clusters(spark):
    """Three tight groups, one of them a third of all rows and exact copies."""
    rng = np.random.default_rng(1)
    rows = []
    for c in range(3):
        center = np.eye(8)[c] * 5
        for i in range(40):
            noise = 0.0 if c == 0 else rng.normal(0, 0.2, 8)
            rows.append((c * 100 + i, [float(x) for x in center + noise]))
    docs = spark.createDataFrame(rows, "doc_id long, embedding array<float>").repartition(4)
    queries = docs.select((F.col("doc_id") * 10).alias("query_id"), "embedding")
    return docs, queries


def brute(docs, queries, k):
    d = {r["doc_id"]: np.array(r["embedding"], float) for r in docs.collect()}
    out = {}
    for row in queries.collect():
        q = np.array(row["embedding"], float)
        scored = [(i, round(float(q @ v / np.linalg.norm(q) / np.linalg.norm(v)), 6))
                  for i, v in d.items()]
        out[row["query_id"]] = sorted(scored, key=lambda x: (-x[1], x[0]))[:k]
    return out


def test_search_equals_brute_force_with_query_sides_of_any_size(clusters, monkeypatch):
    docs, queries = clusters
    expected = brute(docs, queries, 9)
    assert ranked_lists(cosine_search(docs, queries, 9)) == expected
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 3000)
    monkeypatch.setattr(scan, "BLOCK_ROWS", 50)
    plan = nearest(docs, queries, 9, None)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan
    assert ranked_lists(cosine_search(docs, queries, 9)) == expected


def test_documents_and_queries_are_cut_alike(spark, monkeypatch):
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 20_000)
    texts = spark.createDataFrame([(i, "x" * 5000) for i in range(12)], "doc_id int, text string")
    # Twelve rows of 5 KB make pieces of at most two rows, whatever the bound on rows.
    assert scan.pieces(*sizing.measured_size(texts), 50_000) == 7
    assert scan.pieces(100, 10_000, 50) == 2 and scan.pieces(0, 0, 50) == 1


def test_approximate_search(clusters, tmp_path, monkeypatch):
    docs, queries = clusters
    centroids = train_centroids(docs, 3, seed=1)
    index = VectorIndex.build(docs, centroids)
    exact = ranked_lists(cosine_search(docs, queries, 9))
    assert ranked_lists(index.search(queries, 9, nprobe=3)) == exact
    # Planted groups: the nearest cell holds the true neighbours.
    found = ranked_lists(index.search(queries, 9, nprobe=1))
    hits = sum(len({d for d, _ in exact[q]} & {d for d, _ in found[q]}) for q in exact)
    assert hits / (9 * len(exact)) > 0.95
    monkeypatch.setattr(approx, "SLOT_CELLS", 1)
    saved = index.save(str(tmp_path / "cells"))
    assert ranked_lists(saved.search(queries, 9, nprobe=1)) == found


def test_bounds_change_no_result(clusters, monkeypatch):
    docs, queries = clusters
    index = VectorIndex.build(docs, train_centroids(docs, 6, seed=2))
    cells = sorted(tuple(r) for r in index.cells.select("doc_id", "cell").collect())
    lists = ranked_lists(index.search(queries, 5, nprobe=2))
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 100)
    again = VectorIndex.build(docs, index.centroids)
    assert sorted(tuple(r) for r in again.cells.select("doc_id", "cell").collect()) == cells
    assert ranked_lists(again.search(queries, 5, nprobe=2)) == lists


def test_training_finds_planted_groups(spark):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(9, 16)) * 4
    rows = [(i, [float(x) for x in centres[i % 9] + rng.normal(0, 0.1, 16)]) for i in range(450)]
    docs = spark.createDataFrame(rows, "doc_id long, embedding array<float>").repartition(3)
    index = VectorIndex.build(docs, train_centroids(docs, 36, seed=3))
    held = {}
    for r in index.cells.collect():
        held.setdefault(r["cell"], set()).add(r["doc_id"] % 9)
    assert len(held) >= 18 and all(len(groups) == 1 for groups in held.values())


def test_approximate_rerank_keeps_to_candidates_and_cells(clusters):
    docs, queries = clusters
    index = VectorIndex.build(docs, train_centroids(docs, 3, seed=1))
    some = cosine_search(docs, queries, 30).filter("rank % 2 = 0")
    lists = ranked_lists(index.rerank(some, queries, 50, nprobe=3))
    allowed = {}
    for r in some.collect():
        allowed.setdefault(r["query_id"], set()).add(r["doc_id"])
    assert {q: {d for d, _ in items} for q, items in lists.items()} == allowed


def test_different_lengths_are_an_error(spark, query):
    docs = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0])],
                                 "doc_id string, embedding array<float>").coalesce(1)
    with pytest.raises(Exception, match="different length"):
        cosine_search(docs, query, 3).collect()
