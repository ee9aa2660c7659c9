"""Steps whose cost must not grow faster than their input."""

import numpy as np
import pyarrow as pa
import pytest
from conftest import ranked_lists
from pyspark.sql import functions as F

from sparkrank.operators import models, scan
from sparkrank.operators.dense import cosine_search, nearest
from sparkrank.operators.lexical import LexicalIndex
from sparkrank.operators.lexical_scan import slices
from sparkrank.sources import readers


def test_all_queries_meet_a_passage_before_the_next_ones(spark):
    class LastPassages:
        """A scorer that may not see a passage again after 100 others."""

        def __call__(self):
            seen, gone = [], set()

            def score(queries, passages):
                for passage in passages:
                    if passage in gone:
                        raise ValueError("a passage was left and met again")
                    if passage not in seen:
                        seen.append(passage)
                        if len(seen) > 100:
                            gone.add(seen.pop(0))
                return [float(len(q) * len(p) % 7) for q, p in zip(queries, passages)]

            return score

    docs = spark.createDataFrame([(i, f"{'x' * (i % 9)} {i}") for i in range(300)], "doc_id long, text string")
    asked = spark.createDataFrame([(i, "q" * (i + 1)) for i in range(5)], "query_id long, text string")
    found = ranked_lists(models.model_search(docs.coalesce(1), asked, LastPassages(), 4, 32))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for q in range(5):
        scored = sorted((-float((q + 1) * len(t) % 7), d) for d, t in texts.items())
        assert found[q] == [(d, -s) for s, d in scored[:4]]


def test_only_scores_near_the_floor_are_rounded(monkeypatch):
    rng = np.random.default_rng(1)
    floor, sizes, rounded = np.full(20, -np.inf), [], scan.rounded
    monkeypatch.setattr(scan, "rounded", lambda s: sizes.append(s.size) or rounded(s))
    for _ in range(2):
        scan.select_best(rng.random((20, 5000)), np.arange(20), np.arange(5000), 10, floor)
    assert sum(sizes) < 2000


def test_a_task_holds_the_lists_of_its_part_only(spark, monkeypatch):
    rng = np.random.default_rng(2)
    docs = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(200)], "doc_id long, embedding array<float>")
    queries = docs.select(F.col("doc_id").alias("query_id"), "embedding")
    expected = ranked_lists(cosine_search(docs, queries, 10))
    monkeypatch.setattr(scan, "HELD", 1000)
    plan = nearest(docs, queries, 10, None)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan
    assert nearest(docs, queries, 10, None).count() == 2000
    assert ranked_lists(cosine_search(docs, queries, 10)) == expected


def test_token_lists_are_taken_in_pieces():
    batch = pa.record_batch({"doc_id": list(range(2500))})
    pieces = list(slices([batch]))
    assert [p.num_rows for p in pieces] == [1024, 1024, 452]
    assert sum((p.column("doc_id").to_pylist() for p in pieces), []) == list(range(2500))


def test_saved_postings_make_no_row_per_pair(docs, questions, tmp_path):
    saved = LexicalIndex.build(docs).save(str(tmp_path / "index"), 4)
    result = saved.search(questions, 10)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "HashAggregate(keys=[query_id" not in plan
    assert ranked_lists(result) == ranked_lists(LexicalIndex.build(docs).search(questions, 10))


@pytest.mark.parametrize("folder", ["plain", "a b+%ü"])
def test_rows_carry_no_path(spark, tmp_path, folder):
    """The last line of the last file wins, in order of paths."""
    path = tmp_path / folder
    path.mkdir()
    for name, rel in (("a", 5), ("c", 7), ("b", 6)):
        (path / f"{name} 1.txt").write_text(f"q 0 d 1\nq 0 d {rel}\nq 0 {name} 2\n")
    assert dict(readers._fields(spark, str(path)).dtypes)["_path"] == "int"
    found = {r["doc_id"]: r["rel"] for r in readers.read_qrels(spark, str(path)).collect()}
    assert found == {"d": 7, "a": 2, "b": 2, "c": 2}
