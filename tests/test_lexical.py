import math
import random
import re

import numpy as np
import pytest
from conftest import ranked_lists

from sparkrank.operators import lexical, sizing
from sparkrank.operators.lexical import LexicalIndex, query_terms
from sparkrank.operators.lexical_scan import weight_blocks


def approx(pairs):
    return [(d, pytest.approx(s, abs=1e-6)) for d, s in pairs]


WORKED = {
    "q1": [("d1", 1.604271), ("d3", 1.053195), ("d2", 0.786938)],
    "q2": [("d3", 2.106391), ("d1", 1.952265)],
    "q3": [("d4", 1.246107)],
}


def check(lists, expected):
    assert set(lists) == set(expected)
    for q, items in expected.items():
        assert lists[q] == approx(items)


def test_worked_scores(docs, questions):
    check(ranked_lists(LexicalIndex.build(docs).search(questions, 10)), WORKED)


def test_depth_cuts_lists(docs, questions):
    lists = ranked_lists(LexicalIndex.build(docs).search(questions, 1))
    check(lists, {q: items[:1] for q, items in WORKED.items()})


def test_statistics(docs):
    index = LexicalIndex.build(docs)
    assert index.stats.first().asDict() == {"n": 5, "avgdl": 1.6}
    idf = {r["term"]: round(r["idf"], 6) for r in index.term_stats().collect()}
    assert idf == {"a": 0.875469, "b": 0.875469, "c": 1.386294, "d": 1.386294, "D": 1.386294}


def test_repeated_query_terms_count(questions):
    found = {(r["query_id"], r["term"]): r["qtf"] for r in query_terms(questions).collect()}
    assert found[("q2", "a")] == 2 and found[("q1", "a")] == 1


def test_saved_index_reads_the_folders_of_its_terms(spark, docs, questions, tmp_path):
    path = str(tmp_path / "index")
    saved = LexicalIndex.build(docs).save(path, 8)
    result = saved.search(questions, 10)
    check(ranked_lists(result), WORKED)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*slot", plan)
    check(ranked_lists(LexicalIndex.load(spark, path).search(questions, 10)), WORKED)
    few = questions.filter("query_id = 'q3'")
    check(ranked_lists(saved.search(few, 10)), {"q3": WORKED["q3"]})


def test_search_prunes_before_the_pair_shuffle(docs, questions):
    plan = LexicalIndex.build(docs).search(questions, 5)._jdf.queryExecution()
    plan = plan.executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "hashpartitioning(query_id" in plan
    assert "hashpartitioning(query_id#" in plan and ", doc_id" not in "".join(
        line.split("hashpartitioning(")[1].split(")")[0]
        for line in plan.splitlines() if "Exchange hashpartitioning(query_id" in line
    )


def test_rerank_pads_with_zero_and_keeps_previous_order(spark, docs, questions):
    rows = [("q1", "d5", 1), ("q1", "d4", 2), ("q1", "d2", 3), ("q1", "d1", 4), ("q1", "dx", 5),
            ("q4", "d3", 1), ("q4", "d1", 2)]
    candidates = spark.createDataFrame(rows, "query_id string, doc_id string, rank int")
    index = LexicalIndex.build(docs)
    lists = ranked_lists(index.rerank(questions, candidates, 10))
    check(lists, {
        "q1": [("d1", 1.604271), ("d2", 0.786938), ("d5", 0.0), ("d4", 0.0)],
        "q4": [("d3", 0.0), ("d1", 0.0)],
    })
    bare = ranked_lists(index.rerank(questions, candidates, 10, pad_zero=False))
    check(bare, {"q1": [("d1", 1.604271), ("d2", 0.786938)]})


def brute(docs, queries, k, k1=1.5, b=0.75):
    tokens = {d: t.split() for d, t in docs}
    n, avgdl = len(docs), sum(len(t) for t in tokens.values()) / len(docs)
    df = {}
    for ts in tokens.values():
        for t in set(ts):
            df[t] = df.get(t, 0) + 1
    out = {}
    for q, text in queries:
        scored = []
        for d, ts in tokens.items():
            s = 0.0
            for t in text.split():
                if t in df and t in ts:
                    idf = math.log((n - df[t] + 0.5) / (df[t] + 0.5) + 1)
                    tf = ts.count(t)
                    s += idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(ts) / avgdl))
            if s > 0:
                scored.append((d, round(s, 6)))
        if scored:
            out[q] = sorted(scored, key=lambda x: (-x[1], x[0]))[:k]
    return out


@pytest.fixture
def random_case(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    # A third of the documents are copies of one text.
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 20))) for _ in range(80)]
    texts += ["w1 w2 w3 w1"] * 40
    docs = list(enumerate(texts))
    queries = [(i, " ".join(rng.choices(words, k=rng.randint(1, 8)))) for i in range(25)]
    return docs, queries


def test_search_equals_brute_force(spark, random_case):
    docs, queries = random_case
    index = LexicalIndex.build(spark.createDataFrame(docs, "doc_id int, text string"))
    asked = spark.createDataFrame(queries, "query_id int, text string")
    check(ranked_lists(index.search(asked, 7)), brute(docs, queries, 7))


@pytest.mark.parametrize("bound", [2000, 60])
def test_query_sides_beyond_the_bound_give_the_same(spark, random_case, monkeypatch, bound):
    docs, queries = random_case
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", bound)
    index = LexicalIndex.build(spark.createDataFrame(docs, "doc_id int, text string"))
    asked = spark.createDataFrame(queries, "query_id int, text string")
    called = []
    real = lexical.salted_join
    monkeypatch.setattr(lexical, "salted_join", lambda *a: called.append(1) or real(*a))
    check(ranked_lists(index.search(asked, 7)), brute(docs, queries, 7))
    assert called
    pairs = index.search(asked, 7).select("query_id", "doc_id")
    check(ranked_lists(index.rerank(asked, pairs, 7)), brute(docs, queries, 7))


def test_scores_of_candidates_only(spark, random_case):
    docs, queries = random_case
    index = LexicalIndex.build(spark.createDataFrame(docs, "doc_id int, text string"))
    asked = spark.createDataFrame(queries, "query_id int, text string")
    every = {(r["query_id"], r["doc_id"]): r["score"] for r in index.scores(asked).collect()}
    some = spark.createDataFrame(list(every)[::3], "query_id int, doc_id int")
    found = {(r["query_id"], r["doc_id"]): r["score"] for r in index.scores(asked, some).collect()}
    assert found == {pair: every[pair] for pair in list(every)[::3]}
    plan = index.rerank(asked, some, 5)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(term" not in plan


def test_a_block_holds_the_terms_of_its_queries_only():
    query, term = np.array([0, 0, 600, 601]), np.array([7, 90_000, 3, 90_000])
    blocks = weight_blocks(query, term, np.ones(4), 602)
    assert [b[2].tolist() for b in blocks] == [[7, 90_000], [3, 90_000]]
    assert sum(a.nbytes for b in blocks for a in b[2:]) < 500
