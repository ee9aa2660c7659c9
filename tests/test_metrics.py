import math
import random

import pytest
from pyspark.sql import functions as F

from sparkrank.functions import exact_sum
from sparkrank.operators import metrics
from sparkrank.operators.topk import numbered, ranking_order, top_k
from sparkrank.sources.scratch import materialize

RUN = "run_name string, query_id string, doc_id string, rank int, score double"
QRELS = "query_id string, doc_id string, rel int"


def values(df, *keys):
    return {tuple(r[k] for k in (*keys, "measure")): r["value"] for r in df.collect()}


def test_worked_metrics(spark):
    run = spark.createDataFrame(
        [("r", "q1", "d1", 1, 3.0), ("r", "q1", "d3", 2, 2.0), ("r", "q1", "d2", 3, 1.0)], RUN)
    qrels = spark.createDataFrame(
        [("q1", "d1", 1), ("q1", "d2", 2), ("q1", "d3", 0), ("q1", "d4", 1)], QRELS)
    found = values(metrics.evaluate(run, qrels, recall_cutoffs=[1, 10]))
    assert found == {("map",): 0.555556, ("ndcg",): 0.638788, ("recip_rank",): 1.0,
                     ("recall_1",): 0.333333, ("recall_10",): 0.666667}


def test_which_queries_are_evaluated(spark):
    run = spark.createDataFrame([("r", "q1", "d1", 1, 1.0), ("r", "q2", "d1", 1, 1.0),
                                 ("r", "q3", "d1", 1, 1.0)], RUN)
    qrels = spark.createDataFrame([("q1", "d1", 1), ("q2", "d9", 0), ("q4", "d1", 1)], QRELS)
    found = values(metrics.evaluate(run, qrels, ["map"]), "query_id")
    # q3 is not judged, q4 not retrieved; q2 has no relevant document.
    assert found == {("q1", "map"): 1.0, ("q2", "map"): 0.0}
    mean = values(metrics.mean_over_queries(metrics.evaluate(run, qrels, ["map"])), "run_name")
    assert mean == {("r", "map"): 0.5}


def test_score_order_ignores_the_rank_and_breaks_ties_by_descending_id(spark):
    run = spark.createDataFrame([("r", "q", "a", 1, 0.5), ("r", "q", "b", 2, 0.5),
                                 ("r", "q", "c", 3, 0.9)], RUN)
    qrels = spark.createDataFrame([("q", "a", 1)], QRELS)
    by_score = values(metrics.evaluate(run, qrels, ["recip_rank"]))
    by_rank = values(metrics.evaluate(run, qrels, ["recip_rank"], order="rank"))
    assert by_score == {("recip_rank",): 0.333333} and by_rank == {("recip_rank",): 1.0}


def test_negative_judgments_gain_nothing(spark):
    run = spark.createDataFrame([("r", "q", "a", 1, 2.0), ("r", "q", "b", 2, 1.0)], RUN)
    qrels = spark.createDataFrame([("q", "a", -2), ("q", "b", 1)], QRELS)
    found = values(metrics.evaluate(run, qrels, ["ndcg", "map"]))
    assert found == {("map",): 0.5, ("ndcg",): 0.63093}


def random_run(n_queries, hot, seed):
    rng = random.Random(seed)
    run, qrels = [], []
    for q in range(n_queries):
        # One query holds a large part of all rows.
        depth = hot if q == 0 else rng.randint(1, 12)
        for d in range(depth):
            run.append(("r", f"q{q}", f"d{d}", 0, round(rng.random(), 1)))
            if rng.random() < 0.4:
                qrels.append((f"q{q}", f"d{d}", rng.randint(0, 3)))
        qrels.append((f"q{q}", "unseen", 2))
    return run, qrels


def brute(run, qrels):
    out = {}
    for q in {r[1] for r in run}:
        judged = {d: g for p, d, g in qrels if p == q}
        docs = [r[2] for r in sorted((r for r in run if r[1] == q), key=lambda r: r[2],
                                     reverse=True)]
        score = {r[2]: r[4] for r in run if r[1] == q}
        docs.sort(key=lambda d: -score[d])
        gains = [judged.get(d, 0) for d in docs]
        n_rel = sum(g >= 1 for g in judged.values())
        ap = hits = 0
        for i, g in enumerate(gains, 1):
            if g >= 1:
                hits += 1
                ap += hits / i
        dcg = sum(g / math.log2(i + 1) for i, g in enumerate(gains, 1))
        best = sorted(judged.values(), reverse=True)
        ideal = sum(g / math.log2(i + 1) for i, g in enumerate(best, 1))
        first = next((i for i, g in enumerate(gains, 1) if g >= 1), None)
        out[(q, "map")] = ap / n_rel if n_rel else 0
        out[(q, "ndcg")] = dcg / ideal if ideal else 0
        out[(q, "recip_rank")] = 1 / first if first else 0
        out[(q, "recall_5")] = sum(g >= 1 for g in gains[:5]) / n_rel if n_rel else 0
    return {k: pytest.approx(v, abs=1e-6) for k, v in out.items()}


@pytest.mark.parametrize("max_list", [1000, 10])
def test_metrics_equal_brute_force_with_lists_longer_than_a_task(spark, max_list, monkeypatch):
    monkeypatch.setattr(metrics, "CHUNK", 7)
    run, qrels = random_run(12, 150, 5)
    found = metrics.evaluate(
        spark.createDataFrame(run, RUN).repartition(3), spark.createDataFrame(qrels, QRELS),
        recall_cutoffs=[5], max_list=max_list)
    found = values(found, "query_id")
    assert found == brute(run, qrels)
    assert all(0 <= v <= 1 for v in found.values())


def test_hits_do_not_depend_on_the_length_of_a_task(spark):
    run, qrels = random_run(6, 150, 7)
    judged = metrics.with_judgments(
        spark.createDataFrame(run, RUN).repartition(3), spark.createDataFrame(qrels, QRELS))
    tables = [
        sorted(tuple(r) for r in metrics.relevant_hits(judged, max_list=n).select(
            "query_id", "doc_id", "rank", "hits").collect())
        for n in (1000, 10)
    ]
    assert tables[0] == tables[1] and all(r[3] is not None for r in tables[0])


def test_sums_do_not_depend_on_the_order_of_rows(spark):
    rng = random.Random(5)
    # One group holds most rows; values span sixteen orders of magnitude and both signs.
    rows = [(g if g < 3 else 0, rng.choice([-1, 1]) * rng.random() * 10 ** rng.uniform(-10, 6))
            for g in (rng.randrange(9) for _ in range(20_000))]
    rows += [(4, None), (4, 0.1), (5, None)]
    table = materialize(spark.createDataFrame(rows, "g int, x double"))
    expected = {g: math.fsum(x for h, x in rows if h == g and x is not None) for g in (0, 1, 2, 4)}
    seen = set()
    for seed in range(10):
        dealt = table.orderBy(F.rand(seed)).repartition(2 + seed)
        found = dict(tuple(r) for r in dealt.groupBy("g").agg(exact_sum(F.col("x"))).collect())
        assert found.pop(5) is None
        assert found == pytest.approx(expected, rel=1e-15, abs=1e-18)
        seen.add(tuple(sorted((g, v.hex()) for g, v in found.items())))
    assert len(seen) == 1


def test_measures_do_not_depend_on_the_order_of_rows(spark):
    run, qrels = random_run(4, 400, 11)
    table = spark.createDataFrame(run, RUN)
    judged = spark.createDataFrame(qrels, QRELS)
    gains = set()
    for seed in range(3):
        dealt = metrics.ideal_gains(judged.orderBy(F.rand(seed)).repartition(2 + seed))
        gains.add(tuple(sorted((r["query_id"], r["n_rel"], r["ideal"].hex()) for r in dealt.collect())))
    assert len(gains) == 1
    one, two = (metrics.evaluate(table.repartition(n), judged) for n in (1, 7))
    assert one.exceptAll(two).count() == 0


def test_perfect_run_scores_one(spark):
    _, qrels = random_run(5, 20, 9)
    run = [("r", q, d, 0, float(g)) for q, d, g in qrels if g >= 1]
    found = values(metrics.evaluate(spark.createDataFrame(run, RUN),
                                    spark.createDataFrame(qrels, QRELS),
                                    ["map", "ndcg", "recip_rank"]), "query_id")
    assert set(found.values()) == {1.0}


def test_numbering_across_tasks_equals_a_window(spark):
    rows = [(q, i * 37 % 101, float(i % 5)) for q in ("a", "b") for i in range(101)]
    rows += [("a", 1000 + i, 2.0) for i in range(300)]
    df = materialize(spark.createDataFrame(rows, "query_id string, doc_id int, score double"))
    order = ranking_order(df)
    window = numbered(df, ["query_id"], order, longest=10**6, max_list=10**9)
    across = numbered(df, ["query_id"], order, max_list=50)
    assert window.select(sorted(window.columns)).exceptAll(
        across.select(sorted(window.columns))).count() == 0
    assert across.count() == len(rows)


def test_two_round_top_k_equals_one_round(spark):
    rows = [(q, i, float(i * 7 % 13)) for q in range(3) for i in range(200)]
    df = spark.createDataFrame(rows, "query_id int, doc_id int, score double").repartition(9)
    order = ranking_order(df)
    one = top_k(df, ["query_id"], order, 11, salts=1)
    two = top_k(df, ["query_id"], order, 11, salts=4)
    assert one.exceptAll(two).count() == 0 and two.count() == 33


def test_runs_are_matched_to_judgments_by_name(spark):
    runs = spark.createDataFrame(
        [("one.tsv-BM25(1.5-0.75)-[10]-10.txt", "q", "a", 1, 2.0),
         ("two.tsv-Cos()-[10]-10.txt", "q", "a", 1, 2.0),
         ("three.tsv-Cos()-[10]-10.txt", "q", "a", 1, 2.0)], RUN)
    qrels = spark.createDataFrame([("one.tsv", "q", "a", 1), ("two.tsv", "q", "b", 1)],
                                  "qrels_name string, " + QRELS)
    found = values(metrics.evaluate_runs(runs, qrels, measures=["map"]), "qrels_name")
    assert found == {("one.tsv", "map"): 1.0, ("two.tsv", "map"): 0.0}
    missing = metrics.runs_without_qrels(runs, qrels).collect()
    assert [r["qrels_name"] for r in missing] == ["three.tsv"]
