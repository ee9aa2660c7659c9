import pytest
from conftest import ranked_lists
from pyspark.sql import functions as F

from sparkrank import catalog
from sparkrank.functions.standins import HashedBagEncoder, TokenOverlapScorer
from sparkrank.operators import sizing
from sparkrank.operators.lexical import LexicalIndex
from sparkrank.operators.models import encode, model_rerank, model_search
from sparkrank.operators.validate import load_report, malformed_vectors, missing_details
from sparkrank.plans.experiments import run_experiments
from sparkrank.plans.stages import ApproxStage, Bm25Stage, CosineStage, ModelStage, Ranking


@pytest.fixture
def stages(docs, questions):
    dv = encode(docs, HashedBagEncoder(16))
    qv = encode(questions, HashedBagEncoder(16), "query_id")
    return (Bm25Stage(LexicalIndex.build(docs)), CosineStage(dv, qv),
            ModelStage(docs, TokenOverlapScorer(), "cross-encoder/tiny"))


def test_encoder_keeps_ids_and_batches(spark, docs):
    found = {r["doc_id"]: list(r["embedding"]) for r in
             encode(docs, HashedBagEncoder(16), batch_size=2).collect()}
    one = HashedBagEncoder(16)()
    assert found == {r["doc_id"]: [float(x) for x in one([r["text"]])[0]] for r in docs.collect()}


def test_restricting_happens_before_encoding(docs):
    listed = docs.filter("doc_id in ('d1', 'd3')")
    assert {r["doc_id"] for r in encode(listed, HashedBagEncoder(8)).collect()} == {"d1", "d3"}


def overlap(docs, questions, k):
    texts = {r["doc_id"]: set(r["text"].split()) for r in docs.collect()}
    out = {}
    for row in questions.collect():
        asked = set(row["text"].split())
        scored = [(d, round(len(asked & t) / len(asked), 6)) for d, t in texts.items()]
        out[row["query_id"]] = sorted(scored, key=lambda x: (-x[1], x[0]))[:k]
    return out


def test_model_search_and_rerank(docs, questions, monkeypatch):
    every = model_search(docs, questions, TokenOverlapScorer(), 4, batch_size=2)
    assert ranked_lists(every) == overlap(docs, questions, 4)
    again = model_rerank(docs, questions, every.select("query_id", "doc_id"),
                         TokenOverlapScorer(), 4, batch_size=2)
    assert ranked_lists(again) == overlap(docs, questions, 4)
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 80)
    assert ranked_lists(model_search(docs, questions, TokenOverlapScorer(), 4)) == overlap(
        docs, questions, 4)


def test_later_stages_only_see_earlier_results(docs, questions, stages):
    bm25, cos, model = stages
    first = {q: {d for d, _ in items} for q, items in
             ranked_lists(bm25.search(questions, None, 2)).items()}
    lists = ranked_lists(Ranking([bm25, cos, model]).retrieve(questions, [2, 2, 1]))
    assert set(lists) == set(first)
    assert all({d for d, _ in items} <= first[q] and len(items) == 1
               for q, items in lists.items())


def test_ties_keep_the_order_of_the_stage_before(spark, docs, questions, stages):
    _, _, model = stages
    rows = [("q2", "d1", 2), ("q2", "d3", 1)]
    given = spark.createDataFrame(rows, "query_id string, doc_id string, rank int")
    found = ranked_lists(model.search(questions, given, 5))
    assert found == {"q2": [("d3", 1.0), ("d1", 1.0)]}


def test_labels_and_depths(stages, questions):
    ranking = Ranking(stages)
    assert ranking.label == "BM25(1.5-0.75), Cos(), C(cross-encoder/tiny)"
    with pytest.raises(ValueError, match="3 stages but 2 depths"):
        ranking.retrieve(questions, [10, 10])
    shorter = ranked_lists(ranking.retrieve(questions, [3], strict=False))
    assert shorter == ranked_lists(stages[0].search(questions, None, 3))
    assert ApproxStage(None, None, 4).label == "IVF(4)"
    assert ApproxStage(None, None, 4, name="HNSW(8-200-50)").label == "HNSW(8-200-50)"


def test_no_stage_gives_the_candidates_back(spark, questions):
    given = spark.createDataFrame([("q1", "d9", 1)], "query_id string, doc_id string, rank int")
    row = Ranking([]).retrieve(questions, [], given).first()
    assert row.asDict() == {"query_id": "q1", "doc_id": "d9", "score": None, "rank": 1}


def test_own_stage(docs, questions, stages):
    class ById:
        label = "ById()"

        def search(self, queries, candidates, k):
            ranked = candidates.withColumn("score", F.lit(1.0))
            from sparkrank.operators.topk import top_k
            return top_k(ranked.drop("rank"), ["query_id"], [F.desc("doc_id")], k)

    found = ranked_lists(Ranking([stages[0], ById()]).retrieve(questions, [3, 1]))
    assert found["q1"] == [("d3", 1.0)]


def test_queries_without_text_or_vector_are_errors(spark, stages, questions):
    bm25, cos, _ = stages
    unknown = questions.union(spark.createDataFrame([("q9", None)], questions.schema))
    with pytest.raises(Exception, match="nothing found for id q9"):
        bm25.search(unknown, None, 3).collect()
    with pytest.raises(Exception, match="nothing found for id q9"):
        cos.search(unknown, None, 3).collect()


def test_experiments(spark, questions, stages):
    bm25, cos, _ = stages
    one = spark.createDataFrame([("q1", "d1", 1), ("q1", "d2", 0)],
                                "query_id string, doc_id string, rel int")
    two = spark.createDataFrame([("q1", "d1", 1), ("q2", "d2", 1), ("q9", "d2", 1)], one.schema)
    rankings = [Ranking([bm25]), Ranking([cos])]
    runs = run_experiments(rankings, [10], {"one.tsv": one, "two.tsv": two}, questions, [3, 1],
                           on_missing="drop")
    found = {(r["run_name"], r["query_id"]): r["n"] for r in
             runs.groupBy("run_name", "query_id").agg(F.count("*").alias("n")).collect()}
    assert found == {
        ("one.tsv-BM25(1.5-0.75)-[10]-3.txt", "q1"): 3,
        ("one.tsv-BM25(1.5-0.75)-[10]-1.txt", "q1"): 1,
        ("two.tsv-BM25(1.5-0.75)-[10]-3.txt", "q1"): 3,
        ("two.tsv-BM25(1.5-0.75)-[10]-1.txt", "q1"): 1,
        ("two.tsv-BM25(1.5-0.75)-[10]-3.txt", "q2"): 2,
        ("two.tsv-BM25(1.5-0.75)-[10]-1.txt", "q2"): 1,
        ("one.tsv-Cos()-[10]-3.txt", "q1"): 3,
        ("one.tsv-Cos()-[10]-1.txt", "q1"): 1,
        ("two.tsv-Cos()-[10]-3.txt", "q1"): 3,
        ("two.tsv-Cos()-[10]-1.txt", "q1"): 1,
        ("two.tsv-Cos()-[10]-3.txt", "q2"): 3,
        ("two.tsv-Cos()-[10]-1.txt", "q2"): 1,
    }
    with pytest.raises(Exception, match="nothing found for id q9"):
        run_experiments(rankings, [10], {"two.tsv": two}, questions, [3])


class Counting:
    """A stage that counts its searches."""

    def __init__(self, inner, reads_candidates=True):
        self.inner, self.label, self.reads_candidates = inner, inner.label, reads_candidates
        self.calls = 0

    def search(self, queries, candidates, k):
        self.calls += 1
        return self.inner.search(queries, candidates, k)


def test_first_stages_in_common_run_once(spark, questions, stages):
    bm25, cos, model = stages
    first = Counting(bm25)
    judged = spark.createDataFrame([("q1", "d1", 1), ("q2", "d2", 1)], "query_id string, doc_id string, rel int")
    rankings = [Ranking([first, cos]), Ranking([first, model])]
    runs = run_experiments(rankings, [3, 2], {"one.tsv": judged}, questions, [2])
    assert first.calls == 1
    alone = Ranking([bm25, model]).retrieve(questions.filter("query_id < 'q3'"), [3, 2])
    found = runs.filter(~F.col("run_name").contains("Cos()")).select("query_id", "doc_id", "rank", "score")
    assert ranked_lists(found) == ranked_lists(alone)


def test_stages_before_one_that_reads_nothing_are_not_run(questions, stages):
    bm25, cos, _ = stages
    first, second = Counting(bm25), Counting(cos, reads_candidates=False)
    Ranking([first, second]).retrieve(questions, [3, 2])
    assert (first.calls, second.calls) == (0, 1)


def test_checks(spark, docs):
    vectors = spark.createDataFrame(
        [("d1", [1.0, 2.0]), ("d2", [1.0]), ("d3", None), ("x", [3.0, 4.0])],
        "doc_id string, embedding array<float>")
    assert {(r["doc_id"], r["problem"]) for r in malformed_vectors(vectors, "doc_id").collect()} == {
        ("d2", "other length"), ("d3", "no vector")}
    assert {r["doc_id"] for r in missing_details(docs, vectors, "doc_id", "embedding").collect()} == {
        "d3", "d4", "d5"}
    assert {tuple(r) for r in load_report(docs, vectors).collect()} == {
        ("passages", 5), ("vectors", 3), ("passages without vector", 3),
        ("vectors without passage", 1)}


def test_empty_inputs_are_errors(spark, docs, questions):
    from sparkrank.operators.approx import VectorIndex

    with pytest.raises(Exception, match="no documents found"):
        LexicalIndex.build(docs.limit(0)).search(questions, 3).collect()
    none = spark.createDataFrame([], "doc_id string, embedding array<float>")
    centres = spark.createDataFrame([], "cell int, centroid array<double>")
    with pytest.raises(ValueError, match="no vectors found"):
        VectorIndex.build(none, centres)
    given = spark.createDataFrame([(0, [1.0])], centres.schema)
    with pytest.raises(ValueError, match="no vectors found"):
        VectorIndex.build(none, given)
    some = spark.createDataFrame([("d1", [1.0])], none.schema)
    with pytest.raises(ValueError, match="no centroids found"):
        VectorIndex.build(some, centres)


def test_passages_of_any_length_are_found(spark):
    texts = [
        (1, "xalpha beta gammay and so on"), (2, "alpha  beta gamma"), (3, ""), (4, "日本語のテキスト and beta"),
        (5, "a b c d e f g h i"), (6, "one two three four five six seven eight"), (7, "aaaa"), (8, None), (9, "eta"),
    ]
    passages = [
        "", " ", "a", "eta", "alpha", "alpha beta", "a b", "c d e", "two three four five", "wo three four five six",
        "wo three four five six sev", "two three four five six seven e", "語のテ", "aaaaa", "alpha  beta", "lpha beta gamma", "beta gamma",
        "b c d e f g h", "zzz", "a\tb",
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame([*enumerate(passages), (99, None)], "query_id long, text string")
    found = {tuple(r) for r in catalog.containing_pairs(docs, asked).collect()}
    assert found == {(q, i) for q, p in enumerate(passages) for i, t in texts if t is not None and p in t}
    for p in ("lpha beta gamma", "aaaa"):  # one length asked for
        one = spark.createDataFrame([(0, p)], "query_id long, text string")
        assert {tuple(r) for r in catalog.containing_pairs(docs, one).collect()} == {(0, i) for i, t in texts if t and p in t}
    assert catalog.containing_pairs(docs, asked.limit(0)).count() == 0
