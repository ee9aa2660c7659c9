"""The pipeline against plain versions of its stages, one after another."""

import random

import awkward
import brute
import corpus_pipeline
import duckdb
import __spark_entry__ as driver

from sparkrank.llm import langid


def test_pipeline(spark, small):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{small}/documents.parquet'").fetchall()
    # The documents of the table all have a language.
    docs = [(i, t) for i, t in docs if langid.words_of(t or "")]
    cut = brute.line_dedup(docs)
    docs = [(i, cut[i][2]) for i, _ in docs]
    near = brute.components(docs)
    docs = [(i, t) for i, t in docs if near[i][1] == i]
    left = brute.suffix_dedup(docs)
    docs = [(i, left[i][3].decode("utf-8", "ignore")) for i, _ in docs]
    found = corpus_pipeline.run(spark, small).collect()
    assert sorted([tuple(r)[:5] for r in found]) == sorted(brute.pieces(docs))
    used = brute.check_sequences([(r["sequence_id"], r["offset"], r["length"]) for r in found])
    assert used <= sum(r["length"] for r in found) / 1024 * 1.01 + 2


def test_near_duplicate_stage_keeps_the_first_of_each_component(spark):
    r, rows = random.Random(2), []
    for family in range(20):
        base = [f"w{r.randrange(5000)}" for _ in range(400)]
        for n in range(4):
            own = base[:]
            for at in r.sample(range(400), n):
                own[at] = "changed"
            rows.append((4 * family + n, " ".join(own)))
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    found = stage(spark, awkward.docs(spark, rows, clashing=False), "")
    firsts = [i for i, (_, component) in brute.components(rows).items() if component == i]
    assert sorted(x["doc_id"] for x in found.collect()) == sorted(firsts)
    assert 20 <= len(firsts) < len(rows)


def test_stages_keep_columns(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, small).dtypes == docs.dtypes
        assert stage(spark, docs.limit(0), small).count() == 0


def test_queries_are_registered():
    names = list(driver.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
    assert "pipeline" in names and set(driver.oracle_sql()) <= set(names)
