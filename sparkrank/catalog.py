"""Every operator as a query on the shared tables, with the same result stated in SQL.

``documents`` is the collection and ``benchmark`` the queries; ``embeddings`` are vectors that
serve as documents and as queries. Large judged runs come from orders: a customer is a query,
the parts bought are documents.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import catalog_sql as sql
from .functions import (
    cosine,
    discount,
    dot,
    l2_norm,
    l2_normalize,
    round_score,
    tokenize,
)
from .functions.standins import HashedBagEncoder, TokenOverlapScorer
from .operators import corpus, metrics, validate
from .operators.approx import VectorIndex, calibrated_probes, train_centroids
from .operators.graph import OWN_NODES, GraphIndex, calibrated_beam
from .operators.joins import hinted
from .operators.lexical import LexicalIndex, query_terms
from .operators.models import encode
from .operators.sizing import fits
from .operators.topk import cut, numbered, ranking_order, top_k, with_rank
from .plans.experiments import judged_queries, make_run, run_experiments
from .plans.stages import ApproxStage, Bm25Stage, CosineStage, GraphStage, ModelStage, Ranking
from .sources import readers, writers
from .sources.scratch import materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

CELLS = sql.CELLS
NPROBE = sql.NPROBE


def query(statement: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL where there is one."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if statement is not None:
            SQL[fn.__name__] = statement
        return fn

    return register


# Inputs -------------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str, *columns, key: str | None = None):
    """Chosen columns of a table. A file too small to occupy the cluster is spread by ``key``."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)
    width = spark.sparkContext.defaultParallelism
    if key and df.rdd.getNumPartitions() < width:
        df = df.repartition(width, key)
    return df


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents", "doc_id", "text", key="doc_id")


def questions(spark, sf_dir):
    return table(spark, sf_dir, "benchmark", F.col("item_id").alias("query_id"), "text")


def labels(spark, sf_dir):
    return table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")


def vectors(spark, sf_dir, name="doc_id"):
    key = F.col("vec_id").alias(name)
    return table(spark, sf_dir, "embeddings", key, "embedding", key=name)


def doc_vectors(spark, sf_dir):
    return encode(documents(spark, sf_dir), HashedBagEncoder(sql.DIM))


def first_by_hash(ids: DataFrame, key: str) -> DataFrame:
    """``(key, cell)``: ids that serve as cell centres."""
    order = [F.md5(F.col(key).cast("string")), F.col(key)]
    chosen = ids.select(key).orderBy(*order).limit(CELLS)
    return chosen.select(key, (F.row_number().over(W.orderBy(*order)) - 1).alias("cell"))


def centroids_of(points: DataFrame, chosen: DataFrame) -> DataFrame:
    centre = F.col("embedding").cast("array<double>").alias("centroid")
    return points.join(F.broadcast(chosen), "doc_id").select("cell", centre)


def vector_index(spark, sf_dir):
    points = vectors(spark, sf_dir)
    return VectorIndex.build(points, centroids_of(points, first_by_hash(points, "doc_id")))


class Inputs:
    """Collection, queries and their vectors; vectors are encoded and written once."""

    def __init__(self, spark, sf_dir):
        self.documents = documents(spark, sf_dir)
        self.questions = questions(spark, sf_dir)

    @cached_property
    def doc_vectors(self):
        return materialize(encode(self.documents, HashedBagEncoder(sql.DIM)), "vectors")

    @cached_property
    def query_vectors(self):
        encoded = encode(self.questions, HashedBagEncoder(sql.DIM), "query_id")
        return materialize(encoded, "vectors")

    @cached_property
    def index(self):
        chosen = first_by_hash(self.documents, "doc_id")
        return VectorIndex.build(self.doc_vectors, centroids_of(self.doc_vectors, chosen))


def bm25_stage(given: Inputs):
    return Bm25Stage(LexicalIndex.build(given.documents))


def cosine_stage(given: Inputs):
    return CosineStage(given.doc_vectors, given.query_vectors)


def approx_stage(given: Inputs):
    return ApproxStage(given.index, given.query_vectors, NPROBE)


def model_stage(given: Inputs):
    return ModelStage(given.documents, TokenOverlapScorer(), "overlap")


def chain(spark, sf_dir, *stages, depths, candidates=None) -> DataFrame:
    given = Inputs(spark, sf_dir)
    ranking = Ranking([stage(given) for stage in stages])
    return ranking.retrieve(given.questions, depths, candidates)


def bought(spark, sf_dir) -> DataFrame:
    """``(query_id, doc_id, price, flag)``: a line per part a customer ordered."""
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_extendedprice",
                  "l_returnflag", key="l_orderkey")
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("query_id"),
        F.col("l_partkey").alias("doc_id"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_returnflag").alias("flag"),
    )


def bought_judged(spark, sf_dir) -> DataFrame:
    """``(query_id, doc_id, score, rel)``: money spent and a grade, from one pass, written once."""
    grade = F.when(F.col("flag") == "N", 2).when(F.col("flag") == "A", 1).otherwise(0)
    both = bought(spark, sf_dir).groupBy("query_id", "doc_id").agg(
        F.round(F.sum("price"), 2).alias("score"), F.max(grade).cast("int").alias("rel")
    )
    return materialize(both, "judged")


def ranked_lists(spent: DataFrame) -> DataFrame:
    """Whole lists, numbered from 1."""
    scored = spent.select("query_id", "doc_id", "score")
    return numbered(scored, ["query_id"], ranking_order(scored))


def bought_run(spark, sf_dir) -> DataFrame:
    return ranked_lists(bought_judged(spark, sf_dir))


def bought_qrels(spark, sf_dir) -> DataFrame:
    return bought_judged(spark, sf_dir).select("query_id", "doc_id", "rel")


def run_and_qrels(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    both = bought_judged(spark, sf_dir)
    return ranked_lists(both), both.select("query_id", "doc_id", "rel")


# Whole tokens of a passage, and first characters of one without any, that stand in every text that
# contains it.
GRAM, CHARS = 5, 8


def containing_pairs(texts: DataFrame, passages: DataFrame) -> DataFrame:
    """``(query_id, doc_id)`` of texts that contain a passage.

    Pairs come from equal keys, and are tested on the texts. A passage's first and last token may
    be parts of longer ones, so its key is the whole tokens between them, ``GRAM`` at most. A
    passage of one or two tokens has none: its key is its first characters, ``CHARS`` at most, of
    which texts give theirs only if some passage asks for that many. An empty passage is in every
    text.
    """
    asked = passages.filter("text IS NOT NULL").select(
        "query_id", F.col("text").alias("passage"), tokenize(F.col("text")).alias("t")
    )
    whole = F.least(F.size("t") - 2, F.lit(GRAM))
    kind = F.when(whole > 0, whole).otherwise(-F.least(F.char_length("passage"), F.lit(CHARS)))
    asked = asked.withColumn("kind", kind.cast("int"))
    inner = F.xxhash64("kind", F.slice("t", F.lit(2), F.greatest("kind", F.lit(0))))
    begin = F.xxhash64("kind", F.substr("passage", F.lit(1), -F.col("kind")))
    asked = asked.select("query_id", "passage", "kind", F.when(F.col("kind") > 0, inner).otherwise(begin).alias("gram"))
    asked = materialize(asked, "passages")
    kinds = [r["kind"] for r in asked.select("kind").distinct().collect()]  # GRAM + CHARS + 1 at most
    split = texts.filter("text IS NOT NULL").select(
        "doc_id", tokenize(F.col("text")).alias("t"), *([F.split("text", "").alias("c")] if min(kinds, default=1) < 0 else [])
    )

    def keys(kind: int):
        """Of all places of a text that have so many tokens or characters."""
        parts, n = F.col("t" if kind > 0 else "c"), abs(kind)
        places = F.when(F.size(parts) >= n, F.sequence(F.lit(1), F.size(parts) - (n - 1))).otherwise(F.array().cast("array<int>"))
        piece = lambda i: F.slice(parts, i, n) if kind > 0 else F.array_join(F.slice(parts, i, n), "")
        return F.transform(places, lambda i: F.xxhash64(F.lit(kind), piece(i)))

    every = [keys(kind) if kind else F.array(F.xxhash64(F.lit(0), F.lit(""))) for kind in sorted(kinds)]
    every = F.concat(*every) if every else F.array().cast("array<bigint>")
    seen = split.select("doc_id", F.explode(F.array_distinct(every)).alias("gram"))
    small = asked.select("query_id", "passage", "gram")
    near = seen.join(hinted(small, fits(small)), "gram").select("query_id", "doc_id", "passage").distinct()
    return near.join(texts, "doc_id").filter(F.col("text").contains(F.col("passage"))).select("query_id", "doc_id").distinct()


def passage_qrels(spark, sf_dir) -> DataFrame:
    """Judgments of the documents that contain a query's passage, from their labels if any."""
    pairs = containing_pairs(documents(spark, sf_dir), questions(spark, sf_dir))
    judged = pairs.join(labels(spark, sf_dir), "doc_id", "left")
    return judged.select(
        "query_id",
        "doc_id",
        F.coalesce("quality", F.lit(1)).alias("good"),
        (1 - F.coalesce("toxic", F.lit(0))).alias("clean"),
    )


# Text and term statistics -------------------------------------------------------------------


@query(sql.TOKENS)
def tokens(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return docs.select("doc_id", F.posexplode(tokenize(F.col("text"))).alias("pos", "term"))


@query(sql.TERM_FREQUENCY)
def term_frequency(spark, sf_dir):
    return LexicalIndex.build(documents(spark, sf_dir)).postings.select("doc_id", "term", "tf")


@query(sql.DOCUMENT_FREQUENCY)
def document_frequency(spark, sf_dir):
    return LexicalIndex.build(documents(spark, sf_dir)).terms


@query(sql.DOC_LENGTH)
def doc_length(spark, sf_dir):
    return LexicalIndex.build(documents(spark, sf_dir)).docs


@query(sql.CORPUS_STATS)
def corpus_stats(spark, sf_dir):
    stats = LexicalIndex.build(documents(spark, sf_dir)).stats
    return stats.select("n", round_score(F.col("avgdl")).alias("avgdl"))


@query(sql.IDF)
def idf(spark, sf_dir):
    stats = LexicalIndex.build(documents(spark, sf_dir)).term_stats()
    return stats.select("term", "df", round_score(F.col("idf")).alias("idf"))


@query(sql.QUERY_TERM_COUNTS)
def query_term_counts(spark, sf_dir):
    return query_terms(questions(spark, sf_dir))


@query(sql.KNOWN_QUERY_TERMS)
def known_query_terms(spark, sf_dir):
    terms = LexicalIndex.build(documents(spark, sf_dir)).terms
    return query_terms(questions(spark, sf_dir)).join(terms, "term").select(
        "query_id", "term", "qtf", "df"
    )


@query(sql.BM25_TERM_WEIGHTS)
def bm25_term_weights(spark, sf_dir):
    """Of the documents found by vector."""
    index, asked, candidates = _by_vector(spark, sf_dir, 100)
    return index.contributions(asked, candidates)


@query(sql.BM25_SCORES)
def bm25_scores(spark, sf_dir):
    """Of the documents found by vector."""
    index, asked, candidates = _by_vector(spark, sf_dir, 100)
    return index.scores(asked, candidates)


# Vectors ------------------------------------------------------------------------------------


@query(sql.VECTOR_NORMS)
def vector_norms(spark, sf_dir):
    norm = round_score(l2_norm(F.col("embedding"))).alias("norm")
    return vectors(spark, sf_dir, "vec_id").select("vec_id", norm)


@query(sql.UNIT_VECTORS)
def unit_vectors(spark, sf_dir):
    unit = l2_normalize(F.col("embedding"))
    rows = vectors(spark, sf_dir, "vec_id").select("vec_id", F.posexplode(unit).alias("pos", "x"))
    return rows.select("vec_id", "pos", round_score(F.col("x")).alias("x"))


@query(sql.NEIGHBOUR_PRODUCTS)
def neighbour_products(spark, sf_dir):
    """Inner product and cosine of vectors with consecutive ids."""
    left = vectors(spark, sf_dir, "vec_id")
    right = left.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    a, b = F.col("embedding"), F.col("other")
    return left.join(right, "vec_id").select(
        "vec_id", round_score(dot(a, b)).alias("dot"), round_score(cosine(a, b)).alias("cosine")
    )


@query(sql.ENCODED_DOCUMENTS)
def encoded_documents(spark, sf_dir):
    rows = doc_vectors(spark, sf_dir).select("doc_id", F.posexplode("embedding").alias("pos", "x"))
    return rows.select("doc_id", "pos", F.col("x").cast("double").alias("x"))


@query(sql.ENCODED_SUBSET)
def encoded_subset(spark, sf_dir):
    """Only listed documents reach the model."""
    listed = corpus.restrict(documents(spark, sf_dir), labels(spark, sf_dir))
    rows = encode(listed, HashedBagEncoder(sql.DIM)).select(
        "doc_id", F.posexplode("embedding").alias("pos", "x")
    )
    return rows.select("doc_id", "pos", F.col("x").cast("double").alias("x"))


@query(sql.NEAREST_CELLS)
def nearest_cells(spark, sf_dir):
    probes = vector_index(spark, sf_dir).probes(vectors(spark, sf_dir, "query_id"), NPROBE)
    rows = probes.select("query_id", F.posexplode("cells").alias("pos", "cell"))
    return rows.select("query_id", (F.col("pos") + 1).alias("place"), "cell")


@query(sql.CELL_ASSIGNMENT)
def cell_assignment(spark, sf_dir):
    return vector_index(spark, sf_dir).cells.select("doc_id", "cell")


# Collections, queries and their parts -------------------------------------------------------


@query(sql.COLLECTION_SUBSET)
def collection_subset(spark, sf_dir):
    return corpus.restrict(documents(spark, sf_dir), labels(spark, sf_dir))


@query(sql.COLLECTION_WHOLE)
def collection_without_subset(spark, sf_dir):
    return corpus.restrict(documents(spark, sf_dir), None)


@query(sql.DOCS_WITH_VECTOR)
def docs_with_vector(spark, sf_dir):
    both = corpus.attach(documents(spark, sf_dir).select("doc_id"), vectors(spark, sf_dir),
                         "doc_id")
    return corpus.with_vectors(both).select("doc_id", F.size("embedding").alias("dim"))


@query(sql.ATTACHED_TEXTS)
def attached_texts(spark, sf_dir):
    """Texts of the documents of a ranked list."""
    run = bought_run(spark, sf_dir).select("query_id", "doc_id", "rank")
    return corpus.attach(run, documents(spark, sf_dir), "doc_id").select(
        "query_id", "doc_id", "rank", F.length("text").alias("n_chars")
    )


@query(sql.CORPUS_ASSEMBLY)
def corpus_assembly(spark, sf_dir):
    whole = corpus.assemble(documents(spark, sf_dir), vectors(spark, sf_dir))
    return whole.select(
        "doc_id",
        F.col("text").isNotNull().alias("has_text"),
        F.col("embedding").isNotNull().alias("has_vector"),
    )


@query(sql.ALL_IDS)
def all_ids(spark, sf_dir):
    return corpus.all_ids(labels(spark, sf_dir), documents(spark, sf_dir), vectors(spark, sf_dir))


# Files --------------------------------------------------------------------------------------


def _one_line(text):
    """Texts as a plain TSV can hold them."""
    return F.regexp_replace(text, sql.LINE_BREAKERS, " ")


def _tsv(df: DataFrame, quoted: bool = False) -> str:
    path = scratch_path(df.sparkSession, "tsv")
    writer = df.write.option("sep", "\t").option("ignoreLeadingWhiteSpace", False)
    writer = writer.option("ignoreTrailingWhiteSpace", False).option("emptyValue", "")
    if quoted:
        writer = writer.option("quoteAll", True).option("escape", '"')
        writer.csv(path)
        return path
    df.select(F.concat_ws("\t", *df.columns)).write.text(path)
    return path


@query(sql.READ_COLLECTION)
def read_collection(spark, sf_dir):
    rows = documents(spark, sf_dir).withColumn("text", _one_line(F.col("text")))
    return readers.read_collection(spark, _tsv(rows))


@query(sql.READ_COLLECTION_QUOTED)
def read_collection_quoted(spark, sf_dir):
    path = _tsv(documents(spark, sf_dir), quoted=True)
    return readers.read_collection(spark, path, quoted=True)


@query(sql.READ_COLLECTION_SUBSET)
def read_collection_subset(spark, sf_dir):
    rows = documents(spark, sf_dir).withColumn("text", _one_line(F.col("text")))
    listed = _tsv(labels(spark, sf_dir).select(F.col("doc_id").cast("string")))
    return readers.read_collection(spark, _tsv(rows), listed)


@query(sql.READ_QUERIES)
def read_queries(spark, sf_dir):
    """Two query files that share ids: the later one wins."""
    early = documents(spark, sf_dir).withColumn("text", _one_line(F.col("text")))
    late = questions(spark, sf_dir).withColumn("text", _one_line(F.col("text")))
    return readers.read_queries(spark, [_tsv(early), _tsv(late)])


@query(sql.READ_VECTORS)
def read_vectors(spark, sf_dir):
    """Two vector files that share ids: the later one wins."""
    early, late = scratch_path(spark, "vectors"), scratch_path(spark, "vectors")
    whole = vectors(spark, sf_dir, "query_id")
    writers.write_vectors(whole, early)
    changed = whole.join(questions(spark, sf_dir), "query_id", "left_semi")
    writers.write_vectors(changed.withColumn("embedding", F.reverse("embedding")), late)
    rows = readers.read_vectors(spark, [early, late], "query_id")
    rows = rows.select("query_id", F.posexplode("embedding").alias("pos", "x"))
    return rows.select("query_id", "pos", round_score(F.col("x")).alias("x"))


@query(sql.ENCODED_FILE)
def encoded_collection_file(spark, sf_dir):
    """Collection and id list from files, listed texts encoded, vectors written and read."""
    rows = documents(spark, sf_dir).withColumn("text", _one_line(F.col("text")))
    listed = _tsv(labels(spark, sf_dir).select(F.col("doc_id").cast("string")))
    path = scratch_path(spark, "vectors")
    texts = readers.read_collection(spark, _tsv(rows), listed)
    writers.write_vectors(encode(texts, HashedBagEncoder(sql.DIM)), path)
    back = readers.read_vectors(spark, path, "doc_id")
    back = back.select("doc_id", F.posexplode("embedding").alias("pos", "x"))
    return back.select("doc_id", "pos", F.col("x").cast("double").alias("x"))


def _qrels_file(spark, sf_dir) -> str:
    """Judgment lines by order, line and grade; a pair may be judged again."""
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey",
                  F.col("l_quantity").cast("int").alias("rel"))
    ordered = lines.orderBy("l_orderkey", "l_linenumber", "rel")
    path = scratch_path(spark, "qrels")
    ordered.select(F.concat_ws(" ", "l_orderkey", F.lit("0"), "l_partkey", "rel")).write.text(path)
    return path


@query(sql.READ_QRELS)
def read_qrels(spark, sf_dir):
    return readers.read_qrels(spark, _qrels_file(spark, sf_dir))


@query(sql.READ_QUERY_IDS)
def read_query_ids(spark, sf_dir):
    return readers.read_query_ids(spark, _qrels_file(spark, sf_dir))


@query(sql.RUN_LINES)
def run_lines(spark, sf_dir):
    run = bought_run(spark, sf_dir).withColumn("run_name", F.lit("bought"))
    return writers.run_lines(run.withColumn("run_id", F.lit("run_1"))).select("run_name", "value")


@query(sql.RUN_ROUND_TRIP)
def run_round_trip(spark, sf_dir):
    """Runs at two cutoffs, written as run files and read back."""
    asked = questions(spark, sf_dir).select("query_id")
    named = judged_queries({"qrels.one.tsv": asked})
    found = bm25_top10(spark, sf_dir)
    run = make_run(found, named, "BM25(1.5-0.75)", [10], [10, 3])
    path = scratch_path(spark, "runs")
    writers.write_runs(run, path)
    return readers.read_runs(spark, path)


@query(sql.RUN_CUTOFFS)
def run_cutoffs(spark, sf_dir):
    rows = writers.at_cutoffs(bought_run(spark, sf_dir), [20, 5, 1])
    return rows.select("cutoff", "query_id", "doc_id", "rank")


@query(sql.RUN_NAMES)
def run_names(spark, sf_dir):
    """Names of runs over judgment files that are named by document source and language."""
    files = table(spark, sf_dir, "documents", "source", "lang").distinct()
    path = F.concat(F.lit("data sets/qrels."), "source", F.lit("."), "lang", F.lit(".tsv"))
    label = F.lit("HNSW(8-200-50), C(cross-encoder/ms-marco-TinyBERT-L-2-v2)")
    depths = F.array(F.lit(1000), F.lit(100))
    name = writers.run_name(path, label, depths, F.lit(10))
    return files.select("source", "lang", name.alias("run_name"),
                        F.regexp_extract(name, "^([^-]*)", 1).alias("qrels_name"))


@query(sql.METRICS_ROUND_TRIP)
def metrics_round_trip(spark, sf_dir):
    path = scratch_path(spark, "metrics")
    values = metrics.evaluate(*run_and_qrels(spark, sf_dir))
    writers.write_metrics(metrics.mean_over_queries(values), path)
    return spark.read.parquet(path)


# Scorers and their chains -------------------------------------------------------------------


@query(sql.BM25_TOP10)
def bm25_top10(spark, sf_dir):
    return LexicalIndex.build(documents(spark, sf_dir)).search(questions(spark, sf_dir), 10)


@query(sql.BM25_TOP10)
def bm25_saved_index_top10(spark, sf_dir):
    """Search in saved statistics."""
    slots = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = LexicalIndex.build(documents(spark, sf_dir)).save(scratch_path(spark, "lexical"), slots)
    return index.search(questions(spark, sf_dir), 10)


@query(sql.BM25_TOP1000)
def bm25_top1000(spark, sf_dir):
    return LexicalIndex.build(documents(spark, sf_dir)).search(questions(spark, sf_dir), 1000)


def _by_vector(spark, sf_dir, k):
    """Lexical index, queries, and what a vector search gives to re-rank."""
    given = Inputs(spark, sf_dir)
    found = cosine_stage(given).search(given.questions, None, k)
    return LexicalIndex.build(given.documents), given.questions, materialize(found, "stage")


@query(sql.BM25_RERANK_PADDED)
def bm25_rerank_padded(spark, sf_dir):
    """Documents found by vector; those without a matching term stay with score 0."""
    index, asked, candidates = _by_vector(spark, sf_dir, 500)
    return index.rerank(asked, candidates, 500)


@query(sql.BM25_RERANK_MATCHED)
def bm25_rerank_matched(spark, sf_dir):
    index, asked, candidates = _by_vector(spark, sf_dir, 500)
    return index.rerank(asked, candidates, 500, pad_zero=False)


@query(sql.BM25_IN_POOL)
def bm25_in_pool(spark, sf_dir):
    """Search in the labelled documents only, with statistics of the whole collection."""
    return chain(spark, sf_dir, bm25_stage, depths=[10], candidates=_pool(spark, sf_dir))


@query(sql.TEXT_COSINE_IN_POOL)
def cosine_in_pool(spark, sf_dir):
    return chain(spark, sf_dir, cosine_stage, depths=[10], candidates=_pool(spark, sf_dir))


@query(sql.MODEL_IN_POOL)
def cross_encoder_in_pool(spark, sf_dir):
    return chain(spark, sf_dir, model_stage, depths=[10], candidates=_pool(spark, sf_dir))


def _pool(spark, sf_dir):
    return labels(spark, sf_dir).select("doc_id").distinct()


@query(sql.COSINE_TOP100)
def cosine_top100(spark, sf_dir):
    """Every vector against all vectors, exactly."""
    asked = vectors(spark, sf_dir, "query_id")
    return CosineStage(vectors(spark, sf_dir), asked).search(asked, None, 100)


@query(sql.APPROX_TOP10)
def approx_top10(spark, sf_dir):
    asked = vectors(spark, sf_dir, "query_id")
    return vector_index(spark, sf_dir).search(asked, 10, NPROBE)


@query(sql.COSINE_TOP10)
def approx_all_cells_top10(spark, sf_dir):
    """With every cell probed the approximate search is the exact one."""
    asked = vectors(spark, sf_dir, "query_id")
    return vector_index(spark, sf_dir).search(asked, 10, CELLS)


@query(sql.APPROX_TOP10)
def approx_saved_index_top10(spark, sf_dir):
    """Search in cells written as partitions."""
    index = vector_index(spark, sf_dir).save(scratch_path(spark, "cells"))
    return index.search(vectors(spark, sf_dir, "query_id"), 10, NPROBE)


@query(sql.COSINE_TOP10)
def approx_trained_top10(spark, sf_dir):
    """Cells trained by k-means on the vectors, their number growing with the data; with all of
    them probed, the search is the exact one."""

    points = vectors(spark, sf_dir)
    cells = max(1, round(points.count() ** 0.5))
    index = VectorIndex.build(points, train_centroids(points, cells, seed=7))
    return index.search(vectors(spark, sf_dir, "query_id"), 10, 2 * cells)


def trained_index(points: DataFrame, per_root: float) -> VectorIndex:
    """Cells trained by k-means, ``per_root`` times the root of the vectors."""
    cells = max(1, round(per_root * points.count() ** 0.5))
    return VectorIndex.build(points, train_centroids(points, cells, seed=7))


@query(sql.COSINE_TOP10)
def approx_exact_top10(spark, sf_dir):
    """Cells are passed over only where their radii show that they hold nothing better."""
    index = trained_index(vectors(spark, sf_dir), 1.0)
    return index.search_exact(vectors(spark, sf_dir, "query_id"), 10)


@query()
def approx_recall_top10(spark, sf_dir):
    """As many probes as a recall of 0.9 takes, told by a sample of the vectors."""
    index = trained_index(vectors(spark, sf_dir), 4.0)
    probes = calibrated_probes(index, 10, 0.9)
    return index.search(vectors(spark, sf_dir, "query_id"), 10, probes)


@query()
def graph_top10(spark, sf_dir):
    """Search by walking a neighbour graph of all vectors, in beams as wide as a recall of 0.9 takes."""
    index = GraphIndex.build(vectors(spark, sf_dir), block_nodes=OWN_NODES)
    return index.search(vectors(spark, sf_dir, "query_id"), 10, calibrated_beam(index, 10, 0.9))


@query()
def graph_then_cosine(spark, sf_dir):
    """A walk of the graph of text vectors, in beams as wide as a recall of 0.9 takes, re-ranked exactly."""

    def graph(given: Inputs):
        index = GraphIndex.build(given.doc_vectors)
        beam = calibrated_beam(index, 10, 0.9, given.query_vectors, least=100)
        return GraphStage(index, given.query_vectors, beam)

    return chain(spark, sf_dir, graph, cosine_stage, depths=[100, 10])


@query(sql.APPROX_RESTRICTED)
def approx_restricted(spark, sf_dir):
    """Approximate search among candidates only."""
    asked = vectors(spark, sf_dir, "query_id")
    found = materialize(cosine_top100(spark, sf_dir), "stage")
    return vector_index(spark, sf_dir).rerank(found, asked, 10, NPROBE)


@query(sql.MODEL_TOP10)
def cross_encoder(spark, sf_dir):
    """The pairwise model alone, over the whole collection."""
    return chain(spark, sf_dir, model_stage, depths=[10])


@query(sql.TEXT_COSINE_TOP10)
def cosine_alone(spark, sf_dir):
    return chain(spark, sf_dir, cosine_stage, depths=[10])


@query(sql.TEXT_APPROX_TOP10)
def approx_alone(spark, sf_dir):
    return chain(spark, sf_dir, approx_stage, depths=[10])


@query(sql.BM25_THEN_COSINE)
def bm25_then_cosine(spark, sf_dir):
    return chain(spark, sf_dir, bm25_stage, cosine_stage, depths=[100, 10])


@query(sql.BM25_THEN_MODEL)
def bm25_then_cross_encoder(spark, sf_dir):
    return chain(spark, sf_dir, bm25_stage, model_stage, depths=[100, 10])


@query(sql.TEXT_APPROX_TOP10)
def bm25_then_approx(spark, sf_dir):
    """Approximate search as a later stage looks through the whole collection again."""
    return chain(spark, sf_dir, bm25_stage, approx_stage, depths=[100, 10])


@query(sql.APPROX_THEN_COSINE)
def approx_then_cosine(spark, sf_dir):
    return chain(spark, sf_dir, approx_stage, cosine_stage, depths=[100, 10])


@query(sql.APPROX_THEN_MODEL)
def approx_then_cross_encoder(spark, sf_dir):
    return chain(spark, sf_dir, approx_stage, model_stage, depths=[100, 10])


@query(sql.APPROX_THEN_BM25)
def approx_then_bm25(spark, sf_dir):
    return chain(spark, sf_dir, approx_stage, bm25_stage, depths=[100, 10])


@query(sql.COSINE_THEN_MODEL)
def cosine_then_cross_encoder(spark, sf_dir):
    return chain(spark, sf_dir, cosine_stage, model_stage, depths=[100, 10])


@query(sql.COSINE_THEN_BM25)
def cosine_then_bm25(spark, sf_dir):
    return chain(spark, sf_dir, cosine_stage, bm25_stage, depths=[100, 10])


@dataclass(frozen=True)
class LongestStage:
    """A stage of one's own: the longest texts first."""

    collection: DataFrame
    label: str = "Longest()"

    def search(self, queries, candidates, k):
        length = F.char_length("text").cast("double")
        pairs = candidates.select("query_id", "doc_id", F.col("rank").alias("prev_rank"))
        scored = pairs.join(self.collection.select("doc_id", length.alias("score")), "doc_id")
        best = top_k(scored, ["query_id"], ranking_order(scored), k)
        return best.select("query_id", "doc_id", "score", "rank")


@query(sql.OWN_STAGE)
def own_stage(spark, sf_dir):
    """A stage defined by the caller behind a lexical one."""
    longest = lambda given: LongestStage(given.documents)
    return chain(spark, sf_dir, bm25_stage, longest, depths=[100, 10])


@query(sql.NO_STAGE)
def no_stage(spark, sf_dir):
    """Without stages the given documents come back in their order, without a score."""
    given = bought_run(spark, sf_dir)
    return Ranking([]).retrieve(questions(spark, sf_dir), [], given)


# Ranks and metrics --------------------------------------------------------------------------


@query(sql.RANKS)
def ranks(spark, sf_dir):
    """Ranks of whole lists: best score first, then id."""
    return bought_run(spark, sf_dir)


@query(sql.RANK_CUTOFF)
def rank_cutoff(spark, sf_dir):
    return cut(bm25_top10(spark, sf_dir), 3)


@query(sql.RANK_DISCOUNTS)
def rank_discounts(spark, sf_dir):
    run = bought_run(spark, sf_dir)
    return run.select(
        "query_id", "doc_id", "rank", round_score(discount(F.col("rank"))).alias("discount")
    )


@query(sql.JUDGED_RUN)
def judged_run(spark, sf_dir):
    return metrics.with_judgments(*run_and_qrels(spark, sf_dir)).select(
        "query_id", "doc_id", "rank", "rel"
    )


@query(sql.RUNNING_HITS)
def running_hits(spark, sf_dir):
    judged = metrics.with_judgments(*run_and_qrels(spark, sf_dir))
    return metrics.relevant_hits(judged).select(
        "query_id", "doc_id", "rank", "hits"
    )


@query(sql.IDEAL_GAINS)
def ideal_gains(spark, sf_dir):
    gains = metrics.ideal_gains(bought_qrels(spark, sf_dir))
    return gains.select("query_id", F.col("n_rel").cast("bigint").alias("n_rel"),
                        round_score(F.col("ideal")).alias("ideal"))


def _bought_metrics(spark, sf_dir, **options):
    return metrics.evaluate(*run_and_qrels(spark, sf_dir), **options)


@query(sql.METRICS_PER_QUERY)
def metrics_per_query(spark, sf_dir):
    return _bought_metrics(spark, sf_dir)


@query(sql.metric("map"))
def metric_map(spark, sf_dir):
    return _bought_metrics(spark, sf_dir, measures=["map"])


@query(sql.metric("ndcg"))
def metric_ndcg(spark, sf_dir):
    return _bought_metrics(spark, sf_dir, measures=["ndcg"])


@query(sql.metric("recip_rank"))
def metric_recip_rank(spark, sf_dir):
    return _bought_metrics(spark, sf_dir, measures=["recip_rank"])


@query(sql.metric("recall_10"))
def metric_recall(spark, sf_dir):
    return _bought_metrics(spark, sf_dir, measures=["recall"], recall_cutoffs=[10])


@query(sql.METRICS_BY_RANK)
def metrics_by_given_rank(spark, sf_dir):
    """Metrics that trust the rank of the run, here in ascending order of id."""
    both = bought_judged(spark, sf_dir)
    run = numbered(both.select("query_id", "doc_id", "score"), ["query_id"], [F.asc("doc_id")])
    return metrics.evaluate(run, both.select("query_id", "doc_id", "rel"), order="rank")


@query(sql.METRICS_MEAN)
def metrics_mean(spark, sf_dir):
    return metrics.mean_over_queries(_bought_metrics(spark, sf_dir))


def _experiment(spark, sf_dir):
    given = Inputs(spark, sf_dir)
    judged = materialize(passage_qrels(spark, sf_dir), "qrels")
    qrels = judged.select(
        "query_id", "doc_id",
        F.explode(F.array(
            F.struct(F.lit("qrels.good.tsv").alias("qrels_name"), F.col("good").alias("rel")),
            F.struct(F.lit("qrels.clean.tsv").alias("qrels_name"), F.col("clean").alias("rel")),
        )).alias("j"),
    ).select("j.qrels_name", "query_id", "doc_id", "j.rel")
    cosines = cosine_stage(given)
    rankings = [
        Ranking([bm25_stage(given), cosines]), Ranking([approx_stage(given), cosines])
    ]
    sets = {name: qrels.filter(F.col("qrels_name") == name)
            for name in ("qrels.good.tsv", "qrels.clean.tsv")}
    runs = run_experiments(rankings, [1000, 100], sets, given.questions, [100, 10])
    return runs, qrels


@query(sql.EXPERIMENT_RUNS)
def experiment_runs(spark, sf_dir):
    """Two rankings over two judgment sets at two cutoffs."""
    runs, _ = _experiment(spark, sf_dir)
    return runs


@query(sql.EXPERIMENT_METRICS)
def experiment_metrics(spark, sf_dir):
    """Runs written as files, read back, and scored against the judgments of their name."""
    runs, qrels = _experiment(spark, sf_dir)
    path = scratch_path(spark, "runs")
    writers.write_runs(runs, path)
    judged = qrels.select("qrels_name", F.col("query_id").cast("string").alias("query_id"),
                          F.col("doc_id").cast("string").alias("doc_id"), "rel")
    values = metrics.evaluate_runs(readers.read_runs(spark, path), judged, depth=100)
    return metrics.mean_over_queries(values)


@query(sql.RUNS_WITHOUT_QRELS)
def runs_without_qrels(spark, sf_dir):
    """Runs named by document source, judgments named by the sources of labelled documents."""
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "lang")
    runs = docs.select(F.concat("source", F.lit("."), "lang", F.lit("-run-10.txt"))
                       .alias("run_name"))
    toxic = labels(spark, sf_dir).filter("toxic = 1")
    judged = docs.join(toxic, "doc_id").select(
        F.concat("source", F.lit("."), "lang").alias("qrels_name")
    )
    return metrics.runs_without_qrels(runs, judged)


# Checks -------------------------------------------------------------------------------------


@query(sql.QUERIES_WITHOUT_TEXT)
def queries_without_text(spark, sf_dir):
    """Ordered parts as query ids, looked up among the documents."""
    asked = bought(spark, sf_dir).select(F.col("doc_id").alias("query_id"))
    texts = documents(spark, sf_dir).withColumnRenamed("doc_id", "query_id")
    return validate.missing_details(asked, texts, "query_id", "text")


@query(sql.QUERIES_WITHOUT_VECTOR)
def queries_without_vector(spark, sf_dir):
    asked = documents(spark, sf_dir).select(F.col("doc_id").alias("query_id"))
    return validate.missing_details(asked, vectors(spark, sf_dir, "query_id"), "query_id",
                                    "embedding")


@query(sql.MALFORMED_VECTORS)
def malformed_vectors(spark, sf_dir):
    """Documents with the vectors of their id, some of which are absent or cut short."""
    found = corpus.attach(documents(spark, sf_dir).select("doc_id"), vectors(spark, sf_dir),
                          "doc_id")
    flagged = found.join(labels(spark, sf_dir), "doc_id", "left")
    short = F.when(F.col("toxic") == 1, F.slice("embedding", 1, 10)).otherwise(F.col("embedding"))
    return validate.malformed_vectors(flagged.select("doc_id", short.alias("embedding")), "doc_id")


@query(sql.LOAD_REPORT)
def load_report(spark, sf_dir):
    return validate.load_report(documents(spark, sf_dir), vectors(spark, sf_dir))


@query(sql.INPUT_CHECKS)
def input_checks(spark, sf_dir):
    """Whether there is a document and a vector; also of the parts nobody labelled."""
    docs, points = documents(spark, sf_dir), corpus.with_vectors(vectors(spark, sf_dir))
    listed = labels(spark, sf_dir)
    rest = listed.join(listed, "doc_id", "left_anti")
    return validate.input_checks(
        documents=docs,
        vectors=points,
        unlabelled_documents=docs.join(listed, "doc_id", "left_anti"),
        unlabelled_labels=rest,
    )
