"""BM25: corpus statistics, full-collection search and re-ranking."""

from __future__ import annotations

import math
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ranking import round_score
from ..functions.sums import exact_sum
from ..functions.text import B, K1, bm25_idf, bm25_weight, term_counts, tokenize
from ..sources.scratch import materialize
from .corpus import restrict
from .joins import hinted, salted_join
from .lexical_scan import best_documents, wanted_counts, weight_blocks
from .sizing import fits
from .topk import ranking_order, top_k
from .validate import require_rows


# Postings of one file of a saved index, and those that a task writes.
FILE_ROWS, TASK_ROWS = 2_000_000, 500_000


def term_vectors(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``(key, dl, counts)``: token count and per-term counts of each row, without a shuffle."""
    tokens = texts.select(key, tokenize(F.col(text)).alias("_tokens"))
    return tokens.select(
        key,
        F.size("_tokens").alias("dl"),
        term_counts(F.col("_tokens")).alias("counts"),
    )


def _exploded(counted: DataFrame) -> DataFrame:
    """One row per (key, term).

    The outer form with a later filter: for a plain explode Catalyst adds a filter on the size
    of the array below the explode, which counts every row's terms twice.
    """
    keys = [c for c in counted.columns if c != "counts"]
    rows = counted.select(*keys, F.explode_outer("counts").alias("t"))
    rows = rows.select(*keys, F.col("t.term").alias("term"), F.col("t.tf").alias("tf"))
    return rows.filter(F.col("term").isNotNull())


def term_slot(term: Column, slots: int) -> Column:
    """The folder of a saved index that holds a term's postings."""
    return F.pmod(F.xxhash64(term), F.lit(int(slots))).cast("int")


def query_terms(queries: DataFrame) -> DataFrame:
    """``(query_id, term, qtf)``: a repeated query term counts as often as it occurs."""
    counted = _exploded(term_vectors(queries, "query_id"))
    return counted.select("query_id", "term", F.col("tf").alias("qtf"))


def _corpus_stats(docs: DataFrame) -> DataFrame:
    """One row ``(n, avgdl)``; empty documents count in both."""
    return docs.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"))


def _stat(stats: DataFrame, name: str) -> Column:
    return stats.select(F.struct("n", "avgdl")).scalar().getField(name)


def _summed(hits: DataFrame) -> DataFrame:
    return hits.groupBy("query_id", "doc_id").agg(round_score(exact_sum(F.col("score"))).alias("score"))


class LexicalIndex:
    """Term statistics of a whole collection.

    ``postings(doc_id, dl, term, tf)``, ``docs(doc_id, dl)``, ``terms(term, df)`` and the
    one-row ``stats(n, avgdl)``. Derived lazily from ``collection(doc_id, text)``, or opened
    from saved tables, whose postings lie in folders by a hash of the term (``slots``).
    """

    def __init__(
        self,
        collection: DataFrame | None = None,
        slots: int = 0,
        k1: float = K1,
        b: float = B,
        **tables: DataFrame,
    ):
        self.collection, self.slots, self.k1, self.b = collection, slots, k1, b
        vars(self).update(tables)

    @classmethod
    def build(cls, collection: DataFrame, k1: float = K1, b: float = B) -> LexicalIndex:
        """Statistics of ``collection(doc_id, text)``; ids must be unique (see ``keep_last``)."""
        return cls(collection, k1=k1, b=b)

    @cached_property
    def postings(self) -> DataFrame:
        return _exploded(term_vectors(self.collection, "doc_id"))

    @cached_property
    def docs(self) -> DataFrame:
        return self.collection.select("doc_id", F.size(tokenize(F.col("text"))).alias("dl"))

    @cached_property
    def terms(self) -> DataFrame:
        return self.postings.groupBy("term").agg(F.count("*").alias("df"))

    @cached_property
    def stats(self) -> DataFrame:
        return _corpus_stats(self.docs)

    def save(self, path: str, slots: int) -> LexicalIndex:
        """Write the statistics under ``path``; texts are split once.

        Postings go to ``slots`` folders by term, each file sorted by term, so that a search reads
        the folders of its terms and skips the row groups between them. The postings of a crowded
        folder are written by as many tasks as its measured size asks for.
        """
        spark = self.collection.sparkSession
        require_rows(self.collection.select("doc_id"), "documents")
        counted = materialize(term_vectors(self.collection, "doc_id"), "counted")
        counted.select("doc_id", "dl").write.parquet(f"{path}/docs")
        postings = _exploded(counted).withColumn("slot", term_slot(F.col("term"), slots))
        sizes = materialize(postings.groupBy("slot").count(), "slots")
        total = sizes.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
        files = sizes.select("slot", F.ceil(F.col("count") / FILE_ROWS).alias("_files"))
        spread = postings.join(hinted(files, fits(files)), "slot").withColumn(
            "_file", F.pmod(F.xxhash64("doc_id"), F.col("_files"))
        )
        (
            spread.repartition(max(1, math.ceil(total / TASK_ROWS)), "slot", "_file")
            .sortWithinPartitions("slot", "term")
            .drop("_file", "_files")
            .write.partitionBy("slot")
            .option("parquet.bloom.filter.enabled#term", "true")
            .parquet(f"{path}/postings")
        )
        written = spark.read.parquet(f"{path}/postings")
        written.groupBy("term").agg(F.count("*").alias("df")).write.parquet(f"{path}/terms")
        stats = _corpus_stats(spark.read.parquet(f"{path}/docs"))
        stats.withColumn("slots", F.lit(int(slots))).write.parquet(f"{path}/stats")
        return self.load(spark, path, self.k1, self.b)

    @classmethod
    def load(cls, spark: SparkSession, path: str, k1: float = K1, b: float = B) -> LexicalIndex:
        """Open saved statistics."""
        stats = spark.read.parquet(f"{path}/stats")
        return cls(
            slots=stats.first()["slots"],
            k1=k1,
            b=b,
            stats=stats,
            **{t: spark.read.parquet(f"{path}/{t}") for t in ("postings", "docs", "terms")},
        )

    def term_stats(self) -> DataFrame:
        """``(term, df, idf)`` of every term of the collection."""
        n = _stat(self.stats, "n")
        return self.terms.select("term", "df", bm25_idf(n, F.col("df")).alias("idf"))

    def _found(self, wanted: DataFrame, small: bool) -> LexicalIndex:
        """The index cut down to the wanted terms, with statistics of the whole collection.

        Without saved postings the texts are scanned once: tokens that no query asks for are
        dropped before they are counted, and what is left is written, since document
        frequencies and scores are both taken from it. Every document also leaves a row under
        the empty term, which no text holds, so the same scan gives the number of documents and
        their mean length.
        """
        if self.collection is None:
            listed = hinted(wanted, small)
            return LexicalIndex(
                slots=self.slots,
                k1=self.k1,
                b=self.b,
                postings=self._folders(wanted).join(listed, "term", "left_semi"),
                docs=self.docs,
                terms=self.terms.join(listed, "term", "left_semi"),
                stats=self.stats,
            )
        own = self.collection.sparkSession.range(1).select(F.lit("").alias("term"))
        tokens = self.collection.select("doc_id", tokenize(F.col("text")).alias("_tokens"))
        rows = tokens.select(
            "doc_id",
            F.size("_tokens").alias("dl"),
            F.explode(F.array_append("_tokens", F.lit(""))).alias("term"),
        )
        kept = rows.join(hinted(wanted.union(own), small), "term", "left_semi")
        counted = kept.groupBy("doc_id", "dl", "term").agg(F.count("*").alias("tf"))
        written = materialize(counted, "postings")
        require_rows(written, "documents")
        return LexicalIndex(
            k1=self.k1,
            b=self.b,
            postings=written.filter(F.col("term") != ""),
            docs=written.filter(F.col("term") == "").select("doc_id", "dl"),
        )

    def _folders(self, wanted: DataFrame) -> DataFrame:
        """Saved postings of the folders that hold the ``wanted(term)``."""
        # At most one row per folder comes to the driver.
        slots = wanted.select(term_slot(F.col("term"), self.slots).alias("slot")).distinct()
        return self.postings.filter(F.col("slot").isin([r["slot"] for r in slots.collect()])).drop("slot")

    def _weights(self, terms: DataFrame) -> DataFrame:
        """``(query_id, term, weight)``: idf times multiplicity; unknown terms drop out."""
        idf = bm25_idf(_stat(self.stats, "n"), F.col("df"))
        return terms.join(self.terms, "term").select(
            "query_id", "term", (idf * F.col("qtf")).alias("weight")
        )

    def _weight(self) -> Column:
        avgdl = _stat(self.stats, "avgdl")
        return bm25_weight(F.col("weight"), F.col("tf"), F.col("dl"), avgdl, self.k1, self.b)

    def _asked(self, queries: DataFrame) -> tuple[LexicalIndex, DataFrame, bool]:
        """The index cut to the terms of ``queries``, these terms, and whether they fit."""
        terms = query_terms(queries)
        wanted = terms.select("term").distinct()
        small = fits(terms)
        return self._found(wanted, small or fits(wanted)), terms, small

    def _hits(self, terms: DataFrame, small: bool, within: DataFrame | None = None) -> DataFrame:
        """``(query_id, doc_id, term, score)``: what every matching term adds to a score."""
        postings = restrict(self.postings, within)
        weights = self._weights(terms)
        if not small:
            hits = salted_join(postings, weights, "term", "doc_id")
        else:
            if not self.slots:
                # Only postings of query terms move, and they move once: scores are then summed
                # and cut to the best k where the document is, before pairs are shuffled.
                postings = postings.repartition("doc_id")
            hits = postings.join(F.broadcast(weights), "term")
        return hits.select("query_id", "doc_id", "term", self._weight().alias("score"))

    def contributions(
        self, queries: DataFrame, candidates: DataFrame | None = None
    ) -> DataFrame:
        """``(query_id, doc_id, term, weight)`` of matching terms, of all pairs of query and
        document that share one, or of ``candidates(query_id, doc_id)`` only."""
        hits = self._pair_hits(queries, candidates)
        return hits.select(
            "query_id", "doc_id", "term", round_score(F.col("score")).alias("weight")
        )

    def scores(self, queries: DataFrame, candidates: DataFrame | None = None) -> DataFrame:
        """``(query_id, doc_id, score)`` of every document that shares a term with the query, or
        of those among ``candidates(query_id, doc_id)``."""
        return _summed(self._pair_hits(queries, candidates))

    def _pair_hits(self, queries: DataFrame, candidates: DataFrame | None) -> DataFrame:
        found, terms, small = self._asked(queries)
        if candidates is None:
            return found._hits(terms, small)
        pairs = candidates.select("query_id", "doc_id").distinct()
        ids = pairs.select("doc_id").distinct()
        hits = found._hits(terms, small, ids)
        return hits.join(hinted(pairs, fits(pairs)), ["query_id", "doc_id"], "left_semi")

    def search(self, queries: DataFrame, k: int, within: DataFrame | None = None) -> DataFrame:
        """The ``k`` best documents for every query, of the whole collection or of the ids in
        ``within(doc_id)``."""
        terms = query_terms(queries)
        if fits(terms):
            return self._scan(terms, k, within)
        found, terms, small = self._asked(queries)
        return found._best(terms, small, k, within).select("query_id", "doc_id", "score", "rank")

    def _best(
        self, terms: DataFrame, small: bool, k: int, within: DataFrame | None
    ) -> DataFrame:
        scored = _summed(self._hits(terms, small, within))
        return top_k(scored, ["query_id"], ranking_order(scored), k)

    def _counted(self, terms: DataFrame) -> tuple[DataFrame, pa.Table, float]:
        """Counts of the wanted terms per document, written once, and what comes from them:
        ``(counts, weights, avgdl)``.

        ``weights(query_id, number, weight)`` is of checked size; terms are numbered. Document
        frequencies, corpus statistics and all scores come from the counts, without moving a
        posting.
        """
        # In one order, so that scores are summed in one order.
        block = terms.toArrow().combine_chunks().sort_by([("query_id", "ascending"), ("term", "ascending")])
        vocabulary = pc.unique(block.column("term").combine_chunks())
        df = np.zeros(len(vocabulary))
        if self.collection is None:
            counts, seen = self._saved_counts(vocabulary, terms.sparkSession)
            stats = self.stats.first()
        else:
            counts = materialize(wanted_counts(self.collection, vocabulary), "counts")
            stats = _corpus_stats(counts).first()
            seen = counts.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
        if stats["n"] == 0:
            raise ValueError("no documents found")
        df[seen.column("term").to_numpy()] = seen.column("count").to_numpy()
        idf = np.where(df > 0, np.log((stats["n"] - df + 0.5) / (df + 0.5) + 1.0), 0.0)
        term = pc.index_in(block.column("term").combine_chunks(), value_set=vocabulary).to_numpy()
        weights = pa.table(
            {
                "query_id": block.column("query_id"),
                "number": pa.array(term, pa.int32()),
                "weight": idf[term] * block.column("qtf").to_numpy(),
            }
        )
        return counts, weights, stats["avgdl"]

    def _saved_counts(self, vocabulary: pa.Array, spark: SparkSession) -> tuple[DataFrame, pa.Table]:
        """Counts of the wanted terms per document that has any, from saved postings, and the terms'
        document frequencies.

        A posting moves once, to its document, however many queries ask for its term.
        """
        numbers = pa.array(np.arange(len(vocabulary)), pa.int32())
        listed = F.broadcast(spark.createDataFrame(pa.table({"term": vocabulary, "number": numbers})))
        wanted = self._folders(listed).join(listed, "term").select(
            "doc_id", "dl", F.struct("number", F.col("tf").cast("int").alias("tf")).alias("t")
        )
        grouped = wanted.groupBy("doc_id").agg(
            F.max("dl").alias("dl"), F.sort_array(F.collect_list("t")).alias("t")
        )
        counts = grouped.select("doc_id", "dl", F.col("t.number").alias("terms"), F.col("t.tf").alias("tfs"))
        seen = self.terms.join(listed, "term").select(F.col("number").alias("term"), F.col("df").alias("count"))
        return counts, seen.toArrow()

    def _scan(self, terms: DataFrame, k: int, within: DataFrame | None) -> DataFrame:
        """Search without a row per pair, for query terms of checked size."""
        counts, weights, avgdl = self._counted(terms)
        ids = weights.column("query_id").combine_chunks().dictionary_encode()
        grouped = weight_blocks(
            ids.indices.to_numpy(),
            weights.column("number").to_numpy(),
            weights.column("weight").to_numpy(),
            len(ids.dictionary),
        )
        found = best_documents(
            restrict(counts, within), ids.dictionary, terms.schema["query_id"].dataType, grouped,
            k, avgdl, self.k1, self.b,
        )
        return top_k(found, ["query_id"], ranking_order(found), k).select(
            "query_id", "doc_id", "score", "rank"
        )

    def rerank(
        self, queries: DataFrame, candidates: DataFrame, k: int, pad_zero: bool = True
    ) -> DataFrame:
        """The ``k`` best of ``candidates(query_id, doc_id[, rank])``, corpus-wide statistics.

        Candidates the collection does not hold drop out. Those without a matching term stay
        with score 0, after all matches, unless ``pad_zero`` is off.
        """
        pairs = candidates.select(
            "query_id",
            "doc_id",
            *([F.col("rank").alias("prev_rank")] if "rank" in candidates.columns else []),
        )
        ids = pairs.select("doc_id").distinct()
        few = fits(pairs)
        terms = query_terms(queries)
        small = fits(terms)
        if self.collection is not None and small:
            known, hits = self._candidate_hits(terms, pairs, ids, few)
        else:
            found = self._found(terms.select("term").distinct(), small)
            weights = hinted(found._weights(terms), small)
            pair_terms = pairs.select("query_id", "doc_id").join(weights, "query_id")
            known = found.docs.join(hinted(ids, few), "doc_id", "left_semi").select("doc_id")
            hits = (
                found.postings.join(hinted(ids, few), "doc_id", "left_semi")
                .join(pair_terms, ["doc_id", "term"])
                .select("query_id", "doc_id", found._weight().alias("score"))
            )
        scored = pairs.join(known, "doc_id").join(
            _summed(hits), ["query_id", "doc_id"], "left" if pad_zero else "inner"
        )
        scored = scored.withColumn("score", F.coalesce("score", F.lit(0.0)))
        return top_k(scored, ["query_id"], ranking_order(scored), k).select(
            "query_id", "doc_id", "score", "rank"
        )

    def _candidate_hits(self, terms: DataFrame, pairs: DataFrame, ids: DataFrame, few: bool):
        """Candidates the collection holds, and what each of their terms adds.

        Only counts of candidates meet their pairs; a count stays in its document's row till then.
        """
        counts, weights, avgdl = self._counted(terms)
        held = counts.join(hinted(ids, few), "doc_id", "left_semi")
        listed = terms.sparkSession.createDataFrame(weights)
        postings = pairs.select("query_id", "doc_id").join(held, "doc_id").select(
            "query_id", "doc_id", "dl", F.explode(F.arrays_zip("terms", "tfs")).alias("t")
        )
        matched = postings.select(
            "query_id", "doc_id", "dl", F.col("t.terms").alias("number"), F.col("t.tfs").alias("tf")
        ).join(F.broadcast(listed), ["query_id", "number"])
        score = bm25_weight(
            F.col("weight"), F.col("tf"), F.col("dl"), F.lit(avgdl), self.k1, self.b
        )
        return held.select("doc_id"), matched.select("query_id", "doc_id", score.alias("score"))
