"""The operators of this subpackage as queries on the shared tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import round_trip
from .exact_dedup import exact_dedup
from .fingerprints import edited_fingerprints
from .html_extract import extract
from .langid import identify, learn_languages
from .line_dedup import line_dedup
from .packing import pack_documents
from .quality_rules import quality_rules
from .queries_sql import SQL  # noqa: F401
from .ranked import RankedIndex
from .simhash import near_duplicates
from .site_quality import site_quality, url_sites
from .spelling import spelling_variants
from .suffix_dedup import suffix_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op7_exact_dedup(spark, sf_dir):
    return exact_dedup(documents(spark, sf_dir))


@query
def op10_quality_rules(spark, sf_dir):
    judged = quality_rules(documents(spark, sf_dir))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


@query
def op2_bpe_round_trip(spark, sf_dir):
    return round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op6_line_dedup(spark, sf_dir):
    lines = line_dedup(documents(spark, sf_dir))
    return lines.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op8_simhash(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir))


@query
def op3_best_fit_packing(spark, sf_dir):
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query
def op1_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return identify(docs, learn_languages(docs, public_tokenizers.path("piece_bpe_32k.model")))


@query
def op5_suffix_dedup(spark, sf_dir):
    removed = suffix_dedup(documents(spark, sf_dir))
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op4_html_extraction(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages).select("page_id", "url", "text", "n_chars")


@query
def op9_quality_classifier(spark, sf_dir):
    """A document's site is that of the page that names it, else its source and language."""
    sites = url_sites(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return site_quality(documents(spark, sf_dir), labels, "source", "lang", sites=sites)


@query
def op11_fingerprints(spark, sf_dir):
    return edited_fingerprints(documents(spark, sf_dir))


@query
def op12_ranked_search(spark, sf_dir):
    index = RankedIndex.build(documents(spark, sf_dir))
    return index.search(spark.read.parquet(f"{sf_dir}/benchmark.parquet"), 10)


@query
def op13_spelling_variants(spark, sf_dir):
    return spelling_variants(documents(spark, sf_dir), typo_every=97)
