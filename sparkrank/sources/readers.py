"""Readers of collections, id lists, queries, vectors, judgments and run files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import WHITESPACE
from ..operators.corpus import keep_last, keep_last_sparse, restrict
from ..operators.sizing import union_all
from .quoted import read_quoted


def _tsv(spark: SparkSession, path: str, schema: str, quoted: bool, file_order: int) -> DataFrame:
    """Headerless tab-separated text with a fixed schema and the position of its rows.

    By default every line is one row and quotes are text. ``quoted`` reads quoted fields, which
    may hold tabs, doubled quotes and line ends.
    """
    if quoted:
        return read_quoted(spark, path, schema).withColumn("_file", F.lit(file_order))
    reader = spark.read.schema(schema).option("sep", "\t").option("nullValue", "\u0000")
    return _positioned(reader.option("quote", "").option("escape", "").csv(path), file_order)


# Order of rows over files, splits of a file, and lines of a split.
ORDER = ["_file", "_path", "_start", "_line"]


def _positioned(df: DataFrame, file_order: int) -> DataFrame:
    """A freshly read table with the position of its rows, for last-one-wins rules.

    A file stands for its place in the order of paths, since rows that carry their path are wide.
    """
    placed = (
        df.withColumn("_file", F.lit(file_order))
        .withColumn("_name", F.input_file_name())
        .withColumn("_start", F.col("_metadata.file_block_start"))
        .withColumn("_line", F.monotonically_increasing_id())
    )
    places = [(name, place) for place, name in enumerate(sorted(df.inputFiles()))]
    known = df.sparkSession.createDataFrame(places, "_name string, _path int")
    unknown = F.raise_error(F.concat(F.lit("not among the files listed: "), "_name")).cast("int")
    found = placed.join(F.broadcast(known), "_name", "left")
    return found.withColumn("_path", F.coalesce("_path", unknown)).drop("_name")


def read_collection(
    spark: SparkSession, path: str, subset: str | DataFrame | None = None, quoted: bool = False
) -> DataFrame:
    """``(doc_id STRING, text STRING)``; the last row of an id wins, missing text is ''.

    With ``subset``, a path or a table of ids, only listed ids are kept, before anything else.
    """
    rows = _tsv(spark, path, "doc_id string, text string", quoted, 0)
    if isinstance(subset, str):
        subset = read_subset(spark, subset)
    rows = restrict(rows, subset)
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")))
    return keep_last_sparse(rows, ["doc_id"], ORDER)


def read_subset(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id STRING)``, one id per line."""
    return spark.read.schema("doc_id string").option("quote", "").csv(path)


def read_queries(spark: SparkSession, paths: Sequence[str], quoted: bool = False) -> DataFrame:
    """``(query_id STRING, text STRING)`` of several files; later files and rows win."""
    files = [
        _tsv(spark, path, "query_id string, text string", quoted, i)
        for i, path in enumerate(paths)
    ]
    rows = union_all(files).withColumn("text", F.coalesce("text", F.lit("")))
    return keep_last(rows, ["query_id"], ORDER)


def read_vectors(spark: SparkSession, paths: str | Sequence[str], id_column: str) -> DataFrame:
    """``(id, embedding ARRAY<FLOAT>)`` of Parquet tables; later files and rows win."""
    paths = [paths] if isinstance(paths, str) else paths
    files = [
        _positioned(spark.read.parquet(path), i).select(
            id_column, F.col("embedding").cast("array<float>").alias("embedding"), *ORDER
        )
        for i, path in enumerate(paths)
    ]
    return keep_last_sparse(union_all(files), [id_column], ORDER)


def _fields(spark: SparkSession, path: str) -> DataFrame:
    lines = _positioned(spark.read.text(path), 0)
    parts = F.array_remove(F.split("value", WHITESPACE), "")
    return lines.select(parts.alias("parts"), *ORDER)


def read_qrels(spark: SparkSession, path: str) -> DataFrame:
    """``(query_id STRING, doc_id STRING, rel INT)``.

    Fields 1, 3 and 4 of whitespace-separated lines. Shorter lines are skipped, the last line
    of a pair wins, and a judgment that is no integer is an error.
    """
    rows = _fields(spark, path).filter(F.size("parts") >= 4)
    judged = rows.select(
        F.get("parts", F.lit(0)).alias("query_id"),
        F.get("parts", F.lit(2)).alias("doc_id"),
        F.get("parts", F.lit(3)).cast("int").alias("rel"),
        *ORDER,
    )
    return keep_last(judged, ["query_id", "doc_id"], ORDER)


def read_query_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct first fields of the non-blank lines of a judgment file."""
    rows = _fields(spark, path).filter(F.size("parts") >= 1)
    return rows.select(F.get("parts", F.lit(0)).alias("query_id")).distinct()


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """``(run_name, query_id, doc_id, rank, score, run_id)`` of a folder of run files.

    The run name is the file's, or for parts of a run that of their folder.
    """
    # Names are taken from the path, so folders are not read as typed partition columns.
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    located = lines.select("value", F.col("_metadata.file_path").alias("_path"))
    # Run names may hold characters that paths escape.
    place = F.url_decode(F.replace("_path", F.lit("+"), F.lit("%2B")))
    folder = F.regexp_extract(place, "run_name=([^/]*)", 1)
    steps = F.split(place, "/")
    file = F.element_at(steps, -1)
    name = F.when(file.rlike(r"^part-\d{5}$"), F.element_at(steps, -2)).otherwise(file)
    parts = F.split("value", "\t")
    return located.filter(F.size(parts) >= 6).select(
        F.when(folder == "", name).otherwise(F.url_decode(folder)).alias("run_name"),
        F.get(parts, F.lit(0)).alias("query_id"),
        F.get(parts, F.lit(2)).alias("doc_id"),
        F.get(parts, F.lit(3)).cast("int").alias("rank"),
        F.get(parts, F.lit(4)).cast("double").alias("score"),
        F.get(parts, F.lit(5)).alias("run_id"),
    )
