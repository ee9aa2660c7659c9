"""Writers of runs, vectors and metrics."""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import format_run_line
from ..operators.joins import hinted
from ..operators.sizing import fits
from .scratch import materialize

# Lines of a run file that one task sorts and writes.
FILE_LINES = 20_000_000


def run_name(qrels: Column, label: Column, depths: Column, cutoff: Column) -> Column:
    """Fixed format of a run's name: judgment file, stages, depths and cutoff.

    Blanks are removed and slashes become dashes. ``depths`` is an array of integers.
    """
    base = F.element_at(F.split(qrels, "/"), -1)
    listed = F.concat(F.lit("["), F.concat_ws(",", depths.cast("array<string>")), F.lit("]"))
    name = F.concat_ws("-", base, label, listed, cutoff.cast("string"))
    return F.replace(F.replace(F.concat(name, F.lit(".txt")), F.lit(" "), F.lit("")),
                     F.lit("/"), F.lit("-"))


def at_cutoffs(ranked: DataFrame, cutoffs: list[int]) -> DataFrame:
    """One retrieval, cut at several depths: a row per cutoff its rank is within."""
    wanted = F.array(*[F.lit(int(c)) for c in cutoffs])
    return ranked.withColumn(
        "cutoff", F.explode(F.filter(wanted, lambda c: c >= F.col("rank")))
    )


def run_lines(run: DataFrame) -> DataFrame:
    """``(run_name, value)``: the text lines of runs."""
    line = format_run_line(
        F.col("query_id"), F.col("doc_id"), F.col("rank"), F.col("score"), F.col("run_id")
    )
    return run.select("run_name", "query_id", "rank", line.alias("value"))


def write_runs(
    run: DataFrame, path: str, mode: str = "error", file_lines: int = FILE_LINES
) -> None:
    """Write ``run(run_name, query_id, doc_id, rank, score, run_id)`` as run files.

    One file per run, named after it, ordered by query and rank. A run of more than ``file_lines``
    lines is a folder of that name, whose parts in order of their names make up the file; no task
    then sorts it whole. Files appear under their names when all are written. ``mode`` is Spark's;
    "append" adds runs and fails on a name that is there.
    """
    spark = run.sparkSession
    conf, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path
    root = place(path)
    store = root.getFileSystem(conf)
    if mode not in ("error", "errorifexists", "overwrite", "append", "ignore"):
        raise ValueError(f"unknown mode {mode}")
    if store.exists(root):
        if mode == "ignore":
            return
        if mode in ("error", "errorifexists"):
            raise ValueError(f"{path} exists")
    # Names with a leading underscore are not read as data.
    staged = f"{path}/_writing-{uuid.uuid4().hex}"
    _place_lines(run, staged, file_lines)
    runs = [f.getPath() for f in store.listStatus(place(staged)) if f.isDirectory()]
    moves = []
    for folder in runs:
        name = unquote(folder.getName().split("=", 1)[1])
        if ":" in name or "/" in name or name[:1] in "._":
            raise ValueError(f"a run named {name} cannot be a file")
        parts = sorted(f.getPath().getName() for f in store.listStatus(folder))
        many = len(parts) > 1
        moves += [
            (place(folder, part), f"{name}/part-{i:05d}" if many else name)
            for i, part in enumerate(parts)
        ]
    if mode == "overwrite":
        for old in store.listStatus(root):
            if old.getPath().getName() != place(staged).getName():
                store.delete(old.getPath(), True)
    for source, name in moves:
        target = place(root, place(None, None, name))
        if store.exists(target):
            raise ValueError(f"{target} exists")
        store.mkdirs(target.getParent())
        if not store.rename(source, target):
            raise OSError(f"{source} could not be renamed to {target}")
    store.delete(place(staged), True)


def _place_lines(run: DataFrame, path: str, file_lines: int) -> None:
    """Lines in a folder per run: in one file, or cut at places in the order of a long run."""
    order = ["run_name", "query_id", "rank"]
    lines = materialize(run_lines(run), "run-lines")
    # One row per run.
    counts = lines.groupBy("run_name").count()
    long = materialize(counts.filter(F.col("count") > file_lines), "long-runs")
    total = long.agg(F.sum("count")).first()[0] or 0
    listed = hinted(long.select("run_name"), fits(long))
    placed = lines.join(listed, "run_name", "left_anti").repartition("run_name")
    _write_placed(placed.sortWithinPartitions(*order), path, "overwrite")
    if total:
        parts = -(-total // file_lines) + 1
        ranged = lines.join(listed, "run_name", "left_semi").repartitionByRange(parts, *order)
        _write_placed(ranged.sortWithinPartitions(*order), path, "append")


def _write_placed(lines: DataFrame, path: str, mode: str) -> None:
    # Sorts start with the partition column, which is the order the partitioned writer asks for.
    lines.select("run_name", "value").write.mode(mode).partitionBy("run_name").text(path)


def write_vectors(vectors: DataFrame, path: str, mode: str = "error") -> None:
    vectors.write.mode(mode).parquet(path)


def write_metrics(metrics: DataFrame, path: str, mode: str = "error") -> None:
    metrics.write.mode(mode).parquet(path)
