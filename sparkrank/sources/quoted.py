"""Tab-separated files with quoted fields, read in pieces.

A quoted field may hold line ends, so where a record starts depends on all quotes before it. A line
is a function of one bit: whether it starts inside quotes decides whether it ends there. A first pass
gives one such function per split of a file; running through these few rows gives the state each split
starts in. A second pass then cuts its lines into records. Only records that cross a split are
gathered from their pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.joins import hinted
from ..operators.sizing import fits
from .scratch import materialize

OPTIONS = {"sep": "\t", "quote": '"', "escape": '"', "nullValue": "\u0000"}
SPLIT = ["_path", "_start"]
# Rows handed on at once.
BATCH = 4096


def ends_inside(line: str, inside: bool) -> bool:
    """Whether ``line`` ends inside quotes. A quote opens at the start of a field only; what follows
    a closed field up to the tab belongs to it."""
    at = 0
    while True:
        if inside:
            quote = line.find('"', at)
            if quote < 0:
                return True
            if line.startswith('"', quote + 1):
                at = quote + 2
                continue
            inside, at = False, quote + 1
        elif line.startswith('"', at):
            inside, at = True, at + 1
            continue
        tab = line.find("\t", at)
        if tab < 0:
            return False
        at = tab + 1


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split, the states a start outside and a start inside lead to."""
    found: list[list] = []
    for batch in batches:
        quoted = pc.match_substring(batch.column("value"), '"')
        rows = batch.append_column("quoted", quoted)
        for path, start in {(r["_path"], r["_start"]): 0 for r in rows.select(SPLIT).to_pylist()}:
            if not found or found[-1][:2] != [path, start]:
                found.append([path, start, False, True])
        # Splits follow one another; only lines with a quote change a state.
        at = {(f[0], f[1]): f for f in found}
        for r in rows.filter(quoted).to_pylist():
            split = at[r["_path"], r["_start"]]
            split[2:] = [ends_inside(r["value"], state) for state in split[2:]]
    columns = list(zip(*found)) if found else [[], [], [], []]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(columns[0], pa.string()),
            pa.array(columns[1], pa.int64()),
            pa.array(columns[2], pa.bool_()),
            pa.array(columns[3], pa.bool_()),
        ],
        names=["_path", "_start", "_out", "_in"],
    )


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of a split. ``part`` 0: whole; 1: begun here, not ended; 2: begun before."""
    done: list[tuple] = []
    split, inside, lines, first, part = None, False, [], 0, 0

    def flushed():
        types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
        columns = list(zip(*done)) if done else [[]] * 5
        arrays = [pa.array(c, t) for c, t in zip(columns, types)]
        done.clear()
        return pa.RecordBatch.from_arrays(arrays, names=[*SPLIT, "_line", "part", "record"])

    def close(ended):
        if lines:
            # A piece that neither begins nor ends here is one of those begun before.
            done.append((*split, first, part or (0 if ended else 1), "\n".join(lines)))
            lines.clear()

    for batch in batches:
        columns = [batch.column(c) for c in (*SPLIT, "_line", "_inside", "value")]
        for path, start, line, begins_inside, value in zip(*(c.to_pylist() for c in columns)):
            if split != (path, start):
                close(False)
                split, inside, part = (path, start), begins_inside, 2 if begins_inside else 0
            if not lines:
                first = line
            lines.append(value)
            if '"' in value:
                inside = ends_inside(value, inside)
            if not inside:
                close(True)
                part = 0
            if len(done) >= BATCH:
                yield flushed()
    close(False)
    yield flushed()


def read_quoted(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Columns of ``schema`` with ``_path, _start, _line``, the place of a record's first line.

    Doubled quotes stand for one. Records end at a line feed outside quotes, a carriage return before
    it is dropped, and empty lines are no records. A quote that is never closed takes the rest of its
    file. Files are split between tasks unless they are compressed.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_start"),
    )
    effect = "_path string, _start bigint, _out boolean, _in boolean"
    effects = materialize(lines.mapInArrow(_splits, effect), "splits")
    states = materialize(_starts(effects), "split-states")
    placed = lines.withColumn("_line", F.monotonically_increasing_id())
    few = fits(states)
    ready = placed.join(hinted(states, few), SPLIT)
    if not few:
        ready = ready.repartition(*SPLIT).sortWithinPartitions(*SPLIT, "_line")
    shape = "_path string, _start bigint, _line bigint, part int, record string"
    records = ready.mapInArrow(_records, shape)
    whole = records.filter("part = 0").drop("part")
    # At most two pieces a split.
    pieces = materialize(records.filter("part > 0"), "pieces")
    begun = F.sum((F.col("part") == 1).cast("int"))
    in_order = W.partitionBy("_path").orderBy("_start", "_line")
    numbered = pieces.withColumn("_record", begun.over(in_order))
    piece = F.struct("_start", "_line", "record")
    crossing = numbered.groupBy("_path", "_record").agg(F.sort_array(F.collect_list(piece)).alias("p"))
    joined = crossing.select(
        "_path",
        F.col("p")[0]["_start"].alias("_start"),
        F.col("p")[0]["_line"].alias("_line"),
        F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record"),
    )
    every = whole.unionByName(joined).withColumn("record", F.regexp_replace("record", r"\r\z", ""))
    parsed = F.from_csv("record", schema, OPTIONS).alias("row")
    return every.filter("record <> ''").select(parsed, *SPLIT, "_line").select("row.*", *SPLIT, "_line")


def _starts(effects: DataFrame) -> DataFrame:
    """``(_path, _start, _inside)``: the state that each split of a file starts in.

    A split whose end does not depend on its start settles what follows; others keep the state or
    turn it around.
    """
    before = W.partitionBy("_path").orderBy("_start").rowsBetween(W.unboundedPreceding, -1)
    so_far = W.partitionBy("_path").orderBy("_start").rowsBetween(W.unboundedPreceding, 0)
    turns = F.sum(F.when(F.col("_out") & ~F.col("_in"), 1).otherwise(0)).over(so_far)
    settled = F.when(
        F.col("_out") == F.col("_in"), F.struct(F.col("_out").cast("int").alias("s"), "_turns")
    )
    marked = effects.withColumn("_turns", turns).withColumn("_settled", settled)
    last = F.last("_settled", ignorenulls=True).over(before)
    turned = F.coalesce(F.last("_turns").over(before), F.lit(0))
    known = marked.select(*SPLIT, last.alias("last"), turned.alias("turned"))
    state = F.coalesce(
        F.col("last.s") + F.col("turned") - F.col("last._turns"), F.col("turned")
    )
    return known.select(*SPLIT, (F.pmod(state, F.lit(2)) == 1).alias("_inside"))
