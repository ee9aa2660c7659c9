"""SimHash near-duplicates by exact comparison of tiles.

Fingerprints are made where texts are read. Equal ones are one node from then on, so a group of
copies costs one fingerprint. Nodes fall into cells by the population counts of their four 16-bit
quarters. Two fingerprints at ``radius`` bits differ by at most ``radius`` in the sum of these
counts' differences, so only cells that near are compared; cells are cut into tiles of bounded
size, and a pair of tiles is one row: numpy exclusive-or and bit counts over its whole matrix.
A pair of tiles gives a spanning forest of its links, so never more links than fingerprints.
Components come from rounds of star contractions on the links, written between rounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from .columns import fresh, ids_and_bytes, known_id, map_arrow, named, outer_id

SEED = 42
SHINGLE = 3
RADIUS = 2
# Fingerprints of a tile, on average.
TILE = 1024
PARTS, PART_BITS = 4, 16
# Shingles whose bits are counted at once.
CHUNK = 1 << 15


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of every word shingle, A-Z lower-cased; of all words if they are fewer."""
    words = text.lower().split()  # both know ASCII only
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = list(accumulate(map(len, words), lambda a, n: a + 1 + n))
    starts = [0, *(e + 1 for e in ends[: -size])]
    digest = xxhash.xxh64_intdigest
    return np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1 :])], np.uint64
    )


def fingerprint(text: bytes) -> int:
    """64 bits, as a signed integer; a bit is set if it is set in over half the hashes."""
    hashes = shingle_hashes(text)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        octets = hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint(text.as_py()) for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(found, pa.int64())], names=["id", "fp"]
        )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp)`` per row."""
    return map_arrow(ids_and_bytes(docs, id_col, text_col), _fingerprints, "id bigint, fp bigint")


def spanning_links(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> list[tuple[int, int]]:
    """Links (i, j) of a[i] and b[j] within ``radius`` bits that connect all that are connected.

    ``same``: both are one tile.
    """
    label = np.arange(len(a) if same else len(a) + len(b))
    shift, links = 0 if same else len(a), []
    block = max(1, (1 << 16) // max(1, len(b)))
    for start in range(0, len(a), block):
        near = np.bitwise_count(a[start : start + block, None] ^ b[None, :]) <= radius
        for row in np.flatnonzero(near.any(1)):
            i, js = start + row, np.flatnonzero(near[row])
            own = label[i]
            for other in np.unique(label[js + shift]):
                if other != own:
                    j = js[label[js + shift] == other][0]
                    links.append((int(i), int(j)))
                    label[label == other] = own
    return links


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for a, b, same in zip(*(batch.column(c) for c in ("a", "b", "same"))):
                a, b = (np.asarray(x.values, np.int64).view(np.uint64) for x in (a, b))
                for i, j in spanning_links(a, b, radius, same.as_py()):
                    left.append(int(a[i].view(np.int64)))
                    right.append(int(b[j].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["u", "v"]
            )

    return run


def near_cells(radius: int) -> list[int]:
    """Steps between numbers of cells whose counts differ by ``radius`` at most, one of each pair."""
    width = PART_BITS + 1
    found = []
    for step in product(range(-radius, radius + 1), repeat=PARTS):
        if sum(map(abs, step)) <= radius and step >= (0,) * PARTS:
            found.append(list(step))
    assert width > radius
    return found


def links(nodes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``(u, v)``: links that connect all fingerprints of ``nodes(fp)`` within ``radius``."""
    counts = [
        F.bit_count(F.shiftrightunsigned("fp", PART_BITS * k).bitwiseAND(F.lit(2**PART_BITS - 1)))
        for k in range(PARTS)
    ]
    placed = nodes.select("fp", F.array(*counts).alias("cell"))
    # A row per cell: 17**4 at most, whatever the input.
    crowd = placed.groupBy("cell").agg(F.ceil(F.count("*") / tile).alias("tiles"))
    tiles = materialize(
        placed.join(F.broadcast(crowd), "cell")
        .groupBy("cell", F.pmod(F.xxhash64("fp"), F.col("tiles")).alias("part"))
        .agg(F.collect_list("fp").alias("fps"))
        .withColumn("tile", F.struct("cell", "part")),
        "simhash-tiles",
    )
    names = tiles.select("cell", "part", "tile")
    steps = F.array(*[F.array(*[F.lit(x) for x in s]) for s in near_cells(radius)])
    reach = names.select(F.col("tile").alias("a"), F.explode(steps).alias("step"), "cell").select(
        "a", F.zip_with("cell", "step", lambda x, y: x + y).alias("cell")
    )
    pairs = reach.join(names.select("cell", F.col("tile").alias("b")), "cell").filter(
        (F.col("a.cell") != F.col("b.cell")) | (F.col("a.part") <= F.col("b.part"))
    )
    full = (
        pairs.select("a", "b")
        .join(tiles.select(F.col("tile").alias("a"), F.col("fps").alias("fa")), "a")
        .join(tiles.select(F.col("tile").alias("b"), F.col("fps").alias("fb")), "b")
        .select(F.col("fa").alias("a"), F.col("fb").alias("b"), (F.col("a") == F.col("b")).alias("same"))
    )
    return map_arrow(full, _compare(radius), "u bigint, v bigint")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)``; the root is the component's least node.

    Large-star and small-star steps in turn until nothing changes. Each round is written to the
    shared folder, so a lost executor repeats one round at most.
    """
    bigger = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    edges = materialize(edges.select(*bigger).filter("u <> v").distinct(), "star")

    def mark(table):
        return table.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    known = mark(edges)
    while known[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(floor, "u").select(
            F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        edges = materialize(small.select("e.u", "e.v").filter("u <> v").distinct(), "star")
        found = mark(edges)
        if found == known:
            break
        known = found
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    radius: int = RADIUS,
    tile: int = TILE,
) -> DataFrame:
    """``id_col, fingerprint, component_id`` per row.

    The component is named by the smallest id that can be reached over links of ``radius`` bits or
    fewer. Null and blank texts have fingerprint zero and link like others. Null ids come after
    all others; a component of null ids only has a null name. Rows that repeat an id each get
    their fingerprint. An empty table gives an empty result; other columns are not read.
    """
    rows = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = materialize(rows.groupBy("fp").agg(F.min("id").alias("first")), "nodes")
    stars = components(links(nodes.select("fp"), radius, tile))
    rooted = nodes.join(stars, nodes.fp == stars.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("first").alias("component"))
    classes = materialize(rooted.join(names, "root").select("fp", "component"), "classes")
    return rows.join(classes, "fp").select(
        outer_id("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        outer_id("component").alias("component_id"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """``docs`` without the rows of documents that are not the first of their component.

    Columns stay as they are. Rows with null ids stay only where no row with an id is near.
    """
    found = near_duplicates(docs, id_col, text_col, radius)
    own, component = known_id(F.col(f"`{id_col}`")), known_id(F.col("component_id"))
    gone = fresh(docs, "_gone")
    losers = found.filter(own != component).select(own.alias(gone)).distinct()
    return docs.join(losers, known_id(named(docs, id_col)) == losers[gone], "left_anti")
