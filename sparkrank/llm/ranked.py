"""Ranked lexical search by Block-Max MaxScore over sharded, block-compressed posting lists.

Index. Each task cuts its documents into shards of about ``SHARD_TERMS`` terms. In a shard every term
has a list of postings in blocks of 128, compressed, with the largest impact of each block and of the
list beside them. The index is a table, one row per shard and term, and holds all terms.

Search. Only lists of asked terms are read and dealt out by shard. A task goes through its shards and
keeps the best k of each query; what it has found so far is the threshold for what follows:

* lists are ordered by their bounds; those that can't reach the threshold together are not essential,
  and a shard where no list is essential is passed over for the query,
* documents of essential lists are candidates; block maxima of the other lists reject those that
  can't reach the threshold, before any of these lists' blocks is decompressed,
* for what is left the other lists are read, by falling bounds, with the same test after each.

The tasks' heaps are merged at the end. Scores are integers, so no order of summing changes them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import hinted
from ..operators.sizing import BROADCAST_BYTES, fits, measured_size
from ..operators.topk import top_k
from ..sources.scratch import materialize
from .columns import Batches, ids_and_bytes, map_arrow, named, outer_id, shuffle_parts

# Terms are runs of these; of letters only A-Z are lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_KEPT = [c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)]
_FOLDED = bytes(c + 32 if 65 <= c <= 90 else c for c in _KEPT)
# Postings of a block, documents looked at together, and terms of a shard.
POSTINGS, WINDOW, SHARD_TERMS = 128, 4096, 4_000_000
ROWS = 20_000  # of the index, sent to Spark at once
# Row of a shard that holds its documents; no term is empty.
DOCUMENTS = b""

INDEX = (
    "shard bigint, term binary, df bigint, top bigint, ends array<int>, tops array<bigint>, "
    "widths binary, data binary, docs array<bigint>, norms array<bigint>"
)


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a text in UTF-8, in order."""
    return text.translate(_FOLDED).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * norms)


def norms_of(lengths: list[int], n_docs: int, n_terms: int) -> np.ndarray:
    """What a document's length adds below the fraction; whole numbers of any size on the way."""
    return np.array([10 + 90 * n * n_docs // n_terms for n in lengths], np.int64)


def corpus(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """Documents with a term, and all their terms with repeats."""
    text = F.coalesce(named(docs, text_col).cast("string"), F.lit(""))
    counted = docs.select(F.regexp_count(text, F.lit(TERM)).alias("n"))
    found = counted.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("terms")).first()
    return int(found["docs"]), int(found["terms"] or 0)


class _Vocabulary(dict):
    """Numbers terms as they come."""

    def __missing__(self, term: bytes) -> int:
        self[term] = number = len(self)
        return number


def _widths(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Bytes (1, 2 or 4) that hold every value of a block."""
    most = np.maximum.reduceat(values, starts)
    return np.where(most < 1 << 8, 1, np.where(most < 1 << 16, 2, 4))


def _put(data: np.ndarray, places: np.ndarray, values: np.ndarray, widths: np.ndarray) -> None:
    for k in range(4):
        has = widths > k
        data[places[has] + k] = values[has] >> (8 * k) & 255


def _lists(terms: np.ndarray, docs: np.ndarray, tf: np.ndarray, norms: np.ndarray) -> dict[str, np.ndarray]:
    """Arrays of all lists of a shard, from postings in order of (term, document)."""
    n = len(terms)
    place = np.arange(n)
    new = np.append(True, terms[1:] != terms[:-1])
    heads = np.flatnonzero(new)
    in_list = place - np.repeat(heads, np.diff(np.append(heads, n)))
    starts = np.flatnonzero(in_list % POSTINGS == 0)
    sizes = np.diff(np.append(starts, n))
    # A block's documents count from the last one of the block before, or from -1.
    steps = docs - np.where(new, -1, np.append(0, docs[:-1]))
    impact = impacts(tf, norms[docs])
    wide, deep = _widths(steps, starts), _widths(tf, starts)
    ends = np.cumsum(sizes * (wide + deep))
    at = np.repeat(ends - sizes * (wide + deep), sizes)
    row = place - np.repeat(starts, sizes)
    data = np.zeros(ends[-1] if n else 0, np.uint8)
    w, d = np.repeat(wide, sizes), np.repeat(deep, sizes)
    _put(data, at + row * w, steps, w)
    _put(data, at + np.repeat(sizes, sizes) * w + row * d, tf, d)
    blocks = np.searchsorted(starts, np.append(heads, n))
    return {
        "term": terms[heads],
        "df": np.diff(np.append(heads, n)),
        "top": np.maximum.reduceat(impact, heads),
        "blocks": blocks,
        "ends": docs[starts + sizes - 1],
        "tops": np.maximum.reduceat(impact, starts),
        "widths": (wide | deep << 4).astype(np.uint8),
        "data": data,
        "bytes": np.append(0, ends)[blocks],
    }


def _shard_rows(number: int, ids: list[int], lengths: list[int], found: list[np.ndarray], vocabulary: _Vocabulary, stats: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """The index rows of one shard, in order of terms."""
    names = [f.split()[0] for f in INDEX.split(", ")]
    order = sorted(range(len(ids)), key=ids.__getitem__)  # documents by id, so that ties go by number
    placed = np.empty(len(ids), np.int64)
    placed[order] = np.arange(len(ids))
    norms = norms_of([lengths[i] for i in order], *stats)
    by_term = sorted(vocabulary)
    rank = np.empty(len(vocabulary), np.int64)
    rank[[vocabulary[t] for t in by_term]] = np.arange(len(by_term))
    keys = rank[np.concatenate(found)] * len(ids) + np.repeat(placed, lengths)
    keys, tf = np.unique(keys, return_counts=True)
    x = _lists(keys // len(ids), keys % len(ids), tf, norms)
    blocks, total = x["blocks"].astype(np.int32), len(x["term"])
    none = pa.nulls(1)

    def binary(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
        return pa.Array.from_buffers(
            pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
        ).cast(pa.binary())

    yield pa.RecordBatch.from_arrays(
        [
            pa.array([number]), pa.array([DOCUMENTS], pa.binary()), none.cast(pa.int64()), none.cast(pa.int64()),
            none.cast(pa.list_(pa.int32())), none.cast(pa.list_(pa.int64())), none.cast(pa.binary()), none.cast(pa.binary()),
            pa.array([np.array(ids, np.int64)[order]], pa.list_(pa.int64())), pa.array([norms], pa.list_(pa.int64())),
        ],
        names=names,
    )
    for a in range(0, total, ROWS):
        b = min(a + ROWS, total)
        cut = blocks[a : b + 1]
        inner, span = cut - cut[0], slice(cut[0], cut[-1])
        where = x["bytes"][a : b + 1]
        empty = pa.nulls(b - a, pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(b - a, number)),
                pa.array(by_term[a:b], pa.binary()),
                pa.array(x["df"][a:b].astype(np.int64)),
                pa.array(x["top"][a:b]),
                pa.ListArray.from_arrays(pa.array(inner), pa.array(x["ends"][span].astype(np.int32))),
                pa.ListArray.from_arrays(pa.array(inner), pa.array(x["tops"][span])),
                binary(inner, x["widths"][span]),
                binary(where - where[0], x["data"][where[0] : where[-1]]),
                empty,
                empty,
            ],
            names=names,
        )


def _build(stats: tuple[int, int], shard_terms: int):
    def run(batches: Batches) -> Batches:
        task, made = TaskContext.get().partitionId(), 0
        ids, lengths, found, size, vocabulary = [], [], [], 0, _Vocabulary()
        for batch in batches:
            for i, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                terms = terms_of(text.as_py())
                if not terms:
                    continue
                ids.append(i)
                lengths.append(len(terms))
                found.append(np.fromiter(map(vocabulary.__getitem__, terms), np.int32, len(terms)))
                size += len(terms)
                if size >= shard_terms:
                    yield from _shard_rows(task << 24 | made, ids, lengths, found, vocabulary, stats)
                    ids, lengths, found, size, vocabulary = [], [], [], 0, _Vocabulary()
                    made += 1
        if ids:
            yield from _shard_rows(task << 24 | made, ids, lengths, found, vocabulary, stats)

    return run


class PostingList:
    """One term's postings in one shard; blocks are decompressed when asked for."""

    def __init__(self, top: int, ends: np.ndarray, tops: np.ndarray, widths: bytes, data: bytes, df: int, shard: Shard):
        self.top, self.ends, self.tops, self.data, self.shard = top, ends, tops, data, shard
        widths = np.frombuffer(widths, np.uint8).astype(np.int64)
        self.wide, self.deep = widths & 15, widths >> 4
        self.sizes = np.full(len(ends), POSTINGS)
        self.sizes[-1] = df - POSTINGS * (len(ends) - 1)
        self.at = np.cumsum(self.sizes * (self.wide + self.deep)) - self.sizes * (self.wide + self.deep)
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.windows: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a block."""
        if b not in self.known:
            n, wide, deep, at = int(self.sizes[b]), int(self.wide[b]), int(self.deep[b]), int(self.at[b])
            steps = np.frombuffer(self.data, f"<u{wide}", n, at).astype(np.int64)
            tf = np.frombuffer(self.data, f"<u{deep}", n, at + n * wide).astype(np.int64)
            docs = np.cumsum(steps) + (int(self.ends[b - 1]) if b else -1)
            self.known[b] = docs, impacts(tf, self.shard.norms[docs])
            self.shard.decompressed += 1
        return self.known[b]

    def window(self, low: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts from ``low`` to the end of its window."""
        if low not in self.windows:
            first = int(np.searchsorted(self.ends, low))
            last = min(len(self.ends), int(np.searchsorted(self.ends, low + WINDOW)) + 1)
            parts = [self.block(b) for b in range(first, last)]
            docs, impact = (np.concatenate(x) if parts else np.empty(0, np.int64) for x in (zip(*parts) if parts else [(), ()]))
            inside = slice(*np.searchsorted(docs, [low, low + WINDOW]))
            self.windows[low] = docs[inside], impact[inside]
        return self.windows[low]

    def bounds(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block that may hold each document, and its largest impact (0 beyond the last)."""
        block = np.searchsorted(self.ends, docs)
        beyond = block == len(self.ends)
        return block, np.where(beyond, 0, self.tops[np.where(beyond, 0, block)])

    def exact(self, docs: np.ndarray, block: np.ndarray) -> np.ndarray:
        """The impacts of documents (in ascending order), of which only the blocks are read."""
        out = np.zeros(len(docs), np.int64)
        for b in np.unique(block):
            if b < len(self.ends):
                asked = np.flatnonzero(block == b)
                held, impact = self.block(int(b))
                place = np.minimum(np.searchsorted(held, docs[asked]), len(held) - 1)
                out[asked] = np.where(held[place] == docs[asked], impact[place], 0)
        return out


class Shard:
    """Documents and lists of one shard, and how many blocks were decompressed."""

    def __init__(self, docs: np.ndarray, norms: np.ndarray):
        self.docs, self.norms = docs, norms
        self.lists: dict[bytes, PostingList] = {}
        self.decompressed = 0


class Best:
    """The best k documents of a query so far, equal scores by ascending id."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def threshold(self) -> int:
        """Documents of a lower score are not among the best; scores of 0 are no results."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


def search_shard(shard: Shard, weights: dict[bytes, int], best: Best) -> None:
    """Add to ``best`` what a shard has for the query whose terms have these weights."""
    lists = [(w * shard.lists[t].top, w, shard.lists[t]) for t, w in weights.items() if w and t in shard.lists]
    lists.sort(key=lambda x: x[0])
    reach = np.cumsum([bound for bound, _, _ in lists])
    if not lists or reach[-1] < best.threshold:
        return
    for low in range(0, len(shard.docs), WINDOW):
        # Documents of the first lists only can't reach the threshold.
        rest = int(np.searchsorted(reach, best.threshold))
        if rest == len(lists):
            return
        scores = np.zeros(WINDOW, np.int64)
        for _, w, postings in lists[rest:]:
            docs, impact = postings.window(low)
            scores[docs - low] += w * impact
        docs = np.flatnonzero(scores)
        scores = scores[docs]
        docs += low
        others = lists[:rest][::-1]
        if others:
            near = scores + reach[rest - 1] >= best.threshold
            docs, scores = docs[near], scores[near]
        if others and len(docs):
            found = [postings.bounds(docs) for _, _, postings in others]
            blocks = np.array([block for block, _ in found])
            bounds = np.array([w * most for (_, w, _), (_, most) in zip(others, found)])
            # What the lists not yet read may still add.
            open_ = bounds.sum(axis=0)
            for i, (_, w, postings) in enumerate(others):
                near = scores + open_ >= best.threshold
                docs, scores, open_, blocks, bounds = docs[near], scores[near], open_[near], blocks[:, near], bounds[:, near]
                if not len(docs):
                    break
                open_ = open_ - bounds[i]
                scores = scores + w * postings.exact(docs, blocks[i])
        near = scores >= best.threshold
        if near.any():
            best.add(scores[near], shard.docs[docs[near]])


def _shards(batches: Batches) -> Iterator[Shard]:
    """Shards of rows in order of (shard, term)."""
    shard, number = None, None
    for batch in batches:
        get = {c: batch.column(c) for c in batch.schema.names}
        numbers = get["shard"].to_pylist()
        for i, term in enumerate(get["term"].to_pylist()):
            if numbers[i] != number:
                if shard:
                    yield shard
                number, shard = numbers[i], Shard(*(get[c][i].values.to_numpy() for c in ("docs", "norms")))
                continue
            ends, tops = (get[c][i].values.to_numpy() for c in ("ends", "tops"))
            rest = (get[c][i].as_py() for c in ("widths", "data", "df"))
            shard.lists[term] = PostingList(get["top"][i].as_py(), ends, tops, *rest, shard)
    if shard:
        yield shard


def _search(shared, k: int):
    def run(batches: Batches) -> Batches:
        queries: list[dict[bytes, int]] = shared.value
        best = [Best(k) for _ in queries]
        for shard in _shards(batches):
            for weights, own in zip(queries, best):
                search_shard(shard, weights, own)
        number = np.repeat(np.arange(len(best)), [len(b.ids) for b in best])
        columns = [number.astype(np.int32), *(np.concatenate([getattr(b, x) for b in best] or [[]]).astype(np.int64) for x in ("ids", "scores"))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["number", "doc_id", "score"])

    return run


@dataclass(frozen=True)
class RankedIndex:
    """Posting lists of all terms, as a table of :data:`INDEX`, and the corpus numbers behind them."""

    table: DataFrame
    n_docs: int
    n_terms: int

    @classmethod
    def build(cls, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_terms: int = SHARD_TERMS) -> RankedIndex:
        """Index all documents. Texts are read where they lie; no posting is shuffled.

        Each row is a document; a null text has no terms, and a document without terms is in no list.
        """
        stats = corpus(docs, text_col)
        table = map_arrow(ids_and_bytes(docs, id_col, text_col), _build(stats, shard_terms), INDEX)
        return cls(materialize(table, "ranked-index"), *stats)

    def save(self, path: str) -> RankedIndex:
        self.table.write.parquet(f"{path}/lists")
        spark = self.table.sparkSession
        spark.createDataFrame([(self.n_docs, self.n_terms)], "n_docs bigint, n_terms bigint").write.parquet(f"{path}/corpus")
        return self.load(spark, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> RankedIndex:
        return cls(spark.read.parquet(f"{path}/lists"), *spark.read.parquet(f"{path}/corpus").first())

    def search(self, queries: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
        """``(id_col, rank, doc_id, score)``: the ``k`` best documents of each query, scores above 0.

        A query's terms count once each; rows of one id, null included, are one query of all their
        terms. Equal scores are ranked by ascending ``doc_id``, a null one last. Queries without a
        known term have no rows. Queries are sent to all tasks in portions of a checked size.
        """
        spark = self.table.sparkSession
        asked = queries.select(
            named(queries, id_col).alias("query"),
            F.explode(F.regexp_extract_all(F.coalesce(named(queries, text_col).cast("string"), F.lit("")), F.lit(TERM), F.lit(0))).alias("term"),
        )
        upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
        asked = asked.select("query", F.translate("term", upper, lower).cast("binary").alias("term")).distinct()
        asked = materialize(asked, "ranked-queries")
        wanted = asked.select("term").distinct().unionByName(spark.createDataFrame([(DOCUMENTS,)], "term binary"))
        lists = materialize(self.table.join(hinted(wanted, fits(wanted)), "term", "left_semi"), "ranked-lists")
        df = lists.filter(F.col("df").isNotNull()).groupBy("term").agg(F.sum("df").alias("df"))
        known = materialize(asked.join(df, "term").groupBy("query").agg(F.collect_list(F.struct("term", "df")).alias("terms")), "ranked-known")
        size = measured_size(asked)[1]
        portions = max(1, math.ceil(2 * size / BROADCAST_BYTES))
        dealt = lists.repartition(shuffle_parts(lists), "shard").sortWithinPartitions("shard", "term")
        out = None
        for portion in range(portions):
            own = known.filter(F.pmod(F.xxhash64("query"), F.lit(portions)) == portion).toArrow()
            weights = [{t["term"]: weight(self.n_docs, t["df"]) for t in terms} for terms in own.column("terms").to_pylist()]
            shared = spark.sparkContext.broadcast(weights)
            found = map_arrow(dealt, _search(shared, k), "number int, doc_id bigint, score bigint")
            numbers = pa.table({"number": pa.array(range(own.num_rows), pa.int32()), id_col: own.column("query")})
            part = found.join(F.broadcast(spark.createDataFrame(numbers)), "number").drop("number")
            out = part if out is None else out.unionByName(part)
        ranked = top_k(out, [id_col], [F.desc("score"), F.asc("doc_id")], k)
        return ranked.select(id_col, "rank", outer_id("doc_id").alias("doc_id"), "score")
