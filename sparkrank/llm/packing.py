"""Best-fit packing of token pieces into sequences, after a dominance reduction.

Pieces of one length are interchangeable, so the instance is how many pieces have each length: a
histogram of ``capacity`` numbers at most, whatever the number of documents. The plan is made on it:

1. Reduction (Martello and Toth): for the longest piece left, find a small set that fits with it
   such that any other feasible set around it could be exchanged for that one, part by part. Such
   a set is fixed for good, as many times as its pieces allow.
2. What remains goes by best fit in order of decreasing length.

The plan is a list of patterns with multiplicities. Pieces then get their number among the pieces of
their length, by windows over (length, bucket), and the number says where in the plan they go.
"""

from __future__ import annotations

import base64
import bisect
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from .bpe import PATTERN
from .columns import ids_and_bytes, map_arrow, outer_id, shuffle_parts

CAPACITY = 1024
END_ID = 2
# Fixed value: the special token of the byte-level vocabulary.
SPECIAL = {"<|endoftext|>": 50256}
# Blanks from which on a run is cut off by itself: the library's pattern gives up at about a million.
BLANK_RUN = 1 << 16
_blank_run = regex.compile(rf"(?<!\s)\s{{{BLANK_RUN},}}")

# A pattern: ((length, pieces of it), ...), and how many sequences follow it.
Pattern = tuple[tuple[tuple[int, int], ...], int]


class _Left:
    """Pieces left, by length."""

    def __init__(self, histogram: dict[int, int]):
        self.count = {s: n for s, n in histogram.items() if n > 0}
        self.sizes = sorted(self.count)

    def take(self, pieces: Counter, times: int) -> None:
        for size, n in pieces.items():
            self.count[size] -= n * times
            if not self.count[size]:
                del self.count[size]
                self.sizes.remove(size)

    def largest(self, most: int, used: Counter) -> int | None:
        """The longest piece up to ``most`` beside those in ``used``."""
        at = bisect.bisect_right(self.sizes, most) - 1
        while at >= 0 and self.count[self.sizes[at]] <= used[self.sizes[at]]:
            at -= 1
        return self.sizes[at] if at >= 0 else None

    def smallest(self, n: int, used: Counter, above: int = 0) -> list[int]:
        """The ``n`` shortest pieces longer than ``above`` beside those in ``used``."""
        out: list[int] = []
        for size in self.sizes[bisect.bisect_right(self.sizes, above) :]:
            out += [size] * min(n - len(out), self.count[size] - used[size])
            if len(out) == n:
                break
        return out


def _dominating(left: _Left, size: int, capacity: int) -> Counter | None:
    """A set with a piece of this length that every other feasible set can be exchanged for."""
    own, rest = Counter([size]), capacity - size
    first = left.largest(rest, own)
    if first is None:
        return own  # nothing fits beside it
    if first == rest:
        return own + Counter([first])  # whatever fits beside it fits into this one piece
    shortest = left.smallest(3, own)
    if len(shortest) < 2 or shortest[0] + shortest[1] > rest:
        return own + Counter([first])  # only one piece fits beside it, and this is the longest
    if len(shortest) < 3 or sum(shortest) > rest:
        # Two pieces fit at most. With (first, second), a pair (p, q) is dominated if q <= second;
        # a pair of two longer than second must not exist.
        pair = own + Counter([first])
        second = left.largest(rest - first, pair)
        if second is not None:
            longer = left.smallest(2, own, above=second)
            if len(longer) < 2 or sum(longer) > rest:
                return pair + Counter([second])
    return None


def reduce_instance(histogram: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Fixed patterns, and the histogram of what they leave."""
    left, fixed, changed = _Left(histogram), [], True
    while changed:
        changed = False
        for size in sorted(left.count, reverse=True):
            while left.count.get(size):
                found = _dominating(left, size, capacity)
                if found is None:
                    break
                times = min(left.count[s] // n for s, n in found.items())
                left.take(found, times)
                fixed.append((tuple(sorted(found.items(), reverse=True)), times))
                changed = True
    return fixed, dict(left.count)


def best_fit(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Best fit in order of decreasing length, equal sequences at once."""
    open_: list[list[list]] = [[] for _ in range(capacity + 1)]  # by room left: [pattern, sequences]
    open_[capacity] = [[(), sum(histogram.values())]]
    for size in sorted(histogram, reverse=True):
        n, room = histogram[size], size
        while n:
            while not open_[room]:
                room += 1
            each = min(room // size, n)
            group = open_[room][-1]
            times = min(group[1], n // each)
            group[1] -= times
            if not group[1]:
                open_[room].pop()
            after = room - each * size
            open_[after].append([(*group[0], (size, each)), times])
            n -= each * times
            room = size
    return [(p, times) for groups in open_ for p, times in groups if p]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns for all pieces of the histogram."""
    fixed, rest = reduce_instance(histogram, capacity)
    return fixed + best_fit(rest, capacity)


class Places:
    """Where the n-th piece of a length goes."""

    def __init__(self, patterns: list[Pattern]):
        rows: dict[int, list[tuple[int, int, int, int]]] = {}
        used: Counter = Counter()
        sequence = 0
        for pattern, times in patterns:
            offset = 0
            for size, each in pattern:
                rows.setdefault(size, []).append((used[size], each, sequence, offset))
                used[size] += each * times
                offset += size * each
            sequence += times
        self.sequences = sequence
        self.rows = {size: np.array(r, np.int64).T for size, r in rows.items()}

    def __call__(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequences, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        for size in np.unique(lengths):
            at = np.flatnonzero(lengths == size)
            start, each, base, offset = self.rows[int(size)]
            row = np.searchsorted(start, numbers[at], side="right") - 1
            turn = numbers[at] - start[row]
            sequences[at] = base[row] + turn // each[row]
            offsets[at] = offset[row] + turn % each[row] * size
        return sequences, offsets


def _place(patterns: list[Pattern]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places(patterns)
        for batch in batches:
            sequences, offsets = places(*(batch.column(c).to_numpy() for c in ("length", "number")))
            kept = [n for n in batch.schema.names if n != "number"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(sequences), pa.array(offsets)],
                names=[*kept, "sequence_id", "offset"],
            )

    return run


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``length`` is from 1 to ``capacity``.

    ``pieces`` is read twice and should be a written table. Equal rows are told apart only by the
    places they get. No row, no sequence.
    """
    buckets = shuffle_parts(pieces)
    # A length may be that of most pieces, so its pieces are numbered in buckets.
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64(*pieces.columns), F.lit(buckets)))
    counts = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    counts = materialize(counts, "piece-counts")
    histogram = {
        int(r["length"]): int(r["n"]) for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }  # capacity rows at most
    assert all(0 < s <= capacity for s in histogram), "a length is out of range"
    before = counts.select(
        "length",
        "bucket",
        F.coalesce(
            F.sum("n").over(W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("before"),
    )
    own = F.row_number().over(W.partitionBy("length", "bucket").orderBy(*pieces.columns)) - 1
    numbered = (
        dealt.withColumn("own", own)
        .join(before, ["length", "bucket"])
        .select(*pieces.columns, (F.col("own") + F.col("before")).alias("number"))
    )
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return map_arrow(
        numbered, _place(plan(histogram, capacity)), f"{schema}, sequence_id bigint, offset bigint"
    )


@cache
def _tokenizer(path: str):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _ordinary(encoding, text: str) -> list[int]:
    """Ids of a text without special tokens; long runs of blanks are cut where the pattern cuts them."""
    out, at = [], 0
    for run in _blank_run.finditer(text) if len(text) >= BLANK_RUN else ():
        # The pattern takes a run as one match, without its last blank if something follows.
        end = run.end() - (run.end() < len(text))
        out += encoding.encode_ordinary(text[at : run.start()])
        out += encoding._encode_single_piece(text[run.start() : end])
        at = end
    return out + encoding.encode_ordinary(text[at:])


def token_ids(text: str, path: str) -> list[int]:
    """Ids of a text; written-out special tokens are taken as such."""
    encoding, out = _tokenizer(path), []
    for special, number in SPECIAL.items():
        first, *rest = text.split(special)
        out += _ordinary(encoding, first)
        for part in rest:
            out.append(number)
            out += _ordinary(encoding, part)
    return out


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: full ones but for the first."""
    first = n % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def _pieces(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                ids = np.array([*token_ids(text.as_py().decode("utf-8", "replace"), path), end_id], "<u4")
                for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                    rows.append((i, piece, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def pack_documents(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A row per piece: ``id_col, piece, start, length, ids_crc32, sequence_id, offset``.

    A document is its ids and ``end_id``; one longer than ``capacity`` is cut into full pieces but
    for the first. ``path`` is a rank file of the vocabulary. A null text is an empty one and
    has the end id only. Null ids stay null; rows that repeat an id are packed each. An empty
    table gives no pieces. Columns beside id and text are not read.
    """
    schema = "id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    rows = ids_and_bytes(docs, id_col, text_col)
    pieces = materialize(map_arrow(rows, _pieces(path, capacity, end_id), schema), "pieces")
    packed = pack_pieces(pieces, capacity)
    return packed.select(
        outer_id("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
