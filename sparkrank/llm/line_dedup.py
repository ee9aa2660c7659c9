"""Repeated lines by two Bloom filters and exact confirmation.

1. Each task hashes the keys of its lines and sends the hashes (eight bytes each, packed in
   arrays, a hash at most twice per task) to the segment that owns them.
2. A segment holds two Bloom filters: hashes seen once, and hashes seen again. Only the second
   leaves it. All of these together have a fixed bound (``filter_bytes``), so they are broadcast;
   beyond it filters get denser and let more lines through, which costs time and no correctness.
3. Texts are read again. Only keys that the filter suspects are shuffled, in full. Grouping by the
   key itself confirms them and finds the smallest document; the others' copies are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from .columns import BLANKS, for_workers, fresh, ids_and_bytes, known_id, map_arrow, named, shuffle_parts

# Least code points of a key that counts as a line of text.
MIN_CHARS = 10
# Bound on all filters of suspected repeats together, which every worker holds.
FILTER_BYTES = 48 * 1024 * 1024
# Rows of a key that make a quarter of an even task's (and HOT_ROWS) are not shuffled to meet their first
# document: it is sent. At most MOST_HOT keys of HOT_KEY_BYTES go that way; longer ones are shuffled.
HOT_SHARE = 4
HOT_ROWS = 64
MOST_HOT = 32768
HOT_KEY_BYTES = 1024
PROBES = 4
# Hashes that a task gathers before it sends them off.
FLUSH = 1 << 20

_BLANKS = BLANKS.encode()


def line_key(line: bytes) -> bytes:
    return line.strip(_BLANKS).lower()  # bytes.lower() changes A-Z only


def counted(key: bytes, min_chars: int) -> bool:
    """True if the key has enough code points."""
    if len(key) < min_chars:
        return False
    return len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars


def keys_of(text: bytes, min_chars: int) -> list[bytes]:
    """Distinct counted keys of a text."""
    return [k for k in set(map(line_key, text.split(b"\n"))) if counted(k, min_chars)]


def hashes_of(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def segments_of(hashes: np.ndarray, segments: int) -> np.ndarray:
    """The segment of each hash, by its high bits."""
    return ((hashes >> np.uint64(40)) * np.uint64(segments)) >> np.uint64(24)


class Bloom:
    """A Bloom filter over 64-bit hashes, in whole arrays at a time."""

    def __init__(self, bits: int, words: np.ndarray | None = None):
        self.bits = max(64, 1 << (int(bits) - 1).bit_length())
        self.words = np.zeros(self.bits // 8, np.uint8) if words is None else words

    def _places(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        mask = np.uint64(self.bits - 1)
        step = (hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(17) | np.uint64(1)
        at = hashes ^ (hashes >> np.uint64(29))
        for _ in range(PROBES):
            yield at & mask
            at = at + step

    def add(self, hashes: np.ndarray) -> None:
        for at in self._places(hashes):
            np.bitwise_or.at(
                self.words, (at >> np.uint64(3)).astype(np.int64),
                np.left_shift(1, (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8),
            )

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for at in self._places(hashes):
            byte = self.words[(at >> np.uint64(3)).astype(np.int64)]
            found &= (byte >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def _send_hashes(min_chars: int, segments: int):
    def send(gathered: list[np.ndarray]) -> pa.RecordBatch:
        hashes, times = np.unique(np.concatenate(gathered), return_counts=True)
        owner = segments_of(hashes, segments)
        # Hashes are in order, and so are their owners.
        present = np.unique(owner)
        starts = np.searchsorted(owner, present)
        ends = np.append(starts[1:], len(owner))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(present.astype(np.int32)),
                pa.array([hashes[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                pa.array(
                    [hashes[a:b][times[a:b] > 1].tobytes() for a, b in zip(starts, ends)],
                    pa.binary(),
                ),
            ],
            names=["segment", "seen", "again"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, size = [], 0
        for batch in batches:
            for text in batch.column("text"):
                found = hashes_of(keys_of(text.as_py(), min_chars))
                gathered.append(found)
                size += len(found)
                if size >= FLUSH:
                    yield send(gathered)
                    gathered, size = [], 0
        if size:
            yield send(gathered)

    return run


def _twice_filter(most_bytes: int):
    def run(table: pa.Table) -> pa.Table:
        seen = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("seen")]
        again = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("again")]
        once, repeated = Bloom(10 * sum(map(len, seen))), [np.empty(0, np.uint64)]
        for hashes, more in zip(seen, again):  # an array holds no hash twice
            repeated += [hashes[once.has(hashes)], more]
            once.add(hashes)
        found = np.unique(np.concatenate(repeated))
        most_bits = 1 << max(6, (8 * most_bytes).bit_length() - 1)
        twice = Bloom(min(most_bits, 16 * len(found)))
        twice.add(found)
        return pa.table(
            {
                "segment": table.column("segment")[:1].cast(pa.int32()),
                "twice": pa.array([twice.words.tobytes() if len(found) else b""], pa.binary()),
            }
        )

    return run


class Suspects:
    """The filters of all segments; which hashes may have been seen in two documents."""

    def __init__(self, segments: int, filters: dict[int, bytes]):
        self.segments, self.filters = segments, filters

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), bool)
        if not len(hashes):
            return out
        owner = segments_of(hashes, self.segments)
        order = np.argsort(owner, kind="stable")
        ends = np.flatnonzero(np.diff(owner[order])) + 1
        for places in np.split(order, ends):
            words = self.filters.get(int(owner[places[0]]))
            if words:
                bloom = Bloom(8 * len(words), np.frombuffer(words, np.uint8))
                out[places] = bloom.has(hashes[places])
        return out


def _suspected(min_chars: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suspects = Suspects(*shared.value)
        for batch in batches:
            keys, rows = [], []
            for row, text in enumerate(batch.column("text")):
                own = keys_of(text.as_py(), min_chars)
                keys += own
                rows += [row] * len(own)
            hit = np.flatnonzero(suspects(hashes_of(keys)))
            ids = batch.column("id").take(pa.array(np.array(rows, np.int64)[hit]))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([keys[i] for i in hit], pa.binary())], names=["id", "key"]
            )

    return run


def repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    filter_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """``(id, keys)``: the line keys each document loses, for documents that lose any."""
    spark = docs.sparkSession
    for_workers(spark)
    rows = ids_and_bytes(docs, id_col, text_col)
    segments = shuffle_parts(docs)
    filters = (
        map_arrow(rows.select("text"), _send_hashes(min_chars, segments), "segment int, seen binary, again binary")
        .groupBy("segment")
        .applyInArrow(_twice_filter(max(8, filter_bytes // segments)), "segment int, twice binary")
    )
    # At most filter_bytes in all.
    found = {int(r["segment"]): bytes(r["twice"]) for r in filters.collect()}
    shared = spark.sparkContext.broadcast((segments, found))
    suspects = materialize(
        map_arrow(rows, _suspected(min_chars, shared), "id bigint, key binary"), "line-suspects"
    )
    confirmed = materialize(
        suspects.groupBy("key")
        .agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n"))
        .filter("first < last")
        .select("key", "first", "n"),
        "line-firsts",
    )
    # A key with this many rows is a large part of a task. There are at most MOST_HOT of them, so
    # their first documents are sent, and their rows stay where they are.
    large = max(HOT_ROWS, -(-suspects.count() // min(MOST_HOT, HOT_SHARE * segments)))
    is_hot = (F.col("n") >= large) & (F.octet_length("key") <= HOT_KEY_BYTES)
    hot = confirmed.filter(is_hot).select("key", F.col("first").alias("hot"))
    split = suspects.join(F.broadcast(hot), "key", "left")
    sent = split.filter("hot IS NOT NULL").select("id", "key", F.col("hot").alias("first"))
    rest = split.filter("hot IS NULL").select("id", "key").join(confirmed.filter(~is_hot), "key")
    return (
        sent.unionByName(rest.select("id", "key", "first"))
        .filter("id <> first")
        .select("id", "key")
        .distinct()
        .groupBy("id")
        .agg(F.collect_list("key").alias("keys"))
    )


def _without_lines(texts: pd.Series, keys: pd.Series) -> pd.DataFrame:
    out = []
    for text, gone in zip(texts, keys):
        lines = text.split(b"\n")
        n = len(lines)
        if gone is not None and len(gone):
            drop = set(map(bytes, gone))
            lines = [x for x in lines if line_key(x) not in drop]
        out.append((n, n - len(lines), b"\n".join(lines).decode("utf-8", "replace")))
    return pd.DataFrame(out, columns=["n_lines", "n_dropped", "text"])


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    filter_bytes: int = FILTER_BYTES,
    report: tuple[str, str] | None = ("n_lines", "n_dropped"),
) -> DataFrame:
    """``docs`` with repeated lines removed from ``text_col``, all other columns as they are.

    A line's key is the line without blanks at its ends and with A-Z lower-cased. Keys of at least
    ``min_chars`` code points in two or more documents keep their lines in the document with the
    smallest id only (there, all of them). ``report`` names two added columns, or is None; a
    column of ``docs`` with such a name is replaced.

    A null text is one empty line and becomes an empty text. Rows with one id are one document,
    null ids together are one document after all others. An empty table stays empty.
    """
    losses = repeated_lines(docs, id_col, text_col, min_chars, filter_bytes)
    key, gone, result = (fresh(docs, f"_line_{x}") for x in ("id", "keys", "result"))
    joined = docs.withColumn(key, known_id(named(docs, id_col))).join(
        losses.select(F.col("id").alias(key), F.col("keys").alias(gone)), key, "left"
    )
    text = F.coalesce(joined[f"`{text_col}`"].cast("string"), F.lit("")).cast("binary")
    removed = F.pandas_udf(_without_lines, "n_lines bigint, n_dropped bigint, text string")
    out = joined.withColumn(result, removed(text, F.col(gone)))
    columns = [
        F.col(f"{result}.text").alias(c) if c == text_col else F.col(f"`{c}`")
        for c in docs.columns
        if not report or c not in report
    ]
    if report:
        columns += [
            F.col(f"{result}.n_lines").alias(report[0]),
            F.col(f"{result}.n_dropped").alias(report[1]),
        ]
    return out.select(*columns)
