"""Document fingerprints from prefix polynomial hashes.

The prefix hashes of a text are modular sums of ``code[i] * base**i``. From them the hash of any span
follows by one subtraction, freed of its place by an inverse power: equal spans have equal hashes
wherever they stand. So spans are compared in constant time, the longest common extension of two
places is found by binary search, and the hashes of all spans of a width are a few array operations.

A fingerprint holds the length, the hash of the whole text, and the least hashes of its spans of a
short and of a long width, by which two texts' likeness is estimated: the share of common spans,
repeats counted. Two bases under one modulus of 31 bits keep all products within 64 bits and give 62
bits together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import Batches, ids_and_texts, known_id, map_arrow, named, outer_id, shuffle_parts

MODULUS = 2**31 - 1
BASES = (911_382_323, 1_508_217_997)
# Code points of a block: prefix hashes start anew in each, and powers are kept for one block.
BLOCK = 1 << 16
# Widths of spans, and the lengths from which the long and up to which the short width is used.
SHORT, LONG = 3, 16
LONG_FROM, SHORT_BELOW = 64, 128
# Least hashes kept of a width, and their bits.
KEPT, BITS = 128, 32
# Spans of a text that are sorted at once.
PORTION = 1 << 22
# Rows of the sample for each partition by which documents are dealt out in order.
SAMPLED = 20


def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    def table(x: int) -> np.ndarray:
        out = np.ones(1, np.uint64)
        while len(out) < BLOCK + LONG:
            out = np.concatenate([out, out * np.uint64(pow(x, len(out), MODULUS)) % np.uint64(MODULUS)])
        return out

    return table(base), table(pow(base, -1, MODULUS))


_TABLES: list[tuple[np.ndarray, np.ndarray]] = []


def tables() -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers and inverse powers of each base, made once per process."""
    if not _TABLES:
        _TABLES.extend(_powers(b) for b in BASES)
    return _TABLES


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


_P, _SHIFT = np.uint64(MODULUS), np.uint64(31)


def _reduced(x: np.ndarray) -> np.ndarray:
    """``x`` modulo ``2**31 - 1`` for ``x`` below ``2**64``, by folding."""
    x = (x & _P) + (x >> _SHIFT)
    x = (x & _P) + (x >> _SHIFT)
    return np.where(x >= _P, x - _P, x)


class PrefixHashes:
    """Prefix arrays of a text, a block at a time, and what they answer."""

    def __init__(self, text: str):
        self.codes = code_points(text)
        n = len(self.codes)
        # Of each base: prefix hashes within their block, and hashes of all that stands before a block.
        self.local = [np.zeros(n + 1, np.uint32) for _ in BASES]
        self.before: list[list[int]] = [[0] for _ in BASES]
        for at in range(0, n, BLOCK):
            block = self.codes[at : at + BLOCK].astype(np.uint64) + np.uint64(1)
            for b, (powers, _) in enumerate(tables()):
                sums = _reduced(np.cumsum(_reduced(block * powers[: len(block)])))
                self.local[b][at + 1 : at + len(block) + 1] = sums
                shift = pow(BASES[b], at, MODULUS)
                self.before[b].append((self.before[b][-1] + int(sums[-1]) * shift) % MODULUS)

    def __len__(self) -> int:
        return len(self.codes)

    def prefix(self, end: int, b: int) -> int:
        """Hash of the first ``end`` code points under base ``b``."""
        block = max(0, end - 1) // BLOCK
        shift = pow(BASES[b], block * BLOCK, MODULUS)
        return (self.before[b][block] + int(self.local[b][end]) * shift) % MODULUS if end else 0

    def span(self, start: int, end: int) -> int:
        """Hash of a span, the same wherever it stands."""
        out = 0
        for b, base in enumerate(BASES):
            found = (self.prefix(end, b) - self.prefix(start, b)) * pow(base, -start, MODULUS)
            out = out << 31 | found % MODULUS
        return out

    def whole(self) -> int:
        return self.span(0, len(self))

    def spans(self, width: int) -> Iterator[np.ndarray]:
        """Hashes of all spans of a width, a block at a time; a shorter text is one span."""
        n = len(self)
        if n <= width:
            if n:
                yield np.array([self.whole()], np.uint64)
            return
        for at in range(0, n - width + 1, BLOCK):
            many = min(BLOCK, n - width + 1 - at)
            out = np.zeros(many, np.uint64)
            for b, (powers, inverse) in enumerate(tables()):
                local = self.local[b][at : at + many + width].astype(np.uint64)
                local[0] = 0
                if at + many + width - 1 > at + BLOCK:
                    # The ends of the last spans lie in the next block: carried over to this one's sums.
                    local[BLOCK + 1 :] = _reduced(local[BLOCK + 1 :] * powers[BLOCK] + local[BLOCK])
                found = _reduced((local[width:] + _P - local[:-width]) * inverse[:many])
                out = out << _SHIFT | found
            yield out


def common_extension(a: PrefixHashes, i: int, b: PrefixHashes, j: int) -> int:
    """Length of the longest common extension of ``a`` from ``i`` and ``b`` from ``j``."""
    low, high = 0, min(len(a) - i, len(b) - j)
    while low < high:
        middle = (low + high + 1) // 2
        if a.span(i, i + middle) == b.span(j, j + middle):
            low = middle
        else:
            high = middle - 1
    return low


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """Hashes whose order says nothing of the text, in ``BITS`` bits."""
    x = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x >> np.uint64(64 - BITS)


def _numbered(hashes: PrefixHashes, width: int) -> Iterator[np.ndarray]:
    """Mixed hashes of all spans of a width, each repeat of a span with its number, so that repeated
    text weighs as much as it is long. Spans are taken in portions of ``PORTION``, dealt by hash."""
    portions = -(-len(hashes) // PORTION)
    for portion in range(portions):
        found = [x if portions == 1 else x[x % np.uint64(portions) == portion] for x in hashes.spans(width)]
        found = np.sort(np.concatenate(found))
        same = found[1:] == found[:-1]
        if same.any():
            place = np.arange(len(found))
            first = np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), place, 0))
            found = found + (place - first).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        yield _mixed(found)


def _least(hashes: PrefixHashes, width: int) -> np.ndarray:
    """The ``KEPT`` least hashes of numbered spans."""
    out = np.empty(0, np.uint64)
    for found in _numbered(hashes, width):
        if len(found) > 8 * KEPT:
            # Few of many hashes can be among the least.
            few = np.unique(found[found < np.uint64((1 << BITS) * 3 * KEPT // len(found))])
            found = few if len(few) >= KEPT else found
        out = np.unique(np.concatenate([out, found]))[:KEPT]
    return out


class Fingerprint:
    """Length, whole hash, and the least span hashes of both widths (None where not used)."""

    def __init__(self, n: int, whole: int, short: np.ndarray | None, long: np.ndarray | None):
        self.n, self.whole, self.short, self.long = n, whole, short, long

    @classmethod
    def of(cls, hashes: PrefixHashes) -> Fingerprint:
        n = len(hashes)
        return cls(
            n,
            hashes.whole(),
            _least(hashes, SHORT) if n < SHORT_BELOW else None,
            _least(hashes, LONG) if n >= LONG_FROM else None,
        )

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        n, whole, short, long = text.split("-")

        def least(digits: str) -> np.ndarray | None:
            if not digits:
                return None
            wide = BITS // 4
            return np.array([int(digits[i : i + wide], 16) for i in range(1, len(digits), wide)], np.uint64)

        return cls(int(n, 16), int(whole, 16), least(short), least(long))

    def __str__(self) -> str:
        def digits(letter: str, least: np.ndarray | None) -> str:
            if least is None:
                return ""
            return letter + least.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BITS // 8 :].tobytes().hex()

        return f"{self.n:x}-{self.whole:016x}-{digits('s', self.short)}-{digits('l', self.long)}"

    def likeness(self, other: Fingerprint) -> float:
        """Estimated share of the spans of both that are in both, from 0 to 1; exact for short texts.

        The long width decides where both have it, else the short one. Texts too different in
        length to have a width in common have a likeness of 0.
        """
        if self.n == other.n and self.whole == other.whole:
            return 1.0
        for a, b in ((self.long, other.long), (self.short, other.short)):
            if a is not None and b is not None:
                both = np.union1d(a, b)
                if len(a) == KEPT or len(b) == KEPT:
                    both = both[:KEPT]
                shared = np.intersect1d(a, b, assume_unique=True)
                return float(np.count_nonzero(shared <= both[-1]) / len(both)) if len(both) else 0.0
        return 0.0


def likeness(a: str, b: str) -> float:
    """Likeness of two fingerprints as they are written."""
    return Fingerprint.parse(a).likeness(Fingerprint.parse(b))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_chars, fingerprint)``, one row per row of ``docs``; nothing is shuffled.

    A null text is an empty one. Equal texts have equal fingerprints. Null and repeated ids stay as
    they are, an empty table gives an empty result, and other columns are not read.
    """

    def run(batches: Batches) -> Batches:
        for batch in batches:
            made = [Fingerprint.of(PrefixHashes(t.as_py())) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([x.n for x in made], pa.int64()), pa.array(list(map(str, made)), pa.string())],
                names=["id", "n_chars", "fingerprint"],
            )

    found = map_arrow(ids_and_texts(docs, id_col, text_col), run, "id bigint, n_chars bigint, fingerprint string")
    return found.withColumnRenamed("id", id_col)


class Order:
    """Documents in ascending order of (id, hash of the text), cut into parts."""

    def __init__(self, ids: np.ndarray, hashes: np.ndarray):
        order = np.lexsort((hashes, ids))
        self.ids, self.hashes = ids[order], hashes[order]

    def part(self, ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """How many of the cuts are not above each key."""
        low, high = np.searchsorted(self.ids, ids, "left"), np.searchsorted(self.ids, ids, "right")
        for i in np.flatnonzero(low < high):  # cuts within the rows of one id
            low[i] += np.searchsorted(self.hashes[low[i] : high[i]], hashes[i], "right")
        return low


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("id").to_numpy(), batch.column("hash").to_numpy()


def _cuts(keys: DataFrame, parts: int) -> Order:
    """Cuts that make about equal parts, from a sample of ``SAMPLED`` rows a part."""
    total = keys.count()
    share = min(1.0, SAMPLED * parts / max(1, total))
    found = keys.sample(share, seed=1).toArrow() if share < 1 else keys.toArrow()
    ids, hashes = (np.asarray(found.column(c).to_numpy(), np.int64) for c in ("id", "hash"))
    order = np.lexsort((hashes, ids))
    at = order[np.unique(len(order) * np.arange(1, parts) // parts)] if len(order) else order
    return Order(ids[at], hashes[at])


def _firsts(keys: DataFrame, cuts: Order) -> dict[int, tuple[int, int]]:
    """The first key of each part that has any: one row a part."""

    def run(batches: Batches) -> Batches:
        first: dict[int, tuple[int, int]] = {}
        for batch in batches:
            ids, hashes = _keys(batch)
            part = cuts.part(ids, hashes)
            order = np.lexsort((hashes, ids))
            present, at = np.unique(part[order], return_index=True)
            for p, i in zip(present.tolist(), order[at].tolist()):
                key = int(ids[i]), int(hashes[i])
                first[p] = min(first.get(p, key), key)
        rows = [(p, *key) for p, key in first.items()]
        columns = list(zip(*rows)) if rows else [[]] * 3
        types = (pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["part", "id", "hash"])

    found = map_arrow(keys, run, "part int, id bigint, hash bigint").groupBy("part").agg(F.min(F.struct("id", "hash")).alias("first"))
    return {r["part"]: tuple(r["first"]) for r in found.collect()}


def _dealt(cuts: Order, firsts: dict[int, tuple[int, int]]):
    """Rows with their part; the first of each part also goes to the part before, marked as its end."""
    present = sorted(firsts)
    before = dict(zip(present, [present[-1], *present[:-1]])) if present else {}
    heads = {firsts[p]: before[p] for p in present}

    def run(batches: Batches) -> Batches:
        left = dict(heads)  # a task sends the row that ends a part once
        for batch in batches:
            ids, hashes = _keys(batch)
            part = cuts.part(ids, hashes)
            is_end = np.zeros(len(ids), bool)
            ends = [(i, left.pop(key)) for i, key in enumerate(zip(ids.tolist(), hashes.tolist())) if key in left]
            take = np.concatenate([np.arange(len(ids)), np.array([i for i, _ in ends], np.int64)])
            goes = np.concatenate([part, np.array([p for _, p in ends], np.int64)])
            is_end = np.concatenate([is_end, np.ones(len(ends), bool)])
            rows = batch.take(pa.array(take))
            yield pa.RecordBatch.from_arrays(
                [pa.array(goes.astype(np.int32)), pa.array(is_end), *rows.columns],
                names=["part", "is_end", *batch.schema.names],
            )

    return run


def _probe(batches: Batches) -> Batches:
    """Rows in order, the last one an end: each document beside its edited text and the next one."""
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "common_prefix"]
    types = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64(), pa.int64()]
    held, ended = None, False
    for batch in batches:
        out = []
        for i, is_end, text in zip(batch.column("id").to_pylist(), batch.column("is_end").to_pylist(), batch.column("text")):
            if ended:
                continue
            text = text.as_py()
            hashes = PrefixHashes(text)
            mark = Fingerprint.of(hashes)
            if held is not None:
                own, known, own_hashes, own_mark = held
                cut = own_mark.n // 4
                edited = known[: own_mark.n - cut] + text[:cut]
                edited_hashes = PrefixHashes(edited)
                edited_mark = Fingerprint.of(edited_hashes)
                digest = hashlib.sha256(edited.encode()).hexdigest()
                out.append(
                    (
                        own, own_mark.n, digest, str(own_mark), str(edited_mark), own_mark.likeness(edited_mark),
                        own_mark.likeness(mark), common_extension(own_hashes, 0, edited_hashes, 0),
                    )
                )
            held, ended = (i, text, hashes, mark), is_end
        columns = list(zip(*out)) if out else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint beside that of an edited text and of the next document.

    The edited text has the document's last ``floor(n_chars / 4)`` code points replaced by as many
    first ones of the next document, or all it has. Rows are in ascending order of id; after the
    last comes the first. Columns: ``id_col, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, common_prefix``, the last one being the longest
    common extension of both texts from their starts.

    Each row is a document. Null texts are empty, null ids come last, rows of one id are in the
    order of their texts' hashes. A table of one row is its own next, an empty one stays empty.
    Other columns are not read. Whole texts are shuffled once; cuts come from a bounded sample and
    decide only how evenly documents are dealt out.
    """
    rows = docs.select(
        known_id(named(docs, id_col)).alias("id"),
        F.coalesce(named(docs, text_col).cast("string"), F.lit("")).alias("text"),
    ).select("id", F.xxhash64("text").alias("hash"), "text")
    parts = shuffle_parts(docs)
    keys = rows.select("id", "hash")
    cuts = _cuts(keys, parts)
    dealt = map_arrow(
        rows, _dealt(cuts, _firsts(keys, cuts)), "part int, is_end boolean, id bigint, hash bigint, text string"
    )
    ordered = dealt.repartitionById(parts, F.col("part")).sortWithinPartitions("is_end", "id", "hash", "text")
    found = map_arrow(
        ordered.select("id", "is_end", "text"),
        _probe,
        "id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, common_prefix bigint",
    )
    return found.select(outer_id("id").alias(id_col), *[c for c in found.columns if c != "id"])
