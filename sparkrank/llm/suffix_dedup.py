"""Repeated byte strings across documents, by suffix arrays of shards.

A string of ``span`` bytes that starts in two documents must end up in one shard. Its *anchor* does
that: of all the string's pieces of ``ANCHOR`` bytes the one with the least hash, so equal strings
have equal anchors at equal places.

1. Of byte-equal documents all but the one with the smallest id lose everything, and send nothing.
2. Tasks send the hashes of their anchors to the owners of hash ranges (about four bytes each,
   combined per task). Owners answer with Bloom filters of anchors in two or more documents, and
   of those in very many; together they have a fixed bound and are broadcast.
3. Texts are read again. Where anchors in a row are known to the filter, the run is cut into chunks
   at anchors that their hash chooses, so equal runs have equal chunks. A chunk travels once, to the
   shard of its hash, and equal ones are combined on the way and there: the smallest document's copy
   is left, the others are settled.
4. What is left are different contents. Their anchors are counted again, and now only anchors in
   two or more contents are of interest. The stretch of strings around each goes to the anchor's
   shard. Strings around a very common anchor travel one by one instead, each to a shard of its own
   hash, so no anchor's neighbourhoods meet in one place.
5. A shard sorts the suffixes of stretches that differ around a common anchor by induced sorting
   (and what that names, by doubling prefixes).
   Permuted common prefixes of ``span`` bytes or more cut the order into classes of equal strings;
   all strings but the smallest document's are marked.
6. Marks meet their texts by document, and covered bytes are removed.

Filters may let strangers through, which costs time only: what is removed is decided on bytes, and
for whole documents on their SHA-256.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import hinted, salted_join
from ..operators.sizing import fits
from ..sources.scratch import materialize
from .columns import LAST_ID, for_workers, fresh, ids_and_bytes, known_id, map_arrow, named, release, shuffle_parts
from .line_dedup import Bloom, Suspects, segments_of
from .suffix_array import common_prefixes, suffix_array

SPAN = 50
ANCHOR = 20
# Bound on the filters that every worker holds, and the part of it for very common anchors, which are few.
FILTER_BYTES = 128 * 1024 * 1024
COMMON_PART = 16
# Documents from which on an anchor is very common.
COMMON = 16384
# Bytes of text looked at in one piece; different stretches, and places of them, that are combined at
# once; anchors counted at once.
BLOCK = 1 << 18
STRETCHES = 80_000
PLACES = 1_000_000
ANCHORS = 1 << 19
# One anchor of so many, by its hash, begins a chunk; bytes of chunks that are combined at once.
CHUNK = 16
CHUNK_BYTES = 1 << 24
# Shards per partition of a shuffle; many small ones are dealt more evenly.
SHARDS = 8
# Bytes whose suffixes are sorted at once; contents around one anchor are never parted.
SORTED = 1 << 18

_LOW = np.uint64(0xFFFFFFFF)


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (value ^ (value >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)


def piece_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the ``ANCHOR`` (20) bytes at each place."""
    n = len(data) - ANCHOR + 1
    # Words of eight bytes from each place, read where they lie; three of them cover a piece.
    words = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), 0, (1,)).copy()
    out = words[:n] * np.uint64(0xA0761D6478BD642F)
    for place, factor in ((8, 0xE7037ED1A0B428DB), (ANCHOR - 8, 0x8EBC6AF09C88C6E3)):
        out ^= out >> np.uint64(29)
        out += words[place : place + n] * np.uint64(factor)
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out


def stretches(data: np.ndarray, lengths: np.ndarray, span: int = SPAN):
    """(document, first string, last string, anchor's hash) of all anchored stretches.

    ``data`` is documents one after the other. Strings are named by where they start.
    """
    n, width = len(data), span - ANCHOR + 1
    ends = np.cumsum(lengths)
    if n < span:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    hashes = piece_hashes(data)
    # Least hash first, of equal ones the rightmost: a rule that the string alone decides.
    least = (hashes & ~_LOW) | (_LOW - np.arange(len(hashes), dtype=np.uint64))
    have = 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    # Places where a string fits into its document.
    inside = np.ones(n - span + 1, bool)
    for end in ends[:-1].tolist():
        inside[max(0, end - span + 1) : end] = False
    turns = np.append(True, (least[1:] != least[:-1]) | ~inside[1:] | ~inside[:-1])
    first = np.flatnonzero(turns & inside)
    last = np.flatnonzero(np.append(turns[1:], True) & inside)
    anchors = (_LOW - (least[first] & _LOW)).astype(np.int64)
    # An anchor's hash is a least one: mixed, its high bits are as even as its low ones.
    return np.searchsorted(ends, first, side="right"), first, last, _mixed(hashes[anchors])


def _blocks(batches: Iterator[pa.RecordBatch], *more: str) -> Iterator[tuple]:
    """(ids, texts, lists of ``more`` columns) of about ``BLOCK`` bytes; a text is never cut."""
    ids, texts, rest, size = [], [], [[] for _ in more], 0
    for batch in batches:
        for i, text, *other in zip(batch.column("id").to_pylist(), *(batch.column(c) for c in ("text", *more))):
            ids.append(i)
            texts.append(text.as_py())
            for column, value in zip(rest, other):
                column.append(value.as_py())
            size += len(texts[-1])
            if size >= BLOCK:
                yield np.array(ids, np.int64), texts, *rest
                ids, texts, rest, size = [], [], [[] for _ in more], 0
    if ids:
        yield np.array(ids, np.int64), texts, *rest


def _joined(texts: list[bytes]) -> tuple[bytes, np.ndarray]:
    return b"".join(texts), np.array([len(t) for t in texts], np.int64)


def _parted(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A stable order by owner, the owners present, and the bounds of their parts."""
    order = np.argsort(owner, kind="stable")
    present, starts = np.unique(owner[order], return_index=True)
    return order, present, np.append(starts, len(owner))


def packed(values: np.ndarray) -> bytes:
    """32-bit numbers in ascending order as planes of their differences' bytes, which compress."""
    steps = np.diff(values, prepend=np.uint32(0)).astype("<u4")
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(planes: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()
    return np.cumsum(steps, dtype=np.uint64).astype(np.uint32)


class Anchors(Suspects):
    """Which anchors a filter of their hashes' low halves knows; the high halves name the segment."""

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), bool)
        if len(hashes):
            order, present, bounds = _parted(segments_of(hashes, self.segments))
            for segment, a, b in zip(present, bounds[:-1], bounds[1:]):
                words = self.filters.get(int(segment))
                if words:
                    bloom = Bloom(8 * len(words), np.frombuffer(words, np.uint8))
                    out[order[a:b]] = bloom.has(hashes[order[a:b]] & _LOW)
        return out


def _send_anchors(span: int, shards: int):
    def send(hashes: list[np.ndarray], documents: list[np.ndarray]) -> pa.RecordBatch:
        found, document = np.concatenate(hashes), np.concatenate(documents)
        owner = segments_of(found, shards).astype(np.uint64)
        found = owner << np.uint64(32) | found & _LOW
        order = np.lexsort((document, found))
        found, document = found[order], document[order]
        once = np.append(True, (found[1:] != found[:-1]) | (document[1:] != document[:-1]))
        found, counts = np.unique(found[once], return_counts=True)
        _, present, bounds = _parted(found >> np.uint64(32))
        low, parts = (found & _LOW).astype(np.uint32), list(zip(bounds[:-1], bounds[1:]))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(present.astype(np.int32)),
                pa.array([packed(low[a:b]) for a, b in parts], pa.binary()),
                pa.array([counts[a:b].astype(np.uint32).tobytes() for a, b in parts], pa.binary()),
            ],
            names=["segment", "hashes", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, documents, size, seen = [], [], 0, 0
        for _, texts in _blocks(batches):
            joined, lengths = _joined(texts)
            document, _, _, found = stretches(np.frombuffer(joined, np.uint8), lengths, span)
            hashes.append(found)
            documents.append(document + seen)
            seen += len(texts)
            size += len(found)
            if size >= ANCHORS:
                yield send(hashes, documents)
                hashes, documents, size = [], [], 0
        if size:
            yield send(hashes, documents)

    return run


def _anchor_filters(most_bytes: int, common: int):
    def filtered(found: np.ndarray, most_bytes: int) -> bytes:
        if not len(found):
            return b""
        most_bits = 1 << max(6, (8 * most_bytes).bit_length() - 1)
        bloom = Bloom(min(most_bits, 16 * len(found)))
        bloom.add(found.astype(np.uint64))
        return bloom.words.tobytes()

    few_bytes = most_bytes // COMMON_PART

    def run(table: pa.Table) -> pa.Table:
        hashes = np.concatenate([unpacked(x.as_py()) for x in table.column("hashes")])
        counts = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in table.column("counts")])
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        starts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
        totals = np.add.reduceat(counts[order].astype(np.int64), starts)
        return pa.table(
            {
                "segment": table.column("segment")[:1],
                "shared": pa.array([filtered(hashes[starts][totals > 1], most_bytes - few_bytes)], pa.binary()),
                "common": pa.array([filtered(hashes[starts][totals >= common], few_bytes)], pa.binary()),
            }
        )

    return run


def merged(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
    """Spans ``(ids, starts, sizes)`` with those that overlap or touch in a document as one."""
    order = np.lexsort((starts, ids))
    ids, starts, ends = ids[order], starts[order], (starts + sizes)[order]
    if not len(ids):
        return ids, starts, sizes
    # Documents one after the other on one line, with gaps between them.
    document = np.cumsum(np.append(0, ids[1:] != ids[:-1])) * (int(ends.max()) + 2)
    reach = np.maximum.accumulate(ends + document)
    begins = np.flatnonzero(np.append(True, starts[1:] + document[1:] > reach[:-1]))
    last = np.append(begins[1:], len(ids)) - 1
    ends = reach[last] - document[last]
    return ids[begins], starts[begins], (ends - starts[begins]).astype(np.int32)


SENT = "shard int, keys binary, ids binary, starts binary, sizes binary, contents binary"


class _Sender:
    """Contents and where they stand, equal contents as one until they are sent."""

    def __init__(self, shards: int):
        self.shards = shards
        self.clear()

    def clear(self) -> None:
        self.entries, self.keys, self.contents, self.place, self.size = array("q"), [], [], {}, 0

    def add(self, content: bytes, key: int | None, i: int, starts: list[int]) -> None:
        at = self.place.get(content)
        if at is None:
            at = self.place[content] = len(self.contents)
            self.contents.append(content)
            self.keys.append(xxhash.xxh3_64_intdigest(content) if key is None else key)
            self.size += len(content)
        for start in starts:
            self.entries.extend((at, i, start))

    def sent(self) -> pa.RecordBatch:
        """Rows by shard: keys, ids, starts, sizes and contents; without contents what is settled."""
        contents = self.contents
        which, ids, starts = np.frombuffer(self.entries, np.int64).reshape(-1, 3).T.copy()
        sizes = np.array([len(c) for c in contents], np.int32)[which]
        smallest = np.full(len(contents), np.iinfo(np.int64).max)
        np.minimum.at(smallest, which, ids)
        settled = ids > smallest[which]
        own = np.array(self.keys, np.uint64)[which]
        columns: list[list] = [[] for _ in range(6)]
        # What is settled is spans of documents, and those that touch are one.
        runs = merged(ids[settled], starts[settled], sizes[settled])
        left, kept = np.flatnonzero(~settled), (ids, starts, sizes)
        for part, known in ((left, False), (np.arange(len(runs[0])), True)):
            if not len(part):
                continue
            ids, starts, sizes = runs if known else kept
            spread = _mixed(ids[part].view(np.uint64)) if known else own[part]
            order, present, bounds = _parted(segments_of(spread, self.shards))
            for shard, a, b in zip(present, bounds[:-1], bounds[1:]):
                at = part[order[a:b]]
                row = (
                    int(shard),
                    b"" if known else own[at].tobytes(),
                    ids[at].tobytes(),
                    starts[at].tobytes(),
                    sizes[at].tobytes(),
                    None if known else b"".join(contents[i] for i in which[at]),
                )
                for column, value in zip(columns, row):
                    column.append(value)
        kinds = (pa.int32(), *[pa.binary()] * 5)
        self.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in SENT.split(", ")]
        )


def chunks(document: np.ndarray, first: np.ndarray, last: np.ndarray, hashes: np.ndarray, known: np.ndarray):
    """(document, first string, last string) of runs of stretches that are known, cut by hash."""
    hit = np.flatnonzero(known)
    begins = np.ones(len(hit), bool)
    if len(hit):
        on = (hit[1:] == hit[:-1] + 1) & (document[hit[1:]] == document[hit[:-1]])
        begins[1:] = ~on | (hashes[hit[1:]] % np.uint64(CHUNK) == 0)
    at = np.flatnonzero(begins)
    ends = np.append(at[1:], len(hit))[: len(at)] - 1
    return document[hit[at]], first[hit[at]], last[hit[ends]]


def _send_chunks(span: int, shards: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments, filters, _ = shared.value
        is_shared, sender = Anchors(segments, filters), _Sender(shards)
        for ids, texts in _blocks(batches):
            joined, lengths = _joined(texts)
            document, first, last, hashes = stretches(np.frombuffer(joined, np.uint8), lengths, span)
            document, first, last = chunks(document, first, last, hashes, is_shared(hashes))
            begins = (np.cumsum(lengths) - lengths)[document]
            for a, b, i, begin in zip(first.tolist(), last.tolist(), ids[document].tolist(), begins.tolist()):
                sender.add(joined[a : b + span], None, i, [a - begin])
            if sender.size >= CHUNK_BYTES or len(sender.entries) >= 3 * PLACES:
                yield sender.sent()
        if sender.entries:
            yield sender.sent()

    return run


def _send_stretches(span: int, shards: int, shared):
    """Of contents ``(id, text, starts)``, each at all its places in the smallest document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments, filters, very = shared.value
        is_shared, is_common = Anchors(segments, filters), Anchors(segments, very)
        sender = _Sender(shards)
        for ids, texts, starts in _blocks(batches, "starts"):
            joined, lengths = _joined(texts)
            document, first, last, hashes = stretches(np.frombuffer(joined, np.uint8), lengths, span)
            hit = np.flatnonzero(is_shared(hashes))
            begins = np.cumsum(lengths) - lengths
            rows = zip(
                first[hit].tolist(), last[hit].tolist(), hashes[hit].tolist(), document[hit].tolist(),
                begins[document[hit]].tolist(), is_common(hashes[hit]).tolist(),
            )
            for a, b, key, d, begin, single in rows:
                if single:
                    for at in range(a, b + 1):
                        sender.add(joined[at : at + span], None, int(ids[d]), [at - begin + s for s in starts[d]])
                else:
                    sender.add(joined[a : b + span], key, int(ids[d]), [a - begin + s for s in starts[d]])
            if len(sender.contents) >= STRETCHES or len(sender.entries) >= 3 * PLACES:
                yield sender.sent()
        if sender.entries:
            yield sender.sent()

    return run


def repeated_strings(contents: list[bytes], smallest: np.ndarray, span: int = SPAN):
    """(content, offset, length) of what is covered by strings of ``span`` bytes that also occur in
    a content with a smaller id; ``smallest`` is the id of each content."""
    lengths = np.array([len(c) for c in contents], np.int64)
    which = np.repeat(np.arange(len(contents)), lengths + 1)
    begins = np.cumsum(lengths + 1) - lengths - 1
    place = np.arange(len(which)) - begins[which]
    text = np.zeros(len(which), np.int64)  # 0 between contents
    text[place < lengths[which]] = np.frombuffer(b"".join(contents), np.uint8).astype(np.int64) + 1
    order = suffix_array(text)
    shared = common_prefixes(text, order, span)
    classes = np.cumsum(shared[order] < span)
    inside = (place + span <= lengths[which])[order]
    order, classes = order[inside], classes[inside]
    if not len(order):
        return (np.empty(0, np.int64),) * 3
    ids = smallest[which[order]]
    starts = np.flatnonzero(np.append(True, classes[1:] != classes[:-1]))
    least = np.repeat(np.minimum.reduceat(ids, starts), np.diff(np.append(starts, len(ids))))
    covered = np.sort(order[ids > least])
    if not len(covered):
        return (np.empty(0, np.int64),) * 3
    cuts = np.append(True, (covered[1:] != covered[:-1] + 1) | (which[covered[1:]] != which[covered[:-1]]))
    at = np.flatnonzero(cuts)
    first, last = covered[at], covered[np.append(at[1:], len(covered)) - 1]
    return which[first], place[first], last - first + span


def _portions(several: np.ndarray, anchor: np.ndarray, contents: list[bytes]) -> Iterator[np.ndarray]:
    """Contents, in order of their anchor, in portions of about ``SORTED`` bytes."""
    if not len(several):
        return
    sizes = np.cumsum([len(contents[i]) for i in several])
    # The portion of an anchor is that of its first content.
    own = anchor[several]
    first = np.maximum.accumulate(np.where(np.append(True, own[1:] != own[:-1]), np.arange(len(own)), 0))
    portion = sizes[first] // SORTED
    yield from np.split(several, np.flatnonzero(np.diff(portion)) + 1)


class _Received:
    """What a shard was sent: settled spans, and contents, equal ones combined."""

    def __init__(self, table: pa.Table):
        self.settled: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        keys, ids, starts, sizes, contents = [], [], [], [], []
        for k, i, a, n, text in zip(*(table.column(c) for c in ("keys", "ids", "starts", "sizes", "contents"))):
            i, a = np.frombuffer(i.as_py(), np.int64), np.frombuffer(a.as_py(), np.int64)
            n, text = np.frombuffer(n.as_py(), np.int32).astype(np.int64), text.as_py()
            if text is None:
                self.settled.append((i, a, n))
                continue
            keys.append(np.frombuffer(k.as_py(), np.uint64))
            ids.append(i), starts.append(a), sizes.append(n)
            ends = np.cumsum(n).tolist()
            contents += [text[x:y] for x, y in zip([0, *ends[:-1]], ends)]
        place: dict[bytes, int] = {}
        self.which = np.array([place.setdefault(c, len(place)) for c in contents], np.int64)
        self.distinct, self.smallest = list(place), np.full(len(place), np.iinfo(np.int64).max)
        if contents:
            self.keys, self.ids, self.starts, self.sizes = map(np.concatenate, (keys, ids, starts, sizes))
            np.minimum.at(self.smallest, self.which, self.ids)
            self.done = self.ids > self.smallest[self.which]
            self.settled.append((self.ids[self.done], self.starts[self.done], self.sizes[self.done]))


def _settle(table: pa.Table) -> pa.Table:
    """Spans that are settled, and each content once with all its places in the smallest document."""
    got = _Received(table)
    spans = [np.concatenate(x) for x in zip(*got.settled)] if got.settled else [np.empty(0, np.int64)] * 3
    ids, starts, sizes = merged(*spans)
    n, many = len(ids), len(got.distinct)
    holders = np.flatnonzero(~got.done) if many else np.empty(0, np.int64)
    holders = holders[np.argsort(got.which[holders], kind="stable")]
    bounds = np.searchsorted(got.which[holders], np.arange(many + 1))
    places = got.starts[holders] if many else holders
    release()
    return pa.table(
        {
            "id": np.concatenate([ids, got.smallest]),
            "span": pa.concat_arrays([pa.array(starts << 32 | sizes.astype(np.int64)), pa.nulls(many, pa.int64())]),
            "text": pa.concat_arrays([pa.nulls(n, pa.binary()), pa.array(got.distinct, pa.binary())]),
            "starts": pa.ListArray.from_arrays(pa.array(np.append(np.zeros(n), bounds).astype(np.int32)), pa.array(places)),
        }
    )


def _shard(span: int):
    def run(table: pa.Table) -> pa.Table:
        got = _Received(table)
        out_ids, out_starts, out_sizes = (list(x) for x in zip(*got.settled)) if got.settled else ([], [], [])
        if got.distinct:
            keys, ids, starts = got.keys, got.ids, got.starts
            which, distinct, smallest, settled = got.which, got.distinct, got.smallest, got.done
            # Around an anchor with one content only there is nothing left to sort.
            key = np.empty(len(distinct), np.uint64)
            key[which] = keys
            _, back, counts = np.unique(key, return_inverse=True, return_counts=True)
            several = np.flatnonzero(counts[back] > 1)
            for some in _portions(several[np.argsort(back[several], kind="stable")], back, distinct):
                content, offset, length = repeated_strings([distinct[i] for i in some], smallest[some], span)
                content = some[content]
                # Each place where the smallest document has this content.
                holders = np.flatnonzero(~settled)
                holders = holders[np.argsort(which[holders], kind="stable")]
                low = np.searchsorted(which[holders], content, side="left")
                n = np.searchsorted(which[holders], content, side="right") - low
                own = np.repeat(np.arange(len(content)), n)
                step = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
                holder = holders[low[own] + step]
                out_ids.append(ids[holder])
                out_starts.append(starts[holder] + offset[own])
                out_sizes.append(length[own])
        release()
        spans = [(np.concatenate(x) if x else np.empty(0, np.int64)) for x in (out_ids, out_starts, out_sizes)]
        return pa.table({"id": spans[0], "span": spans[1] << 32 | spans[2]})

    return run


def whole_copies(rows: DataFrame, span: int = SPAN) -> DataFrame:
    """``(id, n)`` of documents ``(id, text)`` that are byte-equal to one with a smaller id.

    ``n`` is the bytes they lose. A group of copies, however large, is told by its smallest id.
    """
    long = rows.filter((F.octet_length("text") >= span) & (F.col("id") < LAST_ID))
    marks = long.select("id", F.octet_length("text").alias("n"), F.unhex(F.sha2("text", 256)).alias("digest"))
    marks = materialize(marks, "suffix-digests")
    groups = marks.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    groups = materialize(groups.filter("first < last").select("digest", "first"), "suffix-copied")
    if fits(groups):
        found = marks.join(F.broadcast(groups), "digest")
    else:
        found = salted_join(marks, groups, "digest", "id")
    return materialize(found.filter("id > first").select("id", "n"), "suffix-copies")


def _shared_anchors(rows: DataFrame, span: int, segments: int, filter_bytes: int, common: int):
    """The broadcast filters of anchors in two or more rows; ``filter_bytes`` at most."""
    filters = (
        map_arrow(rows.select("id", "text"), _send_anchors(span, segments), "segment int, hashes binary, counts binary")
        .groupBy("segment")
        .applyInArrow(
            _anchor_filters(max(8, filter_bytes // segments), common),
            "segment int, shared binary, common binary",
        )
        .collect()
    )
    shared, very = ({int(r["segment"]): bytes(r[c]) for r in filters} for c in ("shared", "common"))
    return rows.sparkSession.sparkContext.broadcast((segments, shared, very))


def repeated_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    span: int = SPAN,
    filter_bytes: int = FILTER_BYTES,
    common: int = COMMON,
) -> DataFrame:
    """``(id, spans)``: what each document loses, as ``start << 32 | length`` in bytes."""
    if span < ANCHOR:
        raise ValueError(f"span must be at least {ANCHOR} bytes")
    spark = docs.sparkSession
    for_workers(spark)
    rows, segments = ids_and_bytes(docs, id_col, text_col), shuffle_parts(docs)
    shards = SHARDS * segments

    def by_shard(sent: DataFrame):
        # A stated number of partitions: what is sent is small, and sorting it is not.
        return sent.repartition(segments, "shard").groupBy("shard")

    copies = whole_copies(rows, span)
    few = fits(copies)
    rows = rows.join(hinted(copies.select("id"), few), "id", "left_anti")
    if not few:
        # Texts are read twice from here on, and moved for it once.
        rows = materialize(rows, "suffix-texts")
    anchors = _shared_anchors(rows, span, segments, filter_bytes, common)
    cut = by_shard(map_arrow(rows, _send_chunks(span, shards, anchors), SENT))
    settled = materialize(
        cut.applyInArrow(_settle, "id bigint, span bigint, text binary, starts array<bigint>"), "suffix-chunks"
    )
    left = settled.filter("text IS NOT NULL").select("id", "text", "starts")
    anchors = _shared_anchors(left, span, segments, filter_bytes, common)
    sent = by_shard(map_arrow(left, _send_stretches(span, shards, anchors), SENT))
    found = (
        sent.applyInArrow(_shard(span), "id bigint, span bigint")
        .unionByName(settled.filter("span IS NOT NULL").select("id", "span"))
        .unionByName(copies.select("id", F.col("n").cast("bigint").alias("span")))
    )
    return found.groupBy("id").agg(F.collect_list("span").alias("spans"))


def _without_spans(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
    out = []
    for text, gone in zip(texts, spans):
        n, removed, runs = len(text), 0, 0
        if gone is not None and len(gone):
            gone = np.asarray(gone, np.int64)
            change = np.zeros(n + 1, np.int64)
            # Rows that share an id may be shorter than the one that was marked.
            np.add.at(change, np.minimum(gone >> 32, n), 1)
            np.add.at(change, np.minimum((gone >> 32) + (gone & 0xFFFFFFFF), n), -1)
            covered = np.cumsum(change[:n]) > 0
            removed = int(covered.sum())
            runs = int((covered & ~np.append(False, covered[:-1])).sum())
            text = np.frombuffer(text, np.uint8)[~covered].tobytes()
        out.append((n, removed, runs, text))
    return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept"])


def suffix_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    span: int = SPAN,
    filter_bytes: int = FILTER_BYTES,
    common: int = COMMON,
) -> DataFrame:
    """``docs`` with ``n_bytes, n_removed, n_spans, kept`` in place of columns so named, if any.

    Removed is each byte covered by a string of ``span`` bytes that also starts in a document with
    a smaller id; strings are those of the input and don't cross documents. ``kept`` is the
    remaining bytes.

    A null text is an empty one. Texts shorter than ``span`` lose nothing. Rows with one id are
    one document (and should have one text), null ids together are one document after all
    others. An empty table stays empty; other columns stay as they are.
    """
    losses = repeated_spans(docs, id_col, text_col, span, filter_bytes, common)
    key, gone, result = (fresh(docs, f"_suffix_{x}") for x in ("id", "spans", "result"))
    joined = docs.withColumn(key, known_id(named(docs, id_col))).join(
        losses.select(F.col("id").alias(key), F.col("spans").alias(gone)), key, "left"
    )
    text = F.coalesce(joined[f"`{text_col}`"].cast("string"), F.lit("")).cast("binary")
    removed = F.pandas_udf(_without_spans, "n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    out = joined.withColumn(result, removed(text, F.col(gone)))
    added = ("n_bytes", "n_removed", "n_spans", "kept")
    return out.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in added],
        *[F.col(f"{result}.{c}").alias(c) for c in added],
    )


def drop_repeated_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN) -> DataFrame:
    """``docs`` with the repeated strings cut out of ``text_col``; no row goes, and columns stay.

    Bytes of a character that was cut in the middle go with it.
    """
    out = suffix_dedup(docs.select(named(docs, id_col).alias("id"), named(docs, text_col).alias("text"), F.struct("*").alias("row")), "id", "text", span)
    text = F.pandas_udf(lambda kept: kept.map(lambda b: b.decode("utf-8", "ignore")), "string")(F.col("kept"))
    return out.select(
        *[text.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns]
    )
