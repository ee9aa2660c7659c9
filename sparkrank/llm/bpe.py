"""Byte-level BPE as a streaming transducer, and decoding as a byte-to-text state machine.

The encoder reads a text in pieces of any size and gives tokens as soon as no later text can change
them. It holds a bounded buffer, whatever the length of the text:

* The splitting pattern never joins a non-blank to a blank behind it, so text before such a place
  is complete. Without one, single matches of the pattern are final once two characters behind
  them are seen. Within a run that has no end in sight, merging itself is cut.
* Merges are applied in order of rank. What is unseen can change a merge, and that merge another
  one of higher rank on its left, and so on. :func:`sufficient_lookahead` follows these chains
  through the merge list and bounds how far left they reach. A token that ends further left is
  stable. A boundary between stable tokens stays one, so what follows is encoded on its own.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import struct
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .columns import ids_and_texts, map_arrow

# Fixed value: the pattern that byte-level vocabularies of this kind split texts with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Longest stretch of text that is split and merged at once.
LONG = 4096
# Entries of each generation of a worker's cache.
CACHE = 300_000
# Bytes of one stretch that are merged at once, beside those held back.
PIECE = 256
# Ids that are turned into bytes at once.
STEP = 8192

# Ids are below 2**20, and ranks stand above them in one number.
ID_MASK = (1 << 20) - 1
NONE = 1 << 62


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes behind a token after which it can't change any more.

    ``reach[t]``: the farthest that a token ``t`` can begin before the end of what is seen, if what
    is unseen decides whether it is there. At first that is any token at the end itself. A merge
    whose right part is such a token is undecided too, and its left part begins further left; one
    whose left part is such a token gives another token that begins at the same place. Ranks rise
    along a chain, so one pass in rank order follows them all. (Equal ranks are taken from the
    left, so a merge isn't changed by one of its own rank on its right.)
    """
    reach: dict[bytes, int] = {}
    for left, right in merges:
        whole = left + right
        for token in (left, right, whole):
            reach.setdefault(token, len(token))
        begun = reach[right] + len(left)
        same = reach[left]
        reach[left] = max(reach[left], begun)
        reach[whole] = max(reach[whole], begun, same)
    return max(reach.values(), default=1)


class Vocabulary:
    """Tokens, merges and special tokens of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        letters, model = byte_alphabet(), described["model"]
        self.special = {t["content"]: t["id"] for t in described["added_tokens"] if t["special"]}
        tokens = {t: bytes(map(letters.__getitem__, t)) for t in model["vocab"]}
        self.bytes_of = {i: tokens[t] for t, i in model["vocab"].items()}
        self.bytes_of |= {i: text.encode() for text, i in self.special.items()}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        ids = model["vocab"]
        # (left id, right id) as one number: rank and merged id as one number.
        self.merges = {
            ids[a] << 20 | ids[b]: rank << 20 | ids[a + b] for rank, (a, b) in enumerate(pairs)
        }
        self.single = [ids[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.lookahead = sufficient_lookahead([(tokens[a], tokens[b]) for a, b in pairs])

    def merge(self, data: bytes) -> list[int]:
        """The tokens of a stretch without further splits: merges in order of rank."""
        parts, rank_of = [self.single[b] for b in data], self.merges.get
        ranks = [rank_of(a << 20 | b, NONE) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == NONE:
                break
            at = ranks.index(best)  # of equal ranks the leftmost
            parts[at] = best & ID_MASK
            del parts[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = rank_of(parts[at] << 20 | parts[at + 1], NONE)
            if at:
                ranks[at - 1] = rank_of(parts[at - 1] << 20 | parts[at], NONE)
        return parts


class Stretch:
    """Merges of one stretch whose bytes come in pieces; holds back what may still change."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.held = vocabulary, b""

    def feed(self, data: bytes) -> list[int]:
        out, ahead = [], self.vocabulary.lookahead
        for at in range(0, len(data), PIECE):
            self.held += data[at : at + PIECE]
            if len(self.held) < 2 * ahead + PIECE:
                continue
            end, stable = 0, len(self.held) - ahead
            for token in self.vocabulary.merge(self.held):
                size = len(self.vocabulary.bytes_of[token])
                if end + size > stable:
                    break
                end += size
                out.append(token)
            self.held = self.held[end:]
        return out

    def finish(self) -> list[int]:
        out, self.held = self.vocabulary.merge(self.held), b""
        return out


class Recent(dict):
    """Results by key, made when missing; holds two generations of ``limit`` entries at most.

    What is asked for again moves to the young generation, so frequent keys are never lost.
    """

    def __init__(self, make, limit: int):
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key: str) -> bytes:
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if len(key) <= 64:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = found
        return found


_space_after_blank = regex.compile(r"\s ")
_units = regex.compile(r"\s*\S+|\s+")


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Units:
    """Packed ids of texts, by units that no token crosses.

    A unit is blanks and the non-blanks behind them. Most begin with one space and come again and
    again, so their ids are kept. ``encode`` gives the packed ids of a unit.
    """

    def __init__(self, encode, limit: int = CACHE):
        self.encode, self.spaced = encode, Recent(lambda rest: encode(" " + rest), limit)

    def packed(self, text: str) -> bytes:
        if _space_after_blank.search(text):
            return b"".join(map(self.encode, _units.findall(text)))
        first, *rest = text.split(" ")
        head = self.encode(first) if first else b""
        return head + b"".join(map(self.spaced.__getitem__, rest))


class Encoder:
    """The transducer: ``feed`` pieces of a text, then ``finish``; ids come packed."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.pattern = regex.compile(PATTERN)
        # How a run goes on, by the class of its last character.
        self.runs = [regex.compile(x) for x in (r"\p{L}+", r"\p{N}+", r"\s+", r"[^\s\p{L}\p{N}]+")]
        self.words = Recent(self._word, CACHE)
        self.units = Units(self._unit)
        self.margin = max(map(len, vocabulary.special), default=1)
        self.buffer, self.run, self.stretch = "", None, Stretch(vocabulary)

    def _word(self, word: str) -> bytes:
        data = word.encode()
        if len(data) > PIECE:
            return pack(self.stretch.feed(data) + self.stretch.finish())
        return pack(self.vocabulary.merge(data))

    def _unit(self, unit: str) -> bytes:
        if len(unit) > LONG:
            return self._long(unit)
        return b"".join(map(self.words.__getitem__, self.pattern.findall(unit)))

    def _long(self, unit: str) -> bytes:
        """A unit too long to be split at once: through a buffer of its own."""
        inner = Encoder.__new__(Encoder)
        inner.__dict__ = self.__dict__ | {"buffer": "", "run": None, "stretch": Stretch(self.vocabulary)}
        out = [inner._matches(unit[at : at + LONG], False) for at in range(0, len(unit), LONG)]
        return b"".join([*out, inner._matches("", True)])

    def _matches(self, text: str, last: bool) -> bytes:
        """Split without safe places: final matches, or what is stable of one open run."""
        self.buffer += text
        out = []
        while self.buffer:
            if self.run is not None:
                found = self.run.match(self.buffer)
                end = found.end() if found else 0
                blank = self.run is self.runs[2]
                # The last blank of a run may belong to what follows.
                take = end - 1 if blank and end and not (last and end == len(self.buffer)) else end
                if take > 0:
                    out.append(pack(self.stretch.feed(self.buffer[:take].encode())))
                    self.buffer = self.buffer[take:]
                if end == take + len(self.buffer) and not last:
                    break  # the run may go on
                out.append(pack(self.stretch.finish()))
                self.run = None
                continue
            done = 0
            for match in self.pattern.finditer(self.buffer):
                if not last and match.end() > len(self.buffer) - 2:
                    break
                if match.end() - match.start() > LONG:
                    break
                out.append(self.words[match.group()])
                done = match.end()
            self.buffer = self.buffer[done:]
            if len(self.buffer) <= LONG:
                if last and self.buffer:
                    continue
                break
            self._open()
        if last and self.run is not None:
            out.append(pack(self.stretch.finish()))
            self.run = None
        return b"".join(out)

    def _open(self) -> None:
        """Begin a run: the buffer starts with a match longer than any that is taken at once."""
        lead = self.buffer[0] == " " and not self.buffer[1].isspace()
        if lead:
            self.stretch.feed(b" ")
            self.buffer = self.buffer[1:]
        self.run = next(r for r in self.runs if r.match(self.buffer[:1]))

    def _complete(self, text: str) -> bytes:
        """A text that ends where no token can go on."""
        return self.units.packed(text)

    def feed(self, text: str) -> bytes:
        self.buffer += text
        out = [self._specials()]
        # Not into what may be the start of a special token.
        cut = self._safe_place(len(self.buffer) - self.margin)
        if cut > 0:
            out.append(self._complete(self.buffer[:cut]))
            self.buffer = self.buffer[cut:]
        return b"".join(out)

    def finish(self) -> bytes:
        out = self._specials() + self._complete(self.buffer)
        self.buffer = ""
        return out

    def _specials(self) -> bytes:
        out = []
        for special, i in self.vocabulary.special.items():
            while special in self.buffer:
                before, _, self.buffer = self.buffer.partition(special)
                out += [self._complete(before), pack([i])]
        return b"".join(out)

    def _safe_place(self, most: int) -> int:
        """The last place up to ``most`` with a non-blank before and a blank behind it, or 0."""
        while most > 0:
            at = self.buffer.rfind(" ", 1, most)
            if at < 1:
                return 0
            if not self.buffer[at - 1].isspace():
                return at
            most = at
        return 0

    def encode(self, text: str, step: int = 1 << 18) -> bytes:
        """Packed ids of a whole text."""
        if len(text) <= step:
            self.buffer = text
            return self.finish()
        out = [self.feed(text[at : at + step]) for at in range(0, len(text), step)]
        return b"".join([*out, self.finish()])


class Decoder:
    """Ids to text. The state is the bytes of a character that is not complete yet, three at most."""

    def __init__(self, vocabulary: Vocabulary):
        self.bytes_of = vocabulary.bytes_of
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.state.decode(b"".join(map(self.bytes_of.__getitem__, ids)))

    def finish(self) -> str:
        text = self.state.decode(b"", True)
        self.state.reset()
        return text


@cache
def vocabulary(path: str) -> Vocabulary:
    """Read once per worker."""
    return Vocabulary(path)


@cache
def encoder(path: str) -> Encoder:
    return Encoder(vocabulary(path))


def unpack(packed: bytes) -> list[int]:
    return np.frombuffer(packed, "<u4").tolist()


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            packed = [own.encode(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(packed, pa.binary())], names=["id", "ids"]
            )

    return run


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids)`` per row: ids as little-endian unsigned 32-bit numbers.

    A null text is an empty one and has no ids. Special tokens written out in a text are taken as
    such. Null ids and repeated rows pass through; an empty table gives an empty result.
    """
    rows = ids_and_texts(docs, id_col, text_col)
    return map_arrow(rows, _encode(path), "id bigint, ids binary")


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Decoder(vocabulary(path))
        for batch in batches:
            texts = []
            for packed in batch.column("ids"):
                ids = unpack(packed.as_py() or b"")
                parts = [machine.feed(ids[at : at + STEP]) for at in range(0, len(ids), STEP)]
                texts.append("".join([*parts, machine.finish()]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(texts, pa.string())], names=["id", "text"]
            )

    return run


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """``(id, text)`` of ``(id, ids)``; bytes that are no UTF-8 become replacement characters."""
    return map_arrow(encoded.select("id", "ids"), _decode(path), "id bigint, text string")


def _round_trip(path: str):
    names = [str(i) for i in range(max(vocabulary(path).bytes_of) + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, machine = encoder(path), Decoder(vocabulary(path))
        for batch in batches:
            sizes, id_hashes, text_hashes = [], [], []
            for text in batch.column("text"):
                ids = unpack(own.encode(text.as_py()))
                sizes.append(len(ids))
                id_hashes.append(hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
                digest = hashlib.sha256()
                for at in range(0, len(ids), STEP):
                    digest.update(machine.feed(ids[at : at + STEP]).encode())
                digest.update(machine.finish().encode())
                text_hashes.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(id_hashes, pa.string()),
                    pa.array(text_hashes, pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of ids and of decoded text per row, both made as the stream goes by."""
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_arrow(ids_and_texts(docs, id_col, text_col), _round_trip(path), schema)
