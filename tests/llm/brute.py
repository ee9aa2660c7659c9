"""Plain versions of the operators' contracts, one document after another."""

import hashlib
import re
import zlib

import public_tokenizers
import xxhash
from tokenizers import Tokenizer

BLANKS = " \t\n\x0b\x0c\r"
LAST = 2**63 - 1
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def ordered(docs):
    """(id, text) with null ids last and null texts empty, by id."""
    return sorted(((LAST if i is None else i, t or "") for i, t in docs), key=lambda d: d[0])


def line_key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(BLANKS))


def line_dedup(docs):
    """{id: (lines, dropped, kept text)}"""
    first, many = {}, set()
    for i, text in ordered(docs):
        for line in text.split("\n"):
            key = line_key(line)
            if len(key) >= 10 and first.setdefault(key, i) != i:
                many.add(key)
    out = {}
    for i, text in ordered(docs):
        lines = text.split("\n")
        kept = [x for x in lines if not (line_key(x) in many and first[line_key(x)] != i)]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(docs, radius=2):
    """{id: (fingerprint, smallest id reachable)}"""
    docs = ordered(docs)
    prints = [fingerprint(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a in range(len(docs)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (p, docs[find(n)][0]) for n, ((i, _), p) in enumerate(zip(docs, prints))}


def suffix_dedup(docs, span=50):
    """{id: (bytes, removed, runs, kept bytes)}"""
    first, out = {}, {}
    for i, text in ordered(docs):
        data = text.encode()
        gone = bytearray(len(data))
        for at in range(len(data) - span + 1):
            if first.setdefault(data[at : at + span], i) < i:
                gone[at : at + span] = b"\1" * span
        runs = sum(g and not (n and gone[n - 1]) for n, g in enumerate(gone))
        out[i] = (len(data), sum(gone), runs, bytes(c for c, g in zip(data, gone) if not g))
    return out


def ids(text):
    return TOKENIZER.encode(text, add_special_tokens=False).ids


def pieces(docs, capacity=1024):
    """[(id, piece, start, length, crc)]"""
    out = []
    for i, text in docs:
        own = [*ids(text or ""), 2]
        first = len(own) % capacity or capacity
        starts = [0, *range(first, len(own), capacity)]
        for n, (a, b) in enumerate(zip(starts, [*starts[1:], len(own)])):
            data = b"".join(x.to_bytes(4, "little") for x in own[a:b])
            out.append((i, n, a, b - a, zlib.crc32(data)))
    return out


def rules(text):
    """(words, word chars, symbols, repeated lines, repeated words, failed)"""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed,
    )


def check_sequences(rows, capacity=1024):
    """Sequences without gaps or overflow; how many there are. rows: (sequence, offset, length)"""
    by = {}
    for sequence, offset, length in rows:
        by.setdefault(sequence, []).append((offset, length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)
