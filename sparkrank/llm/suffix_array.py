"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

Suffixes are classified as smaller or larger than their right neighbour. The leftmost of each run of
smaller ones are sorted by their substrings, which is done recursively where substrings tie; all
other suffixes are induced from them, in one pass over the buckets each way. Over a small alphabet
a pass handles a bucket at a time in whole arrays; over the names of a recursion it walks.
"""

from __future__ import annotations

import numpy as np

# Alphabets up to this size are induced bucket by bucket, larger ones sorted by doubling.
FEW_SYMBOLS = 1024


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of all suffixes of ``text`` (numbers from 0) in order; a shorter prefix is first."""
    if len(text) < 2:
        return np.arange(len(text))
    closed = np.append(text.astype(np.int64) + 1, 0)
    return _sorted(closed, int(closed.max()) + 1)[1:]


def smaller_suffixes(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one behind it; the last one counts as smaller."""
    n = len(text)
    differs = np.append(text[:-1] != text[1:], True)
    smaller = np.append(text[:-1] < text[1:], True)
    # Within a run of one symbol, the place where it ends decides.
    end = np.where(differs, np.arange(n), n)
    end = np.minimum.accumulate(end[::-1])[::-1]
    return smaller[end]


def _packed(text: np.ndarray, bits: int, width: int) -> np.ndarray:
    """By position, ``width`` symbols from there as one number, the first one highest; 0 after the end."""
    n, closed = len(text), np.append(text.astype(np.int64), np.zeros(width, np.int64))
    out = closed[:n].copy()
    for offset in range(1, width):
        out <<= bits
        out |= closed[offset : n + offset]
    return out


def _doubled(text: np.ndarray) -> np.ndarray:
    """The order of all suffixes of ``text``, whose last symbol is the only 0."""
    n, bits = len(text), max(1, int(text.max()).bit_length())
    width = max(1, min(62 // bits, n))
    keys = _packed(text, bits, width)
    slots, order = np.arange(n), np.argsort(keys)
    rank, own, keys = np.empty(n, np.int64), order, keys[order]
    while True:
        first = np.append(True, keys[1:] != keys[:-1])
        # A rank is the first place of those that are equal so far.
        rank[own] = np.maximum.accumulate(np.where(first, slots, 0))
        slots = slots[~(first & np.append(first[1:], True))]
        if not len(slots):
            return order
        own = order[slots]
        keys = rank[own] * n + rank[own + width]
        by = np.argsort(keys)
        own, keys = own[by], keys[by]
        order[slots] = own
        width *= 2


def _sorted(text: np.ndarray, symbols: int) -> np.ndarray:
    if symbols > FEW_SYMBOLS:
        return _doubled(text)
    n, small = len(text), smaller_suffixes(text)
    leftmost = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(leftmost) == 1:
        return _induced(text, small, leftmost, symbols)
    # Sorted by substrings up to the next leftmost one.
    order = _induced(text, small, leftmost, symbols)
    is_leftmost = np.zeros(n, bool)
    is_leftmost[leftmost] = True
    ranked = order[is_leftmost[order]]
    names = _named(text, small, leftmost, ranked)
    place = np.empty(n, np.int64)
    place[ranked] = names
    reduced = place[leftmost]
    if names[-1] + 1 == len(leftmost):
        return _induced(text, small, ranked, symbols)
    return _induced(text, small, leftmost[_sorted(reduced, int(names[-1]) + 1)], symbols)


def _named(text, small, leftmost, ranked) -> np.ndarray:
    """Names in order; equal substrings share one."""
    n = len(text)
    following = np.empty(n, np.int64)
    following[leftmost[:-1]] = leftmost[1:]
    following[leftmost[-1]] = n - 1
    a, b = ranked[:-1], ranked[1:]
    same = (following[a] - a) == (following[b] - b)
    left, offset = np.flatnonzero(same), 0
    while len(left):
        equal = text[a[left] + offset] == text[b[left] + offset]
        same[left[~equal]] = False
        left = left[equal]
        offset += 1
        left = left[following[a[left]] - a[left] >= offset]
    # The end of all is a substring of its own.
    same[(a == n - 1) | (b == n - 1)] = False
    return np.append(0, np.cumsum(~same))


def _induced(text, small, leftmost, symbols) -> np.ndarray:
    """The order induced by ``leftmost`` ones, which are in order within each bucket."""
    sizes = np.bincount(text, minlength=symbols)
    ends = np.cumsum(sizes)
    return _by_buckets(text, small, leftmost, ends - sizes, ends)


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A stable order by key, the keys present, and where each begins."""
    order = np.argsort(keys, kind="stable")
    inner = keys[order]
    starts = np.flatnonzero(np.append(True, inner[1:] != inner[:-1]))
    return order, inner[starts], starts


def _by_buckets(text, small, leftmost, heads, ends) -> np.ndarray:
    n = len(text)
    symbols = text.astype(np.int16)
    order = np.full(n, -1, np.int64)
    # Larger suffixes, from the left: from larger ones first, then from the leftmost smaller ones.
    by, keys, starts = _grouped(symbols[leftmost])
    seeds = dict(zip(keys.tolist(), np.split(leftmost[by], starts[1:])))
    at = heads.copy()

    def put(found):
        by, keys, starts = _grouped(symbols[found])
        found = found[by]
        counts = np.diff(np.append(starts, len(found)))
        order[np.repeat(at[keys] - starts, counts) + np.arange(len(found))] = found
        at[keys] += counts

    for symbol in range(len(heads)):
        done = int(heads[symbol])
        while done < at[symbol]:
            here = order[done : at[symbol]]
            done = int(at[symbol])
            found = here[here > 0] - 1
            found = found[~small[found]]
            if len(found):
                put(found)
        if symbol in seeds:
            found = seeds[symbol] - 1
            found = found[(found >= 0)]
            found = found[~small[found]]
            if len(found):
                put(found)
    # Smaller suffixes, from the right.
    larger_ends = at.copy()
    at = ends.copy()

    def put_back(found):
        by, keys, starts = _grouped(symbols[found])
        found = found[by]
        counts = np.diff(np.append(starts, len(found)))
        # The first found stands last in its bucket.
        order[np.repeat(at[keys] - 1 + starts, counts) - np.arange(len(found))] = found
        at[keys] -= counts

    for symbol in range(len(heads) - 1, -1, -1):
        done = int(ends[symbol])
        while done > at[symbol]:
            here = order[at[symbol] : done][::-1]
            done = int(at[symbol])
            found = here[here > 0] - 1
            found = found[small[found]]
            if len(found):
                put_back(found)
        here = order[heads[symbol] : larger_ends[symbol]][::-1]
        found = here[here > 0] - 1
        found = found[small[found]]
        if len(found):
            put_back(found)
        if symbol == 0 and at[0] == 1:
            order[0] = n - 1  # the end itself, which nothing induces
    order[0] = n - 1
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Permuted common prefixes: by position, the length shared with the suffix before it in
    ``order``, ``most`` at most."""
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)
    left = np.flatnonzero(before >= 0)
    # Several symbols are compared at a time; what is behind the end equals none.
    bits = (int(text.max(initial=0)) + 1).bit_length()
    width = max(1, 62 // bits)
    words = np.append(_packed(text + 1, bits, width), 0)
    for offset in range(0, most, width):
        differ = words[np.minimum(left + offset, n)] ^ words[np.minimum(before[left] + offset, n)]
        same = differ == 0
        ends, differ = left[~same], differ[~same]
        for behind in range(1, width):
            shared[ends] += differ >> (bits * behind) == 0
        left = left[same]
        shared[left] += width
        if not len(left):
            break
    return np.minimum(shared, most)
