"""Spelling variants of frequent words by dense prefix-suffix tiles.

Two words differ by one edit exactly if their common prefix and common suffix together reach the
longer length minus one. Cut the shorter word's length in two halves: an edit leaves one of them as
it is, so a near pair shares its first half or its last half. Words that share a half are a block.

1. Words are counted; counts are combined where texts are read.
2. Each word goes to its blocks: per half, and as the shorter or the longer word of a pair. Blocks
   over ``TILE`` words are cut into tiles, and pairs of tiles are dealt out over tasks.
3. A task compares two tiles as padded code-point matrices, all words with all, and sends per word
   how many it found near and the most frequent of them, never the pairs.
4. Forms are followed to their roots by pointer jumping; counts double at each step of a chain, so
   its length is at most the logarithm of the largest count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import hinted
from ..operators.sizing import fits
from ..sources.scratch import materialize
from .columns import map_arrow, named

# Runs of letters that are words.
RUN = r"[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS, MIN_COUNT = 5, 3
# A word's form is at least so many times as frequent.
RATIO = 2
# Most words of a tile, and most code points of its matrix where words are very long.
TILE, CELLS = 1024, 4_000_000
BLOCK = ["size", "side", "half"]


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_count: int = MIN_COUNT,
    typo_every: int | None = None,
) -> DataFrame:
    """``(word, n)``: words of at least ``min_chars`` code points found ``min_count`` times or more.

    Words are runs of letters with A-Z lower-cased. With ``typo_every``, a run of which the CRC-32
    of ``<id>:<run>`` is divisible by it loses one code point, the one that number names; a null id
    is written as nothing. Null texts have no words.
    """
    rows = docs.select(
        F.coalesce(named(docs, id_col).cast("string"), F.lit("")).alias("id"),
        named(docs, text_col).cast("string").alias("text"),
    )
    runs = rows.select("id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    # The plain lower() is right for ASCII words, and much faster.
    ascii_only = F.octet_length("run") == F.char_length("run")
    lowered = F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", _UPPER, _LOWER))
    words = runs.filter(F.char_length("run") >= min_chars).select("id", lowered.alias("word"))
    if typo_every:
        code = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
        at = F.pmod(F.col("code"), F.char_length("word")).cast("int")
        rest = F.substr("word", at + 2, F.char_length("word"))
        shorter = F.concat(F.substr("word", F.lit(1), at), rest)
        words = words.withColumn("code", code).select(
            F.when(F.col("code") % typo_every == 0, shorter).otherwise(F.col("word")).alias("word")
        )
    counted = words.filter(F.char_length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= min_count)


def _blocks(words: DataFrame, min_chars: int) -> DataFrame:
    """``words(word, n)`` once per block: ``size`` is the shorter length of the pairs looked for."""
    keys = []
    for less in (0, 1):
        size = F.char_length("word") - less
        front = F.floor(size / 2).cast("int")
        keys += [
            F.struct(size.alias("size"), F.lit(0).alias("side"), F.substr("word", F.lit(1), front).alias("half")),
            F.struct(size.alias("size"), F.lit(1).alias("side"), F.right("word", size - front).alias("half")),
        ]
    out = words.select("word", "n", F.explode(F.array(*keys)).alias("key")).select("key.*", "word", "n")
    return out.filter(F.col("size") >= min_chars)


def _tiles(words: DataFrame, tile: int, min_chars: int) -> DataFrame:
    """``(size, side, half, part, parts, rows)`` with at most about ``tile`` words in ``rows``."""
    blocks = _blocks(words, min_chars)
    room = F.greatest(F.lit(2), F.least(F.lit(tile), F.floor(F.lit(CELLS) / F.col("size")))).cast("bigint")
    crowded = blocks.groupBy(*BLOCK).agg(F.count("*").alias("_n")).filter(F.col("_n") > room)
    crowded = materialize(crowded.select(*BLOCK, F.ceil(F.col("_n") / room).cast("int").alias("parts")), "spelling-crowded")
    parted = blocks.join(hinted(crowded, fits(crowded)), BLOCK, "left").withColumn(
        "parts", F.coalesce("parts", F.lit(1))
    )
    part = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    tiles = parted.groupBy(*BLOCK, part.alias("part"), "parts").agg(
        F.collect_list(F.struct("n", "word")).alias("rows")
    )
    return tiles.filter((F.col("parts") > 1) | (F.size("rows") > 1))


def _pairs_of_tiles(tiles: DataFrame) -> DataFrame:
    """Each tile with itself, and each two tiles of a block once."""
    itself = tiles.select(*BLOCK, "rows", F.lit(None).cast(tiles.schema["rows"].dataType).alias("others"))
    several = tiles.filter("parts > 1")
    # Of two tiles, each is the one that travels about as often.
    partners = F.filter(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda j: (j != F.col("part")) & ((F.col("part") < j) == ((F.col("part") + j) % 2 == 1)),
    )
    sent = several.select(*BLOCK, "rows", F.explode(partners).alias("part"))
    across = sent.join(several.select(*BLOCK, "part", F.col("rows").alias("others")), [*BLOCK, "part"])
    return itself.unionByName(across.drop("part"))


class Tile:
    """Words of one block by falling count, as padded matrices of code points."""

    def __init__(self, words: list[str], counts: np.ndarray, size: int):
        order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
        self.words = [words[i] for i in order]
        self.n = counts[order]
        points = np.array(self.words, dtype=f"U{size + 1}").view(np.uint32).reshape(len(words), size + 1)
        points = points.astype(np.uint8) if points.max() < 256 else points
        longer = points[:, size] != 0
        self.short, self.long = np.flatnonzero(~longer), np.flatnonzero(longer)
        # From the front, and from the back: the last column is the last code point of each.
        self.front = points
        self.back = points.copy()
        self.back[self.short, 1:] = points[self.short, :-1]
        self.near = np.zeros(len(words), np.int64)
        self.best: dict[int, tuple[int, str]] = {}

    def note(self, rows: np.ndarray, near: np.ndarray, other: Tile, columns: np.ndarray) -> None:
        """``near[i, j]``: row ``i`` of ``rows`` and ``j`` of the other's ``columns`` are near."""
        found = near.sum(axis=1)
        self.near[rows] += found
        first = near.argmax(axis=1)
        for i in np.flatnonzero(found):
            j = columns[first[i]]
            mine, new = int(rows[i]), (-int(other.n[j]), other.words[j])
            if mine not in self.best or new < self.best[mine]:
                self.best[mine] = new


def _common(a: np.ndarray, b: np.ndarray, columns: range) -> np.ndarray:
    """How many of ``columns``, in their order, two rows share before they first differ."""
    shared = np.zeros((len(a), len(b)), np.uint8 if len(columns) < 250 else np.int32)
    alive = np.ones(shared.shape, bool)
    for c in columns:
        alive &= a[:, c, None] == b[None, :, c]
        if not alive.any():
            break
        shared += alive
    return shared.astype(np.int32) if len(columns) >= 120 else shared


def near_words(a: Tile, rows: np.ndarray, b: Tile, columns: np.ndarray, size: int, side: int) -> np.ndarray:
    """Which words of length ``size`` in ``a`` are one edit from words of ``b`` in the same block.

    Pairs that share both halves are told in the block of their first half only.
    """
    longer = len(columns) > 0 and b.front[columns[0], size] != 0
    prefix = _common(a.front[rows], b.front[columns], range(size))
    suffix = _common(a.back[rows], b.back[columns], range(size, 0, -1))
    near = prefix + suffix >= size - 1 + longer
    if not longer:
        near &= prefix < size  # else the same word
    if side:
        near &= prefix < size // 2
    return near


def compare(a: Tile, b: Tile | None, size: int, side: int) -> None:
    """Note all near pairs between two tiles, or within one."""
    other = b or a
    pairs = [(a, a.short, other, other.short), (a, a.short, other, other.long)]
    if b:
        pairs.append((b, b.short, a, a.long))
    for x, rows, y, columns in pairs:
        if len(rows) and len(columns):
            near = near_words(x, rows, y, columns, size, side)
            if near.any():
                x.note(rows, near, y, columns)
                if not (x is y and rows is columns):
                    y.note(columns, near.T, x, rows)


def _found(tiles: list[Tile]) -> pa.RecordBatch:
    rows = [(t.words[i], int(t.near[i]), -t.best[i][0], t.best[i][1]) for t in tiles for i in sorted(t.best)]
    columns = list(zip(*rows)) if rows else [[]] * 4
    types = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], names=["word", "near", "form_n", "form"]
    )


def _compare_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def tile(rows, size):
        return Tile([r["word"] for r in rows], np.array([r["n"] for r in rows], np.int64), size)

    for batch in batches:
        held = []
        for at in range(batch.num_rows):
            size, side, rows, others = (batch.column(c)[at].as_py() for c in ("size", "side", "rows", "others"))
            if not any(len(r["word"]) == size for r in rows + (others or [])):
                continue
            a, b = tile(rows, size), others and tile(others, size)
            compare(a, b, size, side)
            held += [a, b] if b else [a]
        yield _found(held)


def near_forms(words: DataFrame, ratio: int = RATIO, tile: int = TILE, min_chars: int = MIN_CHARS) -> DataFrame:
    """``words(word, n)``, words of ``min_chars`` or more, with ``n_near, form, form_n``.

    ``form`` is the most frequent near word (of equals the first in code-point order) if it is at
    least ``ratio`` times as frequent, else null.
    """
    tiles = materialize(_tiles(words, tile, min_chars), "spelling-tiles")
    found = map_arrow(
        _pairs_of_tiles(tiles).select("size", "side", "rows", "others"),
        _compare_tiles,
        "word string, near bigint, form_n bigint, form string",
    )
    # Of equal counts the first word: the least of (-count, word).
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form")))
    merged = found.groupBy(F.col("word").alias("_word")).agg(F.sum("near").alias("near"), best.alias("best"))
    joined = words.join(merged, words["word"] == merged["_word"], "left")
    enough = -F.col("best.less") >= ratio * F.col("n")
    return joined.select(
        "word",
        "n",
        F.coalesce("near", F.lit(0)).alias("n_near"),
        F.when(enough, F.col("best.form")).alias("form"),
        F.when(enough, -F.col("best.less")).alias("form_n"),
    )


def roots(links: DataFrame) -> DataFrame:
    """``(word, root)`` of ``links(word, form)``: where a chain of forms ends, each step halving it."""
    state = materialize(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = state.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        moved = materialize(moved, "spelling-roots")
        state = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return state


def spelling_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    typo_every: int | None = None,
    tile: int = TILE,
) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``, one row per word of :func:`word_counts`.

    Near are words that differ by one inserted, deleted or replaced code point; see
    :func:`near_forms` for ``form``. ``root`` is where following forms ends, the word itself if it
    has none. Null and empty texts have no words, repeated rows count each, an empty table gives an
    empty result, words may be of any length, and columns beside id and text are not read.
    """
    words = materialize(word_counts(docs, id_col, text_col, min_chars, min_count, typo_every), "spelling-words")
    formed = materialize(near_forms(words, ratio, tile, min_chars), "spelling-forms")
    ends = roots(formed.filter("form IS NOT NULL")).withColumnRenamed("word", "_word")
    out = formed.join(ends, formed["word"] == ends["_word"], "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
