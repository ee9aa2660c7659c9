"""Column expressions for lexical scoring. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: every character Python's str.split() splits on, and no other.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"

# BM25 saturation and length normalization.
K1 = 1.5
B = 0.75


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, not once per use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tokenize(text: Column) -> Column:
    """Whitespace tokens in order: case kept, punctuation kept, null text -> []."""
    pieces = F.split(F.coalesce(text, F.lit("")), WHITESPACE)
    return F.array_remove(pieces, "")


def term_counts(tokens: Column) -> Column:
    """``array<struct<term string, tf bigint>>`` of one row's tokens.

    Sorting the row's own tokens puts equal terms next to each other, so the
    counts are run lengths and a posting list needs no shuffle by (document, term).
    """

    def runs(s: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)),
        )
        return _bind(
            starts,
            lambda at: F.transform(
                at,
                lambda p, i: F.struct(
                    F.get(s, p).alias("term"),
                    (F.coalesce(F.get(at, i + 1), F.size(s)) - p).cast("bigint").alias("tf"),
                ),
            ),
        )

    empty = F.array().cast("array<struct<term:string,tf:bigint>>")
    return F.when(F.size(tokens) == 0, empty).otherwise(_bind(F.sort_array(tokens), runs))


def bm25_idf(n: Column, df: Column) -> Column:
    return F.log((n - df + F.lit(0.5)) / (df + F.lit(0.5)) + F.lit(1.0))


def bm25_weight(
    idf: Column, tf: Column, dl: Column, avgdl: Column, k1: float = K1, b: float = B
) -> Column:
    """One term's share of one document's score."""
    length = F.lit(1.0 - b) + F.lit(b) * dl / avgdl
    return idf * tf * F.lit(k1 + 1.0) / (tf + F.lit(k1) * length)
