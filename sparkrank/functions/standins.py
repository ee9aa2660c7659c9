"""Small models without weights, for tests and for checks against SQL.

Real encoders and pairwise models enter through the same hooks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import lru_cache

import numpy as np


class HashedBagEncoder:
    """Loader of an encoder: token counts in ``dim`` slots chosen by the token's MD5."""

    def __init__(self, dim: int = 64):
        self.dim = dim

    def __call__(self):
        dim = self.dim

        @lru_cache(maxsize=100_000)
        def slot(token: str) -> int:
            return int(hashlib.md5(token.encode()).hexdigest()[:4], 16) % dim

        def encode(texts: Sequence[str]) -> np.ndarray:
            out = np.zeros((len(texts), dim), dtype=np.float32)
            for row, text in enumerate(texts):
                slots = [slot(token) for token in text.split()]
                out[row] = np.bincount(slots, minlength=dim) if slots else 0
            return out

        return encode


class TokenOverlapScorer:
    """Loader of a pairwise scorer: share of the query's distinct tokens found in the passage."""

    def __call__(self):
        @lru_cache(maxsize=4096)
        def tokens(text: str) -> frozenset[str]:
            return frozenset(text.split())

        def score(queries: Sequence[str], passages: Sequence[str]) -> list[float]:
            out = []
            for query, passage in zip(queries, passages, strict=True):
                asked = tokens(query)
                out.append(len(asked & tokens(passage)) / len(asked) if asked else 0.0)
            return out

        return score
