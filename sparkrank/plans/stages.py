"""Ranking stages and their chaining."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.approx import VectorIndex
from ..operators.corpus import restrict
from ..operators.dense import cosine_rerank, cosine_search
from ..operators.graph import BEAM, GraphIndex
from ..operators.lexical import LexicalIndex
from ..operators.models import BATCH, model_rerank, model_search
from ..operators.validate import required, with_required
from ..sources.scratch import materialize


class Stage(Protocol):
    """``search`` ranks for all queries at once: ``(query_id, doc_id, score, rank)``.

    ``candidates`` are pairs ``(query_id, doc_id[, rank])``, or ids ``(doc_id)`` that are
    candidates of every query, or None for the whole collection. Any object with this method
    and a ``label`` can be used as a stage. One that doesn't look at its candidates may say so by
    ``reads_candidates = False``; then stages before it are not run.
    """

    label: str

    def search(
        self, queries: DataFrame, candidates: DataFrame | None, k: int
    ) -> DataFrame: ...


def _shared(candidates: DataFrame | None) -> bool:
    """No pairs are made where all queries look through the same documents."""
    return candidates is None or "query_id" not in candidates.columns


def _texts(queries: DataFrame) -> DataFrame:
    """Texts of the queries asked; a query without one is an error."""
    return queries.select("query_id", required(F.col("text"), F.col("query_id")).alias("text"))


@dataclass(frozen=True)
class Bm25Stage:
    index: LexicalIndex

    @property
    def label(self) -> str:
        return f"BM25({self.index.k1}-{self.index.b})"

    def search(self, queries: DataFrame, candidates: DataFrame | None, k: int) -> DataFrame:
        if _shared(candidates):
            return self.index.search(_texts(queries), k, candidates)
        return self.index.rerank(_texts(queries), candidates, k)


@dataclass(frozen=True)
class CosineStage:
    doc_vectors: DataFrame
    query_vectors: DataFrame
    label: str = "Cos()"

    def search(self, queries: DataFrame, candidates: DataFrame | None, k: int) -> DataFrame:
        wanted = with_required(queries, self.query_vectors, "query_id", "embedding")
        if _shared(candidates):
            return cosine_search(restrict(self.doc_vectors, candidates), wanted, k)
        return cosine_rerank(candidates, self.doc_vectors, wanted, k)


@dataclass(frozen=True)
class ApproxStage:
    """Approximate search. Like a graph index it looks through the whole collection even as a
    later stage, unless ``respect_candidates`` is set."""

    index: VectorIndex
    query_vectors: DataFrame
    nprobe: int
    respect_candidates: bool = False
    name: str | None = None

    @property
    def label(self) -> str:
        return self.name or f"IVF({self.nprobe})"

    @property
    def reads_candidates(self) -> bool:
        return self.respect_candidates

    def search(self, queries: DataFrame, candidates: DataFrame | None, k: int) -> DataFrame:
        wanted = with_required(queries, self.query_vectors, "query_id", "embedding")
        if not self.respect_candidates:
            return self.index.search(wanted, k, self.nprobe)
        if _shared(candidates):
            return self.index.search(wanted, k, self.nprobe, candidates)
        return self.index.rerank(candidates, wanted, k, self.nprobe)


@dataclass(frozen=True)
class GraphStage:
    """Approximate search by a walk of the neighbour graph, always through the whole collection."""

    index: GraphIndex
    query_vectors: DataFrame
    beam: int = BEAM
    name: str | None = None

    @property
    def label(self) -> str:
        return self.name or f"Graph({self.index.degree}-{self.beam})"

    @property
    def reads_candidates(self) -> bool:
        return False

    def search(self, queries: DataFrame, candidates: DataFrame | None, k: int) -> DataFrame:
        wanted = with_required(queries, self.query_vectors, "query_id", "embedding")
        return self.index.search(wanted, k, self.beam)


@dataclass(frozen=True)
class ModelStage:
    """Pairwise model over query and passage texts (a cross-encoder)."""

    collection: DataFrame
    loader: Callable
    model_name: str
    batch_size: int = BATCH

    @property
    def label(self) -> str:
        return f"C({self.model_name})"

    def search(self, queries: DataFrame, candidates: DataFrame | None, k: int) -> DataFrame:
        asked = _texts(queries)
        if _shared(candidates):
            passages = restrict(self.collection, candidates)
            return model_search(passages, asked, self.loader, k, self.batch_size)
        return model_rerank(self.collection, asked, candidates, self.loader, k, self.batch_size)


@dataclass(frozen=True)
class Ranking:
    """Stages in order. Each gets the documents of the one before; scores are replaced."""

    stages: Sequence[Stage] = field(default_factory=tuple)

    @property
    def label(self) -> str:
        return ", ".join(stage.label for stage in self.stages)

    def retrieve(
        self,
        queries: DataFrame,
        depths: Sequence[int],
        candidates: DataFrame | None = None,
        strict: bool = True,
        known: list[tuple[list, DataFrame]] | None = None,
    ) -> DataFrame:
        """Run all stages for all queries.

        ``known`` keeps what the first stages of rankings gave, as ``([(stage, depth), ...],
        written list)``, for further rankings of the same queries that begin with them.

        ``depths`` gives each stage's k. With ``strict=False`` surplus stages or depths are
        ignored. What one stage hands to the next is written: at most k rows per query, whose
        size then decides how the next stage joins.
        """
        if strict and len(depths) != len(self.stages):
            raise ValueError(f"{len(self.stages)} stages but {len(depths)} depths")
        steps = list(zip(self.stages, depths, strict=False))
        if not steps:
            if candidates is None:
                raise ValueError("no stage and no candidates")
            return _unscored(candidates)
        # What comes before a stage that looks through everything again is not needed.
        unread = [i for i, (s, _) in enumerate(steps) if not getattr(s, "reads_candidates", True)]
        steps = steps[unread[-1] if unread else 0 :]
        ranked, done = candidates, 0
        for prefix, frame in known or []:
            if done < len(prefix) <= len(steps) and prefix == steps[: len(prefix)]:
                ranked, done = frame, len(prefix)
        for i, (stage, k) in enumerate(steps[done:], done):
            ranked = stage.search(queries, ranked, k)
            if i < len(steps) - 1 or known is not None:
                ranked = materialize(ranked, "stage")
            if known is not None:
                known.append((steps[: i + 1], ranked))
        return ranked


def _unscored(candidates: DataFrame) -> DataFrame:
    if "rank" not in candidates.columns:
        raise ValueError("candidates without a rank have no order to keep")
    score = F.lit(None).cast("double").alias("score")
    return candidates.select("query_id", "doc_id", score, "rank")
