from .ranking import discount, format_run_line, round_score
from .sums import exact_sum
from .text import bm25_idf, bm25_weight, term_counts, tokenize
from .vectors import cosine, dot, l2_norm, l2_normalize

__all__ = [
    "bm25_idf", "bm25_weight", "term_counts", "tokenize",
    "cosine", "dot", "l2_norm", "l2_normalize",
    "discount", "exact_sum", "format_run_line", "round_score",
]
