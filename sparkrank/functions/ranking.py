"""Column expressions shared by ranked lists, run files and metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: decimals of a score in a run file.
SCORE_DECIMALS = 6


def round_score(score: Column) -> Column:
    """Scores are rounded once, before ranking, so that what is ranked is what is written."""
    return F.round(score.cast("double"), SCORE_DECIMALS)


def discount(rank: Column) -> Column:
    return F.lit(1.0) / F.log2(rank + F.lit(1.0))


def format_run_line(
    query_id: Column, doc_id: Column, rank: Column, score: Column, run_id: Column
) -> Column:
    """Fixed format of a run line: six tab-separated fields, second one constant."""
    return F.format_string(
        "%s\t0\t%s\t%d\t%." + str(SCORE_DECIMALS) + "f\t%s",
        query_id.cast("string"),
        doc_id.cast("string"),
        rank.cast("int"),
        score.cast("double"),
        run_id.cast("string"),
    )
