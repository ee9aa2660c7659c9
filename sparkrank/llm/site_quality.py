"""Document quality from text and site, by hierarchical empirical Bayes.

A logistic classifier on the shape of a text gives each document its own evidence. Sites give more: a
host's rate of good documents is shrunk toward the global rate, and a path's toward its host's, by
as much as the spread between groups says (method of moments). All of it is grouped sums, in which a
labelled document counts with its label and any other with its classifier's probability. A
document's posterior takes its own evidence and its path's rate, from which its own part is taken out
at every level: of the path, of the host and of all.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import salted_join
from ..operators.sizing import fits
from ..sources.scratch import materialize
from .columns import ids_and_bytes, known_id, map_arrow, named, outer_id

# Bound on the labelled rows the classifier is fitted on: rows expected, drawn by a hash of the id.
TRAINING_ROWS = 20_000
# What a document without a label counts in its site's sums.
SOFT = 0.25
# Least and most pseudo-documents by which a group is drawn toward its parent.
LEAST_PULL, MOST_PULL = 2.0, 1000.0
KEEP_FROM = 0.5

FEATURES = ["words", "length", "symbols", "pipes", "shouts", "capitals", "repeats", "distinct", "lines", "ends"]
_symbols = re.compile(r"[#*$%&<>]")
_capital = re.compile(r"[A-ZÀ-Þ]")


def shape(text: str) -> list[float]:
    """Numbers about a whole text, most between 0 and 1."""
    words = text.split()
    n, chars = len(words), max(1, len(text))
    lines = [x for x in text.split("\n") if x.strip()]
    return [
        np.log1p(n) / 10,
        min(2.0, (chars - n) / max(1, n) / 10),
        min(1.0, len(_symbols.findall(text)) / chars * 5),
        min(1.0, text.count("|") / max(1, n) * 3),
        min(1.0, text.count("!!") / max(1, n) * 3),
        len(_capital.findall(text)) / chars,
        sum(map(eq, words, words[1:])) / max(1, n),
        # Distinct words against what a text of this length usually has.
        min(1.5, len(set(words)) / max(1.0, n**0.85)),
        len(set(lines)) / max(1, len(lines)),
        sum(x.rstrip()[-1:] in ".!?" for x in lines) / max(1, len(lines)),
    ]


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shape(t.as_py().decode("utf-8", "replace")) for t in batch.column("text")]
        columns = np.array(found, float).reshape(-1, len(FEATURES)).T
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("host"), batch.column("path"), *map(pa.array, columns)],
            names=["id", "host", "path", *FEATURES],
        )


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights and a last intercept, by Newton's steps."""
    x = np.column_stack([x, np.ones(len(x))])
    weights, pull = np.zeros(x.shape[1]), np.full(x.shape[1], ridge * 0.05)
    pull[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - y) + pull * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(curve, gradient)
        weights -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return weights


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p) - F.log1p(-p)


def pull_of(groups: DataFrame, parent: str) -> float:
    """Pseudo-documents by which groups ``(good, n, parent rate)`` are drawn to their parents.

    Method of moments for a Beta spread around the parents' rates: what the groups' rates differ
    beyond what their sizes explain. One row comes to the driver.
    """
    p, n = F.col(parent), F.col("n")
    noise = p * (1 - p)
    found = groups.filter("n > 1").agg(
        F.sum(n * (F.col("good") / n - p) ** 2).alias("spread"),
        F.sum(noise).alias("noise"),
        F.sum(n * noise).alias("all"),
        F.sum(noise * F.lit(1.0)).alias("one"),
    ).first()
    if not found["all"]:
        return MOST_PULL
    # E[n (rate - p)^2] = p (1 - p) (1 + (n - 1) r), with r = 1 / (pull + 1).
    r = (found["spread"] - found["noise"]) / max(1e-9, found["all"] - found["one"])
    return float(np.clip(1 / r - 1 if r > 0 else MOST_PULL, LEAST_PULL, MOST_PULL))


def site_quality(
    docs: DataFrame,
    labels: DataFrame,
    host: Column | str,
    path: Column | str,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    rows: int = TRAINING_ROWS,
    keep_from: float = KEEP_FROM,
    sites: DataFrame | None = None,
) -> DataFrame:
    """``id_col, host, path, text_score, host_rate, path_rate, quality, kept`` per row of ``docs``.

    ``host`` and ``path`` are columns of ``docs``; null ones are groups of their own. ``sites``, if
    given, has ``(doc_id, host, path)`` of some documents, each once, in place of these. ``labels``
    has ``id_col`` and ``label_col`` (1 good, 0 bad); repeated labels count by their mean, null ones
    and those of unknown ids not at all. Without labels every score is one half. A null text
    is an empty one. Rows with one id get that id's label; null ids have none. An empty table gives
    an empty result. Other columns of ``docs`` are not read. ``host_rate`` is that of all the host's
    documents; ``path_rate`` leaves the row's own document out of path, host and whole.
    """
    host, path = (named(docs, c) if isinstance(c, str) else c for c in (host, path))
    placed = docs.select(
        named(docs, id_col), named(docs, text_col),
        F.coalesce(host.cast("string"), F.lit("")).alias("_host"), F.coalesce(path.cast("string"), F.lit("")).alias("_path"),
    )
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    plain = placed.select(
        known_id(F.col(f"`{id_col}`")).alias("id"), text.alias("text"), F.col("_host").alias("host"), F.col("_path").alias("path")
    )
    schema = "id bigint, host string, path string, " + ", ".join(f"{f} double" for f in FEATURES)
    shapes = map_arrow(plain, _shapes, schema)
    known = (
        labels.select(named(labels, id_col).cast("bigint").alias("id"), named(labels, label_col).cast("double").alias("y"))
        .filter("id IS NOT NULL AND y IS NOT NULL")
        .groupBy("id")
        .agg(F.avg("y").alias("y"))
    )
    if sites is not None:
        better = sites.select(F.col("doc_id").alias("id"), F.struct("host", "path").alias("site"))
        shapes = shapes.join(better, "id", "left").select(
            "id",
            F.coalesce("site.host", "host").alias("host"),
            F.coalesce("site.path", "path").alias("path"),
            *FEATURES,
        )
    seen = materialize(shapes.join(known, "id", "left"), "shapes")
    labelled = seen.filter("y IS NOT NULL")
    total = labelled.count()
    drawn = F.pmod(F.xxhash64("id", F.lit("fit")), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.filter(drawn < min(1.0, rows / max(1, total))).select(*FEATURES, "y").toPandas()
    if len(sample):
        weights = fit_logistic(sample[FEATURES].to_numpy(), (sample["y"] >= 0.5).to_numpy(float)).tolist()
    else:
        weights = [0.0] * (len(FEATURES) + 1)
    line = sum((F.col(f) * w for f, w in zip(FEATURES, weights)), F.lit(weights[-1]))
    scored = seen.select("id", "host", "path", "y", (1 / (1 + F.exp(-line))).alias("p")).select(
        "*",
        F.coalesce("y", "p").alias("good"),
        F.when(F.col("y").isNotNull(), 1.0).otherwise(SOFT).alias("n"),
    ).withColumn("good", F.col("good") * F.col("n"))
    paths = materialize(
        scored.groupBy("host", "path").agg(F.sum("good").alias("good"), F.sum("n").alias("n")), "paths"
    )
    hosts = paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    whole = paths.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    base = (whole["good"] + 0.5) / (whole["n"] + 1) if whole["n"] else 0.5
    hosts = hosts.withColumn("base", F.lit(base))
    pull = pull_of(hosts, "base")
    rated = hosts.select(
        "host",
        ((F.col("good") + pull * base) / (F.col("n") + pull)).alias("host_rate"),
        F.struct("good", "n").alias("host_all"),
    )
    paths = materialize(paths.join(rated, "host"), "path-rates")
    path_pull = pull_of(paths, "host_rate")
    site = F.struct("host", "path").alias("site")
    sums = paths.select(site, "host_rate", "host_all", F.struct("good", "n").alias("path_all"))
    placed = scored.select("*", site)
    if fits(sums):
        joined = placed.join(F.broadcast(sums), "site")
    else:
        joined = salted_join(placed, sums, "site", "id")
    everything = F.struct(F.lit(whole["good"] or 0.0).alias("good"), F.lit(whole["n"] or 0.0).alias("n"))

    def others(group: Column, parent: Column, weight: float) -> Column:
        """The rate of a group's other documents, drawn to ``parent``."""
        good = F.greatest(group["good"] - F.col("good"), F.lit(0.0))
        n = F.greatest(group["n"] - F.col("n"), F.lit(0.0))
        return (F.least(good, n) + weight * parent) / (n + weight)

    start = others(everything, F.lit(0.5), 1.0)
    rate = others(F.col("path_all"), others(F.col("host_all"), start, pull), path_pull)
    odds = _logit(F.col("p")) + _logit(F.col("path_rate")) - _logit(start)
    out = joined.withColumn("path_rate", rate).withColumn("quality", 1 / (1 + F.exp(-odds)))
    return out.select(
        outer_id("id").alias(id_col), "host", "path", F.col("p").alias("text_score"), "host_rate", "path_rate", "quality",
        (F.col("quality") >= keep_from).alias("kept"),
    )


def url_sites(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """``(doc_id, host, path)`` of pages whose path names a document by number; one row per document."""
    url = named(pages, url_col)
    found = pages.select(
        F.regexp_extract(url, r"^[a-z]+://[^/?#]+/(?:[^/?#]+/)*?(\d+)(?:[./?#]|$)", 1).alias("id"),
        F.regexp_extract(url, r"^[a-z]+://([^/?#]+)", 1).alias("host"),
        F.regexp_extract(url, r"^[a-z]+://[^/?#]+/([^/?#]*)", 1).alias("path"),
    ).select(F.col("id").try_cast("bigint").alias("doc_id"), "host", "path")
    return (
        found.filter("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min(F.struct("host", "path")).alias("site"))
        .select("doc_id", "site.host", "site.path")
    )
