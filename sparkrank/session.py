"""Session settings the operators are written for."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark import SparkContext
from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Depths above 1000 keep their map-side top-k as well.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add :data:`SETTINGS` to a session builder."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> SparkContext:
    """Make this package importable in the executors' Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        base = os.path.join(tempfile.mkdtemp(prefix="sparkrank-zip-"), "sparkrank")
        context.addPyFile(
            shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package))
        )
        _shipped.add(context.applicationId)
    return context
