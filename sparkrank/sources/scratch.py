"""Written tables that cut lineage between steps."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sparkrank-"))
    return spark.sparkContext.getCheckpointDir()


_written: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Remove the tables this process has written between steps; their results must be written."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    The step is not computed again by later uses, survives the loss of executors,
    and has a known size, by which Spark chooses between broadcast and shuffled joins.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
