"""Tables written once in the shared folder and read again: a cut in the lineage that any
executor can read, and that a lost executor does not take away."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from rollbook.session import ensure_checkpoint_dir


def stored_path(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/rollbook-{uuid.uuid4().hex}/{name}"


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet in the folder of ``spark.checkpoint.dir``, read back; the folder is
    cleaned with the cluster's checkpoints, or by ``drop_stored``."""
    path = stored_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def drop_stored(*frames: DataFrame) -> None:
    """Delete tables of ``store`` that nothing still to be computed reads."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
