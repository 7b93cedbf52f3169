"""Helpers shared by the corpus operators."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollbook.session import ensure_checkpoint_dir

#: Characters that separate words: space and \t \n \v \f \r.
BLANKS = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
#: Whether Spark drops a query's shuffle files as soon as it is done.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def kept(df: DataFrame) -> DataFrame:
    """Cut the lineage: ``df`` as a table in the shared folder, which any executor can read again."""
    return written(df, "kept")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{ensure_checkpoint_dir(spark)}/rollbook-{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: compact and column-pruned.
    Unlike a checkpoint it hands no constraints, orders or partitionings on, which in loops
    multiply until planning takes longer than the jobs.  The folder is the cluster's place for
    such files and is cleaned with its checkpoints.  The shuffle files of the write are dropped once
    it is done: what is read later is the table."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*stored: DataFrame) -> None:
    """Delete tables of ``written`` or ``kept`` that no frame still to be computed reads."""
    for df in stored:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def stored_bytes(stored: DataFrame) -> int:
    """Size of the files of a table of ``written`` or ``kept``."""
    path = stored.sparkSession._jvm.org.apache.hadoop.fs.Path(stored.stored_at)
    return path.getFileSystem(stored.sparkSession._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def slices(column, rows: int = 512, chars: int = 1 << 22):
    """Values of an Arrow text column in short runs, as (first row, list): what is made of a text
    (words, hashes) is never there for a whole batch at once."""
    for a in range(0, len(column), rows):
        some = column.slice(a, rows).to_pylist()
        first, size = 0, 0
        for i, t in enumerate(some):
            size += len(t or "")
            if size >= chars or i + 1 == len(some):
                yield a + first, some[first:i + 1]
                first, size = i + 1, 0


def ship(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once per session, so that functions
    of it run there wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_rollbook_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(), "rollbook_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(path)
    sc._rollbook_shipped = True


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores put before it until ``df`` has no such column."""
    have = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in have:
            n = "_" + n
        out.append(n)
    return out


def nullable_key(c: str | Column) -> Column:
    """A string key that is never null and keeps null apart from every text."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))


def hex_digits(rows: int) -> int:
    """Leading hex digits that cut a group of up to ``rows`` uniform keys into cells of
    at most a few hundred thousand rows."""
    return max(2, math.ceil(math.log(max(rows, 1) / 2**18 + 1, 16)))


def rank_in_group(df: DataFrame, group: list[str], hexed: str, ties: list[str], digits: int,
                  rank: str = "rank0", total: str = "group_n") -> DataFrame:
    """0-based rank by (``hexed``, ``ties``) within ``group`` and the group's row count.

    No task sees a whole group: rows are counted per cell (group, first ``digits`` hex
    digits), the counts are summed up over the cells of a group (at most 16**digits
    rows), and only the rows of one cell are sorted together.  ``hexed`` must be close
    to uniform in its leading digits; ``group`` columns must not be null.
    """
    d = df.withColumn("_cell", F.substring(hexed, 1, digits))
    before = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (d.groupBy(*group, "_cell").agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
             .withColumn(total, F.sum("_n").over(Window.partitionBy(*group)))
             .drop("_n"))
    w = Window.partitionBy(*group, "_cell").orderBy(hexed, *ties)
    return (d.join(cells, [*group, "_cell"])
            .withColumn(rank, F.col("_before") + F.row_number().over(w) - 1)
            .drop("_cell", "_before"))
