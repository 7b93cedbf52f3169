"""Row numbers of a global order without a task that sees all rows.

Rows are range-partitioned on the order, sorted within their partition and stored.  A
row's number is the count of rows in the files before its own plus its place in its
file, which Parquet gives without another sort or shuffle.  Only one row per file (and
group) is summed up in one place.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.sources.stored import store


def with_ordinal(df: DataFrame, order: Sequence[Column], out: str = "ordinal", per: Sequence[str] = (),
                 total: str | None = None) -> DataFrame:
    """``df`` with ``out``: 1, 2, ... in ``order``, over all rows or within the groups ``per``;
    with ``total``, the row count of the group as well.

    ``df`` is read twice (once for the range bounds), so hand in a stored frame where its
    plan is dear.  Rows that tie on everything get their numbers in the order they are
    read, and the last sort key keeps even a value that a third of all rows share from
    staying in one partition.  An empty frame gives an empty frame.
    """
    names = {"_tie", "_part", "_file", "_row", "_n", "_first", "_before", out, *([total] if total else [])}
    taken = names & set(df.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are needed for the ordinals")
    keys = [F.col(c).asc_nulls_first() for c in per] + list(order) + [F.col("_tie").asc()]
    placed = (df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys)
              .withColumn("_part", F.spark_partition_id()).sortWithinPartitions(*keys).drop("_tie"))
    rows = store(placed, "in_order").select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    group = Window.partitionBy(*per)
    before = group.orderBy("_part", "_file").rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.groupBy("_part", "_file", *per).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1)
    if total:
        runs = runs.withColumn(total, F.sum("_n").over(group))
    # stored, so that Spark knows its size and broadcasts it only below its threshold
    runs = store(runs.drop("_n", "_first", "_part"), "runs")
    on = rows["_file"] == runs["_file"]
    for c in per:
        on = on & rows[c].eqNullSafe(runs[c])
    return rows.join(runs, on).select(*[rows[c] for c in df.columns], (F.col("_row") + F.col("_before")).alias(out),
                                      *([runs[total]] if total else []))
