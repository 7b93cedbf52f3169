"""Row numbers of a global order, against Python's sort."""

from pyspark.sql import functions as F

from rollbook.operators.ordering import with_ordinal


def test_numbers_equal_a_plain_sort(spark):
    rows = [(i, None if i % 7 == 0 else f"g{i % 3}", (i * 37) % 50 if i % 5 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, g string, v int").repartition(7)
    got = with_ordinal(df, [F.col("v").desc_nulls_last(), F.col("id").asc()]).collect()
    want = sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
    assert [r.id for r in sorted(got, key=lambda r: r.ordinal)] == [r[0] for r in want]
    assert sorted(r.ordinal for r in got) == list(range(1, 401))


def test_numbers_within_groups_with_a_hot_one(spark):
    df = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 > 0, F.lit(None).cast("string"))
                                  .otherwise(F.concat(F.lit("g"), F.col("id") % 10)).alias("g"), F.lit(1).alias("same"))
    got = with_ordinal(df, [F.col("same").asc()], per=["g"], total="n")
    sizes = {r.g: r.n for r in got.select("g", "n").distinct().collect()}
    assert sizes[None] == 2000 and sum(sizes.values()) == 3000
    by = got.groupBy("g").agg(F.min("ordinal").alias("a"), F.max("ordinal").alias("b"), F.countDistinct("ordinal").alias("c"),
                              F.first("n").alias("n")).collect()
    assert all((r.a, r.b, r.c) == (1, r.n, r.n) for r in by)


def test_empty(spark):
    df = spark.createDataFrame([], "a int")
    assert with_ordinal(df, [F.col("a").asc()]).collect() == []
