"""Distributed exact rank = window rank; NTILE and quantile-bin arithmetic."""

import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starling.operators.ranking import add_global_rank, ntile_from_rank, quantile_bin_from_rank


def _frame(spark, n, distinct, seed=7):
    rnd = random.Random(seed)
    # one value holds about a third of all rows: heavy ties must still spread
    rows = [(i, 0 if rnd.random() < 0.33 else rnd.randrange(distinct)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, v long")


@pytest.mark.parametrize("n,distinct", [(1, 1), (7, 3), (1363, 21), (5000, 5000)])
def test_rank_equals_row_number(spark, n, distinct):
    df = _frame(spark, n, distinct)
    order = [F.col("v").desc(), F.col("id").asc()]
    got = add_global_rank(df, order, "rk", "n", num_partitions=6)
    want = df.withColumn("rk2", F.row_number().over(Window.orderBy(*order)))
    joined = got.join(want, "id")
    assert joined.filter(F.col("rk") != F.col("rk2")).count() == 0
    assert joined.count() == n
    assert set(r.n for r in got.select("n").distinct().collect()) == {n}


@pytest.mark.parametrize("n", [1, 2, 4, 5, 6, 7, 8, 13, 1363])
def test_ntile_matches_spark_ntile(spark, n):
    df = spark.range(1, n + 1).withColumnRenamed("id", "r")
    got = df.select("r", ntile_from_rank(F.col("r"), F.lit(n)).alias("a"),
                    F.ntile(5).over(Window.orderBy("r")).alias("b"))
    assert got.filter(F.col("a") != F.col("b")).count() == 0


@pytest.mark.parametrize("n", list(range(5, 40)) + [1363, 1364])
def test_quantile_bins_match_qcut(spark, n):
    want = pd.qcut(pd.Series(range(1, n + 1)), 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()
    df = spark.range(1, n + 1).withColumnRenamed("id", "r")
    got = [r.s for r in df.select(quantile_bin_from_rank(F.col("r"), F.lit(n)).alias("s")).orderBy("r").collect()]
    assert got == want


def test_bucket_sizes_n7(spark):
    df = spark.range(1, 8).withColumnRenamed("id", "r")
    q = df.groupBy(quantile_bin_from_rank(F.col("r"), F.lit(7)).alias("b")).count().orderBy("b").collect()
    t = df.groupBy(ntile_from_rank(F.col("r"), F.lit(7)).alias("b")).count().orderBy("b").collect()
    assert [r["count"] for r in q] == [2, 1, 1, 1, 2]
    assert [r["count"] for r in t] == [2, 2, 1, 1, 1]


@pytest.mark.parametrize("n", [1, 7, 1363])
def test_multi_rank_pass_equals_row_numbers(spark, n):
    from starling.operators.ranking import add_global_ranks
    rnd = random.Random(n)
    rows = [(i, 0 if rnd.random() < 0.33 else rnd.randrange(9), rnd.randrange(100) / 4) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, a long, b double")
    got = add_global_ranks(df, [("ra", F.col("a"), True), ("rb", F.col("b"), False)], ["id"], "n", 5)
    want = (df.withColumn("wa", F.row_number().over(Window.orderBy(F.col("a").desc(), "id")))
            .withColumn("wb", F.row_number().over(Window.orderBy("b", "id"))))
    j = got.join(want, ["id", "a", "b"])
    assert j.count() == n
    assert j.filter((F.col("ra") != F.col("wa")) | (F.col("rb") != F.col("wb")) | (F.col("n") != n)).count() == 0


def test_bins_and_ntile_differ_where_five_does_not_divide(spark):
    """1,267 customers (the cleaned fact at sf0.01): swapping the two scorings changes results."""
    from starling.operators.ranking import ntile_from_rank, quantile_bin_from_rank
    n = F.lit(1267)
    rows = spark.range(1, 1268).select(ntile_from_rank(F.col("id"), n).alias("t"), quantile_bin_from_rank(F.col("id"), n).alias("q"))
    assert rows.filter("t <> q").count() > 0
