"""Exact global ranks without a single-partition window.

``ntile(5) OVER (ORDER BY x)`` plans ``Exchange SinglePartition``: every row
goes through one task.  Instead:

1. range-partition on the full sort key *including the tie-break*, so even a
   value shared by a third of all rows is spread over many partitions, and sort
   inside each partition;
2. tag each row with its partition and position (``monotonically_increasing_id``
   is ``partition << 33 | position``) and cut lineage by writing the tagged rows
   as a table in the shared checkpoint folder, so every later read sees the same
   split (one job; a reliable ``checkpoint()`` would compute its input twice);
3. count rows per partition (at most ``num_partitions`` rows), prefix-sum those
   counts and join them back as a broadcast (size bounded by the partition count):
   rank = offset of the partition + position + 1.

Scores are then pure arithmetic on (rank, N).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path, shuffle_partitions

_POS_BITS = 33


def add_global_rank(df: DataFrame, order_by: list[Column], rank_col: str = "rank",
                    total_col: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Add a 1-based rank by ``order_by`` (must be a total order) and optionally N."""
    spark = df.sparkSession
    n = num_partitions or shuffle_partitions(spark)
    path = scratch_path(spark, "rank")
    (df.repartitionByRange(n, *order_by)
     .sortWithinPartitions(*order_by)
     .withColumn("_rk_id", F.monotonically_increasing_id())
     .write.parquet(path))
    tagged = spark.read.parquet(path).select(
        *df.columns,
        F.shiftright("_rk_id", _POS_BITS).alias("_rk_part"),
        F.col("_rk_id").bitwiseAND((1 << _POS_BITS) - 1).alias("_rk_pos"),
    )
    sizes = tagged.groupBy("_rk_part").agg(F.count(F.lit(1)).alias("_rk_size"))
    before = Window.orderBy("_rk_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_rk_part",
        F.coalesce(F.sum("_rk_size").over(before), F.lit(0)).alias("_rk_off"),
        F.sum("_rk_size").over(Window.partitionBy()).alias("_rk_total"),
    )
    out = tagged.join(F.broadcast(offsets), "_rk_part").withColumn(
        rank_col, F.col("_rk_off") + F.col("_rk_pos") + 1)
    if total_col:
        out = out.withColumn(total_col, F.col("_rk_total"))
    return out.drop("_rk_part", "_rk_pos", "_rk_off", "_rk_total")


def ntile_from_rank(rank: Column, total: Column, buckets: int = 5) -> Column:
    """NTILE(b) from a 1-based rank: the first N mod b buckets hold one extra row."""
    q = F.floor(total / buckets)
    r = total % buckets
    big = r * (q + 1)
    return F.when(rank <= big, F.floor((rank - 1) / (q + 1)) + 1).otherwise(
        r + F.floor((rank - big - 1) / q) + 1).cast("bigint")


def quantile_bin_from_rank(rank: Column, total: Column, bins: int = 5) -> Column:
    """Equal-quantile bin of a 1-based rank among 1..N (the ``qcut`` of ranks).

    Bin edges sit at 1 + k(N-1)/b; rank i falls in bin ceil(b(i-1)/(N-1)), and
    rank 1 in bin 1.  Integer arithmetic, so no float edge lands on the wrong side.
    """
    num = (rank - 1) * bins
    den = total - 1
    return F.when(total <= 1, F.lit(1)).otherwise(
        F.greatest(F.lit(1), F.floor((num + den - 1) / den))).cast("bigint")


def add_global_ranks(df: DataFrame, specs: list[tuple[str, Column, bool]], tie: list[str],
                     total_col: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Several exact global ranks of the same rows in one range-partitioned pass.

    ``specs`` are ``(rank_column, numeric value, descending)``; ``tie`` columns
    identify a row and break ties (ascending).  The rows are emitted once per spec
    as (spec, value, tie), range-partitioned and sorted on that composite key,
    tagged and written once; since every spec holds exactly N rows, the rank of a
    row within spec i is its global position minus i * N.  One pivot aggregate on
    the tie columns brings the ranks back to one row per input row (the input row
    rides along as a struct on the first spec only).  Values must be non-null.
    One range shuffle and one write instead of one of each per rank.
    """
    spark = df.sparkSession
    n = num_partitions or shuffle_partitions(spark)
    row = F.struct(*[F.col(c) for c in df.columns])
    parts = []
    for i, (_, value, desc) in enumerate(specs):
        v = value.cast("decimal(38,6)")
        parts.append(df.select(
            F.lit(i).alias("_rk_spec"), (-v if desc else v).alias("_rk_v"), *[F.col(c) for c in tie],
            F.when(F.lit(i == 0), row).alias("_rk_row")))
    rows = reduce(DataFrame.unionByName, parts)
    order = [F.col("_rk_spec"), F.col("_rk_v"), *[F.col(c) for c in tie]]
    path = scratch_path(spark, "ranks")
    (rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
     .withColumn("_rk_id", F.monotonically_increasing_id())
     .write.parquet(path))
    tagged = spark.read.parquet(path).select(
        "_rk_spec", *tie, "_rk_row",
        F.shiftright("_rk_id", _POS_BITS).alias("_rk_part"),
        F.col("_rk_id").bitwiseAND((1 << _POS_BITS) - 1).alias("_rk_pos"))
    sizes = tagged.groupBy("_rk_part").agg(F.count(F.lit(1)).alias("_rk_size"))
    before = Window.orderBy("_rk_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_rk_part",
        F.coalesce(F.sum("_rk_size").over(before), F.lit(0)).alias("_rk_off"),
        (F.sum("_rk_size").over(Window.partitionBy()) / len(specs)).cast("bigint").alias("_rk_n"))
    ranked = tagged.join(F.broadcast(offsets), "_rk_part").withColumn(
        "_rk", F.col("_rk_off") + F.col("_rk_pos") + 1 - F.col("_rk_spec") * F.col("_rk_n"))
    pivot = ranked.groupBy(*tie).agg(
        F.max("_rk_row").alias("_rk_row"), F.max("_rk_n").alias("_rk_n"),
        *[F.max(F.when(F.col("_rk_spec") == i, F.col("_rk"))).alias(name) for i, (name, _, _) in enumerate(specs)])
    extra = [F.col("_rk_n").alias(total_col)] if total_col else []
    return pivot.select("_rk_row.*", *[name for name, _, _ in specs], *extra)
