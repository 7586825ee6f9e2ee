"""Access modes for BI tools (L11): live views over the star, or extracts.

Live: temporary views over the published tables, so every query reads the
current data through Catalyst (pruning, pushdown).  Extract: the small marts
written as tables on a schedule, read without touching the fact.  An extract is a
version of its table (``warehouse``): a reader keeps the folders it has opened while
the next version is written, and sees that one when it opens the table again.

Extracts are kept up to date from the staged rows of a load.  What the KPIs are made of is held
in additive parts: lines, units and revenue by month, by category, by order and over
all.  A batch changes them by what its rows bring less what the rows they replace had brought,
so only folders that hold staged keys, and parts' rows of touched keys, are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_key
from ..functions.values import money_out, round_div
from ..operators import kpis, rfm
from ..operators import warehouse as wh
from ..schemas import MONEY, PRIMARY_KEYS, WORK_DECIMAL
from ..session import delete_path

MEASURES = {"lines": "bigint", "units": WORK_DECIMAL.simpleString(), "revenue": MONEY.simpleString()}
#: Parts and their keys.  Orders are many, so their part is laid out in key buckets (more for a larger fact).
PARTS = {"by_total": "scope", "by_month": "month", "by_category": "category", "by_order": "order_id"}
ORDER_BUCKETS = 16


def register_views(spark: SparkSession, star: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """Live mode: one temp view per star table."""
    for name, df in star.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + n for n in star]


def mart_frames(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    fact, dc, dp = star["fact_sales"], star["dim_customers"], star["dim_products"]
    return {
        "kpi_totals": kpis.kpi_totals(fact, dc),
        "category_sales": kpis.category_sales(fact, dp),
        "monthly_sales": kpis.monthly_sales(fact),
        "monthly_signups": kpis.monthly_signups(dc),
        "rfm_customers": rfm.rfm_q(fact, dc),
    }


def write_extracts(spark: SparkSession, star: dict[str, DataFrame], out_dir: str) -> dict[str, str]:
    """Extract mode: write every mart as the next version of its table; name -> folder of that version."""
    return {name: wh.write_version(spark, df, f"{out_dir.rstrip('/')}/{name}").paths[0]
            for name, df in mart_frames(star).items()}


def read_extract(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """The current version of an extract."""
    return wh.read_current(spark, f"{out_dir.rstrip('/')}/{name}")


# ------------------------------------------------------------------ extracts kept up to date

def _summed(df: DataFrame, key: F.Column, name: str) -> DataFrame:
    return df.groupBy(key.alias(name)).agg(*[F.sum(m).cast(kind).alias(m) for m, kind in MEASURES.items()]).filter(F.col(name).isNotNull())


def fact_parts(fact: DataFrame, dim_products: DataFrame) -> dict[str, DataFrame]:
    """The additive parts of some fact rows: (key, lines, units, revenue) each."""
    one = fact.select("order_id", "product_id", "order_date", F.lit(1).cast("bigint").alias("lines"),
                      F.coalesce("quantity", F.lit(0)).cast(WORK_DECIMAL).alias("units"),
                      F.coalesce("item_total", F.lit(0)).cast(MONEY).alias("revenue"))
    # Summed per product first: the join meets each product once.
    products = _summed(one, F.col("product_id"), "product_id").join(dim_products.select("product_id", "category"), "product_id")
    return {
        "by_total": _summed(one, F.lit("all"), "scope"),
        "by_month": _summed(one, month_key(F.col("order_date")), "month"),
        "by_category": _summed(products, F.col("category"), "category"),
        "by_order": _summed(one, F.col("order_id"), "order_id"),
    }


def _added(key: str, *frames: DataFrame) -> DataFrame:
    both = frames[0]
    for f in frames[1:]:
        both = both.unionByName(f)
    return _summed(both, F.col(key), key)


def _less(part: DataFrame) -> DataFrame:
    return part.withColumns({m: (-F.col(m)).cast(kind) for m, kind in MEASURES.items()})


def build_parts(spark: SparkSession, fact: DataFrame, dim_products: DataFrame, marts_dir: str,
                order_buckets: int = ORDER_BUCKETS) -> None:
    """Write the parts of a whole fact as first versions; ``order_buckets`` is the layout of the orders' part."""
    for name, df in fact_parts(fact, dim_products).items():
        wh.upsert_table(spark, f"{marts_dir.rstrip('/')}/{name}", df, [PARTS[name]], new_table=True,
                        buckets=order_buckets if name == "by_order" else 0)


def load_batch(spark: SparkSession, fact_path: str, marts_dir: str, staged: DataFrame, dim_products: DataFrame,
               batch_id: str, mode: str = "merge") -> None:
    """Upsert ``staged`` into the fact and bring the parts up to date by what that changes.

    May be run again after a stop at any point, with the same ``batch_id``: what the batch changes is
    written first, then the fact takes the batch in, then each part; each table remembers the
    batches it holds.  When another writer changes the fact in between, the change is computed again.
    """
    base, keys = marts_dir.rstrip("/"), PRIMARY_KEYS["fact_sales"]
    folder = f"{base}/_batches/{batch_id}"
    while True:
        cur = wh.current_version(spark, fact_path)
        if cur and batch_id in cur.loads:
            break
        delete_path(spark, folder)
        staged.write.parquet(f"{folder}/staged")
        rows = spark.read.parquet(f"{folder}/staged")
        before = wh.rows_of_keys(spark, fact_path, rows, keys)
        if before is not None:  # every part reads it
            before.write.parquet(f"{folder}/before")
            before = spark.read.parquet(f"{folder}/before")
        new = fact_parts(rows, dim_products)
        old = fact_parts(before, dim_products) if before is not None else {}
        for name, key in PARTS.items():
            (_added(key, new[name], _less(old[name])) if old else new[name]).write.parquet(f"{folder}/{name}")
        try:
            wh.upsert_table(spark, fact_path, rows, keys, mode, load_id=batch_id, base_version=cur.version if cur else 0,
                            partition_by=["order_month"], sort_by=wh.SORT_KEYS["fact_sales"], written=True)
            break
        except wh.VersionConflict:
            continue
    for name, key in PARTS.items():
        while True:
            held = wh.current_version(spark, f"{base}/{name}")
            if held and batch_id in held.loads:
                break
            change = spark.read.parquet(f"{folder}/{name}")
            there = wh.rows_of_keys(spark, f"{base}/{name}", change, [key])
            try:
                wh.upsert_table(spark, f"{base}/{name}", _added(key, there, change) if there is not None else change, [key],
                                load_id=batch_id, base_version=held.version if held else 0,
                                buckets=ORDER_BUCKETS if name == "by_order" else 0)
            except wh.VersionConflict:
                continue
    delete_path(spark, folder)


def marts_from_parts(spark: SparkSession, marts_dir: str, dim_customers: DataFrame) -> dict[str, DataFrame]:
    """The KPI marts as sums of the parts: no row of the fact is read."""
    base = marts_dir.rstrip("/")
    part = {name: wh.read_current(spark, f"{base}/{name}").filter("lines > 0") for name in PARTS}
    orders = part["by_order"].agg(F.count(F.lit(1)).alias("n")).scalar()
    customers = dim_customers.agg(F.count_distinct("customer_id")).scalar()
    totals = part["by_total"].agg(F.coalesce(F.sum("revenue"), F.lit(0).cast(MONEY)).alias("revenue"))
    totals = totals.select("revenue", orders.alias("orders"), customers.alias("customers"))
    return {
        "kpi_totals": totals.select(
            money_out(F.col("revenue")).alias("total_revenue"), F.col("orders").cast("bigint").alias("total_orders"),
            F.col("customers").cast("bigint").alias("total_customers"),
            F.when(F.col("orders") > 0, round_div(F.col("revenue"), F.col("orders"))).otherwise(F.lit(0.0)).alias("avg_order_value")),
        "category_sales": part["by_category"].select("category", money_out(F.col("revenue")).alias("revenue")),
        "monthly_sales": part["by_month"].select("month", money_out(F.col("revenue")).alias("revenue")),
    }


def publish_marts(spark: SparkSession, marts_dir: str, dim_customers: DataFrame) -> dict[str, DataFrame]:
    """Write the marts made from the parts as next versions, and read them."""
    for name, df in marts_from_parts(spark, marts_dir, dim_customers).items():
        wh.write_version(spark, df, f"{marts_dir.rstrip('/')}/{name}")
    return {name: read_extract(spark, marts_dir, name) for name in ("kpi_totals", "category_sales", "monthly_sales")}
