"""KPI and report operators over the star.

Every operator reduces the fact with partial (map-side) aggregation before any
join: category revenue is summed per product first, then joined to the product
dimension, so the join sees one row per product instead of one per line.
One-row results are combined through scalar subqueries (``DataFrame.scalar()``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import STANDARD_DATE, STANDARD_DATETIME, is_nonstandard, month_key, render_minutes
from ..functions.values import money_out, normalize_null_tokens, round_div, to_number
from ..schemas import MONEY

# Defaults of a recent-transaction row whose join found nothing.
UNKNOWN_CUSTOMER = "Unknown"
UNKNOWN_PRODUCT = "Unknown Product"
DEFAULT_CATEGORY = "General"
DEFAULT_QUANTITY = 1
DEFAULT_ITEM_TOTAL = 0.0


def kpi_totals(fact: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """A1: revenue, distinct orders, distinct customers of the dimension, average order value."""
    sales = fact.agg(
        F.sum("item_total").alias("_revenue"),
        F.count_distinct("order_id").alias("total_orders"),
    )
    custs = dim_customers.agg(F.count_distinct("customer_id")).scalar()  # scalar subquery
    revenue = F.coalesce(F.col("_revenue"), F.lit(0).cast(MONEY))
    aov = F.when(F.col("total_orders") > 0, round_div(revenue, F.col("total_orders"))).otherwise(F.lit(0.0))
    return sales.select(
        money_out(revenue).alias("total_revenue"),
        F.col("total_orders").cast("bigint").alias("total_orders"),
        custs.cast("bigint").alias("total_customers"),
        aov.cast("double").alias("avg_order_value"),
    )


def category_sales(fact: DataFrame, dim_products: DataFrame) -> DataFrame:
    """A2: revenue per category (inner join to products; NULL category dropped)."""
    per_product = fact.groupBy("product_id").agg(F.sum("item_total").alias("_rev"))
    joined = per_product.join(dim_products.select("product_id", "category"), "product_id")
    return (joined.filter(F.col("category").isNotNull())
            .groupBy("category").agg(money_out(F.sum("_rev")).alias("revenue")))


def monthly_sales(fact: DataFrame) -> DataFrame:
    """A3: revenue per ``yyyy-MM`` of the order date; months without sales are absent."""
    return (fact.filter(F.col("order_date").isNotNull())
            .groupBy(month_key(F.col("order_date")).alias("month"))
            .agg(money_out(F.sum("item_total")).alias("revenue")))


#: Logarithm of a sketch's registers; 2**12 estimate within about 2 % (one standard error).
SKETCH_BITS = 12


def distinct_parts(fact: DataFrame) -> DataFrame:
    """A1b/A1c, optional: sketches of the distinct orders and customers of every month, to be stored and merged.

    A few KB a month, made with partial aggregation: no key is shuffled, unlike an exact distinct count.
    """
    return (fact.filter(F.col("order_date").isNotNull()).groupBy(month_key(F.col("order_date")).alias("month"))
            .agg(F.hll_sketch_agg("order_id", SKETCH_BITS).alias("orders"), F.hll_sketch_agg("customer_id", SKETCH_BITS).alias("customers")))


def merge_distinct(parts: DataFrame) -> DataFrame:
    """Stored sketches to estimates: one row a month, and one for all (month NULL) merged from them."""
    merged = parts.groupBy().agg(F.hll_union_agg("orders").alias("orders"), F.hll_union_agg("customers").alias("customers"))
    merged = merged.select(F.lit(None).cast("string").alias("month"), "orders", "customers")
    return parts.select("month", "orders", "customers").unionByName(merged).select(
        "month", F.hll_sketch_estimate("orders").alias("orders"), F.hll_sketch_estimate("customers").alias("customers"))


def monthly_signups(dim_customers: DataFrame) -> DataFrame:
    """A4: customers per signup month."""
    return (dim_customers.filter(F.col("signup_date").isNotNull())
            .groupBy(month_key(F.col("signup_date")).alias("month"))
            .agg(F.count(F.lit(1)).alias("signups")))


def recent_transactions(fact: DataFrame, dim_products: DataFrame, dim_customers: DataFrame,
                        n: int = 10, with_position: bool = True) -> DataFrame:
    """A5: the n latest lines, then the product and customer lookups.

    Top-k first (each task keeps n rows, one task merges n x tasks rows), then the
    two dimensions are cut down to the k keys with a semi join against the
    k-row key set (broadcast, bounded by n) before the left joins.
    The order after the date is a tie-break over every output column, so the
    n rows are the same on every run.
    """
    order = [F.col("order_date").desc_nulls_last(), F.col("order_id"), F.col("product_id"),
             F.col("quantity"), F.col("item_total"), F.col("customer_id")]
    top = (fact.select("order_id", "customer_id", "product_id", "quantity", "item_total", "order_date")
           .orderBy(*order).limit(n))
    # Position in the list: a window over the n-row result only (bounded by n).
    top = top.withColumn("position", F.row_number().over(Window.orderBy(*order)) - 1)
    prods = dim_products.select("product_id", "product_name", "category").join(
        F.broadcast(top.select("product_id").distinct()), "product_id", "left_semi")
    custs = dim_customers.select("customer_id", F.col("name").alias("customer_name")).join(
        F.broadcast(top.select("customer_id").distinct()), "customer_id", "left_semi")
    j = top.join(prods, "product_id", "left").join(custs, "customer_id", "left")
    cols = [F.col("position").cast("bigint").alias("position")] if with_position else []
    return j.select(
        *cols,
        F.col("order_id").cast("string").alias("order_id"),
        F.coalesce("customer_name", F.lit(UNKNOWN_CUSTOMER)).alias("customer_name"),
        F.coalesce("product_name", F.lit(UNKNOWN_PRODUCT)).alias("product_name"),
        F.coalesce("category", F.lit(DEFAULT_CATEGORY)).alias("category"),
        F.coalesce(F.col("quantity").cast("bigint"), F.lit(DEFAULT_QUANTITY).cast("bigint")).alias("quantity"),
        F.coalesce(F.col("item_total").cast("double"), F.lit(DEFAULT_ITEM_TOTAL)).alias("item_total"),
        F.coalesce(render_minutes(F.col("order_date")), F.lit("")).alias("order_date"),
    )


def seasonality_share(fact: DataFrame) -> DataFrame:
    """% of orders on a weekend and in Nov-Dec, and lines per order.

    Reduced to order grain first (one date per order: its earliest line).
    """
    orders = fact.filter(F.col("order_id").isNotNull()).groupBy("order_id").agg(
        F.min("order_date").alias("d"), F.count(F.lit(1)).alias("lines"))
    dow, mon = F.dayofweek("d"), F.month("d")
    agg = orders.agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(dow.isin(1, 7)).alias("weekend"),
        F.count_if(mon.isin(11, 12)).alias("holiday"),
        F.sum("lines").alias("lines"),
    )

    def pct(c: str) -> F.Column:
        return round_div(F.col(c) * 100, F.col("orders"))

    return agg.select(
        F.col("orders").cast("bigint").alias("orders"),
        pct("weekend").alias("weekend_order_pct"),
        pct("holiday").alias("holiday_order_pct"),
        round_div(F.col("lines"), F.col("orders")).alias("lines_per_order"),
    )


def messiness_profile(raw_customers: DataFrame, raw_orders: DataFrame) -> DataFrame:
    """Noise found in raw extracts, one conditional aggregate per table."""
    from .cleaning import CUSTOMER_COLS, ORDER_COLS, email_missing

    c = normalize_null_tokens(raw_customers.select(*CUSTOMER_COLS))
    cust_dups = c.groupBy(*CUSTOMER_COLS).agg(F.count(F.lit(1)).alias("_n"))
    cust = cust_dups.agg(
        F.sum(F.col("_n") - 1).alias("duplicate_rows"),
        F.sum(F.when(email_missing(F.col("email")), F.col("_n")).otherwise(0)).alias("missing_emails"),
        F.sum(F.when(is_nonstandard(F.col("signup_date"), STANDARD_DATE), F.col("_n")).otherwise(0))
        .alias("nonstandard_dates"),
    )
    o = normalize_null_tokens(raw_orders.select(*ORDER_COLS))
    ord_dups = o.groupBy(*ORDER_COLS).agg(F.count(F.lit(1)).alias("_n"))
    ords = ord_dups.agg(
        F.sum(F.col("_n") - 1).alias("duplicate_rows"),
        F.sum(F.when(is_nonstandard(F.col("order_date"), STANDARD_DATETIME), F.col("_n")).otherwise(0))
        .alias("nonstandard_dates"),
        F.sum(F.when(to_number(F.col("quantity")) <= 0, F.col("_n")).otherwise(0)).alias("nonpositive_quantities"),
        F.sum(F.when(to_number(F.col("unit_price")) <= 0, F.col("_n")).otherwise(0)).alias("nonpositive_prices"),
    )
    parts = [
        cust.select(F.lit("customers").alias("table_name"), F.expr(
            "stack(3, 'duplicate_rows', duplicate_rows, 'missing_emails', missing_emails, "
            "'nonstandard_dates', nonstandard_dates) AS (metric, value)")),
        ords.select(F.lit("orders").alias("table_name"), F.expr(
            "stack(4, 'duplicate_rows', duplicate_rows, 'nonstandard_dates', nonstandard_dates, "
            "'nonpositive_quantities', nonpositive_quantities, 'nonpositive_prices', nonpositive_prices) "
            "AS (metric, value)")),
    ]
    return reduce(DataFrame.unionByName, parts).select(
        "table_name", "metric", F.col("value").cast("bigint").alias("value"))
