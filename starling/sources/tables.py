"""Driver tables and the clean star derived from them.

The star is a lazy plan over the parquet tables: Catalyst prunes every scan to
the few columns used and pushes filters into it.  Keys keep their integer type
here; the raw/cleaning path (``sources.messy``) carries them as text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import add_seconds
from ..functions.values import money
from ..schemas import MONEY
from ..session import materialize, tasks_for

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

# Fixed values of the mapping from the driver tables to the retail star.
SIGNUP_BASE_DATE = "1993-01-01"
SIGNUP_SPREAD_DAYS = 1500
SIGNUP_STRIDE = 37
EMAIL_DOMAIN = "@example.com"
COUNTRY = "United States"
SECONDS_PER_DAY = 86400
#: An order of more lines is not left to one task; hash buckets that orders are first counted in.
HOT_LINES = 1_000_000
HOT_BUCKETS = 1 << 16


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customer_email(name_col) -> F.Column:
    return F.concat(F.lower(F.replace(name_col, F.lit("#"), F.lit("."))), F.lit(EMAIL_DOMAIN))


def signup_date(custkey_col) -> F.Column:
    days = ((custkey_col * SIGNUP_STRIDE) % SIGNUP_SPREAD_DAYS).cast("int")
    return F.date_add(F.lit(SIGNUP_BASE_DATE).cast("date"), days)


def order_timestamp(orderdate_col, orderkey_col) -> F.Column:
    """Order date plus a per-order second of the day, so orders are not all at midnight."""
    return add_seconds(orderdate_col, orderkey_col % SECONDS_PER_DAY)


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation x region: 25 rows by the TPC-H definition, a fixed size."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name")  # small enough for Spark to broadcast by itself


def dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    geo = geography(spark, sf_dir)
    return cust.join(geo, cust.c_nationkey == geo.n_nationkey, "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        customer_email(F.col("c_name")).alias("email"),
        signup_date(F.col("c_custkey")).alias("signup_date"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.lit(COUNTRY).alias("country"),
    )


def dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        money(F.col("p_retailprice")).alias("price"),
    )


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")


def fact_lines(spark: SparkSession, sf_dir: str, li: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """One row per line item with the star's fact columns (no order_total yet).

    ``line_number`` and ``supplier_id`` ride along: they make a line unique and
    give the upsert fixture a deterministic "first row per key".
    ``li``: some of the line items.  ``tasks``: over how many tasks the lines are dealt by their order.
    """
    li = line_items(spark, sf_dir) if li is None else li
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    lines = li.join(part, li.l_partkey == part.p_partkey)
    lines = (lines.repartition(tasks, "l_orderkey") if tasks else lines).join(orders, li.l_orderkey == orders.o_orderkey)
    quantity = F.col("l_quantity").cast("int")
    unit_price = money(F.col("p_retailprice"))
    return lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        quantity.alias("quantity"),
        unit_price.alias("unit_price"),
        (quantity * unit_price).cast(MONEY).alias("item_total"),
        order_timestamp(F.col("o_orderdate"), F.col("l_orderkey")).alias("order_date"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_suppkey").alias("supplier_id"),
    )


def with_order_totals(lines: DataFrame, item_col: str | F.Column = "item_total", split_hot: bool = False) -> DataFrame:
    """Attach order_total = sum of the order's line totals, rounded to cents.

    Aggregate-then-join instead of a window: the aggregate combines map-side.  With
    ``split_hot`` the totals (one row per order) are written first: the join back then has
    a plain exchange on either side, which the adaptive skew join splits if one order is
    hot; an aggregate straight on its exchange it leaves whole.  Without, the plan stays
    lazy, and a query that does not use the total does not compute it.
    A null order_id gets a null total (a window would lump the nulls together).
    """
    totals = (lines.filter(F.col("order_id").isNotNull())
              .groupBy("order_id").agg(F.sum(item_col).alias("_order_sum")))
    if split_hot:
        totals = materialize(totals, "order_totals")
    return (lines.join(totals, "order_id", "left")
            .withColumn("order_total", money(F.col("_order_sum"))).drop("_order_sum"))


def fact_sales(spark: SparkSession, sf_dir: str, extended: bool = False, written: bool = False) -> DataFrame:
    """The fact; ``written``: lines and totals are written first, for consumers of whole rows."""
    lines = fact_lines(spark, sf_dir)
    fact = with_order_totals(materialize(lines, "fact_lines"), split_hot=True) if written else with_order_totals(lines)
    cols = ["order_id", "customer_id", "product_id", "quantity", "unit_price",
            "item_total", "order_total", "order_date"]
    if extended:
        cols += ["line_number", "supplier_id"]
    return fact.select(*cols)


def hot_orders(keys: DataFrame, most: int = HOT_LINES) -> DataFrame | None:
    """(order_id) of the orders with more than ``most`` of the rows of ``keys`` (order_id); None if there are none.

    Rows are counted by hash buckets first, which shuffles a few numbers only: an order has no more rows
    than its bucket.  Orders are counted in the buckets above the limit alone.
    """
    bucket = F.pmod(F.xxhash64("order_id"), F.lit(HOT_BUCKETS))
    full = keys.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)
    full = [r["b"] for r in full.collect()]  # at most rows / most, and never more than HOT_BUCKETS
    if not full:
        return None
    counts = keys.filter(bucket.isin(full)).groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    hot = materialize(counts.filter(F.col("n") > most).select("order_id"), "hot_orders")
    return None if hot.isEmpty() else hot


def item_total() -> F.Column:
    return (F.col("quantity") * F.col("unit_price")).cast(MONEY)


#: The first row of a key is the least by these: a total order, as the driver data repeats (order, line number) pairs.
FIRST_BY = ["line_number", "supplier_id", "quantity", "unit_price", "customer_id", "item_total", "order_total", "order_date"]


def marked_lines(spark: SparkSession, sf_dir: str, most: int = HOT_LINES) -> DataFrame:
    """The fact, written once: a row is a line if ``is_line``, and the first one of its (order, product) if ``is_first``.

    Totals and first lines are found where the join with the orders leaves the lines, each order's
    together, so no line is shuffled after that join.  Orders of more than ``most`` lines go another way, which no
    task has to walk alone: totals joined back, first lines by an aggregate that combines map-side.
    """
    cols = ["order_id", "customer_id", "product_id", "quantity", "unit_price", "order_total", "order_date"]
    li = line_items(spark, sf_dir)
    hot = hot_orders(li.select(F.col("l_orderkey").alias("order_id")), most)
    own = None if hot is None else li["l_orderkey"] == hot["order_id"]
    plain = fact_lines(spark, sf_dir, li if hot is None else li.join(F.broadcast(hot), own, "left_anti"), tasks_for(li))
    plain = plain.withColumn("order_total", money(F.sum("item_total").over(Window.partitionBy("order_id"))))
    place = F.row_number().over(Window.partitionBy("order_id", "product_id").orderBy(*FIRST_BY))
    marked = plain.select(*cols, F.lit(True).alias("is_line"), (place == 1).alias("is_first"))
    if hot is not None:
        rest = materialize(fact_lines(spark, sf_dir, li.join(F.broadcast(hot), own, "left_semi")), "hot_lines")
        rest = materialize(with_order_totals(rest, split_hot=True), "hot_fact")
        firsts = rest.groupBy("order_id", "product_id").agg(F.min(F.struct(*FIRST_BY)).alias("r")).select(
            *[F.col(c) if c in ("order_id", "product_id") else F.col("r")[c].alias(c) for c in cols])
        marked = marked.unionByName(rest.select(*cols, F.lit(True).alias("is_line"), F.lit(False).alias("is_first"))).unionByName(
            firsts.select("*", F.lit(False).alias("is_line"), F.lit(True).alias("is_first")))
    # The item total follows from two other columns, so it is not written.
    marked = materialize(marked, "marked_lines")
    return marked.select(*cols[:5], item_total().alias("item_total"), *cols[5:], "is_line", "is_first")


def star(spark: SparkSession, sf_dir: str, extended: bool = False, written: bool = False) -> dict[str, DataFrame]:
    return {
        "dim_customers": dim_customers(spark, sf_dir),
        "dim_products": dim_products(spark, sf_dir),
        "fact_sales": fact_sales(spark, sf_dir, extended=extended, written=written),
    }
