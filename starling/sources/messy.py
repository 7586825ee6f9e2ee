"""Raw retail extracts derived from the driver tables (the test inputs).

Each rule is a fixed formula of the keys, so the Spark view and an independent
SQL oracle produce the same text byte for byte.  The rules inject the noise the
cleaning operators exist for: mixed date layouts, Unix times, bad numbers,
missing and repeated emails, exact duplicate rows and orphan keys.  Every row of
the driver tables is carried through; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import MONTHS, epoch_seconds, iso_text
from . import tables as tb

# Noise rules (FIXTURES §4.2 of this repository).
ORDER_DATE_MOD = 20
SIGNUP_DATE_MOD = 20
QTY_MOD = 331
PRICE_MOD = 337
ORDER_DUP_MOD = 97
CUST_DUP_MOD = 101
CUST_DUP_REST = 5
EMAIL_MOD = 50
EMAIL_REUSE_MOD = 40
EMAIL_REUSE_REST = 7
PRICE_NA_MOD = 211
PRODUCT_GAP_MOD = 223

def _copies(repeat) -> F.Column:
    """[1] for a normal row, [1, 2] for a row that appears twice in the file."""
    return F.when(repeat, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))


def _money_text(c) -> F.Column:
    """Two-decimal text (``1234.50``): a decimal cast, much cheaper than a format string."""
    return c.cast("decimal(18,2)").cast("string")


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = tb.read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    k = F.col("p_partkey")
    # A product known to the extract by another code: its row stays, its order lines become orphans.
    code = F.when(k % PRODUCT_GAP_MOD == 0, F.concat(F.lit("X"), k.cast("string"))).otherwise(k.cast("string"))
    return part.select(
        code.alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.when(k % PRICE_NA_MOD == 0, F.lit("n/a")).otherwise(_money_text(F.col("p_retailprice"))).alias("price"),
        k.alias("_seq"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = tb.read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    geo = tb.geography(spark, sf_dir)
    c = F.col("c_custkey")
    # The email a customer with key c-1 has; customer names follow the TPC-H
    # pattern ``Customer#<9-digit key>``, so it is derived from the key alone.
    prev_name = F.format_string("Customer#%09d", c - 1)
    email = (
        F.when(c % EMAIL_MOD == 0, F.lit(None).cast("string"))
        .when(c % EMAIL_MOD == 1, F.lit(""))
        .when(c % EMAIL_MOD == 2, F.lit("NaN"))
        .when(c % EMAIL_MOD == 3, F.lit("  "))
        .when(c % EMAIL_REUSE_MOD == EMAIL_REUSE_REST, tb.customer_email(prev_name))
        .otherwise(tb.customer_email(F.col("c_name")))
    )
    d = tb.signup_date(c)
    k = c % SIGNUP_DATE_MOD
    signup = (
        F.when(k == 0, F.date_format(d, "MM/dd/yyyy"))
        .when(k == 1, F.date_format(d, "dd-MM-yyyy"))
        .when(k == 2, F.date_format(d, "yyyy/MM/dd"))
        .when(k == 3, F.date_format(d, "MMMM dd, yyyy"))
        .when(k == 4, F.lit(""))
        .otherwise(F.date_format(d, "yyyy-MM-dd"))
    )
    base = cust.join(geo, cust.c_nationkey == geo.n_nationkey, "left").select(
        c.cast("string").alias("customer_id"),
        F.col("c_name").alias("name"),
        email.alias("email"),
        signup.alias("signup_date"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.lit(tb.COUNTRY).alias("country"),
        c.alias("_key"),
    )
    # Repeated rows are produced in the same pass (explode), not by a second scan.
    copy = F.explode(_copies(F.col("_key") % CUST_DUP_MOD == CUST_DUP_REST)).alias("_copy")
    return base.select("*", copy).select(
        *[c_ for c_ in base.columns if c_ != "_key"],
        F.struct("_copy", "_key").alias("_seq"))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = tb.read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    orders = tb.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = tb.read_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    lines = li.join(part, li.l_partkey == part.p_partkey).join(orders, li.l_orderkey == orders.o_orderkey)
    o, p = F.col("l_orderkey"), F.col("l_partkey")
    # The order time and its ISO text are projected once as columns: every layout
    # below is cut from them, and inlining the expression into each branch would
    # grow the generated code past what the JIT compiles.
    lines = lines.withColumn("_ts", tb.order_timestamp(F.col("o_orderdate"), o)).withColumn(
        "_iso", iso_text(F.col("_ts")))
    ts, iso = F.col("_ts"), F.col("_iso")  # iso: yyyy-MM-dd HH:mm:ss, zone-free
    yyyy, mm, dd = F.substring(iso, 1, 4), F.substring(iso, 6, 2), F.substring(iso, 9, 2)
    k = o % ORDER_DATE_MOD
    month_name = F.element_at(F.array(*[F.lit(n.title()) for n in MONTHS]), F.month(ts))
    half_day = F.when(F.hour(ts) % 12 == 0, 12).otherwise(F.hour(ts) % 12)
    order_date = (
        F.when(k == 0, F.concat_ws("", mm, F.lit("/"), dd, F.lit("/"), yyyy, F.lit(" "), F.substring(iso, 12, 5)))
        .when(k == 1, F.concat_ws("", dd, F.lit("-"), mm, F.lit("-"), yyyy, F.lit(" "), F.substring(iso, 12, 8)))
        .when(k == 2, F.translate(iso, "-", "/"))
        .when(k == 3, epoch_seconds(ts).cast("string"))
        .when(k == 4, F.lit("garbage"))
        .when(k == 5, F.concat_ws("", dd, F.lit("-"), F.substring(month_name, 1, 3), F.lit("-"), yyyy, F.lit(" "), F.substring(iso, 12, 5)))
        .when(k == 6, F.concat_ws("", month_name, F.lit(" "), dd, F.lit(", "), yyyy, F.substring(iso, 11, 9)))
        .when(k == 7, F.concat_ws("", F.substring(iso, 1, 10), F.lit("T"), F.substring(iso, 12, 8), F.lit(".123456789")))
        .when(k == 8, F.concat_ws("", mm, F.lit("/"), dd, F.lit("/"), F.substring(iso, 3, 2), F.lit(" "),
                                  half_day.cast("string"), F.substring(iso, 14, 6), F.when(F.hour(ts) < 12, F.lit(" AM")).otherwise(F.lit(" PM"))))
        .when(k == 9, F.concat_ws("", F.lit("\t"), iso, F.lit("\t ")))
        .otherwise(iso)
    )
    h = (o * 7 + p) % QTY_MOD
    quantity = (
        F.when(h == 0, F.lit("0")).when(h == 1, F.lit("-1")).when(h == 2, F.lit("abc"))
        .when(h == 3, F.lit("")).otherwise(F.col("l_quantity").cast("bigint").cast("string"))
    )
    g = (o + p * 3) % PRICE_MOD
    unit_price = (
        F.when(g == 0, F.lit("0.00")).when(g == 1, F.lit("-10.00")).when(g == 2, F.lit("NaN"))
        .otherwise(_money_text(F.col("p_retailprice")))
    )
    base = lines.select(
        o.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        p.cast("string").alias("product_id"),
        quantity.alias("quantity"),
        unit_price.alias("unit_price"),
        order_date.alias("order_date"),
        F.explode(_copies((o + F.col("l_linenumber")) % ORDER_DUP_MOD == 0)).alias("_copy"),
    )
    return base.drop("_copy")


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "customers": raw_customers(spark, sf_dir),
        "products": raw_products(spark, sf_dir),
        "orders": raw_orders(spark, sf_dir),
    }
