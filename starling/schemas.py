"""Fixed schemas of the raw files and the star, and the declared keys.

Raw files are read with every column as STRING (never inferred); the star is
published with the typed schemas below and columns are always matched by name.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(24, 2)
# Cleaning works at scale 4 so a sub-cent value is not mistaken for zero early; 20 digits
# before the point, so that no amount a file can sensibly hold is lost as "not a number".
WORK_DECIMAL = T.DecimalType(24, 4)


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


RAW_CUSTOMERS = _strings("customer_id", "name", "email", "signup_date", "city", "state", "country")
RAW_PRODUCTS = _strings("product_id", "product_name", "category", "price")
RAW_ORDERS = _strings("order_id", "customer_id", "product_id", "quantity", "unit_price", "order_date")
RAW_FLAT = T.StructType([
    T.StructField("order_id", T.StringType(), True),
    T.StructField("customer_name", T.StringType(), True),
    T.StructField("product_name", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("quantity", T.StringType(), True),
    T.StructField("unit_price", T.StringType(), True),
    T.StructField("item_total", T.StringType(), True),
    T.StructField("order_date", T.StringType(), True),
])

RAW_SCHEMAS = {"customers": RAW_CUSTOMERS, "products": RAW_PRODUCTS, "orders": RAW_ORDERS}

DIM_CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("name", T.StringType(), True),
    T.StructField("email", T.StringType(), True),
    T.StructField("signup_date", T.DateType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("state", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
])
DIM_PRODUCTS = T.StructType([
    T.StructField("product_id", T.StringType(), False),
    T.StructField("product_name", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("price", MONEY, True),
])
FACT_SALES = T.StructType([
    T.StructField("order_id", T.StringType(), False),
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("product_id", T.StringType(), False),
    T.StructField("quantity", WORK_DECIMAL, True),
    T.StructField("unit_price", WORK_DECIMAL, True),
    T.StructField("item_total", MONEY, True),
    T.StructField("order_total", MONEY, True),
    T.StructField("order_date", T.TimestampNTZType(), True),
])

STAR_SCHEMAS = {"dim_customers": DIM_CUSTOMERS, "dim_products": DIM_PRODUCTS, "fact_sales": FACT_SALES}

# Declared primary keys (NOT NULL, not enforced by the warehouse) and foreign keys.
PRIMARY_KEYS = {
    "dim_customers": ["customer_id"],
    "dim_products": ["product_id"],
    "fact_sales": ["order_id", "product_id"],
}
NOT_NULL = {
    "dim_customers": ["customer_id"],
    "dim_products": ["product_id"],
    "fact_sales": ["order_id", "customer_id", "product_id", "order_date"],
}
FOREIGN_KEYS = {
    "fact_sales": [("customer_id", "dim_customers", "customer_id"),
                   ("product_id", "dim_products", "product_id")],
}
# Load order: dimensions before the fact.
LOAD_ORDER = ["dim_customers", "dim_products", "fact_sales"]
