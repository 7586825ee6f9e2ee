"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables under ``sf_dir`` (or data Spark derives
from them: the mapped star, the raw extracts of ``sources.messy``, or tables it
wrote itself) over their whole extent.  Outputs use report types only: money
as DOUBLE (exact cents), counts as BIGINT, dates and times as text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import add_months_keep_time, month_key, parse_mixed_datetime, render_date, render_datetime
from ..operators import integrity as ig
from ..operators import kpis, payload, rfm
from ..operators import warehouse as wh
from ..schemas import MONEY
from ..session import materialize, scratch_path, tasks_for
from ..sources import messy
from ..sources import raw as rw
from ..sources import tables as tb
from . import etl, marts

Query = Callable[[SparkSession, str], DataFrame]


def _star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return tb.star(spark, sf_dir)


def _clean(spark: SparkSession, sf_dir: str) -> etl.CleanRun:
    return etl.clean(messy.raw_tables(spark, sf_dir))


def _fact_columns(df: DataFrame) -> list:
    """The fact's columns in report form."""
    return [
        F.col("order_id").cast("string").alias("order_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("product_id").cast("string").alias("product_id"),
        F.col("quantity").cast("bigint").alias("quantity"),
        F.col("unit_price").cast("double").alias("unit_price"),
        F.col("item_total").cast("double").alias("item_total"),
        F.col("order_total").cast("double").alias("order_total"),
        render_datetime(F.col("order_date")).alias("order_date"),
    ]


def _fact_out(df: DataFrame) -> DataFrame:
    return df.select(*_fact_columns(df))


# ------------------------------------------------------------------ KPIs (A1-A5)

def q_kpi_totals(spark, sf_dir):
    s = _star(spark, sf_dir)
    return kpis.kpi_totals(s["fact_sales"], s["dim_customers"])


def q_category_sales(spark, sf_dir):
    s = _star(spark, sf_dir)
    return kpis.category_sales(s["fact_sales"], s["dim_products"])


def q_monthly_sales(spark, sf_dir):
    return kpis.monthly_sales(_star(spark, sf_dir)["fact_sales"])


def q_monthly_signups(spark, sf_dir):
    return kpis.monthly_signups(_star(spark, sf_dir)["dim_customers"])


def q_recent_transactions(spark, sf_dir):
    s = _star(spark, sf_dir)
    return kpis.recent_transactions(s["fact_sales"], s["dim_products"], s["dim_customers"], 10)


# ------------------------------------------------------------------ RFM

def q_rfm_metrics_ts(spark, sf_dir):
    m = rfm.metrics_elapsed(_star(spark, sf_dir)["fact_sales"])
    return m.select("customer_id", "recency", "frequency", F.col("monetary").cast("double").alias("monetary"))


def q_rfm_scores_bins(spark, sf_dir):
    s = rfm.rfm_p(_star(spark, sf_dir)["fact_sales"])
    return s.select("customer_id", "recency", "frequency", F.col("monetary").cast("double").alias("monetary"),
                    "r_score", "f_score", "m_score", "segment")


def q_rfm_segments(spark, sf_dir):
    return rfm.rfm_segments(_star(spark, sf_dir)["fact_sales"])


def q_rfm_sql(spark, sf_dir):
    s = _star(spark, sf_dir)
    return rfm.rfm_q(s["fact_sales"], s["dim_customers"])


def q_rfm_strategy(spark, sf_dir):
    s = _star(spark, sf_dir)
    return rfm.rfm_strategy(s["fact_sales"], s["dim_customers"])


def q_rfm_clean_bins(spark, sf_dir):
    """Preset P over the cleaned fact: a population that is no multiple of five, so bins and NTILE differ."""
    s = rfm.rfm_p(_clean(spark, sf_dir).fact_sales)
    return s.select("customer_id", "recency", "frequency", F.col("monetary").cast("double").alias("monetary"),
                    "r_score", "f_score", "m_score", "segment")


def q_rfm_clean_ntile(spark, sf_dir):
    run = _clean(spark, sf_dir)
    return rfm.rfm_q(run.fact_sales, run.dim_customers)


# ------------------------------------------------------------------ cleaning

def q_parse_dates(spark, sf_dir):
    """C4 on every raw order-date and signup-date text, with the parsed value."""
    raw = messy.raw_tables(spark, sf_dir)
    orders = raw["orders"].select(F.lit("orders").alias("source"), "order_id", "product_id",
                                  F.col("order_date").alias("raw_text")).distinct()
    cust = raw["customers"].select(F.lit("customers").alias("source"), F.col("customer_id").alias("order_id"),
                                   F.lit(None).cast("string").alias("product_id"),
                                   F.col("signup_date").alias("raw_text")).distinct()
    both = orders.unionByName(cust)
    return both.select(
        "source", F.col("order_id").alias("record_id"), "product_id", "raw_text",
        render_datetime(parse_mixed_datetime(F.col("raw_text"))).alias("parsed"))


def q_clean_customers(spark, sf_dir):
    c = _clean(spark, sf_dir).dim_customers
    return c.select("customer_id", "name", "email", render_date(F.col("signup_date")).alias("signup_date"),
                    "city", "state", "country")


def q_clean_products(spark, sf_dir):
    p = _clean(spark, sf_dir).dim_products
    return p.select("product_id", "product_name", "category", F.col("price").cast("double").alias("price"))


def q_clean_orders(spark, sf_dir):
    return _fact_out(_clean(spark, sf_dir).order_lines)


def q_order_totals(spark, sf_dir):
    lines = _clean(spark, sf_dir).order_lines
    return lines.groupBy("order_id").agg(
        F.max("order_total").cast("double").alias("order_total"),
        F.sum("item_total").cast("double").alias("sum_item_totals"),
        F.count(F.lit(1)).alias("lines"))


def q_fact_sales(spark, sf_dir):
    return _fact_out(_clean(spark, sf_dir).fact_sales)


def q_orphan_counts(spark, sf_dir):
    run = _clean(spark, sf_dir)
    return ig.orphan_counts(run.order_lines, run.dim_customers, run.dim_products)


def q_cleaning_summary(spark, sf_dir):
    return _clean(spark, sf_dir).report


def q_clean_from_csv(spark, sf_dir):
    """Raw CSV files with quotes and newlines in names and headers in another
    order, the star built from them because it is missing, the fact with customer names."""
    raw = messy.raw_tables(spark, sf_dir)
    folder, star_dir = scratch_path(spark, "raw_csv"), scratch_path(spark, "star_from_csv")
    odd_name = F.concat(F.col("name"), F.lit(' "the\n2nd", '), F.col("customer_id"))
    customers = raw["customers"].orderBy("_seq").drop("_seq").withColumn("name", odd_name)
    rw.write_csv(customers.select(*reversed(customers.columns)), f"{folder}/customers.csv")
    rw.write_csv(raw["products"].select("price", "product_id", "product_name", "category"), f"{folder}/products.csv")
    rw.write_csv(raw["orders"], f"{folder}/orders.csv")
    star = etl.ensure_star(spark, folder, star_dir)
    names = star["dim_customers"].select("customer_id", F.col("name").alias("customer_name"))
    named = star["fact_sales"].join(names, "customer_id")
    return named.select("customer_name", *_fact_columns(named))


# ------------------------------------------------------------------ key checks

def q_pk_violations(spark, sf_dir):
    star = _star(spark, sf_dir)
    # The key check needs no totals; lines are dealt by order over tasks of the same share.
    star["fact_sales"] = tb.fact_lines(spark, sf_dir, tasks=tasks_for(tb.line_items(spark, sf_dir)))
    return ig.pk_violations(star)


def q_null_violations(spark, sf_dir):
    return ig.null_violations(_clean(spark, sf_dir).star())


def q_fk_violations(spark, sf_dir):
    run = _clean(spark, sf_dir)
    tables = run.star()
    tables["fact_sales"] = run.order_lines
    return ig.fk_violations(tables)


# ------------------------------------------------------------------ warehouse

def _table_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table: rows, and the money sum that identifies its content."""
    parts = [
        tables["dim_customers"].agg(F.count(F.lit(1)).alias("rows"),
                                    F.lit(None).cast("double").alias("amount")),
        tables["dim_products"].agg(F.count(F.lit(1)).alias("rows"),
                                   F.sum("price").cast("double").alias("amount")),
        tables["fact_sales"].agg(F.count(F.lit(1)).alias("rows"),
                                 F.sum("item_total").cast("double").alias("amount")),
    ]
    named = [p.select(F.lit(n).alias("table_name"), "rows", "amount")
             for p, n in zip(parts, ["dim_customers", "dim_products", "fact_sales"])]
    return reduce(DataFrame.unionByName, named)


def q_publish_star(spark, sf_dir):
    out = scratch_path(spark, "star")
    paths = wh.publish_star(spark, tb.star(spark, sf_dir, written=True), out)
    back = {n: spark.read.parquet(p) for n, p in paths.items()}
    fact = back["fact_sales"]
    months = fact.agg(F.count_distinct("order_month")).scalar()
    return _table_summary(back).withColumn(
        "partitions", F.when(F.col("table_name") == "fact_sales", months))


def q_load_star(spark, sf_dir):
    """Ordered load (dimensions, then the fact) into a fresh warehouse folder
    through staging and the delete-insert upsert; re-running it is a no-op (tested)."""
    star = tb.star(spark, sf_dir, written=True)
    target = scratch_path(spark, "warehouse")
    scratch = scratch_path(spark, "staging")
    loaded = wh.load_star(spark, star, target, mode="replace", scratch_dir=scratch, new_warehouse=True)
    return _table_summary(loaded)


def _upsert_inputs(spark, sf_dir, reduce_keys: bool = True):
    """A restatement batch over the whole fact, split by time, not by key:
    target = the fact as loaded 6 months before its latest order (one row per
    key); staging = every line of the last 18 months with quantity + 1 and totals
    recomputed (one row per key for MERGE, all rows for delete-insert).  Staged
    keys older than the cut update the target; newer ones are inserts."""
    # Both sides and the latest order read one copy of the fact, which has the first row of each key marked.
    fact = tb.marked_lines(spark, sf_dir)
    cols = ["order_id", "customer_id", "product_id", "quantity", "unit_price", "item_total",
            "order_total", "order_date"]
    firsts = fact.filter("is_first").select(*cols)
    ref = fact.agg(F.max("order_date")).scalar()  # scalar subquery: the latest order
    target = firsts.filter(F.col("order_date") < add_months_keep_time(ref, -6))
    base = firsts if reduce_keys else fact.filter("is_line").select(*cols)
    staged = base.filter(F.col("order_date") >= add_months_keep_time(ref, -18))
    staged = staged.withColumn("quantity", F.col("quantity") + 1).withColumn(
        "item_total", (F.col("quantity") * F.col("unit_price")).cast(MONEY))
    staged = tb.with_order_totals(staged.drop("order_total"), split_hot=True).select(*cols)
    return target, staged


def _upsert_query(spark, sf_dir, mode: str, reduce_keys: bool) -> DataFrame:
    target_df, staged = _upsert_inputs(spark, sf_dir, reduce_keys)
    table = scratch_path(spark, f"fact_{mode}")
    staging_path = scratch_path(spark, f"fact_{mode}_staging")
    wh.upsert_table(spark, table, target_df, ["order_id", "product_id"], "replace", partition_by=["order_month"],
                    new_table=True, written=True)
    wh.upsert_table(spark, table, staged, ["order_id", "product_id"], mode, staging_path=staging_path)
    return _fact_out(wh.read_current(spark, table))


def q_upsert_merge(spark, sf_dir):
    return _upsert_query(spark, sf_dir, "merge", reduce_keys=True)


def q_replace_by_key(spark, sf_dir):
    return _upsert_query(spark, sf_dir, "replace", reduce_keys=False)


def _restated(spark, sf_dir, days: int):
    """The fact up to its latest order, first line of each key; and as a batch its last ``days`` days restated
    (quantity + 1), with the orders' totals recomputed."""
    fact = tb.marked_lines(spark, sf_dir)
    firsts = fact.filter("is_first").select("order_id", "product_id", "customer_id", "quantity", "unit_price", "item_total",
                                            "order_total", "order_date")
    latest = fact.agg(F.max("order_date")).scalar()
    staged = firsts.filter(F.col("order_date") >= latest - F.expr(f"INTERVAL {days} DAYS"))
    staged = staged.withColumn("quantity", F.col("quantity") + 1).withColumn(
        "item_total", (F.col("quantity") * F.col("unit_price")).cast(MONEY))
    staged = tb.with_order_totals(staged.drop("order_total"), split_hot=True).select(*firsts.columns)
    return firsts.filter(F.col("order_date") < latest), staged


def q_upsert_buckets(spark, sf_dir):
    """A batch of two days into a fact laid out by hash of the key: only folders of the staged keys'
    buckets are read and written again."""
    target, staged = _restated(spark, sf_dir, 2)
    table, keys = scratch_path(spark, "fact_buckets"), ["order_id", "product_id"]
    wh.upsert_table(spark, table, target, keys, buckets=64, sort_by=wh.SORT_KEYS["fact_sales"], new_table=True,
                    written=True)
    wh.upsert_table(spark, table, staged, keys)
    return _fact_out(wh.read_current(spark, table))


def q_marts_incremental(spark, sf_dir):
    """KPI marts kept up to date by a batch of 90 days, from additive parts."""
    target, staged = _restated(spark, sf_dir, 90)
    base = scratch_path(spark, "marts_incremental")
    products, customers = tb.dim_products(spark, sf_dir), tb.dim_customers(spark, sf_dir)
    wh.upsert_table(spark, f"{base}/fact", target, ["order_id", "product_id"], partition_by=["order_month"], new_table=True,
                    written=True)
    marts.build_parts(spark, target, products, f"{base}/marts")
    marts.load_batch(spark, f"{base}/fact", f"{base}/marts", staged, products, "restated")
    got = marts.publish_marts(spark, f"{base}/marts", customers)
    nothing = F.lit(None).cast("bigint")
    return (got["kpi_totals"].select(F.lit("kpi_totals").alias("mart"), F.lit("all").alias("key"), F.col("total_revenue").alias("revenue"),
                                     F.col("total_orders").alias("orders"))
            .unionByName(got["category_sales"].select(F.lit("category_sales").alias("mart"), F.col("category").alias("key"), "revenue",
                                                      nothing.alias("orders")))
            .unionByName(got["monthly_sales"].select(F.lit("monthly_sales").alias("mart"), F.col("month").alias("key"), "revenue",
                                                     nothing.alias("orders"))))


class _Stopped(RuntimeError):
    pass


def q_load_resume(spark, sf_dir):
    """A load whose fact fails after the dimensions were committed, then the same load again: dimensions
    are left as they are, the fact is loaded, a third run changes nothing."""
    star = tb.star(spark, sf_dir, written=True)
    target = scratch_path(spark, "warehouse_resume")
    broken = star["fact_sales"].withColumn("quantity", F.when(F.col("quantity") > 0, F.raise_error(F.lit("stopped"))).cast("int"))
    try:
        wh.load_star(spark, {**star, "fact_sales": broken}, target, load_id="load-1")
        raise _Stopped("the broken fact was loaded")
    except _Stopped:
        raise
    except Exception as exc:
        if "stopped" not in str(exc):
            raise
    wh.load_star(spark, star, target, load_id="load-1", enforce_foreign_keys=True)
    loaded = wh.load_star(spark, star, target, load_id="load-1")
    versions = [(n, wh.current_version(spark, f"{target}/{n}").version) for n in loaded]
    return _table_summary(loaded).join(spark.createDataFrame(versions, "table_name string, version bigint"), "table_name")


def q_rfm_bucketed(spark, sf_dir):
    """Fact and customers in equal buckets of the customer; the RFM report over them needs no exchange
    up to its ranks."""
    prefix = f"bucketed_{scratch_path(spark, 'b').rsplit('-', 1)[-1]}_"
    star = wh.publish_bucketed_star(spark, tb.star(spark, sf_dir), scratch_path(spark, "bucketed"),
                                    int(spark.conf.get("spark.sql.shuffle.partitions")), prefix)
    return rfm.rfm_q(star["fact_sales"], star["dim_customers"], reuse=False)


def q_category_sales_replicated(spark, sf_dir):
    """Revenue by category with the written product dimension, replicated or not by its measured size."""
    star = _star(spark, sf_dir)
    path = scratch_path(spark, "products")
    star["dim_products"].write.parquet(path)
    return kpis.category_sales(star["fact_sales"], wh.dimension(spark, path))


def q_distinct_sketch(spark, sf_dir):
    """A1b/A1c, optional: orders and customers by month and over all, from stored sketches; and are they
    within 5 % of the exact counts."""
    fact = _star(spark, sf_dir)["fact_sales"].select("order_id", "customer_id", "order_date")
    fact = materialize(fact, "sketch_fact")
    est = kpis.merge_distinct(materialize(kpis.distinct_parts(fact), "sketches"))
    month = month_key(F.col("order_date"))
    exact = fact.groupBy(month.alias("m")).agg(F.count_distinct("order_id").alias("exact_orders"),
                                               F.count_distinct("customer_id").alias("exact_customers"))
    whole = fact.agg(F.count_distinct("order_id").alias("exact_orders"), F.count_distinct("customer_id").alias("exact_customers"))
    exact = exact.unionByName(whole.select(F.lit(None).cast("string").alias("m"), "*"))

    def near(a: str, b: str):
        return F.abs(F.col(a) - F.col(b)) <= 0.05 * F.col(b)

    return est.join(exact, F.col("month").eqNullSafe(F.col("m"))).select(
        F.coalesce("month", F.lit("all")).alias("month"), "exact_orders", "exact_customers",
        near("orders", "exact_orders").alias("orders_near"), near("customers", "exact_customers").alias("customers_near"))


# ------------------------------------------------------------------ flat file, profiles, payload

def q_csv_rejects(spark, sf_dir):
    """A CSV of all customers in which names hold a bare comma and cities a bare newline now and then: the
    malformed rows with their text, and how many rows are left."""
    c = tb.read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    raw = c.select(
        key.cast("string").alias("customer_id"),
        F.concat("c_name", F.when(key % 97 == 0, ",Jr").otherwise("")).alias("name"), tb.customer_email(F.col("c_name")).alias("email"),
        F.lit("2024-01-05").alias("signup_date"),
        F.concat(F.col("c_nationkey").cast("string"), F.when(key % 101 == 0, "\nNorth").otherwise("")).alias("city"),
        F.col("c_mktsegment").alias("state"), F.lit("US").alias("country"))
    path = scratch_path(spark, "ragged")
    # As lines of one column named like the whole header, so that nothing is quoted.
    lines = raw.select(F.explode(F.split(F.concat_ws(",", *raw.columns), "\n")).alias(",".join(raw.columns)))
    lines.write.option("header", True).option("sep", "\u0001").csv(path)
    read = rw.read_raw_aside(spark, path, rw.RAW_SCHEMAS["customers"], "customers")
    kept = read.rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("customer_id").cast("bigint")).alias("ids"))
    return (read.rejects.groupBy("table_name", "text").agg(F.count(F.lit(1)).alias("rows"), F.lit(None).cast("bigint").alias("ids"))
            .unionByName(kept.select(F.lit("customers").alias("table_name"), F.lit(None).cast("string").alias("text"),
                                     F.col("n").alias("rows"), "ids")))


def _flat_file(spark, sf_dir):
    """The flat sales file, written as CSV and read back with its fixed schema."""
    s = _star(spark, sf_dir)
    flat = (s["fact_sales"].join(s["dim_customers"].select("customer_id", F.col("name").alias("customer_name")),
                                 "customer_id", "left")
            .join(s["dim_products"].select("product_id", "product_name", "category"), "product_id", "left")
            .select(F.col("order_id").cast("string").alias("order_id"), "customer_name", "product_name",
                    "category", "quantity", "unit_price", "item_total",
                    render_datetime(F.col("order_date")).alias("order_date")))
    path = scratch_path(spark, "flat_sales")
    rw.write_csv(flat, path)
    return rw.read_flat_sales(spark, path)


def _flat_measures():
    return [F.sum("item_total").cast("decimal(18,2)").cast("double").alias("revenue"),
            F.count_distinct("order_id").alias("orders"),
            F.count(F.lit(1)).alias("lines")]


def q_flat_kpis_customers(spark, sf_dir):
    """The KPIs of the flat file by customer, with the latest order."""
    back = _flat_file(spark, sf_dir)
    return back.filter(F.col("customer_name").isNotNull()).groupBy("customer_name").agg(
        *_flat_measures(), F.count_distinct("category").alias("categories"), F.sum("quantity").cast("bigint").alias("units"),
        render_datetime(F.max("order_date")).alias("latest_order"))

def q_flat_kpis(spark, sf_dir):
    """Write the flat sales file (CSV), read it back with its fixed schema, KPIs per category."""
    back = _flat_file(spark, sf_dir)
    return back.filter(F.col("category").isNotNull()).groupBy("category").agg(
        *_flat_measures(), F.count_distinct("customer_name").alias("customers"), F.sum("quantity").cast("bigint").alias("units"))


def q_seasonality_share(spark, sf_dir):
    return kpis.seasonality_share(_star(spark, sf_dir)["fact_sales"])


def q_messiness_profile(spark, sf_dir):
    raw = messy.raw_tables(spark, sf_dir)
    return kpis.messiness_profile(raw["customers"], raw["orders"])


def q_dashboard_payload(spark, sf_dir):
    """Six parts over one star; the fact is materialised once because every
    part reads it (instead of re-running the lineitem/orders/part joins per part)."""
    star = _star(spark, sf_dir)
    used = ["order_id", "customer_id", "product_id", "quantity", "item_total", "order_date"]
    star["fact_sales"] = materialize(star["fact_sales"].select(*used), "payload_fact")
    return payload.payload_flat(payload.payload_parts(star))


def q_dashboard_document(spark, sf_dir):
    """The nested document, as its parts in JSON text (the time of writing left out)."""
    star = _star(spark, sf_dir)
    used = ["order_id", "customer_id", "product_id", "quantity", "item_total", "order_date"]
    star["fact_sales"] = materialize(star["fact_sales"].select(*used), "document_fact")
    path = scratch_path(spark, "document")
    payload.write_payload(payload.payload_document(payload.payload_parts(star), generated_at="now"), path)
    doc = spark.read.text(path)
    parts = ["$.status", "$.metrics.total_revenue", "$.metrics.total_orders", "$.metrics.total_customers", "$.metrics.avg_order_value"]
    number = [F.get_json_object("value", p).alias(p.split(".")[-1]) for p in parts]
    table = "map<string,double>"
    segments = "map<string,struct<count:bigint,revenue:double>>"
    row = doc.select(*number[:1], *[c.cast("double").alias(p.split(".")[-1]) for c, p in zip(number[1:], parts[1:])],
                     F.from_json(F.get_json_object("value", "$.category_sales"), table).alias("categories"),
                     F.from_json(F.get_json_object("value", "$.monthly_sales"), table).alias("months"),
                     F.from_json(F.get_json_object("value", "$.rfm_segments"), segments).alias("segments"),
                     F.get_json_object("value", "$.recent_transactions[0].order_id").alias("latest_order"),
                     F.get_json_object("value", "$.recent_transactions[9].order_id").alias("tenth_order"))
    base = row.select("status", "total_revenue", "total_orders", "total_customers", "avg_order_value", "latest_order", "tenth_order",
                      F.size("categories").cast("bigint").alias("categories"), F.size("months").cast("bigint").alias("months"),
                      F.explode(F.map_entries("segments")).alias("e"))
    return base.select("*", F.col("e.key").alias("segment"), F.col("e.value.count").alias("segment_customers"),
                       F.col("e.value.revenue").alias("segment_revenue")).drop("e")


def q_dashboard_entries(spark, sf_dir):
    """Every entry of the written document: the amounts of the maps and the fields of the list."""
    star = _star(spark, sf_dir)
    used = ["order_id", "customer_id", "product_id", "quantity", "item_total", "order_date"]
    star["fact_sales"] = materialize(star["fact_sales"].select(*used), "document_fact")
    path = scratch_path(spark, "document")
    payload.write_payload(payload.payload_document(payload.payload_parts(star), generated_at="now"), path)
    doc = spark.read.text(path)
    amounts = F.map_entries(F.from_json(F.col("part"), "map<string,double>"))
    parts = [doc.select(F.lit(name).alias("section"), F.get_json_object("value", f"$.{name}").alias("part"))
             .select("section", F.explode(amounts).alias("e")).select("section", F.col("e.key").alias("key"), F.col("e.value").alias("num_value"),
                                                                      F.lit(None).cast("string").alias("text_value"))
             for name in ("metrics", "category_sales", "monthly_sales", "monthly_signups")]
    rows = "array<struct<order_id:string,customer_name:string,product_name:string,category:string,quantity:double,item_total:double,order_date:string>>"
    recent = doc.select(F.posexplode(F.from_json(F.get_json_object("value", "$.recent_transactions"), rows)).alias("p", "r"))
    texts, numbers = ["order_id", "customer_name", "product_name", "category", "order_date"], ["quantity", "item_total"]
    fields = [F.struct(F.concat("p", F.lit(f".{f}")).alias("key"), (F.col(f"r.{f}") if f in numbers else F.lit(None).cast("double")).alias("num_value"),
                       (F.col(f"r.{f}") if f in texts else F.lit(None).cast("string")).alias("text_value")) for f in texts + numbers]
    parts.append(recent.select(F.lit("recent_transactions").alias("section"), F.inline(F.array(*fields))))
    return reduce(DataFrame.unionByName, parts)


QUERIES: dict[str, Query] = {
    "kpi_totals": q_kpi_totals,
    "category_sales": q_category_sales,
    "monthly_sales": q_monthly_sales,
    "monthly_signups": q_monthly_signups,
    "recent_transactions": q_recent_transactions,
    "rfm_metrics_ts": q_rfm_metrics_ts,
    "rfm_scores_bins": q_rfm_scores_bins,
    "rfm_segments": q_rfm_segments,
    "rfm_sql": q_rfm_sql,
    "rfm_strategy": q_rfm_strategy,
    "rfm_clean_bins": q_rfm_clean_bins,
    "rfm_clean_ntile": q_rfm_clean_ntile,
    "parse_dates": q_parse_dates,
    "clean_customers": q_clean_customers,
    "clean_products": q_clean_products,
    "clean_orders": q_clean_orders,
    "order_totals": q_order_totals,
    "fact_sales": q_fact_sales,
    "orphan_counts": q_orphan_counts,
    "cleaning_summary": q_cleaning_summary,
    "clean_from_csv": q_clean_from_csv,
    "pk_violations": q_pk_violations,
    "null_violations": q_null_violations,
    "fk_violations": q_fk_violations,
    "publish_star": q_publish_star,
    "load_star": q_load_star,
    "upsert_merge": q_upsert_merge,
    "replace_by_key": q_replace_by_key,
    "upsert_buckets": q_upsert_buckets,
    "marts_incremental": q_marts_incremental,
    "load_resume": q_load_resume,
    "rfm_bucketed": q_rfm_bucketed,
    "category_sales_replicated": q_category_sales_replicated,
    "distinct_sketch": q_distinct_sketch,
    "csv_rejects": q_csv_rejects,
    "flat_kpis_customers": q_flat_kpis_customers,
    "dashboard_entries": q_dashboard_entries,
    "flat_kpis": q_flat_kpis,
    "seasonality_share": q_seasonality_share,
    "messiness_profile": q_messiness_profile,
    "dashboard_payload": q_dashboard_payload,
    "dashboard_document": q_dashboard_document,
}
