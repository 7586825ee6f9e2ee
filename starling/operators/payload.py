"""Dashboard payload (A11) and its JSON sink.

Each part is reduced on the cluster to a handful of rows (categories, months,
segments, ten recent lines) and folded into one row with ``collect_list`` over
that small result; only the final one-row document reaches the driver or the
sink.  The flattened form ``(section, key, num_value, text_value)`` is what an
SQL oracle can compare.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kpis, rfm

STATUS = "success"
RECENT_FIELDS_TEXT = ["order_id", "customer_name", "product_name", "category", "order_date"]
RECENT_FIELDS_NUM = ["quantity", "item_total"]


def payload_parts(star: dict[str, DataFrame], recent_n: int = 10) -> dict[str, DataFrame]:
    fact, dc, dp = star["fact_sales"], star["dim_customers"], star["dim_products"]
    return {
        "metrics": kpis.kpi_totals(fact, dc),
        "category_sales": kpis.category_sales(fact, dp),
        "monthly_sales": kpis.monthly_sales(fact),
        "monthly_signups": kpis.monthly_signups(dc),
        "rfm_segments": rfm.rfm_segments(fact),
        "recent_transactions": kpis.recent_transactions(fact, dp, dc, recent_n, with_position=True),
    }


def _entries(df: DataFrame, entries: list[tuple]) -> DataFrame:
    """One branch per part: every (section, key, number, text) entry of a row via one
    explode, so each part is planned and computed once, however many fields it has."""
    structs = [F.struct(F.lit(section).alias("section"), key.cast("string").alias("key"),
                        num.cast("double").alias("num_value"), text.cast("string").alias("text_value"))
               for section, key, num, text in entries]
    return df.select(F.inline(F.array(*structs)))


def payload_flat(parts: dict[str, DataFrame]) -> DataFrame:
    none = F.lit(None)
    metric_names = ["total_revenue", "total_orders", "total_customers", "avg_order_value"]
    pos = F.col("position").cast("string")
    seg = F.col("segment")
    rt = "recent_transactions"
    pieces = [
        _entries(parts["metrics"], [("status", F.lit("status"), none, F.lit(STATUS))]
                 + [("metrics", F.lit(n), F.col(n), none) for n in metric_names]),
        _entries(parts["category_sales"], [("category_sales", F.col("category"), F.col("revenue"), none)]),
        _entries(parts["monthly_sales"], [("monthly_sales", F.col("month"), F.col("revenue"), none)]),
        _entries(parts["monthly_signups"], [("monthly_signups", F.col("month"), F.col("signups"), none)]),
        _entries(parts["rfm_segments"], [
            ("rfm_segments", F.concat(seg, F.lit(".count")), F.col("customers"), none),
            ("rfm_segments", F.concat(seg, F.lit(".revenue")), F.col("revenue"), none)]),
        _entries(parts[rt], [(rt, F.concat(pos, F.lit("." + f)), none, F.col(f)) for f in RECENT_FIELDS_TEXT]
                 + [(rt, F.concat(pos, F.lit("." + f)), F.col(f), none) for f in RECENT_FIELDS_NUM]),
    ]
    return reduce(DataFrame.unionByName, pieces)


def _as_map(df: DataFrame, key: str, value) -> DataFrame:
    entries = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), value.alias("v"))))
    return df.agg(F.map_from_entries(entries).alias("m"))


def payload_document(parts: dict[str, DataFrame], generated_at: str | None = None) -> DataFrame:
    """One row, one column ``json``: the nested document of the reference payload."""
    m = parts["metrics"].select(F.struct("total_revenue", "total_orders", "total_customers",
                                         "avg_order_value").alias("metrics"))
    cat = _as_map(parts["category_sales"], "category", F.col("revenue")).withColumnRenamed("m", "category_sales")
    ms = _as_map(parts["monthly_sales"], "month", F.col("revenue")).withColumnRenamed("m", "monthly_sales")
    su = _as_map(parts["monthly_signups"], "month", F.col("signups")).withColumnRenamed("m", "monthly_signups")
    seg = (parts["rfm_segments"].agg(F.map_from_entries(F.transform(
        F.array_sort(F.collect_list(F.struct("segment_order", "segment", "customers", "revenue"))),
        lambda s: F.struct(s["segment"].alias("k"), F.struct(s["customers"].alias("count"),
                                                             s["revenue"].alias("revenue")).alias("v"))))
        .alias("rfm_segments")))
    recent = parts["recent_transactions"].agg(F.transform(
        F.array_sort(F.collect_list(F.struct("position", *RECENT_FIELDS_TEXT[:4], "quantity", "item_total",
                                             "order_date"))),
        lambda s: F.struct(*[s[f].alias(f) for f in ["order_id", "customer_name", "product_name", "category",
                                                      "quantity", "item_total", "order_date"]]))
        .alias("recent_transactions"))
    stamp = F.lit(generated_at) if generated_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    # Every other part is a one-row aggregate: attach it as a scalar subquery.
    doc = m.select(F.struct(
        F.lit(STATUS).alias("status"), stamp.alias("generated_at"), "metrics",
        cat.scalar().alias("category_sales"), ms.scalar().alias("monthly_sales"),
        su.scalar().alias("monthly_signups"), seg.scalar().alias("rfm_segments"),
        recent.scalar().alias("recent_transactions")).alias("d"))
    return doc.select(F.to_json("d").alias("json"))


def write_payload(doc: DataFrame, path: str) -> None:
    """The one-row document as a single text file (one partition by construction)."""
    doc.coalesce(1).write.mode("overwrite").text(path)
