"""Recency / frequency / monetary customer segmentation.

One parameterised operator covers the three rule sets of the reference:

* preset ``P`` (the dashboard exporter): customers found in the fact, recency in
  elapsed 24-hour days, ranks with ties broken by customer id then five
  equal-quantile bins of the rank, five labels;
* preset ``Q`` (the SQL report): customers of the dimension joined to the fact,
  calendar-day recency, spend rounded to cents, NTILE(5) (tie-break by customer
  id added), six labels;
* preset ``R`` (the documented tiers): Q's scores with the documented labels
  and a strategy text per tier.

Per-customer metrics come from one grouped aggregate (partial aggregation, so a
customer holding a third of all lines is combined map-side); the global ranks
use the distributed rank of ``ranking``; reference dates are one-row aggregates
scalar subqueries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import elapsed_days
from ..session import materialize
from .ranking import add_global_ranks, ntile_from_rank, quantile_bin_from_rank

# Segment labels and rules of each preset, first match wins.
P_LABELS = ["Champions", "Loyal Customers", "New / Promising", "At Risk", "Lost"]
Q_LABELS = ["Champions", "Loyal Customers", "Promising / New Customers", "At Risk / Need Attention",
            "Lost Customers", "Potential / Hibernating"]
R_LABELS = ["Champions", "Loyal Customers", "New / Promising", "At Risk / Attention",
            "Lost Customers", "Potential / Hibernating"]
# Documented tier patterns and strategies (the last tier is our
# catch-all; the documentation gives it no rule or strategy).
R_TIERS = [
    ("Champions", "R >= 4, F >= 4, M >= 4", "VIP rewards, early product access, ambassador programs"),
    ("Loyal Customers", "R >= 3, F >= 3, M >= 3", "Upsell higher-tier products, loyalty discounts"),
    ("New / Promising", "R >= 4, F <= 2", "Onboarding email series, first-purchase follow-ups"),
    ("At Risk / Attention", "R <= 2, F >= 3, M >= 3", "Personalized win-back campaigns, limited-time offers"),
    ("Lost Customers", "R <= 2, F <= 2, M <= 2", "Re-engagement surveys, aggressive clearance promos"),
    ("Potential / Hibernating", None, None),
]
MIN_CUSTOMERS = 5


def segment_p(r: Column, f: Column, m: Column) -> Column:
    return (F.when((r >= 4) & (f >= 4) & (m >= 4), P_LABELS[0])
            .when((r >= 3) & (f >= 3) & (m >= 3), P_LABELS[1])
            .when((r >= 4) & (f <= 2), P_LABELS[2])
            .when((r <= 2) & (f >= 3), P_LABELS[3])
            .otherwise(P_LABELS[4]))


def _segment_qr(labels: list[str], r: Column, f: Column, m: Column) -> Column:
    return (F.when((r >= 4) & (f >= 4) & (m >= 4), labels[0])
            .when((r >= 3) & (f >= 3) & (m >= 3), labels[1])
            .when((r >= 4) & (f <= 2), labels[2])
            .when((r <= 2) & (f >= 3) & (m >= 3), labels[3])
            .when((r <= 2) & (f <= 2) & (m <= 2), labels[4])
            .otherwise(labels[5]))


def segment_q(r: Column, f: Column, m: Column) -> Column:
    return _segment_qr(Q_LABELS, r, f, m)


def segment_r(r: Column, f: Column, m: Column) -> Column:
    return _segment_qr(R_LABELS, r, f, m)


def metrics_elapsed(fact: DataFrame) -> DataFrame:
    """Per customer in the fact: recency (whole elapsed days to the latest order
    overall), distinct orders, total spend (unrounded)."""
    # Written once: the per-customer rows and their latest date come from one pass over the
    # fact (rows without a customer count for the date, as the group of the null customer).
    per = materialize(fact.groupBy("customer_id").agg(
        F.max("order_date").alias("_last"),
        F.count_distinct("order_id").alias("frequency"),
        F.sum("item_total").alias("monetary")), "rfm_per_customer")
    ref = per.agg(F.max("_last")).scalar()  # scalar subquery over the per-customer rows
    return (per.filter(F.col("customer_id").isNotNull())
            .select("customer_id",
                    elapsed_days(F.col("_last"), ref).alias("recency"),
                    F.col("frequency").cast("bigint").alias("frequency"),
                    "monetary")
            .filter(F.col("recency").isNotNull() & F.col("monetary").isNotNull()))


def metrics_calendar(fact: DataFrame, dim_customers: DataFrame, reuse: bool = True) -> DataFrame:
    """A12a/b: dimension x fact population, calendar-day recency, spend rounded to cents.

    Aggregated per customer *before* the join.  The SQL groups the join by
    (customer_id, name, email); a dimension row repeated k times would multiply
    that group's spend by k, which is reproduced exactly with the row count k.
    A customer without any dated or without any priced line has no recency or no
    spend to rank and is left out, as in ``metrics_elapsed``.

    ``reuse=False`` is for inputs in equal buckets of the customer: the per-customer rows are
    not written but joined where they are, in their buckets, and the reference date is
    a scan of its own over one column.
    """
    day = F.to_date("order_date")
    per = fact.groupBy("customer_id").agg(
        F.max(day).alias("_last"),
        F.count_distinct("order_id").alias("frequency_orders"),
        F.sum("item_total").alias("_spend"))
    if reuse:
        per = materialize(per, "rfm_per_customer")
    dims = dim_customers.groupBy("customer_id", "name", "email").agg(F.count(F.lit(1)).alias("_k"))
    ref = (per.agg(F.max("_last")) if reuse else fact.agg(F.max(day))).scalar()  # over all rows of the fact, before the join
    return (per.filter(F.col("_last").isNotNull() & F.col("_spend").isNotNull()).join(dims, "customer_id")
            .select("customer_id", F.col("name").alias("customer_name"), "email",
                    F.datediff(ref, F.col("_last")).cast("bigint").alias("recency_days"),
                    F.col("frequency_orders").cast("bigint").alias("frequency_orders"),
                    F.round(F.col("_spend") * F.col("_k"), 2).alias("monetary_spend")))


def score(metrics: DataFrame, recency: str, frequency: str, monetary: str, tie: list[str],
          method: str = "ntile") -> DataFrame:
    """Add r/f/m scores 1..5: newest recency, highest frequency and spend score 5."""
    to_score = ntile_from_rank if method == "ntile" else quantile_bin_from_rank
    specs = [("_r_rank", F.col(recency), True), ("_f_rank", F.col(frequency), False),
             ("_m_rank", F.col(monetary), False)]
    out = add_global_ranks(metrics, specs, tie, total_col="_n")
    return out.select(*metrics.columns, *[
        to_score(F.col(f"_{x}_rank"), F.col("_n")).alias(f"{x}_score") for x in ("r", "f", "m")])


def rfm_p(fact: DataFrame) -> DataFrame:
    """Preset P per customer: metrics, quantile-bin scores, segment."""
    m = metrics_elapsed(fact)
    s = score(m, "recency", "frequency", "monetary", ["customer_id"], method="quantile")
    return s.withColumn("segment", segment_p(F.col("r_score"), F.col("f_score"), F.col("m_score")))


def _scored_q(fact: DataFrame, dim_customers: DataFrame, reuse: bool = True) -> DataFrame:
    """Preset Q's metrics and scores, spend still DECIMAL."""
    return score(metrics_calendar(fact, dim_customers, reuse), "recency_days", "frequency_orders", "monetary_spend",
                 ["customer_id", "customer_name", "email"], method="ntile")


def rfm_q(fact: DataFrame, dim_customers: DataFrame, reuse: bool = True) -> DataFrame:
    """Preset Q, the SQL report's columns and order (largest spend first, then customer)."""
    r, f, mm = F.col("r_score"), F.col("f_score"), F.col("m_score")
    report = _scored_q(fact, dim_customers, reuse).orderBy(F.desc("monetary_spend"), "customer_id", "customer_name", "email")
    return report.select(
        "customer_id", "customer_name", "email", "recency_days", "frequency_orders",
        F.col("monetary_spend").cast("double").alias("monetary_spend"),
        "r_score", "f_score", "m_score",
        F.concat(r.cast("string"), f.cast("string"), mm.cast("string")).alias("rfm_cell"),
        segment_q(r, f, mm).alias("customer_segmentation"),
    )


def _label_table(base: DataFrame, rows: list[tuple], names: list[str]) -> DataFrame:
    """Attach a fixed lookup (a few literal rows) to a one-row frame, no driver data."""
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names)]) for row in rows]
    return base.select("*", F.inline(F.array(*structs)))


def segment_rollup(scored: DataFrame, labels: list[str], seg_col: str = "segment",
                   spend_col: str = "monetary") -> DataFrame:
    """Count and revenue for every label (zero when empty); no rows when
    fewer than five customers were scored."""
    counts = scored.groupBy(seg_col).agg(
        F.count(F.lit(1)).alias("_cnt"), F.sum(spend_col).alias("_rev"))
    n = scored.agg(F.count(F.lit(1)).alias("_n"))
    lab = _label_table(n, [(i, l_) for i, l_ in enumerate(labels)], ["segment_order", "segment"])
    return (lab.filter(F.col("_n") >= MIN_CUSTOMERS)
            .join(counts.withColumnRenamed(seg_col, "segment"), "segment", "left")
            .select("segment", F.col("segment_order").cast("bigint").alias("segment_order"),
                    F.coalesce(F.col("_cnt"), F.lit(0)).cast("bigint").alias("customers"),
                    F.coalesce(F.round(F.col("_rev"), 2).cast("double"), F.lit(0.0)).alias("revenue")))


def rfm_segments(fact: DataFrame) -> DataFrame:
    return segment_rollup(rfm_p(fact), P_LABELS)


def rfm_strategy(fact: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Preset R: documented tiers with their strategy, customers and revenue per tier."""
    q = _scored_q(fact, dim_customers)
    tiers = q.withColumn("tier", segment_r(F.col("r_score"), F.col("f_score"), F.col("m_score")))
    counts = tiers.groupBy("tier").agg(F.count(F.lit(1)).alias("_cnt"), F.sum("monetary_spend").alias("_rev"))
    one = tiers.agg(F.count(F.lit(1)).alias("_n"))
    lab = _label_table(one, [(i, *t) for i, t in enumerate(R_TIERS)], ["tier_order", "tier", "rule", "strategy"])
    return (lab.join(counts, "tier", "left")
            .select("tier", F.col("tier_order").cast("bigint").alias("tier_order"),
                    F.col("rule").cast("string").alias("rule"), F.col("strategy").cast("string").alias("strategy"),
                    F.coalesce(F.col("_cnt"), F.lit(0)).cast("bigint").alias("customers"),
                    F.coalesce(F.round(F.col("_rev"), 2), F.lit(0.0)).cast("double").alias("revenue")))
