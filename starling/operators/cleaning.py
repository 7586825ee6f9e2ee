"""Cleaning and conforming operators (C1-C12) for the three raw tables.

Each table is cleaned in one plan that *flags* rows at every step instead of
materialising intermediate frames.  The flags feed both the cleaned output
(a filter) and the step report (one conditional aggregate), so the counters
never cost a job each.  Steps keep the reference order, which the counts depend
on: a row with a bad date and a bad price is counted only under the date step.

Skew: exact-duplicate removal and "first row per email" are aggregations
(map-side combine) followed by equi-joins, never a window over a hot key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import (STANDARD_DATE, STANDARD_DATETIME, is_nonstandard, parse_mixed_datetime, strip,
                               truncate_to_second)
from ..functions.values import money, normalize_null_tokens, to_number
from ..schemas import RAW_CUSTOMERS, RAW_ORDERS, RAW_PRODUCTS
from ..session import materialize
from ..sources.tables import with_order_totals

CUSTOMER_COLS = RAW_CUSTOMERS.fieldNames()
PRODUCT_COLS = RAW_PRODUCTS.fieldNames()
ORDER_COLS = RAW_ORDERS.fieldNames()

# Report metric names, in step order, per table.
CUSTOMER_METRICS = ["exact_duplicates_removed", "same_email_duplicates_removed", "missing_email_dropped",
                    "nonstandard_dates_standardized", "unparseable_dates_dropped"]
PRODUCT_METRICS = ["exact_duplicates_removed"]
ORDER_METRICS = ["exact_duplicates_removed", "nonstandard_dates_standardized", "unparseable_dates_dropped",
                 "invalid_amounts_dropped", "orphan_customer_lines_dropped", "orphan_product_lines_dropped"]


@dataclass
class Cleaned:
    """Cleaned rows plus a one-row frame of step counters (lazy, nothing run yet)."""
    df: DataFrame
    metrics: DataFrame


def _exact_dedupe(df: DataFrame, cols: list[str], derived: dict[str, Column] | None = None, written: bool = False) -> DataFrame:
    """One row per distinct data row, with its multiplicity and first position.

    Grouping on the data columns treats NULL = NULL, like a whole-row duplicate test.
    ``derived`` are per-row functions of the grouping columns (typed values, parsed
    dates) computed *as aggregate outputs* (``min`` of a value constant in the
    group): a later filter on them then stays above the aggregate instead of being
    pushed, with the whole parse expression, into the map-side aggregation stage.
    When the result is ``written`` at once no filter can be, and they are made behind the
    aggregate: they are not shuffled, and only distinct rows are parsed.
    """
    aggs = [F.count(F.lit(1)).alias("_n")]
    if "_seq" in df.columns:
        aggs.append(F.min("_seq").alias("_seq"))
    if written:
        return df.groupBy(*cols).agg(*aggs).select("*", *[expr.alias(name) for name, expr in (derived or {}).items()])
    aggs += [F.min(expr).alias(name) for name, expr in (derived or {}).items()]
    return df.groupBy(*cols).agg(*aggs)


def _prepare(raw: DataFrame, cols: list[str]) -> DataFrame:
    keep = cols + (["_seq"] if "_seq" in raw.columns else [])
    return normalize_null_tokens(raw.select(*keep), cols)


def _email_present(email: Column) -> Column:
    return email.isNotNull() & (email != "") & (email != "NaN")


def email_missing(email: Column) -> Column:
    t = strip(email)
    return email.isNull() | (t == "") | (F.lower(t) == "nan")


def flag_customers(raw: DataFrame, hyphen_day_first: bool = False, reuse: bool = True) -> DataFrame:
    """Customers after C1 with one boolean column per later step.

    The C1 result feeds both sides of the "first row per email" join; with
    ``reuse`` it is materialised once so the scan and shuffle are not run twice.
    """
    parsed = parse_mixed_datetime(F.col("signup_date"), hyphen_day_first)
    g = _exact_dedupe(_prepare(raw, CUSTOMER_COLS), CUSTOMER_COLS, {"_parsed": parsed}, written=reuse)
    if reuse:
        g = materialize(g, "customers_c1")
    email = F.col("email")
    # First row in file order per email; rows without an email are exempt.
    firsts = g.filter(_email_present(email)).groupBy("email").agg(F.min("_seq").alias("_first_seq"))
    if reuse:  # both sides of the join are then plain exchanges, which the adaptive skew join splits
        firsts = materialize(firsts, "email_firsts")
    f = g.join(firsts, "email", "left")
    crm = _email_present(email) & (F.col("_seq") != F.col("_first_seq"))
    missing = ~crm & email_missing(email)
    alive = ~crm & ~missing
    return f.select(
        *CUSTOMER_COLS, "_n",
        crm.alias("_crm_dup"),
        missing.alias("_missing_email"),
        (alive & is_nonstandard(F.col("signup_date"), STANDARD_DATE)).alias("_nonstandard"),
        "_parsed",
        alive.alias("_alive"),
    )


def clean_customers(raw: DataFrame, hyphen_day_first: bool = False) -> Cleaned:
    f = flag_customers(raw, hyphen_day_first)
    keep = F.col("_alive") & F.col("_parsed").isNotNull()
    df = f.filter(keep).select(
        "customer_id", "name", "email", F.to_date("_parsed").alias("signup_date"),
        "city", "state", "country")
    metrics = f.agg(
        F.sum("_n").alias("initial_rows"),
        F.sum(F.col("_n") - 1).alias("exact_duplicates_removed"),
        F.count_if("_crm_dup").alias("same_email_duplicates_removed"),
        F.count_if("_missing_email").alias("missing_email_dropped"),
        F.count_if("_nonstandard").alias("nonstandard_dates_standardized"),
        F.count_if(F.col("_alive") & F.col("_parsed").isNull()).alias("unparseable_dates_dropped"),
        F.count_if(keep).alias("final_rows"),
    )
    return Cleaned(df, metrics)


def clean_products(raw: DataFrame) -> Cleaned:
    """C1 then C8: a price that is not a number becomes NULL and the row stays."""
    g = _exact_dedupe(_prepare(raw, PRODUCT_COLS), PRODUCT_COLS)
    df = g.select("product_id", "product_name", "category", money(to_number(F.col("price"))).alias("price"))
    metrics = g.agg(
        F.sum("_n").alias("initial_rows"),
        F.sum(F.col("_n") - 1).alias("exact_duplicates_removed"),
        F.count(F.lit(1)).alias("final_rows"),
    )
    return Cleaned(df, metrics)


def flag_orders(raw: DataFrame, hyphen_day_first: bool = False, reuse: bool = True) -> DataFrame:
    """Order lines after C1 with date/amount flags and typed values.

    Consumed several times (lines, per-order totals joined back, step counts,
    orphan counts); with ``reuse`` it is materialised once.
    """
    parsed = truncate_to_second(parse_mixed_datetime(F.col("order_date"), hyphen_day_first))
    g = _exact_dedupe(_prepare(raw, ORDER_COLS), ORDER_COLS, {
        "_parsed": parsed.cast("timestamp_ntz"),
        "_q": to_number(F.col("quantity")),
        "_p": to_number(F.col("unit_price")),
    }, written=reuse)
    q, p = F.col("_q"), F.col("_p")
    valid_amount = F.coalesce((q > 0) & (p > 0), F.lit(False))
    flagged = g.select(
        "order_id", "customer_id", "product_id", "_n", "_q", "_p",
        is_nonstandard(F.col("order_date"), STANDARD_DATETIME).alias("_nonstandard"),
        "_parsed",
        valid_amount.alias("_valid_amount"),
    )
    return materialize(flagged, "orders_c1") if reuse else flagged


def order_lines(flagged: DataFrame) -> DataFrame:
    """Valid lines with item_total and order_total (C10-C12), before the key filter.

    order_total sums the *unrounded* line totals of the order and is taken here,
    before orphan lines go, so it can exceed the sum of the lines finally kept.
    Quantity and price keep the values the totals are made of (2.5 pieces stay 2.5).
    """
    lines = flagged.filter(F.col("_parsed").isNotNull() & F.col("_valid_amount")).select(
        "order_id", "customer_id", "product_id",
        F.col("_q").alias("quantity"),
        F.col("_p").alias("unit_price"),
        F.col("_parsed").alias("order_date"),
    )
    item = F.col("quantity") * F.col("unit_price")  # made where it is used, not carried through the join
    return with_order_totals(lines, item, split_hot=True).select(
        "order_id", "customer_id", "product_id", "quantity", "unit_price",
        money(item).alias("item_total"), "order_total", "order_date")


def order_metrics(flagged: DataFrame) -> DataFrame:
    dated = F.col("_parsed").isNotNull()
    return flagged.agg(
        F.sum("_n").alias("initial_rows"),
        F.sum(F.col("_n") - 1).alias("exact_duplicates_removed"),
        F.count_if("_nonstandard").alias("nonstandard_dates_standardized"),
        F.count_if(~dated).alias("unparseable_dates_dropped"),
        F.count_if(dated & ~F.col("_valid_amount")).alias("invalid_amounts_dropped"),
    )


def clean_orders(raw: DataFrame, hyphen_day_first: bool = False) -> Cleaned:
    f = flag_orders(raw, hyphen_day_first)
    return Cleaned(order_lines(f), order_metrics(f))
