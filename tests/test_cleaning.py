"""Cleaning steps on literal raw rows: order of steps, counts, edge rules."""

from decimal import Decimal

from starling.plans import etl
from starling.schemas import RAW_CUSTOMERS, RAW_ORDERS, RAW_PRODUCTS

C = RAW_CUSTOMERS.simpleString()[len("struct<"):-1].replace(":", " ") + ", _seq long"
P = RAW_PRODUCTS.simpleString()[len("struct<"):-1].replace(":", " ") + ", _seq long"
O = RAW_ORDERS.simpleString()[len("struct<"):-1].replace(":", " ")


def _raw(spark):
    customers = spark.createDataFrame([
        ("C1", "Ann", "a@x.com", "2024-01-05", "X", "Y", "US", 1),
        ("C1", "Ann", "a@x.com", "2024-01-05", "X", "Y", "US", 2),       # exact duplicate
        ("C2", "Bob", "b@x.com", "05-03-2024", "X", "Y", "US", 3),       # month-first date
        ("C9", "Bob2", "b@x.com", "2024-02-01", "X", "Y", "US", 4),      # same email, later in file
        ("C3", "Cy", "NaN", "2024-01-05", "X", "Y", "US", 5),            # null token
        ("C4", "Di", "  ", "2024-01-05", "X", "Y", "US", 6),             # blank, exempt from C2
        ("C5", "Ed", "  ", "2024-01-05", "X", "Y", "US", 7),
        ("C6", "Fa", "f@x.com", "not a date", "X", "Y", "US", 8),        # unparseable
        ("C7", "Gi", "g@x.com", "1700000000", "X", "Y", "US", 9),        # Unix seconds
    ], C)
    products = spark.createDataFrame([
        ("P1", "Pen", "Office", "2.50", 1),
        ("P1", "Pen", "Office", "2.50", 2),
        ("P2", "Ink", "Office", "n/a", 3),                                 # price null, row stays
        ("P3", "Cup", "Home", "abc", 4),
    ], P)
    orders = spark.createDataFrame([
        ("O1", "C1", "P1", "2", "2.50", "2024-03-01 10:00:00"),
        ("O1", "C1", "P1", "2", "2.50", "2024-03-01 10:00:00"),          # exact duplicate
        ("O1", "C1", "P2", "1", "3.333", "2024-03-01 10:00:00"),
        ("O1", "C1", "PX", "1", "1.00", "2024-03-01 10:00:00"),          # product orphan, in order_total
        ("O2", "CX", "P1", "1", "2.50", "03/02/2024 09:30"),             # customer orphan
        ("O3", "C2", "P1", "0", "2.50", "2024-03-03 00:00:00"),          # invalid qty
        ("O4", "C2", "P1", "abc", "-1", "garbage"),                      # bad date AND bad amount
        ("O5", "C2", "P3", "1", "NaN", "2024-03-05 00:00:00"),           # price NaN -> invalid
    ], O)
    return {"customers": customers, "products": products, "orders": orders}


def test_customers(spark):
    run = etl.clean(_raw(spark))
    got = {r.customer_id: r for r in run.dim_customers.collect()}
    assert sorted(got) == ["C1", "C2", "C7"]
    assert str(got["C2"].signup_date) == "2024-05-03"
    assert str(got["C7"].signup_date) == "2023-11-14"
    rep = {(r.table_name, r.metric): r.value for r in run.report.collect()}
    assert rep[("customers", "initial_rows")] == 9
    assert rep[("customers", "exact_duplicates_removed")] == 1
    assert rep[("customers", "same_email_duplicates_removed")] == 2   # C9 and the second blank
    assert rep[("customers", "missing_email_dropped")] == 2           # NaN and the first blank
    assert rep[("customers", "nonstandard_dates_standardized")] == 3
    assert rep[("customers", "unparseable_dates_dropped")] == 1
    assert rep[("customers", "final_rows")] == 3


def test_products_keep_null_price(spark):
    run = etl.clean(_raw(spark))
    got = {r.product_id: r.price for r in run.dim_products.collect()}
    assert got == {"P1": Decimal("2.50"), "P2": None, "P3": None}


def test_orders_steps_and_totals(spark):
    run = etl.clean(_raw(spark))
    lines = {(r.order_id, r.product_id): r for r in run.order_lines.collect()}
    assert sorted(lines) == [("O1", "P1"), ("O1", "P2"), ("O1", "PX"), ("O2", "P1")]
    # order_total sums unrounded line totals before orphan lines go: 5 + 3.333 + 1
    assert lines[("O1", "P1")].order_total == Decimal("9.33")
    assert lines[("O1", "P2")].item_total == Decimal("3.33")
    fact = {(r.order_id, r.product_id) for r in run.fact_sales.collect()}
    assert fact == {("O1", "P1"), ("O1", "P2")}
    rep = {(r.table_name, r.metric): r.value for r in run.report.collect()}
    assert rep[("orders", "initial_rows")] == 8
    assert rep[("orders", "exact_duplicates_removed")] == 1
    assert rep[("orders", "nonstandard_dates_standardized")] == 2
    assert rep[("orders", "unparseable_dates_dropped")] == 1           # O4 counted under date only
    assert rep[("orders", "invalid_amounts_dropped")] == 2
    assert rep[("orders", "orphan_customer_lines_dropped")] == 1
    assert rep[("orders", "orphan_product_lines_dropped")] == 1
    assert rep[("orders", "final_rows")] == 2
    assert rep[("products", "exact_duplicates_removed")] == 1


def test_report_invariant_initial_minus_dropped(spark):
    rep = etl.clean(_raw(spark)).report.collect()
    for table in ("customers", "orders"):
        rows = sorted((r.step, r.metric, r.value) for r in rep if r.table_name == table)
        dropped = sum(v for _, m, v in rows if m.endswith(("removed", "dropped")))
        assert rows[0][2] - dropped == rows[-1][2]
