"""S7 build-if-missing and L11 access modes."""

from decimal import Decimal

from starling.plans import etl, marts
from starling.sources import messy
from starling.sources import raw as rw

from conftest import SF001


def test_ensure_star_builds_once(spark, tmp_dir):
    for name, df in messy.raw_tables(spark, SF001).items():
        rw.write_csv(df.drop("_seq") if "_seq" in df.columns else df, f"{tmp_dir}/raw/{name}.csv")
    star = etl.ensure_star(spark, f"{tmp_dir}/raw", f"{tmp_dir}/star")
    n = star["fact_sales"].count()
    assert n > 0
    again = etl.ensure_star(spark, f"{tmp_dir}/nothing", f"{tmp_dir}/star")  # present: no rebuild
    assert again["fact_sales"].count() == n


def test_views_and_extracts(spark, tmp_dir):
    from starling.sources import tables as tb
    star = tb.star(spark, SF001)
    marts.register_views(spark, star, prefix="t_")
    live = spark.sql("SELECT category, SUM(item_total) AS r FROM t_fact_sales f "
                     "JOIN t_dim_products p USING (product_id) GROUP BY category").count()
    paths = marts.write_extracts(spark, star, f"{tmp_dir}/marts")
    assert spark.read.parquet(paths["category_sales"]).count() == live


def test_an_extract_can_be_read_while_it_is_written_again(spark, tmp_dir):
    from starling.operators import warehouse as wh
    from starling.sources import tables as tb
    star = tb.star(spark, SF001)
    marts.write_extracts(spark, star, f"{tmp_dir}/marts")
    old = marts.read_extract(spark, f"{tmp_dir}/marts", "monthly_sales")
    rows = old.count()
    fewer = {**star, "fact_sales": star["fact_sales"].filter("order_date < timestamp_ntz'1994-01-01 00:00:00'")}
    paths = marts.write_extracts(spark, fewer, f"{tmp_dir}/marts")
    assert old.count() == rows  # its files are still there
    assert marts.read_extract(spark, f"{tmp_dir}/marts", "monthly_sales").count() == spark.read.parquet(paths["monthly_sales"]).count() < rows
    assert wh.current_version(spark, f"{tmp_dir}/marts/monthly_sales").version == 2


def _fact(spark, rows):
    from pyspark.sql import functions as F
    return spark.createDataFrame(rows, "order_id string, customer_id string, product_id string, quantity int, item_total decimal(24,2), day string").select(
        "order_id", "customer_id", "product_id", "quantity", "item_total", F.col("day").cast("timestamp_ntz").alias("order_date"))


def _products(spark):
    return spark.createDataFrame([("P1", "Pens"), ("P2", "Ink"), ("P3", None)], "product_id string, category string")


def _state(spark, base):
    return {n: {r[0]: (r.lines, float(r.units), float(r.revenue)) for r in marts.wh.read_current(spark, f"{base}/{n}").filter("lines > 0").collect()}
            for n in marts.PARTS}


def _expected(spark, fact):
    return {n: {r[0]: (r.lines, float(r.units), float(r.revenue)) for r in df.collect()}
            for n, df in marts.fact_parts(fact, _products(spark)).items()}


def test_parts_follow_every_batch(spark, tmp_dir):
    """Rows that move to another month, order lines of other prices, keys replaced by several rows, products without category."""
    products = _products(spark)
    rows = [("A", "C1", "P1", 1, 10, "2024-01-05"), ("A", "C1", "P2", 2, 20, "2024-01-05"), ("B", "C2", "P1", 3, 30, "2024-02-05"),
            ("C", "C2", "P3", 1, 5, None)]
    table, base = f"{tmp_dir}/fact", f"{tmp_dir}/marts"
    fact = _fact(spark, [(a, b, c, d, Decimal(e), f) for a, b, c, d, e, f in rows])
    marts.wh.upsert_table(spark, table, fact, ["order_id", "product_id"], partition_by=["order_month"])
    marts.build_parts(spark, fact, products, base)
    from decimal import Decimal as D
    batches = [
        ("merge", [("A", "C1", "P1", 1, D(99), "2024-03-01"), ("D", "C3", "P2", 7, D(70), "2024-03-02")]),
        ("replace", [("B", "C2", "P1", 1, D(1), "2024-02-06"), ("B", "C2", "P1", 1, D(2), "2024-04-06"), ("C", "C2", "P3", 2, D(6), "2024-04-06")]),
        ("merge", []),
    ]
    for k, (mode, batch) in enumerate(batches):
        for _ in range(2):  # a batch that is run again changes nothing
            marts.load_batch(spark, table, base, _fact(spark, batch), products, f"batch-{k}", mode)
        assert _state(spark, base) == _expected(spark, marts.wh.read_current(spark, table)), k
    customers = spark.createDataFrame([("C1",), ("C2",)], "customer_id string")
    got = marts.publish_marts(spark, base, customers)
    assert tuple(got["kpi_totals"].first()) == (99 + 20 + 70 + 3 + 6, 4, 2, round((99 + 20 + 70 + 3 + 6) / 4, 2))


def test_a_batch_that_stopped_goes_on(spark, tmp_dir, monkeypatch):
    from decimal import Decimal as D
    products, table, base = _products(spark), f"{tmp_dir}/fact", f"{tmp_dir}/marts"
    fact = _fact(spark, [("A", "C1", "P1", 1, D(10), "2024-01-05"), ("B", "C1", "P2", 1, D(20), "2024-02-05")])
    marts.wh.upsert_table(spark, table, fact, ["order_id", "product_id"], partition_by=["order_month"])
    marts.build_parts(spark, fact, products, base)
    batch = _fact(spark, [("A", "C1", "P1", 1, D(11), "2024-01-05"), ("E", "C1", "P2", 1, D(7), "2024-05-05")])
    inner = marts.wh.upsert_table

    def stops(spark_, path, *rest, **options):
        if path.endswith("by_category"):
            raise RuntimeError("stopped")
        return inner(spark_, path, *rest, **options)

    monkeypatch.setattr(marts.wh, "upsert_table", stops)
    try:
        marts.load_batch(spark, table, base, batch, products, "b")
        raise AssertionError("it did not stop")
    except RuntimeError:
        pass
    monkeypatch.undo()
    marts.load_batch(spark, table, base, batch, products, "b")
    assert _state(spark, base) == _expected(spark, marts.wh.read_current(spark, table))
