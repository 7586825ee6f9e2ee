"""What is shuffled and written: a step's rows go through it once, and results stay as they were."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from starling.operators import warehouse as wh
from starling.plans import catalog, marts
from starling.sources import tables as tb

KEYS = ["order_id", "product_id"]


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    """A folder of driver tables: repeated and null keys, an order of many lines, lines without an order."""
    folder = str(tmp_path_factory.mktemp("source"))
    lines = [(i % 40 if i % 5 else 7, i % 9, i % 4, i % 3, float(1 + i % 6)) for i in range(400)]
    lines += [(None, 1, 1, 1, 2.0), (1, None, 1, 1, 2.0), (99, 1, 1, 1, 2.0), (3, 4, 1, 1, None), (3, 4, 1, 1, None)]
    orders = [(k, None if k == 4 else k % 6, f"2024-{1 + k % 12:02d}-{1 + k % 27:02d} 00:00:00") for k in range(40)]
    orders += [(7, 5, "2023-02-01 00:00:00"), (None, 1, "2024-01-01 00:00:00"), (8, 1, None)]
    parts = [(k, f"name {k}", f"type {k % 3}", None if k == 5 else 10.005 + k) for k in range(9)] + [(2, "again", "type 1", 3.5)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double").write.parquet(
        f"{folder}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, d string").select(
        "o_orderkey", "o_custkey", F.col("d").cast("timestamp_ntz").alias("o_orderdate")).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_type string, p_retailprice double").write.parquet(f"{folder}/part.parquet")
    return folder


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=str)


def _written_plans(run):
    plans, write = [], DataFrameWriter.parquet

    def noted(self, *args, **kw):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, *args, **kw)

    DataFrameWriter.parquet = noted
    try:
        run()
    finally:
        DataFrameWriter.parquet = write
    return plans


@pytest.mark.parametrize("most", [tb.HOT_LINES, 20])
def test_marked_lines_are_the_fact_and_its_first_lines(spark, source, most):
    """By both ways, that of the hot order (beyond 20 lines) too."""
    fact = tb.fact_sales(spark, source, extended=True)
    cols = ["order_id", "customer_id", "product_id", "quantity", "unit_price", "item_total", "order_total", "order_date"]
    firsts = fact.groupBy(*KEYS).agg(F.min(F.struct(*tb.FIRST_BY)).alias("r")).select(
        *[F.col(c) if c in KEYS else F.col("r")[c].alias(c) for c in cols])
    got = tb.marked_lines(spark, source, most)
    assert _sorted(got.filter("is_line").select(*cols)) == _sorted(fact.select(*cols))
    assert _sorted(got.filter("is_first").select(*cols)) == _sorted(firsts)
    assert (got.filter("is_first and not is_line").count() > 0) == (most == 20)


def test_hot_orders_are_found_exactly(spark):
    keys = spark.range(1000).select(F.when(F.col("id") < 300, 1).when(F.col("id") < 500, 2).when(F.col("id") < 502, None)
                                    .otherwise(F.col("id")).alias("order_id"))
    assert tb.hot_orders(keys, 300) is None
    assert {r[0] for r in tb.hot_orders(keys, 199).collect()} == {1, 2}


@pytest.mark.parametrize("reduce_keys", [True, False])
def test_upsert_inputs_read_the_written_fact(spark, source, reduce_keys):
    """neither the target nor a sort of whole rows shuffles the fact again."""
    target, staged = catalog._upsert_inputs(spark, source, reduce_keys)
    plan = target._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [order_id" not in plan and "Join" not in plan, plan
    assert "min(struct" not in staged._jdf.queryExecution().optimizedPlan().toString()


def test_a_written_staging_is_not_copied(spark, tmp_dir, monkeypatch):
    """Rows that are a copy already serve as the staging; they are checked all the same and stay."""
    rows = spark.createDataFrame([(1, 1, 1), (2, 1, 2), (2, 1, 3)], "order_id long, product_id long, quantity int")
    rows.write.parquet(f"{tmp_dir}/copy")
    rows = spark.read.parquet(f"{tmp_dir}/copy")
    monkeypatch.setattr(wh, "write_counted", lambda *a, **k: pytest.fail("copied again"))
    with pytest.raises(wh.KeyViolation):
        wh.upsert_table(spark, f"{tmp_dir}/fact", rows, KEYS, "merge", written=True)
    with pytest.raises(wh.KeyViolation):
        wh.upsert_table(spark, f"{tmp_dir}/fact", rows.withColumn("order_id", F.nullif("order_id", F.lit(1))), KEYS, "replace", written=True)
    assert _sorted(wh.upsert_table(spark, f"{tmp_dir}/fact", rows, KEYS, "replace", written=True)) == [(1, 1, 1), (2, 1, 2), (2, 1, 3)]
    assert rows.count() == 3


def _dated(spark, rows):
    return spark.createDataFrame(rows, "order_id string, customer_id string, product_id string, quantity int, price int, day string").select(
        "order_id", "customer_id", "product_id", "quantity", F.col("price").cast("decimal(24,2)").alias("item_total"),
        F.col("day").cast("timestamp_ntz").alias("order_date"))


def test_whole_rows_are_read_from_the_folders_that_hold_a_key(spark, tmp_dir):
    """of the other months only keys are read."""
    table = f"{tmp_dir}/fact"
    wh.upsert_table(spark, table, _dated(spark, [("A", "C", "P", 1, 5, "2024-01-05"), ("B", "C", "P", 1, 6, "2024-02-05"),
                                                 ("C", "C", "P", 1, 7, None)]), KEYS, partition_by=["order_month"])
    staged = _dated(spark, [("A", "C", "P", 3, 8, "2024-03-01"), ("D", "C", "P", 3, 9, "2024-02-01")])
    got = wh.rows_of_keys(spark, table, staged, KEYS)
    assert [r.item_total for r in got.collect()] == [5]
    assert all("202401" in f for f in got.inputFiles()), got.inputFiles()
    assert wh.rows_of_keys(spark, table, staged.filter("order_id = 'D'"), KEYS).count() == 0


def test_a_batch_joins_the_fact_once_for_all_parts(spark, tmp_dir):
    """the rows a batch replaces are found once and written, not once for each part."""
    products = spark.createDataFrame([("P", "Pen")], "product_id string, category string")
    table, base = f"{tmp_dir}/fact", f"{tmp_dir}/marts"
    fact = _dated(spark, [("A", "C", "P", 1, 5, "2024-01-05"), ("B", "C", "P", 1, 6, "2024-02-05")])
    wh.upsert_table(spark, table, fact, KEYS, partition_by=["order_month"])
    marts.build_parts(spark, fact, products, base)
    batch = _dated(spark, [("A", "C", "P", 3, 8, "2024-01-05")])
    plans = _written_plans(lambda: marts.load_batch(spark, table, base, batch, products, "b"))
    assert sum("LeftSemi" in p and "item_total" in p for p in plans) == 1
    got = {r.month: float(r.revenue) for r in wh.read_current(spark, f"{base}/by_month").collect()}
    assert got == {"2024-01": 8.0, "2024-02": 6.0}


def test_the_partition_label_is_not_shuffled(spark, tmp_dir):
    """the text that names a row's folder is made behind the exchange."""
    rows = spark.createDataFrame([(k, k % 3, k) for k in range(50)], "order_id long, product_id long, quantity int")
    plans = _written_plans(lambda: wh.write_version(spark, rows, f"{tmp_dir}/fact", sort_by=["quantity"], buckets=4, bucket_keys=KEYS))
    spread = [line for p in plans for line in p.splitlines() if "rangepartitioning(" in line]
    assert spread and not any(f"rangepartitioning({wh.PART}" in line for line in spread), spread
    assert _sorted(wh.read_current(spark, f"{tmp_dir}/fact").select(*rows.columns)) == _sorted(rows)


def test_key_check_deals_keys_over_tasks_before_it_counts(spark):
    """no task combines the keys of a whole input split; nulls are counted, not grouped."""
    from starling.operators import integrity as ig
    rows = spark.createDataFrame([(1, 1), (1, 1), (1, 1), (2, 1), (2, 2), (2, 2), (None, 1), (None, 1), (3, None)], "a long, b long")
    out = ig.pk_violations({"t": rows}, {"t": ["a", "b"]})
    assert [tuple(r) for r in out.collect()] == [("t", "a,b", 2, 5, 3)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(a" in plan and "REPARTITION_BY_NUM" in plan, plan
    # Aggregates by key stand above the exchange only.
    deal = next(k for k, line in enumerate(plan.splitlines()) if "REPARTITION_BY_NUM" in line)
    assert not any("HashAggregate(keys=[a" in line for line in plan.splitlines()[deal:deal + 4]), plan
    empty = ig.pk_violations({"t": rows.limit(0)}, {"t": ["a", "b"]})
    assert [tuple(r) for r in empty.collect()] == [("t", "a,b", 0, 0, 0)]


def test_tasks_follow_the_rows(spark, tmp_dir):
    from starling.session import ROWS_PER_TASK, tasks_for
    spark.range(1000).write.parquet(f"{tmp_dir}/rows")
    rows = spark.read.parquet(f"{tmp_dir}/rows")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert tasks_for(rows) == least and tasks_for(rows, 10) == 100 and ROWS_PER_TASK > 1000


def test_cleaning_shuffles_texts_and_counts_only(spark):
    """typed values follow from the texts and are made behind the exchange of the duplicates."""
    from starling.operators import cleaning as cl
    rows = [("O1", "C1", "P1", "2", "2.505", "2024-03-01 10:00:00"), ("O1", "C1", "P1", "2", "2.505", "2024-03-01 10:00:00"),
            ("O1", "C2", "P2", "1", "0.004", "03/02/2024 11:00"), ("O2", None, "P1", "abc", "1", "2024-03-01 10:00:00"),
            (None, "C1", "P1", "1.5", "3", "2024-03-01 10:00:00"), ("O3", "C1", "P1", "1", "1", "garbage")]
    raw = spark.createDataFrame(rows, "order_id string, customer_id string, product_id string, quantity string, unit_price string, order_date string")
    flagged = []
    plans = _written_plans(lambda: flagged.append(cl.flag_orders(raw)))
    assert len(plans) == 1 and "HashAggregate" in plans[0] and "min(" not in plans[0], plans
    assert _sorted(flagged[0]) == _sorted(cl.flag_orders(raw, reuse=False))
    lines = []
    plans = _written_plans(lambda: lines.append(cl.order_lines(flagged[0])))
    got = {(r.order_id, r.customer_id): (str(r.item_total), None if r.order_total is None else str(r.order_total)) for r in lines[0].collect()}
    assert got == {("O1", "C1"): ("5.01", "5.01"), ("O1", "C2"): ("0.00", "5.01"), (None, "C1"): ("4.50", None)}
    exchanged = lines[0]._jdf.queryExecution().optimizedPlan().toString()
    below = exchanged[exchanged.index("Join"):]
    assert " * " not in below, exchanged
