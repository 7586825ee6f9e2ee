"""Incremental load: two order files through the stream = one batch clean of both."""

from pyspark.sql import functions as F

from starling.operators import warehouse as wh
from starling.plans import etl
from starling.sources import messy
from starling.sources import raw as rw
from starling.streaming.incremental import start_incremental_load

from conftest import SF001


def test_stream_equals_batch(spark, tmp_dir):
    raw = messy.raw_tables(spark, SF001)
    run = etl.clean(raw)
    orders = raw["orders"]
    # whole orders per file: even and odd order keys
    for i in (0, 1):
        rw.write_csv(orders.filter(F.col("order_id").cast("long") % 2 == i).coalesce(1), f"{tmp_dir}/in/part{i}")
    src = f"{tmp_dir}/in/*"
    q = start_incremental_load(spark, src, f"{tmp_dir}/fact", run.dim_customers, run.dim_products,
                               f"{tmp_dir}/ckpt", files_per_batch=1)
    q.awaitTermination(300)
    assert q.exception() is None
    want = run.fact_sales
    table = wh.read_current(spark, f"{tmp_dir}/fact")
    assert table.columns == [*want.columns, "order_month"]  # the layout of the fact: a batch rewrites the months it touches
    got = table.select(*want.columns)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # a second run over the same files is a no-op (checkpointed), the table is unchanged
    q2 = start_incremental_load(spark, src, f"{tmp_dir}/fact", run.dim_customers, run.dim_products,
                                f"{tmp_dir}/ckpt", files_per_batch=1)
    q2.awaitTermination(300)
    assert wh.read_current(spark, f"{tmp_dir}/fact").count() == want.count()
