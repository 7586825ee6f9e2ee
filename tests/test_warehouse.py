"""Upserts on versioned Parquet tables, publishing, pruning and bucketing."""

import pytest
from pyspark.sql import functions as F

from starling.functions.dates import between_dates
from starling.operators import warehouse as wh
from starling.sources import tables as tb

from conftest import SF001

KEYS = ["order_id", "product_id"]


def _rows(spark, rows):
    return spark.createDataFrame(rows, "order_id long, product_id long, quantity int")


def test_merge_then_rerun_is_identical(spark, tmp_dir):
    t = f"{tmp_dir}/fact"
    wh.upsert_table(spark, t, _rows(spark, [(1, 1, 1), (1, 2, 1), (2, 1, 1)]), KEYS)
    staged = _rows(spark, [(1, 2, 5), (3, 3, 1)])
    once = sorted(wh.upsert_table(spark, t, staged, KEYS).collect())
    twice = sorted(wh.upsert_table(spark, t, staged, KEYS).collect())
    assert once == twice == sorted([(1, 1, 1), (1, 2, 5), (2, 1, 1), (3, 3, 1)])
    assert wh.current_version(spark, t)[0] == 3


def test_merge_rejects_repeated_key_replace_keeps_both(spark, tmp_dir):
    t = f"{tmp_dir}/fact"
    wh.upsert_table(spark, t, _rows(spark, [(1, 1, 1)]), KEYS)
    staged = _rows(spark, [(1, 1, 2), (1, 1, 3)])
    with pytest.raises(wh.KeyViolation):
        wh.upsert_table(spark, t, staged, KEYS, mode="merge")
    got = sorted(wh.upsert_table(spark, t, staged, KEYS, mode="replace").collect())
    assert got == [(1, 1, 2), (1, 1, 3)]


def test_null_key_rejected(spark, tmp_dir):
    with pytest.raises(wh.KeyViolation):
        wh.upsert_table(spark, f"{tmp_dir}/fact", _rows(spark, [(None, 1, 1)]), KEYS, mode="replace")


def test_publish_partitions_and_pruning(spark, tmp_dir):
    star = tb.star(spark, SF001)
    paths = wh.publish_star(spark, star, f"{tmp_dir}/star")
    fact = spark.read.parquet(paths["fact_sales"])
    assert fact.count() == star["fact_sales"].count()
    q = between_dates(fact, "order_date", "order_month", "1996-01-01", "1996-03-01")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan
    want = star["fact_sales"].filter(
        (F.col("order_date") >= F.lit("1996-01-01").cast("timestamp_ntz"))
        & (F.col("order_date") < F.lit("1996-03-01").cast("timestamp_ntz"))).count()
    assert q.count() == want


def test_bucketed_join_has_no_exchange(spark, tmp_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = tb.fact_sales(spark, SF001)
        wh.publish_bucketed_fact(spark, fact, f"{tmp_dir}/b1", "fact_b1", 4)
        wh.publish_bucketed_fact(spark, fact.select("customer_id", "order_id"), f"{tmp_dir}/b2", "fact_b2", 4)
        j = spark.table("fact_b1").join(spark.table("fact_b2").withColumnRenamed("order_id", "o2"), "customer_id")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS fact_b1")
        spark.sql("DROP TABLE IF EXISTS fact_b2")


def test_load_star_twice_equals_once(spark, tmp_dir):
    star = tb.star(spark, SF001)
    once = wh.load_star(spark, star, f"{tmp_dir}/wh", scratch_dir=f"{tmp_dir}/stg")
    rows_once = {n: sorted(df.collect()) for n, df in once.items()}
    twice = wh.load_star(spark, star, f"{tmp_dir}/wh", scratch_dir=f"{tmp_dir}/stg")
    assert {n: sorted(df.collect()) for n, df in twice.items()} == rows_once
    assert wh.current_version(spark, f"{tmp_dir}/wh/fact_sales")[0] == 2


def _dated(spark, rows):
    return spark.createDataFrame(rows, "order_id long, product_id long, quantity int, day string").select(
        "order_id", "product_id", "quantity", F.col("day").cast("timestamp_ntz").alias("order_date"))


def _key_rows(df):
    return sorted((r.order_id, r.product_id, r.quantity, str(r.order_date)[:10]) for r in df.collect())


def test_only_touched_partitions_are_rewritten(spark, tmp_dir):
    t = f"{tmp_dir}/fact"
    wh.upsert_table(spark, t, _dated(spark, [(1, 1, 1, "2024-01-05"), (2, 1, 1, "2024-02-05"), (3, 1, 1, "2024-03-05")]), KEYS,
                    partition_by=["order_month"])
    before = dict(wh.current_version(spark, t).parts)
    # Order 2 moves from February to May; January and March are not touched.
    got = wh.upsert_table(spark, t, _dated(spark, [(2, 1, 9, "2024-05-07")]), KEYS)
    after = dict(wh.current_version(spark, t).parts)
    assert _key_rows(got) == [(1, 1, 1, "2024-01-05"), (2, 1, 9, "2024-05-07"), (3, 1, 1, "2024-03-05")]
    assert after["202401"] == before["202401"] and after["202403"] == before["202403"]
    assert "202402" not in after and "202405" in after
    assert wh.current_version(spark, t).partition_by == ["order_month"]
    assert wh.drop_old_versions(spark, t)
    assert _key_rows(wh.read_current(spark, t)) == _key_rows(got)


def test_a_failed_write_does_not_block_the_table(spark, tmp_dir):
    t = f"{tmp_dir}/fact"
    wh.upsert_table(spark, t, _rows(spark, [(1, 1, 1)]), KEYS)
    _rows(spark, [(7, 7, 7)]).write.parquet(f"{t}/data/000002-left-behind")  # an attempt that never reached the log
    broken = _rows(spark, [(2, 2, 2)]).withColumn("quantity", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        wh.upsert_table(spark, t, broken, KEYS)
    assert wh.read_current(spark, t).collect() == [(1, 1, 1)]
    assert sorted(wh.upsert_table(spark, t, _rows(spark, [(2, 2, 2)]), KEYS).collect()) == [(1, 1, 1), (2, 2, 2)]


def test_merge_keeps_columns_it_does_not_name(spark, tmp_dir):
    t = f"{tmp_dir}/fact"
    wh.upsert_table(spark, t, _rows(spark, [(1, 1, 5), (2, 2, 6)]).withColumn("note", F.lit("n")), KEYS)
    part = spark.createDataFrame([(1, 1, "new"), (3, 3, "new")], "order_id long, product_id long, note string")
    got = wh.upsert_table(spark, t, part, KEYS)
    assert got.columns == ["order_id", "product_id", "quantity", "note"]
    assert sorted(map(tuple, got.collect())) == [(1, 1, 5, "new"), (2, 2, 6, "n"), (3, 3, None, "new")]
    for wrong in (part.withColumn("colour", F.lit("x")), part.withColumn("note", F.lit(1)), part.drop("product_id")):
        with pytest.raises(wh.SchemaMismatch):
            wh.upsert_table(spark, t, wrong, KEYS)
    assert wh.current_version(spark, t).version == 2


def test_empty_tables(spark, tmp_dir):
    t = f"{tmp_dir}/fact"
    none = _dated(spark, [(1, 1, 1, "2024-01-05")]).limit(0)
    assert wh.upsert_table(spark, t, none, KEYS, partition_by=["order_month"]).count() == 0
    assert wh.upsert_table(spark, t, _dated(spark, [(1, 1, 1, "2024-01-05")]), KEYS).count() == 1
    assert wh.upsert_table(spark, t, none, KEYS).count() == 1


def test_publish_checks_columns_and_nulls(spark, tmp_dir):
    star = tb.star(spark, SF001)
    with pytest.raises(wh.SchemaMismatch):
        wh.publish_star(spark, {**star, "dim_products": star["dim_products"].drop("category")}, f"{tmp_dir}/a")
    nulls = star["fact_sales"].withColumn("customer_id", F.when(F.col("order_id") % 7 == 0, None).otherwise(F.col("customer_id")))
    with pytest.raises(wh.KeyViolation):
        wh.publish_star(spark, {**star, "fact_sales": nulls}, f"{tmp_dir}/b")


# ---------------------------------------------------------------- odd partition values, other writers, layouts

ODD_VALUES = ["a:b", "a/b", "a%3Ab", "a%b", "", None, "null", "x,y", "x\\,y", "\\N", "\\E", "__HIVE_DEFAULT_PARTITION__", "a=b", "ü{x}[1]^"]


def test_merge_finds_rows_under_any_partition_value(spark, tmp_dir):
    t = f"{tmp_dir}/t"
    schema = "k long, v long, place string"
    rows = [(k, 10 * k, p) for k, p in enumerate(ODD_VALUES)]
    wh.upsert_table(spark, t, spark.createDataFrame(rows, schema), ["k"], partition_by=["place"])
    assert len(wh.current_version(spark, t).parts) == len(ODD_VALUES)
    # Every row again, half of them under the next one's value.
    n = len(ODD_VALUES)
    staged = [(k, k, ODD_VALUES[(k + k % 2) % n]) for k in range(n)]
    got = wh.upsert_table(spark, t, spark.createDataFrame(staged, schema), ["k"])
    assert sorted(map(tuple, got.select("k", "v").collect())) == [(k, k) for k in range(n)]
    assert {r.place for r in got.collect()} == {s[2] for s in staged}


def test_two_partition_columns_do_not_run_into_each_other(spark, tmp_dir):
    t = f"{tmp_dir}/t"
    rows = [(1, "a,b", "c"), (2, "a", "b,c"), (3, None, "c"), (4, "\\N", "c")]
    wh.upsert_table(spark, t, spark.createDataFrame(rows, "k long, p string, q string"), ["k"], partition_by=["p", "q"])
    assert len(wh.current_version(spark, t).parts) == 4
    got = wh.upsert_table(spark, t, spark.createDataFrame([(2, "a,b", "c")], "k long, p string, q string"), ["k"])
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [(1, "a,b", "c"), (2, "a,b", "c"), (3, None, "c"), (4, "\\N", "c")]))


def test_two_writers_from_one_version_lose_nothing(spark, tmp_dir):
    t = f"{tmp_dir}/fact"
    wh.upsert_table(spark, t, _rows(spark, [(1, 1, 1)]), KEYS)
    base = wh.current_version(spark, t)
    wh.write_version(spark, _rows(spark, [(1, 1, 1), (2, 2, 2)]), t, version=base.version + 1)
    with pytest.raises(wh.VersionConflict):
        wh.write_version(spark, _rows(spark, [(1, 1, 1), (3, 3, 3)]), t, version=base.version + 1)
    assert sorted(wh.read_current(spark, t).collect()) == [(1, 1, 1), (2, 2, 2)]


def test_an_overtaken_upsert_starts_over(spark, tmp_dir, monkeypatch):
    t = f"{tmp_dir}/fact"
    wh.upsert_table(spark, t, _rows(spark, [(1, 1, 1)]), KEYS)
    inner, overtaken = wh._attempt, []

    def slow(spark_, table, cur, *rest):
        if not overtaken:  # while this writer prepares its version, another one commits
            overtaken.append(cur.version)
            wh.upsert_table(spark, t, _rows(spark, [(2, 2, 2)]), KEYS)
        return inner(spark_, table, cur, *rest)

    monkeypatch.setattr(wh, "_attempt", slow)
    got = wh.upsert_table(spark, t, _rows(spark, [(1, 1, 7), (3, 3, 3)]), KEYS)
    assert sorted(got.collect()) == [(1, 1, 7), (2, 2, 2), (3, 3, 3)]
    assert overtaken == [1] and wh.current_version(spark, t).version == 3
    with pytest.raises(wh.VersionConflict):
        wh.upsert_table(spark, t, _rows(spark, [(4, 4, 4)]), KEYS, base_version=1)


def test_writers_at_once(spark, tmp_dir):
    from concurrent.futures import ThreadPoolExecutor
    t = f"{tmp_dir}/fact"
    wh.upsert_table(spark, t, _rows(spark, [(0, 0, 0)]), KEYS)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: wh.upsert_table(spark, t, _rows(spark, [(k, k, k)]), KEYS), range(1, 5)))
    assert sorted(wh.read_current(spark, t).collect()) == [(k, k, k) for k in range(5)]
    assert wh.current_version(spark, t).version == 5


def _read_folders(df):
    """Folders that the executed plan of a frame scans."""
    return {f.rsplit("/", 2)[-2] for f in df.inputFiles()}


def test_only_folders_of_the_staged_keys_are_scanned(spark, tmp_dir, monkeypatch):
    """With key buckets, an upsert never opens a folder of another bucket, whatever its partition."""
    t = f"{tmp_dir}/fact"
    rows = [(k, 1, k, f"2024-{k % 6 + 1:02d}-05") for k in range(200)]
    wh.upsert_table(spark, t, _dated(spark, rows), KEYS, partition_by=["order_month"], buckets=8)
    before = wh.current_version(spark, t)
    staged = [(7, 1, -1, "2024-09-01"), (1000, 1, -1, "2024-09-01")]  # the first one moves to another month
    own = {r.b for r in _dated(spark, staged).select(F.pmod(F.xxhash64(*KEYS), F.lit(8)).alias("b")).collect()}
    assert len(own) < 8
    scanned = set()
    reader = type(spark.read)
    inner = reader.parquet

    def parquet(self, *paths, **options):
        scanned.update(paths)
        return inner(self, *paths, **options)

    merge = wh.merge_plan
    plans = []
    monkeypatch.setattr(wh, "merge_plan", lambda old, new, keys: plans.append(old) or merge(old, new, keys))
    monkeypatch.setattr(reader, "parquet", parquet)
    got = wh.upsert_table(spark, t, _dated(spark, staged), KEYS)
    monkeypatch.undo()
    assert _key_rows(got) == sorted([(k, 1, q, d) for k, _, q, d in rows if k != 7] and
                                    [(k, p, q, d) for k, p, q, d in rows if k != 7] + staged)
    (old,) = plans
    assert old is None or {int(f.split(",")[-1].split("%2C")[-1]) for f in _read_folders(old)} <= own
    after = wh.current_version(spark, t)
    kept = [p for p in before.parts if int(p[0].split(",")[-1]) not in own]
    assert kept and set(kept) <= set(after.parts)
    assert (after.buckets, after.bucket_keys) == (8, KEYS)


def test_key_buckets_alone_need_no_look_at_keys(spark, tmp_dir):
    t = f"{tmp_dir}/fact"
    wh.upsert_table(spark, t, _rows(spark, [(k, k, k) for k in range(100)]), KEYS, buckets=16)
    staged = _rows(spark, [(5, 5, -5), (500, 5, -5)])
    cur = wh.current_version(spark, t)
    old, keep = wh.touched_parts(spark, cur, staged, KEYS)
    assert len(old) <= 2 and len(old) + len(keep) == len(cur.parts)
    assert _read_folders(wh.rows_of_keys(spark, t, staged, KEYS)) <= {p.rsplit("/", 1)[-1] for p in old}
    got = wh.upsert_table(spark, t, staged, KEYS)
    assert sorted(got.collect()) == sorted([(k, k, k) for k in range(100) if k != 5] + [(5, 5, -5), (500, 5, -5)])
    with pytest.raises(wh.SchemaMismatch, match="bucketed"):
        wh.upsert_table(spark, t, staged, ["order_id"])


# ---------------------------------------------------------------- typed targets, checks in the writing pass

def _texts(spark, star):
    """The star with every column as text, as a staging of CSV rows has it."""
    return {n: df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]) for n, df in star.items()}


def test_a_staging_of_texts_lands_typed(spark, tmp_dir):
    from starling.schemas import STAR_SCHEMAS
    star = tb.star(spark, SF001)
    loaded = wh.load_star(spark, _texts(spark, star), f"{tmp_dir}/wh")
    for name, df in loaded.items():
        have = {f.name: f.dataType for f in df.schema.fields}
        assert all(have[f.name] == f.dataType for f in STAR_SCHEMAS[name].fields), name
    assert loaded["fact_sales"].agg(F.sum("item_total")).first() == star["fact_sales"].agg(F.sum("item_total")).first()
    again = wh.load_star(spark, star, f"{tmp_dir}/wh")  # typed otherwise: cast to the declared types, so it fits
    assert again["fact_sales"].count() == star["fact_sales"].count()


def test_values_that_do_not_cast_and_nulls_are_refused_before_the_commit(spark, tmp_dir):
    star = tb.star(spark, SF001)
    bad = _texts(spark, star)
    some = F.col("product_id").cast("int") % 10 == 3
    lost = {**bad, "dim_products": bad["dim_products"].withColumn("price", F.when(some, "twelve").otherwise(F.col("price")))}
    with pytest.raises(wh.SchemaMismatch, match="price"):
        wh.load_star(spark, lost, f"{tmp_dir}/a")
    assert wh.current_version(spark, f"{tmp_dir}/a/dim_products") is None
    nulls = {**bad, "fact_sales": bad["fact_sales"].withColumn("order_date", F.when(~some, F.col("order_date")))}
    with pytest.raises(wh.KeyViolation, match="order_date"):
        wh.load_star(spark, nulls, f"{tmp_dir}/b")
    assert wh.current_version(spark, f"{tmp_dir}/b/dim_products").version == 1
    assert wh.current_version(spark, f"{tmp_dir}/b/fact_sales") is None


def test_foreign_keys_are_checked_by_the_load(spark, tmp_dir):
    star = tb.star(spark, SF001)
    few = {**star, "dim_products": star["dim_products"].filter("product_id > 20")}
    with pytest.raises(wh.KeyViolation, match="dim_products"):
        wh.load_star(spark, few, f"{tmp_dir}/a", enforce_foreign_keys=True)
    assert wh.current_version(spark, f"{tmp_dir}/a/fact_sales") is None
    assert wh.load_star(spark, few, f"{tmp_dir}/a")["fact_sales"].count() == star["fact_sales"].count()


def test_publish_counts_nulls_while_it_writes(spark, tmp_dir, monkeypatch):
    """After the copy of a table is written, only key columns of dimensions are read for a check."""
    aggregated = []
    frame = type(spark.range(0))
    inner = frame.groupBy
    monkeypatch.setattr(frame, "groupBy", lambda self, *cols: aggregated.append((self.columns, cols)) or inner(self, *cols))
    monkeypatch.setattr(frame, "agg", lambda self, *a: pytest.fail("an aggregate over a whole table"))
    wh.publish_star(spark, tb.star(spark, SF001, written=True), f"{tmp_dir}/star")
    monkeypatch.undo()
    assert [cols for columns, cols in aggregated if "item_total" not in columns and "c_custkey" not in columns
            and "_part" not in columns and "l_orderkey" not in columns][-2:] == [("customer_id",), ("product_id",)]


# ---------------------------------------------------------------- loads that go on, layouts that queries use

def test_a_stopped_load_goes_on(spark, tmp_dir):
    star = tb.star(spark, SF001, written=True)
    base = f"{tmp_dir}/wh"
    wh.load_star(spark, star, base, load_id="a")
    broken = {**star, "fact_sales": star["fact_sales"].withColumn("quantity", F.raise_error(F.lit("lost")).cast("int"))}
    with pytest.raises(Exception, match="lost"):
        wh.load_star(spark, broken, base, load_id="b")
    assert [wh.current_version(spark, f"{base}/{n}").version for n in star] == [2, 2, 1]
    wh.load_star(spark, star, base, load_id="b")
    wh.load_star(spark, star, base, load_id="b")
    assert [wh.current_version(spark, f"{base}/{n}").version for n in star] == [2, 2, 2]
    assert wh.current_version(spark, f"{base}/fact_sales").loads == ["a", "b"]


def test_dimension_is_replicated_by_its_measured_size(spark, tmp_dir):
    from starling.operators import kpis
    star = tb.star(spark, SF001)
    path = f"{tmp_dir}/products"
    star["dim_products"].write.parquet(path)
    size = wh.written_bytes(spark, path)

    def plan(bound):
        return kpis.category_sales(star["fact_sales"].select("product_id", "item_total"),
                                   wh.dimension(spark, path, bound))._jdf.queryExecution().optimizedPlan().toString()

    assert "rightHint=(strategy=broadcast)" in plan(size)
    assert "rightHint=(strategy=merge)" in plan(size - 1)


def test_rfm_over_equal_buckets_has_no_exchange(spark, tmp_dir):
    from starling.operators import rfm
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        star = wh.publish_bucketed_star(spark, tb.star(spark, SF001), f"{tmp_dir}/star", 4, "rfm_test_")
        metrics = rfm.metrics_calendar(star["fact_sales"], star["dim_customers"], reuse=False)
        plan = metrics._jdf.queryExecution().executedPlan().toString()
        main = plan[plan.index("SortMergeJoin"):]  # above it: the reference date, one row from a scan of one column
        assert main.count("Bucketed: true") == 2 and "Exchange" not in main
        lazy = rfm.metrics_calendar(tb.star(spark, SF001)["fact_sales"], star["dim_customers"])
        assert sorted(map(str, metrics.collect())) == sorted(map(str, lazy.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for n in ("dim_customers", "fact_sales"):
            spark.sql(f"DROP TABLE IF EXISTS rfm_test_{n}")


def test_a_log_of_the_earlier_format_is_not_a_new_table(spark, tmp_dir):
    _rows(spark, [(1, 1, 1)]).write.parquet(f"{tmp_dir}/t/{wh.LOG_DIR}")
    with pytest.raises(RuntimeError, match="earlier format"):
        wh.upsert_table(spark, f"{tmp_dir}/t", _rows(spark, [(1, 1, 1)]), KEYS)
