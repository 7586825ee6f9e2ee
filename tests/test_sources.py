"""CSV sources: raw extracts written as several files read back in file order;
flat sales file; missing-input error."""

import pytest
from pyspark.sql import functions as F

from starling.plans import etl
from starling.schemas import RAW_FLAT
from starling.sources import messy
from starling.sources import raw as rw

from conftest import SF001


def test_csv_round_trip_matches_views(spark, tmp_dir):
    views = messy.raw_tables(spark, SF001)
    for name, df in views.items():
        # several part files, written in file order (the view's sequence)
        if "_seq" in df.columns:
            df = df.repartitionByRange(3, "_seq").sortWithinPartitions("_seq").drop("_seq")
        ordered = df
        rw.write_csv(ordered, f"{tmp_dir}/{name}.csv")
    from_csv = etl.clean(rw.read_raw_tables(spark, tmp_dir))
    direct = etl.clean(views)
    for attr in ("dim_customers", "dim_products", "fact_sales"):
        a, b = getattr(from_csv, attr), getattr(direct, attr)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, attr
    assert sorted(from_csv.report.collect()) == sorted(direct.report.collect())


def test_missing_input_names_table(spark, tmp_dir):
    with pytest.raises(rw.MissingInputError, match="customers"):
        rw.read_raw_tables(spark, f"{tmp_dir}/nothing-here")


def test_flat_sales_reader(spark, tmp_dir):
    rows = [("O1", "Ann", "Pen", "Office", "2", "2.50", "5.00", "2024-03-01 10:00:00"),
            ("O2", "Bob", "Ink", "Office", "1", "3.25", "3.25", "2024-03-02 11:00:00"),
            ("O3", "Bob", "Cup", "Home", "x", "1.00", "NaN", "bad")]
    spark.createDataFrame(rows, RAW_FLAT).coalesce(1).write.option("header", True).csv(f"{tmp_dir}/flat")
    df = rw.read_flat_sales(spark, f"{tmp_dir}/flat")
    got = {r.order_id: r for r in df.collect()}
    assert float(got["O1"].item_total) == 5.0 and got["O3"].quantity is None and got["O3"].order_date is None
    assert df.agg(F.sum("item_total")).first()[0] == 8.25


def _text(path, text):
    import os
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def test_quotes_and_newlines_belong_to_the_value(spark, tmp_dir):
    path = _text(f"{tmp_dir}/customers.csv", 'customer_id,name,email,signup_date,city,state,country\n'
                 'C1,"Ann ""A"", Lee",a@x.com,2024-01-05,X,Y,US\nC2,"two\nlines",b@x.com,2024-01-06,X,Y,US\n')
    rows = rw.read_raw_csv(spark, path, rw.RAW_SCHEMAS["customers"]).collect()
    assert [(r.customer_id, r.name, r.email, r.country) for r in rows] == [
        ("C1", 'Ann "A", Lee', "a@x.com", "US"), ("C2", "two\nlines", "b@x.com", "US")]


def test_columns_are_taken_by_name(spark, tmp_dir):
    path = _text(f"{tmp_dir}/products.csv", "price,product_id,product_name,extra,category\n9.99,P1,Pen,z,Office\n")
    row = rw.read_raw_csv(spark, path, rw.RAW_SCHEMAS["products"]).first()
    assert (row.product_id, row.price, row.category) == ("P1", "9.99", "Office")
    short = _text(f"{tmp_dir}/short.csv", "price,product_id\n1,P1\n")
    with pytest.raises(ValueError, match="category"):
        rw.read_raw_csv(spark, short, rw.RAW_SCHEMAS["products"])


def test_a_row_with_too_many_values_stops_the_read(spark, tmp_dir):
    path = _text(f"{tmp_dir}/products.csv", "product_id,product_name,category,price\nP1,Pen, red,Office,1.00\n")
    with pytest.raises(Exception, match="MALFORMED"):
        rw.read_raw_csv(spark, path, rw.RAW_SCHEMAS["products"]).collect()


def test_incomplete_star_is_rebuilt(spark, tmp_dir):
    views = messy.raw_tables(spark, SF001)
    for name, df in views.items():
        rw.write_csv(df.drop("_seq"), f"{tmp_dir}/raw/{name}.csv")
    spark.range(3).write.parquet(f"{tmp_dir}/star/dim_customers")  # what a broken build left
    star = etl.ensure_star(spark, f"{tmp_dir}/raw", f"{tmp_dir}/star")
    assert star["dim_products"].count() == views["products"].count()
    assert "email" in star["dim_customers"].columns and star["fact_sales"].count() > 0
    again = etl.ensure_star(spark, f"{tmp_dir}/nothing", f"{tmp_dir}/star")
    assert again["fact_sales"].count() == star["fact_sales"].count()


# ---------------------------------------------------------------- malformed rows, large files

HEADER = "customer_id,name,email,signup_date,city,state,country\n"


def _line(k):
    return f'C{k},"Name, ""{k}""",c{k}@x.com,2024-01-05,X,Y,US\n'


def test_malformed_rows_are_set_aside(spark, tmp_dir):
    folder = f"{tmp_dir}/customers.csv"
    _text(f"{folder}/a.csv", HEADER + _line(1) + "C2,too,many,2024-01-05,X,Y,US,more\n" + _line(3))
    _text(f"{folder}/b.csv", HEADER + "C4,few\n" + _line(5) + "\n" + _line(6))
    read = rw.read_raw_aside(spark, folder, rw.RAW_SCHEMAS["customers"], "customers")
    assert read.rejected == 2
    assert sorted((r.table_name, r.file.rsplit("/", 1)[-1], r.text) for r in read.rejects.collect()) == [
        ("customers", "a.csv", "C2,too,many,2024-01-05,X,Y,US,more"), ("customers", "b.csv", "C4,few")]
    assert [r.customer_id for r in read.rows.orderBy("_seq").collect()] == ["C1", "C3", "C5", "C6"]
    assert read.rows.columns == rw.read_raw_csv(spark, folder, rw.RAW_SCHEMAS["customers"]).columns
    with pytest.raises(rw.TooManyRejects, match="2 malformed rows of 6, at most 1"):
        rw.read_raw_aside(spark, folder, rw.RAW_SCHEMAS["customers"], "customers", max_rejects=1)


def test_the_star_is_built_around_malformed_rows(spark, tmp_dir):
    views = messy.raw_tables(spark, SF001)
    for name, df in views.items():
        rw.write_csv(df.orderBy("_seq").drop("_seq") if "_seq" in df.columns else df, f"{tmp_dir}/raw/{name}.csv")
    _text(f"{tmp_dir}/raw/orders.csv/zz.csv", ",".join(rw.RAW_SCHEMAS["orders"].fieldNames()) + "\n1,2\n3,4,5,6,7,8,9\n")
    run, rejects = etl.clean_files(spark, f"{tmp_dir}/raw")
    report = {(r.table_name, r.metric): r.value for r in run.report.collect()}
    assert report["orders", "malformed_rows_set_aside"] == 2 and report["customers", "malformed_rows_set_aside"] == 0
    want = {(r.table_name, r.metric): r.value for r in etl.clean(views).report.collect()}
    assert {k: v for k, v in report.items() if k[1] != "malformed_rows_set_aside"} == want
    assert sorted(r.text for r in rejects.collect()) == ["1,2", "3,4,5,6,7,8,9"]
    with pytest.raises(rw.TooManyRejects):
        etl.ensure_star(spark, f"{tmp_dir}/raw", f"{tmp_dir}/a", max_rejects=1)
    with pytest.raises(Exception, match="MALFORMED"):  # without a limit any malformed row ends the load, as before
        etl.ensure_star(spark, f"{tmp_dir}/raw", f"{tmp_dir}/b")
    star = etl.ensure_star(spark, f"{tmp_dir}/raw", f"{tmp_dir}/c", max_rejects=2)
    assert star["fact_sales"].count() == etl.clean(views).fact_sales.count()
    assert spark.read.parquet(f"{tmp_dir}/c/_rejects").count() == 2


@pytest.mark.parametrize("newline", [False, True])
def test_large_files_are_split_unless_a_value_holds_a_newline(spark, tmp_dir, newline):
    path = _text(f"{tmp_dir}/customers.csv", HEADER + "".join(_line(k) for k in range(4000))
                 + ('C9,"two\nlines",x@x.com,2024-01-05,X,Y,US\n' if newline else ""))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        assert rw.splittable(spark, path) is not newline
        df = rw.read_raw_csv(spark, path, rw.RAW_SCHEMAS["customers"])
        assert (df.rdd.getNumPartitions() == 1) is newline
        whole = rw.read_raw_csv(spark, path, rw.RAW_SCHEMAS["customers"], multi_line=True)
        assert whole.rdd.getNumPartitions() == 1
        ids = [r.customer_id for r in df.orderBy("_seq").collect()]
        assert ids == [f"C{k}" for k in range(4000)] + ["C9"] * newline
        assert df.drop("_seq").exceptAll(whole.drop("_seq")).isEmpty() and df.count() == whole.count()
        if not newline:
            assert rw.read_raw_aside(spark, path, rw.RAW_SCHEMAS["customers"]).rows.orderBy("_seq").first().name == 'Name, "0"'
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_small_files_are_not_looked_through(spark, tmp_dir):
    path = _text(f"{tmp_dir}/customers.csv", HEADER + _line(1))
    assert rw.splittable(spark, path) is False  # one task anyway


def test_flat_sales_bad_times_and_numbers_become_null(spark, tmp_dir):
    path = _text(f"{tmp_dir}/flat.csv", ",".join(RAW_FLAT.fieldNames()) + "\nO1,Ann,Pen,Office,2,2.50,5.00,2024-03-10 02:30:00\n"
                 "O2,Ann,Pen,Office,2,x,1e400,2024-02-30\nO3,Ann,Pen,Office,,1,1,\n")
    got = {r.order_id: r for r in rw.read_flat_sales(spark, path).collect()}
    assert str(got["O1"].order_date) == "2024-03-10 02:30:00"  # inside a daylight-saving gap of some zones
    assert got["O2"].order_date is None and got["O2"].unit_price is None and got["O2"].item_total is None
    assert got["O3"].order_date is None and got["O3"].quantity is None
