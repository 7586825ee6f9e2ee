"""Every registered query against its DuckDB oracle (the correctness gate), sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as se
from starling.plans.catalog import QUERIES

from conftest import SF001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF001, t)}.parquet')")
    return c


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 6)
        return v

    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(se.oracle_sql()) <= set(se.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = se.queries()[name](spark, SF001)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    res = con.execute(se.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(scols) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _canon(srows, scols) == _canon(orows, ocols)


def test_entry_smoke(spark):
    df = se.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert df.columns == ["segment", "segment_order", "customers", "revenue"]


@pytest.mark.parametrize("name", ["parse_dates", "clean_orders", "rfm_metrics_ts", "recent_transactions",
                                  "upsert_merge", "monthly_sales"])
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    """Zone-less timestamps must not move with a daylight-saving session zone."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        test_query_matches_oracle(spark, con, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
