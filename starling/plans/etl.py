"""Cleaning batch: raw extracts -> star schema + step report (entry 1 of the reference).

One logical plan per table; the fact's referential filter uses LeftSemi joins
against the cleaned dimensions.  The report is one long frame
``(table_name, step, metric, value)`` built from one aggregate per table.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cleaning as cl
from ..operators import integrity as ig
from ..session import materialize


class CleanRun:
    """The cleaned star and report of one set of raw extracts, built on first use.

    Properties are lazy so a query that needs only the products dimension does
    not plan (or analyse) the order pipeline.
    """

    def __init__(self, raw: dict[str, DataFrame], hyphen_day_first: bool = False, rejected: dict[str, int] | None = None):
        self.raw = raw
        self.hyphen_day_first = hyphen_day_first
        self.rejected = rejected

    @cached_property
    def _customers(self) -> cl.Cleaned:
        return cl.clean_customers(self.raw["customers"], self.hyphen_day_first)

    @cached_property
    def _products(self) -> cl.Cleaned:
        return cl.clean_products(self.raw["products"])

    @cached_property
    def _flagged_orders(self) -> DataFrame:
        return cl.flag_orders(self.raw["orders"], self.hyphen_day_first)

    @property
    def dim_customers(self) -> DataFrame:
        return self._customers.df

    @property
    def dim_products(self) -> DataFrame:
        return self._products.df

    @cached_property
    def order_lines(self) -> DataFrame:
        """Valid lines before the referential filter, written once: the key filter, the
        orphan counts and the key checks all read them."""
        return materialize(cl.order_lines(self._flagged_orders), "order_lines")

    @cached_property
    def fact_sales(self) -> DataFrame:
        return ig.referential_filter(self.order_lines, self.dim_customers, self.dim_products)

    @cached_property
    def orphans(self) -> DataFrame:
        return ig.orphan_counts(self.order_lines, self.dim_customers, self.dim_products)

    @cached_property
    def report(self) -> DataFrame:
        orphans = self.orphans.select(F.struct("*")).scalar()  # one-row scalar subquery
        order_counts = cl.order_metrics(self._flagged_orders).select(
            "*",
            orphans["orphan_customer_lines"].alias("orphan_customer_lines_dropped"),
            orphans["orphan_product_lines"].alias("orphan_product_lines_dropped"),
            orphans["kept_lines"].alias("final_rows"),
        )
        report = reduce(DataFrame.unionByName, [
            _long(self._customers.metrics, "customers", cl.CUSTOMER_METRICS),
            _long(self._products.metrics, "products", cl.PRODUCT_METRICS),
            _long(order_counts, "orders", cl.ORDER_METRICS),
        ])
        if self.rejected is None:
            return report
        # Before step 0: rows of the files that never became rows of a table.
        aside = [(t, -1, "malformed_rows_set_aside", n) for t, n in self.rejected.items()]
        return report.unionByName(report.sparkSession.createDataFrame(aside, "table_name string, step int, metric string, value bigint"))

    def star(self) -> dict[str, DataFrame]:
        return {"dim_customers": self.dim_customers, "dim_products": self.dim_products,
                "fact_sales": self.fact_sales}


def _long(metrics: DataFrame, table: str, names: list[str]) -> DataFrame:
    """One-row counters -> (table_name, step, metric, value) in step order."""
    ordered = ["initial_rows", *names, "final_rows"]
    pairs = ", ".join(f"{i}, '{n}', CAST(`{n}` AS BIGINT)" for i, n in enumerate(ordered))
    return metrics.select(F.lit(table).alias("table_name"),
                          F.expr(f"stack({len(ordered)}, {pairs}) AS (step, metric, value)"))


def clean(raw: dict[str, DataFrame], hyphen_day_first: bool = False, rejected: dict[str, int] | None = None) -> CleanRun:
    """``rejected``: malformed rows by table that were set aside before (they head the report)."""
    return CleanRun(raw, hyphen_day_first, rejected)


def clean_files(spark, raw_dir: str, hyphen_day_first: bool = False, max_rejects: int | None = None) -> tuple[CleanRun, DataFrame]:
    """The cleaning run over raw CSV files whose malformed rows are set aside, and these rows."""
    from ..sources.raw import read_raw_tables_aside

    read = read_raw_tables_aside(spark, raw_dir, max_rejects)
    run = clean({n: r.rows for n, r in read.items()}, hyphen_day_first, {n: r.rejected for n, r in read.items()})
    return run, reduce(DataFrame.unionByName, [r.rejects for r in read.values()])


def ensure_star(spark, raw_dir: str, star_dir: str, hyphen_day_first: bool = False, max_rejects: int = 0) -> dict[str, DataFrame]:
    """Read the published star; when any of its tables is absent, build all of it from
    the raw CSV extracts (S1 -> cleaning -> publish) first, over what a broken build left.
    A missing raw table stops with its name (S6).  Up to ``max_rejects`` malformed rows a table
    are set aside (written to ``_rejects`` beside the star); more end the load."""
    from ..operators.warehouse import publish_star
    from ..sources.raw import read_raw_tables

    base = star_dir.rstrip("/")
    names = ["dim_customers", "dim_products", "fact_sales"]
    try:
        return {n: spark.read.parquet(f"{base}/{n}") for n in names}
    except Exception as exc:  # AnalysisException: a table is absent, or its folder holds no finished file
        if not any(x in str(exc) for x in ("PATH_NOT_FOUND", "does not exist", "UNABLE_TO_INFER_SCHEMA")):
            raise
    if max_rejects:
        run, rejects = clean_files(spark, raw_dir, hyphen_day_first, max_rejects)
        rejects.write.mode("overwrite").parquet(f"{base}/_rejects")
    else:
        run = clean(read_raw_tables(spark, raw_dir), hyphen_day_first)
    paths = publish_star(spark, run.star(), base, overwrite=True)
    return {n: spark.read.parquet(paths[n]) for n in names}
