"""Referential filter, orphan counts and declared-key checks.

Key sets never go through the driver: membership is a semi/anti/outer join.
Dimension keys are de-duplicated before an outer join so a repeated dimension
key cannot fan the fact out.  AQE turns a join against a small key set into a
broadcast at run time, and splits a hot key on the fact side otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS
from ..session import materialize, tasks_for


def referential_filter(lines: DataFrame, dim_customers: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Keep lines whose customer and product survived cleaning (two LeftSemi joins)."""
    return (lines.join(dim_customers.select("customer_id"), "customer_id", "left_semi")
            .join(dim_products.select("product_id"), "product_id", "left_semi")
            .select(*lines.columns))


def orphan_counts(lines: DataFrame, dim_customers: DataFrame, dim_products: DataFrame) -> DataFrame:
    """C14: lines without a customer / without a product, both on the unfiltered lines."""
    # Key sets written first: a plain exchange on either side lets the adaptive join split a hot key.
    ck = materialize(dim_customers.select("customer_id").distinct(), "customer_keys").withColumn("_c_ok", F.lit(True))
    pk = materialize(dim_products.select("product_id").distinct(), "product_keys").withColumn("_p_ok", F.lit(True))
    j = lines.select("customer_id", "product_id").join(ck, "customer_id", "left").join(pk, "product_id", "left")
    return j.agg(
        F.count_if(F.col("_c_ok").isNull()).alias("orphan_customer_lines"),
        F.count_if(F.col("_p_ok").isNull()).alias("orphan_product_lines"),
        F.count_if(F.col("_c_ok").isNotNull() & F.col("_p_ok").isNotNull()).alias("kept_lines"),
    )


def pk_violations(tables: dict[str, DataFrame], keys: dict[str, list[str]] | None = None) -> DataFrame:
    """Per table, keys held by more than one row, rows under them, rows with a null key part.

    Keys seldom repeat, so nothing is gained by combining them before the shuffle, where a task would hold all
    keys of its input at once.  They are written (the copy knows how many there are) and dealt over as many
    tasks as keep each one's share the same; rows with a null part are only counted.
    """
    keys = keys or PRIMARY_KEYS
    parts = []
    for name, cols in keys.items():
        df = materialize(tables[name].select(*cols), f"keys_{name}")
        null_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
        nulls = df.agg(F.count_if(null_key)).scalar()
        per_key = (df.filter(~null_key).repartition(tasks_for(df), *cols)
                   .groupBy(*cols).agg(F.count(F.lit(1)).alias("_rows")))
        parts.append(per_key.agg(
            F.count_if(F.col("_rows") > 1).alias("duplicate_keys"),
            F.coalesce(F.sum(F.when(F.col("_rows") > 1, F.col("_rows"))), F.lit(0)).alias("rows_with_duplicate_keys"),
        ).withColumn("null_key_rows", nulls).select(F.lit(name).alias("table_name"), F.lit(",".join(cols)).alias("key_columns"), "*"))
    return reduce(DataFrame.unionByName, parts)


def null_violations(tables: dict[str, DataFrame], not_null: dict[str, list[str]] | None = None) -> DataFrame:
    """NULL count of every NOT NULL column, one scan per table."""
    not_null = not_null or NOT_NULL
    parts = []
    for name, cols in not_null.items():
        counts = tables[name].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        stacked = ", ".join(f"'{c}', `{c}`" for c in cols)
        parts.append(counts.select(
            F.lit(name).alias("table_name"),
            F.expr(f"stack({len(cols)}, {stacked}) AS (column_name, null_rows)")))
    return reduce(DataFrame.unionByName, parts)


def fk_violations(tables: dict[str, DataFrame], fks: dict | None = None) -> DataFrame:
    """Per foreign key, fact rows whose key has no dimension row, and distinct such keys."""
    fks = fks or FOREIGN_KEYS
    parts = []
    for fact_name, specs in fks.items():
        fact = tables[fact_name]
        for col, dim_name, dim_col in specs:
            dim_keys = tables[dim_name].select(F.col(dim_col).alias(col))
            orphans = fact.select(col).join(dim_keys, col, "left_anti")
            parts.append(orphans.agg(
                F.count(F.lit(1)).alias("orphan_rows"),
                F.count_distinct(col).alias("orphan_keys"),
            ).select(F.lit(fact_name).alias("table_name"), F.lit(col).alias("column_name"),
                     F.lit(dim_name).alias("references"), "*"))
    return reduce(DataFrame.unionByName, parts)
