"""Column -> Column helpers for text values: null tokens, numbers, money."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import MONEY, WORK_DECIMAL

# The texts a default pandas CSV read turns into a missing value
# (matched exactly, no trimming).  Raw files are normalised with this list so
# cleaning sees the same nulls the pandas pipeline saw.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def null_if_token(c: Column) -> Column:
    return F.when(c.isin(NULL_TOKENS), F.lit(None).cast("string")).otherwise(c)


def normalize_null_tokens(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Replace null tokens by NULL in every (or the given) string column, one projection."""
    names = set(columns or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"])
    return df.select(*[null_if_token(F.col(c)).alias(c) if c in names else F.col(c) for c in df.columns])


def to_number(c: Column) -> Column:
    """Text -> DECIMAL(24,4); anything that is not a plain number becomes NULL.

    ``try_cast`` to decimal refuses ``NaN``/``inf``/``1.0d`` (a double cast would
    accept ``1.0d``), so bad input falls out as NULL exactly like a coerced parse.
    """
    return c.try_cast(WORK_DECIMAL)


def money(c: Column) -> Column:
    """Round half-up to cents and store as DECIMAL(24,2)."""
    return F.round(c, 2).cast(MONEY)


def money_out(c: Column) -> Column:
    """Money as DOUBLE for reports (exact: the value already has two decimals)."""
    return F.round(c, 2).cast("double")


def round_div(num: Column, den: Column, scale: int = 2) -> Column:
    """num / den rounded half-up to ``scale`` decimals, exactly, as DOUBLE.

    Decimal division rounds its quotient at a fixed scale first, which can move a
    value across a half-cent boundary; here the rounding is one exact integral
    division: floor((num * 10^s * 2 + den) / (2 * den)), with floor(a / b) taken
    as (a - pmod(a, b)) / b.  For num >= 0 and den > 0.
    """
    f = 10 ** scale
    a = num.cast("decimal(38,6)") * (2 * f) + den.cast("decimal(38,0)")
    b = (den * 2).cast("decimal(38,0)")
    q = (a - F.pmod(a, b)) / b
    return (q.cast("decimal(38,0)") / F.lit(f)).cast("double")
