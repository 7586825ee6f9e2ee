"""CSV sources and sinks for raw extracts and flat sales files.

Raw files are read with an explicit all-STRING schema (never inferred), null
tokens are normalised by one projection, and a file-order sequence is taken at
the scan, before any shuffle, because "keep the first row" means first in the file.

A value may hold newlines inside quotes, and Spark can split a CSV file over tasks only if none
does.  Large files are therefore looked through once as plain text (which can be split): a
newline inside quotes leaves lines with an odd number of quotes, so without such a line the file
is read split (``splittable``).

Rows with too many or too few values end the read, or are set aside with their file and text
(``read_raw_aside``), up to a limit.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import normalize_null_tokens
from ..schemas import RAW_FLAT, RAW_SCHEMAS
from ..session import scratch_path

CORRUPT = "_corrupt"


class MissingInputError(FileNotFoundError):
    """A required raw table is absent; carries the table name."""


class TooManyRejects(ValueError):
    """More malformed rows than the load allows."""


class RawRead(NamedTuple):
    """Well-formed rows (as ``read_raw_csv`` gives them), and the malformed ones: (table_name, file, text)."""
    rows: DataFrame
    rejects: DataFrame
    rejected: int


def file_order_seq() -> F.Column:
    """Orderable position of a row in its input files.

    ``monotonically_increasing_id`` alone is not file order across files (split
    order is not path order), so sort by path, split start, then the id, which
    is increasing inside one split.  Deterministic on recomputation for a fixed
    set of files.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def _csv_reader(spark: SparkSession, multi_line: bool):
    return (spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def splittable(spark: SparkSession, path: str) -> bool:
    """Can the files be read in pieces: is there no newline inside a quoted value?

    Doubled quotes keep a line's number of quotes even.  A stray quote makes the answer "no", which
    is only slower.  Files that are one task anyway, for they are smaller than a split, are not looked at.
    """
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    found = fs.globStatus(p) or []
    sizes = [fs.getContentSummary(f.getPath()) for f in found]
    if not any(x.getLength() > most for x in sizes):
        return False
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return spark.read.text(path).filter(quotes % 2 == 1).isEmpty()


def _read_by_name(spark: SparkSession, path: str, expected: T.StructType, table: str, multi_line: bool | None,
                  aside: bool = False) -> DataFrame:
    """All-string columns of a header CSV, chosen by the header's names, not by place.

    The header names the columns (and every further file must have the same header);
    doubled quotes and, with ``multi_line``, newlines inside quotes belong to the value
    (None: it is found out whether there are any).  A row with too many or too few values stops
    the read (``FAILFAST``): it would otherwise shift or lose columns silently.  With ``aside`` its text
    is in the column ``CORRUPT`` instead, which is null for all others.
    """
    try:
        header = _csv_reader(spark, multi_line is not False).csv(path).schema
    except Exception as exc:  # AnalysisException: PATH_NOT_FOUND
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            raise MissingInputError(f"required input table '{table or path}' not found at {path}") from exc
        raise
    strings = T.StructType([T.StructField(f.name, T.StringType()) for f in header.fields])
    check_schema_names(strings, expected, table or path)
    if multi_line is None:
        multi_line = not splittable(spark, path)
    # Without column pruning: a row is malformed by its number of values, whichever columns are asked for.
    reader = _csv_reader(spark, multi_line).option("enforceSchema", False).option("columnPruning", False)
    if aside:
        strings = T.StructType([*strings.fields, T.StructField(CORRUPT, T.StringType())])
        return reader.schema(strings).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    return reader.schema(strings).option("mode", "FAILFAST").csv(path)


def check_schema_names(have: T.StructType, expected: T.StructType, table: str) -> None:
    missing = [n for n in expected.fieldNames() if n not in have.fieldNames()]
    if missing:
        raise ValueError(f"{table}: columns {missing} are not in the header {have.fieldNames()}")


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType, table: str = "",
                 multi_line: bool | None = None) -> DataFrame:
    """Header CSV -> all-string frame + ``_seq``; a missing path fails with the table name.

    Large files are split over tasks unless a value holds a newline; ``multi_line`` True or False says
    that one may, or that none does, and saves the look through the text.
    """
    df = _read_by_name(spark, path, schema, table, multi_line)
    df = df.select(*schema.fieldNames(), file_order_seq().alias("_seq"))
    return normalize_null_tokens(df, schema.fieldNames())


def read_raw_aside(spark: SparkSession, path: str, schema: T.StructType, table: str = "", multi_line: bool | None = None,
                   max_rejects: int | None = None) -> RawRead:
    """As ``read_raw_csv``, with malformed rows set aside.

    The files are parsed once: all rows are written to the scratch folder, the malformed ones counted
    on the way, and both results read that copy.  More than ``max_rejects`` of them (None: any number)
    end the load with TooManyRejects before anything is built from it.
    """
    df = _read_by_name(spark, path, schema, table, multi_line, aside=True)
    df = df.select(*schema.fieldNames(), CORRUPT, file_order_seq().alias("_seq"))
    seen, copy = Observation(), scratch_path(spark, f"raw_{table or 'table'}")
    df.observe(seen, F.count("_corrupt").alias("rejected"), F.count(F.lit(1)).alias("all_rows")).write.parquet(copy)
    rejected = seen.get["rejected"]
    if max_rejects is not None and rejected > max_rejects:
        raise TooManyRejects(f"{table or path}: {rejected} malformed rows of {seen.get['all_rows']}, at most {max_rejects} are allowed; "
                             f"they are the rows with {CORRUPT} in {copy}")
    read = spark.read.parquet(copy)
    rows = normalize_null_tokens(read.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), schema.fieldNames())
    rejects = read.filter(F.col(CORRUPT).isNotNull()).select(
        F.lit(table).alias("table_name"), F.col("_seq.file").alias("file"), F.col(CORRUPT).alias("text"))
    return RawRead(rows, rejects, rejected)


def read_raw_tables(spark: SparkSession, raw_dir: str) -> dict[str, DataFrame]:
    """customers.csv, products.csv, orders.csv under ``raw_dir`` (each may be a folder of parts)."""
    base = raw_dir.rstrip("/")
    return {name: read_raw_csv(spark, f"{base}/{name}.csv", schema, name)
            for name, schema in RAW_SCHEMAS.items()}


def read_raw_tables_aside(spark: SparkSession, raw_dir: str, max_rejects: int | None = None) -> dict[str, RawRead]:
    base = raw_dir.rstrip("/")
    return {name: read_raw_aside(spark, f"{base}/{name}.csv", schema, name, max_rejects=max_rejects)
            for name, schema in RAW_SCHEMAS.items()}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV sink (the export form of the star; Parquet is the primary form).

    The writer trims values by default; a value such as two blanks must survive
    the round trip (it is a distinct, non-missing email to the cleaning rules).
    Quotes are doubled, as in the usual CSV.
    """
    (df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def check_schema(df: DataFrame, expected: T.StructType, table: str) -> None:
    """Schema contract: every expected column present (by name) with the same type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in expected.fields if f.name not in have]
    wrong = [f.name for f in expected.fields if f.name in have and have[f.name] != f.dataType]
    if missing or wrong:
        raise ValueError(f"{table}: schema contract broken; missing={missing} wrong_type={wrong}")


def read_flat_sales(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """Flat denormalised sales file (S5), columns by name, typed by ``try_cast``.

    The time is cast zone-less at once: reading it through the session zone would move
    times inside a daylight-saving gap.
    """
    raw = _read_by_name(spark, path, RAW_FLAT, "flat sales", multi_line)
    df = normalize_null_tokens(raw.select(*RAW_FLAT.fieldNames()))
    return df.select(
        "order_id", "customer_name", "product_name", "category",
        F.col("quantity").try_cast("decimal(18,4)").alias("quantity"),
        F.col("unit_price").try_cast("decimal(18,4)").alias("unit_price"),
        F.col("item_total").try_cast("decimal(18,4)").alias("item_total"),
        F.col("order_date").try_cast("timestamp_ntz").alias("order_date"),
    )
