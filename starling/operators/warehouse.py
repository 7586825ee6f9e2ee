"""Publishing and loading the star.

Parquet folders have no MERGE, so a table is a log of versions.  A version is a list of
folders; a small JSON file named after its number records them, with the partition value each
holds, and is put in place last, by a step that fails if the file is there.  So a failed write
leaves the table as it was, its leftover folder (every attempt has its own) is never looked at
again, nothing is overwritten while it may still be read, and of two writers that started from
one version the second starts over from what the first has committed.

An upsert of a partitioned table rewrites only the partitions it touches: those the staged
rows belong to, and those that hold the staged keys now.  With ``buckets`` the layout has a
hash bucket of the key beside the partition columns, so that keys can only be in folders of
the staged keys' buckets: no other folder is looked at, and without partition columns not
even the keys of those.  All other folders are carried over by name.

Keys are NOT NULL: a null key never matches in an equality join and would be
appended again on every run, so staged rows with a null key are rejected.  What the staged
rows must satisfy (types, NOT NULL) is counted while they are written, not read again.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
import urllib.parse
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import month_number
from ..schemas import LOAD_ORDER, NOT_NULL, PRIMARY_KEYS, STAR_SCHEMAS
from ..session import delete_path, scratch_path
from ..sources.raw import check_schema
from .integrity import fk_violations

LOG_DIR = "_versions"
PART = "_part"
#: Load ids that a version remembers (the latest ones), to tell a load that is run again.
LOADS_KEPT = 100
ATTEMPTS = 20
#: Most bytes of a written dimension (compressed files) that are replicated to every task.
REPLICATE_BYTES = 16 << 20
# Sort keys of the published tables, behind the date partition for the fact.
SORT_KEYS = {"dim_customers": ["customer_id"], "dim_products": ["category", "product_id"],
             "fact_sales": ["order_date", "customer_id", "product_id"]}


class SchemaMismatch(ValueError):
    """Staged columns do not fit the target's."""


class KeyViolation(ValueError):
    """Staged rows break the key contract (null key part, or a repeated key for MERGE)."""


class VersionConflict(RuntimeError):
    """Another writer has committed the version first."""


def _null_key(keys: list[str]) -> Column:
    cond = F.col(keys[0]).isNull()
    for k in keys[1:]:
        cond = cond | F.col(k).isNull()
    return cond


def check_staging(staging: DataFrame, keys: list[str], unique: bool) -> None:
    """One aggregate over the staged keys; raises on a null key, or a repeated one if ``unique``."""
    per_key = staging.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    stats = per_key.agg(
        F.count_if(_null_key(keys)).alias("null_keys"),
        F.count_if(F.col("_rows") > 1).alias("repeated_keys"),
    ).first()
    if stats["null_keys"]:
        raise KeyViolation(f"{stats['null_keys']} staged key(s) with a NULL part in {keys}")
    if unique and stats["repeated_keys"]:
        raise KeyViolation(f"MERGE: {stats['repeated_keys']} staged key(s) in {keys} appear more than once")


def merge_plan(target: DataFrame | None, staging: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key is not staged, plus every staged row (columns by name)."""
    if target is None:
        return staging
    kept = target.join(staging.select(*keys).distinct(), keys, "left_anti")
    return kept.select(*staging.columns).unionByName(staging)


def upsert(target: DataFrame | None, staging: DataFrame, keys: list[str], mode: str = "merge") -> DataFrame:
    """L3 (``merge``: a repeated staged key is an error) or L4 (``replace``: delete
    matching keys, insert all staged rows, repeated keys included)."""
    if mode not in ("merge", "replace"):
        raise ValueError(f"unknown upsert mode {mode!r}")
    check_staging(staging, keys, unique=(mode == "merge"))
    return merge_plan(target, staging, keys)


# ---------------------------------------------------------------- versioned tables

class Version(NamedTuple):
    """One committed version: its number, folders and layout, and the loads it has taken in."""
    version: int
    paths: list[str]
    parts: list[tuple[str, str]]
    partition_by: list[str]
    buckets: int = 0
    bucket_keys: list[str] = []
    loads: list[str] = []


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str, folders: bool = False) -> list[str]:
    """Names of the files (or folders) in a folder; none if it is absent."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory() == folders)


def _log_path(table_path: str) -> str:
    return f"{table_path.rstrip('/')}/{LOG_DIR}"


def current_version(spark: SparkSession, table_path: str) -> Version | None:
    """The latest committed version, or None for a new table."""
    files = _names(spark, _log_path(table_path))
    names = [n for n in files if n.endswith(".json") and n[0].isdigit()]
    if not names:
        if any(n.endswith(".parquet") for n in files):  # never take it for a new table
            raise RuntimeError(f"{table_path} has a version log of an earlier format; load it anew")
        return None
    text = spark.read.text(f"{_log_path(table_path)}/{names[-1]}", wholetext=True).first()[0]
    e = json.loads(text)
    parts = [(v, p) for v, p in e["parts"]]
    return Version(e["version"], [p for _, p in parts], parts, e["partition_by"], e["buckets"], e["bucket_keys"], e["loads"])


def read_current(spark: SparkSession, table_path: str) -> DataFrame | None:
    cur = current_version(spark, table_path)
    return spark.read.parquet(*cur.paths) if cur else None


def _commit(spark: SparkSession, table_path: str, v: Version) -> None:
    """Put the version's file in place; VersionConflict if there is one already.

    The file is written whole under another name first, so a reader never sees part of it.  A
    rename that refuses an existing target is atomic on HDFS; a local file system has links.
    """
    log = _log_path(table_path)
    fs, new = _fs(spark, f"{log}/.new-{uuid.uuid4().hex}")
    entry = {"version": v.version, "partition_by": v.partition_by, "buckets": v.buckets, "bucket_keys": v.bucket_keys,
             "loads": v.loads[-LOADS_KEPT:], "parts": v.parts, "committed_at": _dt.datetime.now(_dt.timezone.utc).isoformat()}
    out = fs.create(new)
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    _, to = _fs(spark, f"{log}/{v.version:010d}.json")
    try:
        if fs.getScheme() == "file":
            os.link(new.toUri().getPath(), to.toUri().getPath())
        else:
            jvm = spark._jvm
            options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), spark._jsc.hadoopConfiguration()).rename(new, to, options)
    except Exception as exc:
        if isinstance(exc, FileExistsError) or "FileAlreadyExistsException" in str(exc):
            raise VersionConflict(f"{table_path}: version {v.version} is committed already") from exc
        raise
    finally:
        fs.delete(new, False)


def _label(by: list[str], buckets: int = 0, bucket_keys: list[str] | None = None) -> Column:
    """A partition's value as one text, different for different values: a null is ``\\N``, an empty text
    ``\\E``, and backslashes and commas inside values have a backslash before them."""
    each = []
    for c in by:
        text = F.col(c).cast("string")
        plain = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(","), F.lit("\\,"))
        each.append(F.when(text.isNull(), "\\N").when(text == "", "\\E").otherwise(plain))
    if buckets:
        each.append(F.pmod(F.xxhash64(*bucket_keys), F.lit(buckets)).cast("string"))
    return F.concat_ws(",", *each)


def _bucket(label: str) -> str:
    return label.rsplit(",", 1)[-1]


def _folders(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(label, folder) of the partitions written under ``path``; names only, no data.  Spark escapes
    characters of the label in the folder's name, which is undone here."""
    names = [n for n in _names(spark, path, folders=True) if n.startswith(f"{PART}=")]
    return [(urllib.parse.unquote(n.split("=", 1)[1]), f"{path}/{n}") for n in names]


def write_version(spark: SparkSession, df: DataFrame, table_path: str,
                  partition_by: list[str] | None = None, sort_by: list[str] | None = None,
                  version: int | None = None, keep: list[tuple[str, str]] | None = None,
                  buckets: int = 0, bucket_keys: list[str] | None = None, loads: list[str] | None = None) -> Version:
    """Write ``df`` into a folder of this attempt, then record it, and the folders kept
    from before, as the next version (the repoint)."""
    if version is None:
        cur = current_version(spark, table_path)
        version = (cur.version + 1) if cur else 1
    by, bucket_keys = list(partition_by or []), list(bucket_keys or [])
    folder = f"{table_path.rstrip('/')}/data/{version:06d}-{uuid.uuid4().hex[:12]}"
    parts: list[tuple[str, str]] = []
    if by or buckets:
        # A task writes a few partition folders (not every folder), and a large partition
        # is still spread over several tasks.  The partition's value also stays a column.
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # The label is made again behind the shuffle, not carried through it.
        label = _label(by, buckets, bucket_keys)
        out = df.repartitionByRange(n, label, *(sort_by or [])).withColumn(PART, label)
        out = out.sortWithinPartitions(PART, *(sort_by or []))
        out.write.partitionBy(PART).parquet(folder)
        parts = _folders(spark, folder)
    else:
        (df.sortWithinPartitions(*sort_by) if sort_by else df).write.parquet(folder)
        parts = [("", folder)]
    parts = [*(keep or []), *parts]
    if not parts:  # no row at all: the columns must still be readable
        df.limit(0).write.parquet(f"{folder}/empty")
        parts = [("", f"{folder}/empty")]
    done = Version(version, [p for _, p in parts], parts, by, buckets, bucket_keys, list(loads or []))
    _commit(spark, table_path, done)
    return done


def fit_columns(target: DataFrame, staging: DataFrame, keys: list[str], mode: str) -> DataFrame:
    """Staged rows with the target's columns, in its order.

    A column the staging lacks keeps the target's value for rows that exist (MERGE updates
    the columns it names) and is NULL otherwise; a column the target lacks, or one of
    another type, is an error before anything is written.
    """
    have, want = dict(staging.dtypes), dict(target.dtypes)
    extra = [c for c in have if c not in want]
    wrong = [f"{c}: {have[c]} for {want[c]}" for c in have if c in want and have[c] != want[c]]
    no_key = [k for k in keys if k not in have]
    if extra or wrong or no_key:
        raise SchemaMismatch(f"staging does not fit: unknown columns {extra}, other types {wrong}, missing keys {no_key}")
    missing = [c for c in want if c not in have]
    if missing and mode == "merge":
        staging = staging.join(target.select(*keys, *missing), keys, "left")
    elif missing:
        staging = staging.select("*", *[F.lit(None).cast(want[c]).alias(c) for c in missing])
    return staging.select(*target.columns)


# ---------------------------------------------------------------- checks in the pass that writes

def conform(df: DataFrame, schema: T.StructType, table: str) -> tuple[list[Column], dict[str, Column]]:
    """L2: the declared columns of ``df`` in their declared types, and what to count over it: values that a
    cast would lose.  A cast is a store assignment: what does not fit is an error, not a NULL."""
    missing = [c for c in schema.fieldNames() if c not in df.columns]
    if missing:
        raise SchemaMismatch(f"{table}: columns {missing} are missing")
    have = {f.name: f.dataType for f in df.schema.fields}
    other = [f for f in schema.fields if have[f.name] != f.dataType]
    counts = {f"lost_{f.name}": F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()) for f in other}
    rest = [c for c in df.columns if c not in schema.fieldNames()]
    cast = [F.col(f.name).try_cast(f.dataType).alias(f.name) if f in other else F.col(f.name) for f in schema.fields]
    return [*cast, *[F.col(c) for c in rest]], counts


def write_counted(df: DataFrame, path: str, counts: dict[str, Column], columns: list[Column] | None = None) -> dict[str, int]:
    """Write ``df`` (or ``columns`` made from it) and return the ``counts``, aggregates over its rows taken
    while it was written."""
    seen = Observation()
    rows = df.observe(seen, *[c.alias(n) for n, c in counts.items()])
    (rows.select(*columns) if columns else rows).write.mode("overwrite").parquet(path)
    return seen.get


def _refuse(found: dict[str, int], table: str) -> None:
    lost = {k[5:]: v for k, v in found.items() if k.startswith("lost_") and v}
    if lost:
        raise SchemaMismatch(f"{table}: values that do not fit the declared type, by column: {lost}")
    nulls = {k[5:]: v for k, v in found.items() if k.startswith("null_") and v}
    if nulls:
        raise KeyViolation(f"{table}: NULLs in NOT NULL columns {nulls}")


def upsert_table(spark: SparkSession, table_path: str, staging: DataFrame, keys: list[str],
                 mode: str = "merge", staging_path: str | None = None,
                 partition_by: list[str] | None = None, sort_by: list[str] | None = None,
                 new_table: bool = False, buckets: int = 0, schema: T.StructType | None = None,
                 not_null: list[str] | None = None, load_id: str | None = None,
                 check: Callable[[DataFrame], None] | None = None, base_version: int | None = None,
                 written: bool = False) -> DataFrame:
    """L1-L4 on a versioned Parquet table; returns the new current version.

    L1: staged rows are first written (to ``staging_path``, or beside the table), so their
    plan runs once and the key check and merge read a stable copy; it is dropped at the
    end.  L2: a missing target is created from ``schema`` (declared columns and types, which the
    staged rows are cast to), or from the staging's if there is none (``new_table=True`` says
    the caller expects it to be new).  The layout is the table's own once it
    exists; ``partition_by`` and ``buckets`` only count at its creation.

    Types, ``not_null`` and the keys are checked before anything is committed, as is ``check``,
    which is given the staged copy.  ``load_id`` names the load: one that the table has taken in
    already changes nothing.  A writer that another one overtakes starts over from the new version,
    unless ``base_version`` says which one the caller has worked from: then it is a VersionConflict.
    ``written`` says that the staged rows are read from a copy that stays (a scan, filtered at most): it
    serves as the staging, and is not copied again.
    """
    if mode not in ("merge", "replace"):
        raise ValueError(f"unknown upsert mode {mode!r}")
    name = table_path.rstrip("/").rsplit("/", 1)[-1]
    copy = staging_path or f"{table_path.rstrip('/')}/_staging/{uuid.uuid4().hex[:12]}"
    cur = None if new_table else current_version(spark, table_path)
    if cur and load_id and load_id in cur.loads:
        return spark.read.parquet(*cur.paths)
    try:
        columns, counts = conform(staging, schema, name) if schema is not None else (None, {})
        no_key = [k for k in keys if k not in staging.columns]
        if no_key:
            raise SchemaMismatch(f"staging does not fit: missing keys {no_key}")
        counts |= {f"null_{c}": F.count_if(F.col(c).isNull()) for c in dict.fromkeys([*keys, *(not_null or [])])}
        if written:
            _refuse(staging.agg(*[c.alias(n) for n, c in counts.items()]).first().asDict(), name)
            staged = staging.select(*columns) if columns else staging
        else:
            _refuse(write_counted(staging, copy, counts, columns), name)
            staged = spark.read.parquet(copy)
        if schema is not None:
            check_schema(staged, schema, name)
        if mode == "merge":
            check_staging(staged, keys, unique=True)
        if check:
            check(staged)
        for _ in range(ATTEMPTS):
            if base_version is not None and (cur.version if cur else 0) != base_version:
                raise VersionConflict(f"{table_path}: version {cur.version if cur else 0} is current, not {base_version}")
            try:
                done = _attempt(spark, table_path, cur, staged, keys, mode, list(partition_by or []), sort_by, buckets, load_id)
                return spark.read.parquet(*done.paths)
            except VersionConflict:
                cur = current_version(spark, table_path)
        raise VersionConflict(f"{table_path}: overtaken {ATTEMPTS} times")
    finally:
        if not written:
            delete_path(spark, copy)


def _attempt(spark: SparkSession, table_path: str, cur: Version | None, staged: DataFrame, keys: list[str], mode: str,
             partition_by: list[str], sort_by: list[str] | None, buckets: int, load_id: str | None) -> Version:
    """Write the version after ``cur`` that has the staged rows."""
    loads = [*(cur.loads if cur else []), *([load_id] if load_id else [])]
    if cur is None:
        staged = _with_partition_cols(staged, partition_by)
        return write_version(spark, staged, table_path, partition_by, sort_by, 1, None, buckets, keys if buckets else [], loads)
    if cur.buckets and cur.bucket_keys != keys:
        raise SchemaMismatch(f"the table is bucketed by {cur.bucket_keys}, not by {keys}")
    by = cur.partition_by
    target = spark.read.parquet(*cur.paths)
    staged = fit_columns(target, _with_partition_cols(staged, by), keys, mode)
    if by:  # kept columns may have moved a row's date
        staged = _with_partition_cols(staged.drop(*[c for c in by if c in DERIVED_PARTS]), by).select(*target.columns)
    old, keep = touched_parts(spark, cur, staged, keys)
    before = spark.read.parquet(*old) if old else None
    return write_version(spark, merge_plan(before, staged, keys), table_path, by, sort_by, cur.version + 1, keep,
                         cur.buckets, cur.bucket_keys, loads)


def _holding(spark: SparkSession, cur: Version, staged: DataFrame, keys: list[str], buckets: set[str]) -> set[str]:
    """Labels of the partitions that hold a staged key now, by the key and partition columns of the folders in
    ``buckets`` (those of the staged keys, if the layout has any)."""
    near = [p for v, p in cur.parts if not cur.buckets or v == "" or _bucket(v) in buckets]
    if not near:
        return set()
    there = spark.read.parquet(*near)
    held = there.select(*dict.fromkeys([*keys, *cur.partition_by])).join(staged.select(*keys).distinct(), keys, "left_semi")
    # At most one row per partition reaches the driver.
    return {r["v"] for r in held.select(_label(cur.partition_by, cur.buckets, cur.bucket_keys).alias("v")).distinct().collect()}


def touched_parts(spark: SparkSession, cur: Version, staged: DataFrame, keys: list[str]) -> tuple[list[str], list[tuple[str, str]]]:
    """(folders that may hold a staged key or will hold a staged row, all other parts).

    Folders of other key buckets are never read; of the others, key and partition columns are, if
    a key could be in several of them.
    """
    if not (cur.partition_by or cur.buckets):
        return cur.paths, []
    label = _label(cur.partition_by, cur.buckets, cur.bucket_keys)
    # At most one row per partition reaches the driver.
    touched = {r["v"] for r in staged.select(label.alias("v")).distinct().collect()}
    if cur.partition_by:
        touched |= _holding(spark, cur, staged, keys, {_bucket(t) for t in touched})
    old = [p for v, p in cur.parts if v in touched or v == ""]
    return old, [(v, p) for v, p in cur.parts if v not in touched and v != ""]


def rows_of_keys(spark: SparkSession, table_path: str, staged: DataFrame, keys: list[str]) -> DataFrame | None:
    """The table's current rows with a staged key, read from the folders that may hold one; None for a new table.

    Of a partitioned table whole rows are read from the folders that hold one, which keys alone tell.
    """
    cur = current_version(spark, table_path)
    if cur is None:
        return None
    there = spark.read.parquet(*cur.paths)
    wanted: set[str] = set()
    if cur.buckets:
        label = F.pmod(F.xxhash64(*cur.bucket_keys), F.lit(cur.buckets)).cast("string")
        wanted = {r["v"] for r in staged.select(label.alias("v")).distinct().collect()}
    if cur.partition_by:
        held = _holding(spark, cur, staged, keys, wanted)
        near = [p for v, p in cur.parts if v == "" or v in held]
        there = spark.read.parquet(*near) if near else there.limit(0)
    elif cur.buckets:
        near = [p for v, p in cur.parts if v == "" or _bucket(v) in wanted]
        there = spark.read.parquet(*near) if near else there.limit(0)
    return there.join(staged.select(*keys).distinct(), keys, "left_semi").select(*there.columns)


def drop_old_versions(spark: SparkSession, table_path: str) -> list[str]:
    """Delete the data folders that the current version does not name (older versions and
    leftovers of failed writes); for times when nobody reads an older version."""
    cur = current_version(spark, table_path)
    if cur is None:
        return []
    base = f"{table_path.rstrip('/')}/data"
    gone = []
    for name in _names(spark, base, folders=True):
        folder = f"{base}/{name}"
        inside = [x for x in cur.paths if x == folder or x.startswith(folder + "/")]
        if not inside:
            delete_path(spark, folder)
            gone.append(folder)
        elif folder not in cur.paths:
            for _, part in _folders(spark, folder):
                if part not in cur.paths:
                    delete_path(spark, part)
                    gone.append(part)
    return gone


# Partition columns that follow from the order date.
DERIVED_PARTS = ("order_month", "order_day")


def _with_partition_cols(df: DataFrame, partition_by: list[str]) -> DataFrame:
    if "order_month" in partition_by and "order_month" not in df.columns:
        df = df.withColumn("order_month", month_number(F.col("order_date")))
    if "order_day" in partition_by and "order_day" not in df.columns:
        df = df.withColumn("order_day", F.to_date("order_date"))
    return df


# ---------------------------------------------------------------- publishing

def publish_star(spark: SparkSession, star: dict[str, DataFrame], out_dir: str,
                 fact_grain: str = "order_month", overwrite: bool = False) -> dict[str, str]:
    """Each table range-partitioned and sorted by its sort key; the fact
    partitioned by order date, and by (order_date, customer_id, product_id) inside.

    Every table's plan runs once, into a scratch copy: the range partitioning samples its
    input before it writes it.  The range key goes down to the line, so a date or a
    customer holding a large share of rows is spread over several tasks while each task
    still writes few partition folders and sorted, prunable files.  Columns are checked
    before the write, NOT NULL while the copy is written, and the dimensions' keys on the
    copy's key columns; nothing else is read for a check.
    ``fact_grain`` is ``order_day`` for large facts, ``order_month`` for small ones.
    """
    base = out_dir.rstrip("/")
    mode = "overwrite" if overwrite else "errorifexists"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name in LOAD_ORDER:
        missing = [c for c in STAR_SCHEMAS[name].fieldNames() if c not in star[name].columns]
        if missing:
            raise SchemaMismatch(f"{name}: columns {missing} are missing")
    paths = {name: f"{base}/{name}" for name in LOAD_ORDER}
    for name in LOAD_ORDER:
        rows, grain = star[name], [fact_grain] if name == "fact_sales" else []
        copy = scratch_path(spark, f"publish_{name}")
        nulls = {f"null_{c}": F.count_if(F.col(c).isNull()) for c in NOT_NULL[name]}
        _refuse(write_counted(_with_partition_cols(rows, grain), copy, nulls), name)
        rows = spark.read.parquet(copy)
        if not grain:
            repeated = rows.groupBy(*PRIMARY_KEYS[name]).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            if not repeated.isEmpty():
                raise KeyViolation(f"{name}: the key {PRIMARY_KEYS[name]} repeats")
        order = [*grain, *SORT_KEYS[name]]
        rows = rows.repartitionByRange(n, *order, *(["order_id"] if grain else [])).sortWithinPartitions(*order)
        (rows.write.mode(mode).partitionBy(*grain) if grain else rows.write.mode(mode)).parquet(paths[name])
    return paths


def publish_bucketed_fact(spark: SparkSession, fact: DataFrame, path: str, table: str,
                          buckets: int, key: str = "customer_id") -> None:
    """Distribute the fact by ``key`` into buckets and sort each bucket, so joins
    and aggregations on ``key`` against an equally bucketed table need no Exchange."""
    (fact.write.mode("overwrite").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))


def publish_bucketed_star(spark: SparkSession, star: dict[str, DataFrame], out_dir: str, buckets: int,
                          prefix: str) -> dict[str, DataFrame]:
    """Fact and customers in equal buckets of the customer, as tables ``prefix`` + name: whatever is
    grouped by customer, or joined on it, stays in its bucket.  Products are written as they are."""
    base = out_dir.rstrip("/")
    out = {}
    for name in ("dim_customers", "fact_sales"):
        # One task a bucket and file: rows of a bucket meet before they are written.
        rows = star[name].repartition(buckets, "customer_id")
        publish_bucketed_fact(spark, rows, f"{base}/{name}", f"{prefix}{name}", buckets)
        out[name] = spark.table(f"{prefix}{name}")
    star["dim_products"].write.mode("overwrite").parquet(f"{base}/dim_products")
    return {**out, "dim_products": spark.read.parquet(f"{base}/dim_products")}


def written_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def dimension(spark: SparkSession, path: str, replicate_bytes: int = REPLICATE_BYTES) -> DataFrame:
    """A written dimension, replicated to every task when its files are at most ``replicate_bytes``
    long, else joined by shuffle: the size that is measured decides, not an estimate of the plan."""
    df = spark.read.parquet(path)
    return F.broadcast(df) if written_bytes(spark, path) <= replicate_bytes else df.hint("shuffle_merge")


def load_star(spark: SparkSession, star: dict[str, DataFrame], warehouse_dir: str,
              mode: str = "replace", scratch_dir: str | None = None,
              new_warehouse: bool = False, load_id: str | None = None, enforce_foreign_keys: bool = False) -> dict[str, DataFrame]:
    """Load dimensions first, then the fact; the first failure stops the load.

    Tables are created with the declared types (``STAR_SCHEMAS``).  A load that has a ``load_id`` and
    stopped halfway is simply run again: tables that have taken it in are left alone, the others
    go on.  ``enforce_foreign_keys`` refuses a fact whose keys the loaded dimensions lack.
    """
    base = warehouse_dir.rstrip("/")
    out: dict[str, DataFrame] = {}

    def no_orphans(staged: DataFrame) -> None:
        found = fk_violations({**out, "fact_sales": staged}).filter("orphan_rows > 0").collect()  # one row per foreign key
        if found:
            raise KeyViolation(f"fact_sales: {', '.join(f'{r.orphan_rows} rows without {r.references}' for r in found)}")

    for name in LOAD_ORDER:
        staging_path = f"{scratch_dir.rstrip('/')}/{name}_staging" if scratch_dir else None
        fact = name == "fact_sales"
        out[name] = upsert_table(spark, f"{base}/{name}", star[name], PRIMARY_KEYS[name], mode,
                                 staging_path=staging_path, partition_by=["order_month"] if fact else None,
                                 sort_by=SORT_KEYS[name], new_table=new_warehouse and load_id is None, schema=STAR_SCHEMAS[name],
                                 not_null=NOT_NULL[name], load_id=load_id, check=no_orphans if fact and enforce_foreign_keys else None)
    return out
