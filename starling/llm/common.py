"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path  # noqa: F401  (re-exported)

#: The word and white-space classes of the query contracts.
SPACE_CLASS = r"[\x20\x09-\x0D]+"

#: Text handled per numpy block inside a task; bounds the memory of a Python worker.
BLOCK_BYTES = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text; empty for null or no word.

    A split on white space leaves an empty first element before leading white
    space and an empty last one after trailing white space; both are removed.
    """
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), "")


def word_count(text: Column) -> Column:
    """Number of words as bigint; 0 for null."""
    return F.size(words(text)).cast("bigint")


def crc_mod(doc_id: Column, mod: int) -> Column:
    """crc32 of the id's decimal text, modulo ``mod`` (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % mod


def unused(df: DataFrame, *stems: str) -> list[str]:
    """Names for columns of one's own that ``df`` does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for stem in stems:
        while stem in taken:
            stem += "_"
        taken.add(stem)
        out.append(stem)
    return out


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per Spark context.

    The driver zips its own copy and Spark's file server hands it to every
    executor, so no machine needs the package installed.
    """
    sc = spark.sparkContext
    if getattr(sc, "_starling_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="starling-code-"), "starling_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._starling_shipped = True


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that this run wrote."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def text_blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into row ranges of about ``block_bytes``.

    Yields ``(first row, end row, bytes, offsets)``: the UTF-8 bytes of the rows
    back to back and, for each row, where it begins (one more entry than rows).
    Nulls are empty.  A row longer than the block is a block of its own: texts
    are never cut.
    """
    arr = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if arr.null_count:
        arr = arr.fill_null("")
    n = len(arr)
    if n == 0:
        return
    buffers = arr.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[arr.offset:arr.offset + n + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + block_bytes, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end, data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
        at = end
