"""SimHash near-duplicates by multi-index hashing.

*Fingerprint* (64 bits): words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z
lower-cased; every shingle of ``shingle`` words, repeats included, joined by one
space, is hashed with XXH64 (seed 42); a bit is 1 if it is set in over half of the
hashes.  Fewer words than a shingle: the whole sequence is the one shingle; no
word: fingerprint zero, linked like any other.

*Search.*  Fingerprints within ``bits`` (3) of each other agree up to one bit on at
least one of the two 32-bit halves, since 3 differing bits put at most one on one
side.  Every distinct fingerprint is stored in two tables, one for each half; for
each table it enumerates the Hamming ball of radius 1 around its half (33 keys),
fetches the matches and verifies the complete distance inside the join.

*Hot halves.*  Fingerprints are distinct before the search, so a group of exact
copies is one row.  Many distinct fingerprints sharing a half (a large group of
near copies) are compared inside the join, split by the adaptive skew join; only
pairs within the distance come out, each found once (see ``_matches``).

Components: union-find over the fingerprints, each standing for its documents.

Defined cases: null text is empty; rows repeated keep one output row each; a null
doc_id never names a component unless its group has no other id; a document is told
by its doc_id and text, so texts that share an id, or have none, are different
documents; an empty table gives an empty result; further columns pass through
``keep_one_each`` unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, ship_package, unused
from .components import connected_components

SHINGLE = 3
BITS = 3
HASH_SEED = 42
HALF = 32
#: Hashes turned into bits at once (eight bytes become 64).
UNPACK_ROWS = 1 << 15

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text, unsigned."""
    from xxhash import xxh64_intdigest
    found = _WORD.findall((text or "").translate(_LOWER))
    if not found:
        return 0
    n = max(len(found) - shingle + 1, 1)
    hashes = np.fromiter((xxh64_intdigest(" ".join(found[i:i + shingle]), HASH_SEED) for i in range(n)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, UNPACK_ROWS):
        part = hashes[at:at + UNPACK_ROWS].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, name: str = "fp") -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as signed bigint."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, 64):
                out += [_signed(fingerprint(t, shingle)) for t in batch.column(1).slice(at, 64).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.int64())], ["doc_id", name])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {name} bigint")


def _half(fp: Column, table: int) -> Column:
    low = F.lit((1 << HALF) - 1)
    return F.shiftrightunsigned(fp, HALF) if table == 0 else fp.bitwiseAND(low)


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _matches(fps: DataFrame, bits: int) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints within ``bits``, from two tables with balls of radius ``bits // 2``."""
    if bits not in (0, 1, 2, 3):
        raise ValueError("two segments with balls of radius one find distances up to 3")
    flips = F.array(F.lit(0).cast("bigint"), *[F.lit(1 << k).cast("bigint") for k in range(HALF)]) if bits > 1 \
        else F.array(F.lit(0).cast("bigint"))
    stored = fps.select(F.col("fp").alias("b"), F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), _half(F.col("fp"), t).alias("k")) for t in (0, 1)])).alias("s")).select(
        "b", F.col("s.t").alias("bt"), F.col("s.k").alias("bk"))
    asked = fps.select(F.col("fp").alias("a"), F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), _half(F.col("fp"), t).alias("h")) for t in (0, 1)])).alias("s")).select(
        "a", F.col("s.t").alias("at"), F.explode(flips).alias("flip"),
        F.col("s.h").alias("h"))
    asked = asked.select("a", "at", F.col("h").bitwiseXOR(F.col("flip")).alias("ak"))
    # One direction only (a < b): the ball around a's half holds b's half exactly when b's holds a's.
    # A pair near in both halves is taken from the first table.
    near_first = F.bit_count(_half(F.col("a"), 0).bitwiseXOR(_half(F.col("b"), 0))) <= (1 if bits > 1 else 0)
    once = (F.col("at") == 0) | ~near_first
    on = (F.col("at") == F.col("bt")) & (F.col("ak") == F.col("bk")) & (F.col("a") < F.col("b")) \
        & (_distance(F.col("a"), F.col("b")) <= bits) & once
    return asked.join(stored, on).select("a", "b")


def _named(docs: DataFrame, shingle: int, bits: int) -> DataFrame:
    """(who, fp, keeper) of every row: its document and the least one of its component, ids before null.

    A document is the struct (no_id, doc_id, text_key), in this order.
    """
    who = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("text_key"))
    rows = materialize(fingerprints(docs.select(who.alias("doc_id"), "text"), shingle).withColumnRenamed("doc_id", "who"), "simhash-rows")
    fps = materialize(rows.groupBy("fp").agg(F.min("who").alias("first")), "simhash-distinct")
    links = _matches(fps.select("fp"), bits)
    found = connected_components(links, "a", "b")
    grouped = fps.join(found, fps["fp"] == found["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root"))
    least = grouped.groupBy("root").agg(F.min("first").alias("keeper"))
    named = grouped.join(least, "root").select(F.col("fp").alias("nfp"), "keeper")
    return rows.join(named, rows["fp"] == named["nfp"]).select("who", "fp", "keeper")


def components(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """(doc_id, fp, component_id) of every row; component_id is the least doc_id of the component."""
    return _named(docs, shingle, bits).select("who.doc_id", "fp", F.col("keeper.doc_id").alias("component_id"))


def keep_one_each(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """``docs`` with one document of each component: the least by (doc_id, nulls last, text digest).

    Rows that repeat (same doc_id and text) are reduced to one.
    """
    own = _named(docs, shingle, bits).filter(
        F.col("who.doc_id").eqNullSafe(F.col("keeper.doc_id")) & (F.col("who.text_key") == F.col("keeper.text_key")))
    key_id, key, n = unused(docs, "kept_id", "kept_key", "kept_n")
    kept = materialize(own.groupBy(F.col("who.doc_id").alias(key_id), F.col("who.text_key").alias(key)).agg(
        F.count(F.lit(1)).alias(n)), "simhash-kept")
    same = docs["doc_id"].eqNullSafe(F.col(key_id)) & (F.xxhash64(docs["text"]) == F.col(key))
    left = docs.join(kept.select(key_id, key), same, "left_semi")
    if kept.filter(F.col(n) > 1).limit(1).count():  # else there is no repeated row to look for
        left = left.dropDuplicates(["doc_id", "text"])
    return left


def simhash_digest(docs: DataFrame) -> DataFrame:
    return components(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
