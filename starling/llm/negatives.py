"""Hard-negative mining with exact scores from a residue-number-system matrix product.

Vectors become integers, ``floor(256 * x)``.  A score is the inner product of two integer vectors and
must be exact, for it is compared with other scores and with windows around them.  So it is
computed in residues: for each of a few primes the integer matrices are reduced to
residues around zero, multiplied in float32 (as fast as floats are, and exact: blocks of ``INNER``
components keep every partial sum below 2**24), reduced again, and the signed scores are put together
by Chinese remaindering in mixed radix.  As many primes are taken as the table's largest component and
longest vector need (a proven bound on any score), so nothing wraps.

*Searches.*  Anchors are a stated query set (every ``EVERY``-th id) and meet all rows, in blocks: a
block of at most ``BLOCK_ROWS`` anchors and ``BLOCK_BYTES`` of numbers is broadcast, each task holds its
share of the rows against it, batch by batch, and keeps the best few for each anchor (or each pair of
anchor and positive), which are then merged.  A block takes two passes: one for the positives of
its anchors (same label), one for the negatives (another label) whose scores lie in the window that
the positive's score opens.  Nothing is approximate and no row is left out.

Defined cases: rows with a null label, a null vector, a null or non-finite component, or without vec_id
(a result could not name them) take no part; an empty vector has score 0 with every row; vectors of
different lengths meet over the components both have; rows that repeat a vec_id count once for an anchor
that they score alike with, and a row is no positive of an anchor with its own id; an anchor without
positives, and a positive without negatives, give no rows; further columns are ignored; an empty table
gives an empty result.  Scores that a long cannot hold raise OverflowError.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, scratch_path, ship_package

SCALE = 256
LABELS = 10
RELABEL = 7
EVERY = 50
POSITIVES = 5
NEGATIVES = 3
#: The window, in hundredths of the positive's score.
LOW, HIGH = 50, 95
#: Components multiplied at once: INNER * ((p - 1) / 2) ** 2 < 2 ** 24 for all primes below.
INNER = 64
BLOCK_ROWS = 8192
BLOCK_BYTES = 16 << 20
#: Rows held against ``ANCHORS`` anchors at a time, in a task.
ROWS, ANCHORS = 1024, 1024


def _primes(largest: int, n: int) -> list[int]:
    out: list[int] = []
    x = largest
    while len(out) < n:
        if all(x % k for k in range(2, int(x ** 0.5) + 1)):
            out.append(x)
        x -= 1
    return out


#: The largest primes that INNER allows; eight exceed 64 bits.
PRIMES = _primes(1022, 8)


def primes_for(bound: int) -> list[int]:
    """The fewest primes whose product tells all scores from ``-bound`` to ``bound`` apart."""
    n, product = 0, 1
    while product <= 2 * bound:
        product *= PRIMES[n]
        n += 1
    return PRIMES[:max(n, 1)]


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Integers to their residues around zero, as float32."""
    r = np.mod(x, p)
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def _around_zero(x: np.ndarray, p: int) -> np.ndarray:
    # p is odd, so x / p is never near enough to a half for rounding to go astray.
    return x - p * np.rint(x * (1.0 / p))


def product(rows: list[np.ndarray], anchors: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact integer products of all rows and all anchors, given as residue matrices for each prime."""
    digits: list[np.ndarray] = []
    for k, p in enumerate(primes):
        a, b = rows[k], anchors[k]
        r = np.zeros((len(a), len(b)))
        for low in range(0, a.shape[1], INNER):
            r += _around_zero((a[:, low:low + INNER] @ b[:, low:low + INNER].T).astype(np.float64), p)
        # Mixed radix: subtract what the digits so far stand for, then divide by the primes so far, modulo p.
        radix = 1
        for q, d in zip(primes, digits):
            r -= d * _around_zero(np.float64(radix % p), p)
            r = _around_zero(r, p)
            radix *= q
        digits.append(_around_zero(_around_zero(r, p) * pow(radix, -1, p), p))
    out = np.zeros(digits[0].shape, np.int64)
    for d, q in zip(reversed(digits), reversed([1, *primes[:-1]])):
        # Horner from the last digit; whatever wraps on the way wraps back, as the result fits.
        out += d.astype(np.int64)
        out *= q
    return out


class Best:
    """The first ``k`` of what each group was offered: higher scores first, then smaller ids."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.group = self.score = self.id = np.zeros(0, np.int64)
        self.last_score = np.full(groups, np.iinfo(np.int64).min)
        self.last_id = np.full(groups, np.iinfo(np.int64).max)

    def wanted(self, scores: np.ndarray, ids: np.ndarray, low: int) -> np.ndarray:
        """Which of ``scores`` (rows x groups from ``low`` on) could still come among the first."""
        s = self.last_score[low:low + scores.shape[1]]
        i = self.last_id[low:low + scores.shape[1]]
        return (scores > s) | ((scores == s) & (ids[:, None] < i))

    def offer(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(group):
            return
        g, s, i = (np.concatenate(x) for x in ((self.group, group), (self.score, score), (self.id, ids)))
        order = np.lexsort((i, -s, g))
        g, s, i = g[order], s[order], i[order]
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (s[1:] != s[:-1]) | (i[1:] != i[:-1])])  # a row that repeats counts once
        g, s, i = g[new], s[new], i[new]
        begin = np.searchsorted(g, g)
        keep = np.arange(len(g)) - begin < self.k
        self.group, self.score, self.id = g[keep], s[keep], i[keep]
        full = np.flatnonzero(np.arange(len(self.group)) - np.searchsorted(self.group, self.group) == self.k - 1)
        self.last_score[self.group[full]] = self.score[full]
        self.last_id[self.group[full]] = self.id[full]


class Block(NamedTuple):
    """Anchors: ids, labels, residue matrices; and for each, the scores of its positives (with their ids)."""
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    primes: list[int]


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flat values, starts, valid) of a list column; nulls and non-finite components make a row invalid."""
    n = len(column)
    valid = np.ones(n, bool) if not column.null_count else np.asarray(column.is_valid().to_numpy(zero_copy_only=False))
    offsets = column.offsets.to_numpy().astype(np.int64)
    inner = column.values
    flat = inner.cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null component reads as NaN
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    valid &= bad[offsets[1:]] == bad[offsets[:-1]]
    return flat, offsets, valid


def quantise(rows: DataFrame) -> DataFrame:
    """(vec_id, label, vec, wide, top, length): the rows that take part, relabelled, as little-endian integers.

    ``vec`` holds 2 bytes a component if that is enough for the row, else 8 (``wide``); ``top`` is the
    largest absolute component.
    """
    ship_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat, offsets, valid = _vectors(batch.column(2))
            whole = np.floor(SCALE * np.where(np.isfinite(flat), flat, 0.0))
            take = np.flatnonzero(valid)
            vec, wide, top = [], [], []
            for k in take:
                v = whole[offsets[k]:offsets[k + 1]]
                t = float(np.abs(v).max()) if len(v) else 0.0
                big = t > 32767
                vec.append((np.clip(v, -2.0 ** 62, 2.0 ** 62).astype("<i8") if big else v.astype("<i2")).tobytes())
                wide.append(big)
                top.append(t)
            part = batch.take(pa.array(take))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(vec, pa.binary()), pa.array(wide, pa.bool_()), pa.array(top, pa.float64()),
                 pa.array(np.diff(offsets)[take].astype(np.int32))], ["vec_id", "label", "vec", "wide", "top", "length"])

    label = F.col("label").cast("bigint")
    label = F.when(F.col("vec_id") % RELABEL == 0, (label + 1) % LABELS).otherwise(label)
    there = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
    there = there.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    return there.mapInArrow(run, "vec_id bigint, label bigint, vec binary, wide boolean, top double, length int")


def _put(row: np.ndarray, packed: bytes, wide: bool) -> None:
    if packed:
        x = np.frombuffer(packed, "<i8" if wide else "<i2")
        row[:len(x)] = x


def _unpack(vec: pa.Array, wide: np.ndarray, length: int) -> np.ndarray:
    """Packed vectors as one integer matrix; shorter ones are filled up with zeros."""
    out = np.zeros((len(vec), length), np.int64)
    for k, v in enumerate(vec):
        _put(out[k], v.as_py(), wide[k])
    return out


def _batches(batch: pa.RecordBatch, block: Block) -> Iterator[tuple[np.ndarray, np.ndarray, int, np.ndarray]]:
    """(ids, labels, first anchor, scores) of all rows of a batch with all anchors, piece by piece."""
    anchors = [[residues(block.vectors[a:a + ANCHORS], p) for p in block.primes] for a in range(0, len(block.ids), ANCHORS)]
    for low in range(0, batch.num_rows, ROWS):
        part = batch.slice(low, ROWS)
        ids, labels = part.column(0).to_numpy(), part.column(1).to_numpy()
        x = _unpack(part.column(2), part.column(3).to_numpy(zero_copy_only=False), block.vectors.shape[1])
        rows = [residues(x, p) for p in block.primes]
        for k, a in enumerate(anchors):
            yield ids, labels, k * ANCHORS, product(rows, a, block.primes)


def _find(rows: DataFrame, shared, pairs) -> DataFrame:
    """What each task finds for the anchors of a block: (slot, score, id).

    Without ``pairs`` a slot is an anchor and the rows are its positives; with them (a broadcast of slots,
    anchors and windows), a slot is an anchor's positive and the rows are its negatives.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = shared.value
        n = len(block.ids)
        if pairs is None:
            slots = [(np.arange(n), None, None)]
            best = Best(n, POSITIVES)
        else:
            # One layer for each place among the positives: an anchor's window there, or one that nothing meets.
            slots = pairs.value
            best = Best(n * len(slots), NEGATIVES)
        for batch in batches:
            for ids, labels, low, scores in _batches(batch, block):
                high = low + scores.shape[1]
                same = labels[:, None] == block.labels[low:high]
                if pairs is None:
                    able = same & (ids[:, None] != block.ids[low:high])
                for layer, (_, floor, top) in enumerate(slots):
                    if pairs is not None:
                        able = ~same & (scores >= floor[low:high]) & (scores <= top[low:high])
                    r, a = np.nonzero(able & best.wanted(scores, ids, layer * n + low))
                    best.offer(layer * n + low + a, scores[r, a], ids[r])
        yield pa.RecordBatch.from_arrays([pa.array(best.group), pa.array(best.score), pa.array(best.id)], ["slot", "score", "id"])

    return rows.mapInArrow(run, "slot bigint, score bigint, id bigint")


def _merge(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each slot over all tasks, ranked; rows that repeat in two tasks are one."""
    order = Window.partitionBy("slot").orderBy(F.col("score").desc(), "id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _blocks(spark: SparkSession, anchors: DataFrame, length: int, primes: list[int]) -> Iterator[Block]:
    """The anchors in blocks of a bounded size; the driver holds one block and one partition of them at a time."""
    most = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(length, 1))))
    ids: list[int] = []
    labels: list[int] = []
    vectors: list[tuple[bytes, bool]] = []

    def block() -> Block:
        x = np.zeros((len(ids), max(length, 1)), np.int64)
        for k, v in enumerate(vectors):
            _put(x[k], *v)
        return Block(np.array(ids, np.int64), np.array(labels, np.int64), x, primes)

    for r in anchors.toLocalIterator():
        ids.append(r["vec_id"])
        labels.append(r["label"])
        vectors.append((bytes(r["vec"]), r["wide"]))
        if len(ids) == most:
            yield block()
            ids, labels, vectors = [], [], []
    if ids:
        yield block()


def _windows(positives: list, n: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each place among the positives: (ids, lowest score, highest score) over the anchors; an empty window without one."""
    out = []
    for k in range(POSITIVES):
        ids, floor, top = np.zeros(n, np.int64), np.ones(n, np.int64), np.zeros(n, np.int64)
        for r in positives:
            if r["rank"] == k + 1:
                s = r["score"]
                ids[r["slot"]] = r["id"]
                if s >= 0:  # below zero the window's ends cross
                    floor[r["slot"]], top[r["slot"]] = -(-LOW * s // 100), HIGH * s // 100
        out.append((ids, floor, top))
    return out


def mine(rows: DataFrame, anchor: Column | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``rows`` (vec_id, embedding, label).

    ``anchor`` (over vec_id) tells the anchors; by default every ``EVERY``-th id.
    """
    spark = rows.sparkSession
    anchor = F.col("vec_id") % EVERY == 0 if anchor is None else anchor
    vectors = materialize(quantise(rows), "negative-vectors")
    size = vectors.agg(F.max("top").alias("top"), F.max("length").alias("length")).first()
    length, top = size["length"] or 0, int(size["top"] or 0)
    bound = max(length, 1) * top * top
    if bound >= 1 << 63:
        raise OverflowError(f"scores of components up to {top} over {length} places do not fit a long")
    primes = primes_for(bound)
    plain = vectors.select("vec_id", "label", "vec", "wide")
    anchors = materialize(plain.filter(anchor).distinct(), "negative-anchors")
    path = scratch_path(spark, "negatives")
    schema = ("anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    spark.createDataFrame([], schema).write.parquet(path)
    for block in _blocks(spark, anchors, length, primes):
        n = len(block.ids)
        shared = spark.sparkContext.broadcast(block)
        positives = _merge(_find(plain, shared, None), POSITIVES).collect()  # at most POSITIVES rows for each anchor of the block
        windows = _windows(positives, n)
        pairs = spark.sparkContext.broadcast(windows)
        found = _merge(_find(plain, shared, pairs), NEGATIVES)
        names = spark.createDataFrame(
            [(int((r["rank"] - 1) * n + r["slot"]), int(block.ids[r["slot"]]), r["id"], r["score"]) for r in positives],
            "slot bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
        (found.join(names, "slot").select("anchor_id", "positive_id", F.col("rank").cast("int"), F.col("id").alias("negative_id"), "positive_score",
                                          F.col("score").alias("negative_score")).write.mode("append").parquet(path))
        pairs.destroy()
        shared.destroy()
    return spark.read.schema(schema).parquet(path)


#: The same by joins in DuckDB: whole rows once, every anchor against every row.
ORACLE_NEGATIVES = """
WITH whole AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
),
places AS (SELECT row, vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS k FROM whole),
scores AS (
  SELECT DISTINCT anchor_id, anchor_label, id, label, score FROM (
    SELECT a.row, a.vec_id AS anchor_id, a.label AS anchor_label, b.row, b.vec_id AS id, b.label AS label, CAST(sum(a.x * b.x) AS BIGINT) AS score
    FROM places a JOIN places b ON a.k = b.k AND a.vec_id % 50 = 0 GROUP BY ALL)
),
positives AS (
  SELECT anchor_id, anchor_label, id AS positive_id, score AS positive_score FROM scores
  WHERE label = anchor_label AND id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
),
negatives AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
  FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND s.label <> p.anchor_label
  WHERE 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 3
"""
