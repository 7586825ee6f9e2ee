"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

    logit(x) = b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

with the pair sum in time linear in the features, by the sum-of-squares identity

    sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i (v_if x_i)^2 ].

*Features.*  Words (ASCII lower-cased) hashed to ``BUCKETS``, weighted by log
frequency and scaled to unit length; structure statistics (sizes, shares of
symbols, capitals, digits, marks, repeats) and the metadata column ``n_chars``.

*Fitting.*  On at most about ``TRAIN_ROWS`` labelled rows, chosen by a hash of the
id (a documented bound).  Executors turn texts into features; only those reach the
driver (a few MB), where numpy runs Adam on the logistic loss.

*Scoring.*  Whole texts, in blocks of about one MB per task.

Defined cases: null and empty texts are scored from their structure alone; with no
label, or labels of one kind only, the score is the constant share of label 1 (0.5
without any); labels repeated for a document count once, the largest; a null
``n_chars`` is taken from the text; a table without that column as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship_package, text_blocks

LOG_BUCKETS = 14
BUCKETS = 1 << LOG_BUCKETS
RANK = 8
TRAIN_ROWS = 6000
EPOCHS = 12
#: Fewer rows are gone through more often, so that the fit takes at least so many steps.
LEAST_STEPS = 288
BATCH = 256
RATE = 0.02
DECAY_LINEAR = 1e-5
DECAY_PAIRS = 1e-4
CUT = 0.3
SEED = 7

#: Structure and metadata features, after the word buckets.
STATS = ("log_words", "log_lines", "word_length", "long_words", "symbols", "capitals", "digits", "marks", "exclaims",
         "other_bytes", "distinct_words", "top_word", "line_repeats", "pair_repeats", "line_words", "ended_lines",
         "log_n_chars")
N_FEATURES = BUCKETS + len(STATS)

_RANDOM = np.random.default_rng(11)
_POSITION = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _class(members: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(members.encode())] = True
    return t


_SPACE = _class(" \t\n\x0b\x0c\r")
_CLASSES = {"symbols": _class("#*$%&|<>{}[]\\^~=_@/"), "capitals": _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
            "digits": _class("0123456789"), "marks": _class(".,;:?"), "exclaims": _class("!")}
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _sum_rows(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    run = np.concatenate([[0], np.cumsum(values)])
    return run[last] - run[first]


def features(data: np.ndarray, offsets: np.ndarray, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse words and dense statistics of the texts of one block.

    Returns ``(row starts, buckets, weights, stats)``.
    """
    rows = len(offsets) - 1
    inner = ~_SPACE[data]
    # A word begins at a non-space byte after a space or at the beginning of a row.
    begins = inner.copy()
    begins[1:] &= ~inner[:-1]
    row_first = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[row_first] = inner[row_first]
    starts = np.flatnonzero(begins)
    n_words = np.searchsorted(starts, offsets[1:]) - np.searchsorted(starts, offsets[:-1])
    word_row = np.repeat(np.arange(rows), n_words)
    if len(starts):
        # Hash of a word: sum of its bytes times a number of their place.
        place = np.arange(len(data)) - np.maximum.accumulate(np.where(begins, np.arange(len(data)), 0))
        terms = (_LOWER[data].astype(np.uint64) + np.uint64(1)) * _POSITION[place & 63]
        terms[~inner] = 0
        hashes = np.add.reduceat(terms, starts) * _MIX
        size = np.add.reduceat(inner.astype(np.int64), starts)
    else:
        hashes, size = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    bucket = (hashes >> np.uint64(64 - LOG_BUCKETS)).astype(np.int64)
    key, n = np.unique(word_row * BUCKETS + bucket, return_counts=True)
    row = key // BUCKETS
    weight = np.log1p(n)
    norm = np.sqrt(np.bincount(row, weight * weight, rows))
    weight = weight / norm[row]
    row_starts = np.searchsorted(row, np.arange(rows + 1))

    words = np.maximum(n_words, 1).astype(float)
    size_bytes = np.maximum(offsets[1:] - offsets[:-1], 1).astype(float)
    stats = np.zeros((rows, len(STATS)))
    at = {name: i for i, name in enumerate(STATS)}
    word_bytes = np.bincount(word_row, size, rows)
    stats[:, at["log_words"]] = np.log1p(n_words)
    stats[:, at["word_length"]] = word_bytes / words / 10
    stats[:, at["long_words"]] = np.bincount(word_row, size > 14, rows) / words
    for name, members in _CLASSES.items():
        stats[:, at[name]] = _sum_rows(members[data], offsets[:-1], offsets[1:]) / size_bytes * 10
    stats[:, at["other_bytes"]] = _sum_rows(data >= 128, offsets[:-1], offsets[1:]) / size_bytes
    stats[:, at["distinct_words"]] = (row_starts[1:] - row_starts[:-1]) / words
    top = np.zeros(rows)
    np.maximum.at(top, row, n)
    stats[:, at["top_word"]] = top / words
    # Lines: a new one begins at the first word after a newline.
    newlines = np.cumsum(data == 10)
    line_no = newlines[starts] if len(starts) else np.zeros(0, np.int64)
    new_line = np.ones(len(starts), bool)
    new_line[1:] = (line_no[1:] != line_no[:-1]) | (word_row[1:] != word_row[:-1])
    line_at = np.flatnonzero(new_line)
    if len(line_at):
        line_row = word_row[line_at]
        in_line = np.arange(len(starts)) - np.repeat(line_at, np.diff(np.append(line_at, len(starts))))
        line_hash = np.add.reduceat(hashes * _POSITION[in_line & 63], line_at)
        n_lines = np.bincount(line_row, minlength=rows)
        lines = np.maximum(n_lines, 1)
        order = np.lexsort((line_hash, line_row))
        again = (np.diff(line_hash[order].astype(np.int64)) == 0) & (np.diff(line_row[order]) == 0)
        stats[:, at["line_repeats"]] = np.bincount(line_row[order][1:][again], minlength=rows) / lines
        stats[:, at["log_lines"]] = np.log1p(n_lines)
        stats[:, at["line_words"]] = np.log1p(n_words / lines)
        pair = hashes[:-1] * _POSITION[0] + hashes[1:] * _POSITION[1]
        same_row = word_row[:-1] == word_row[1:]
        pairs, pair_row = pair[same_row], word_row[:-1][same_row]
        order = np.lexsort((pairs, pair_row))
        again = (np.diff(pairs[order].astype(np.int64)) == 0) & (np.diff(pair_row[order]) == 0)
        stats[:, at["pair_repeats"]] = np.bincount(pair_row[order][1:][again], minlength=rows) / words
        last_word = np.append(line_at[1:], len(starts)) - 1
        ends = starts[last_word] + size[last_word] - 1
        stats[:, at["ended_lines"]] = np.bincount(line_row, np.isin(data[ends], [33, 46, 63]), rows) / lines
    stats[:, at["log_n_chars"]] = np.log1p(np.where(np.isnan(n_chars), size_bytes, n_chars)) / 10
    return row_starts, key % BUCKETS, weight, stats


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    pairs: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def scaled(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.mean) / self.spread, -4, 4) * 0.3

    def logits(self, row_starts: np.ndarray, buckets: np.ndarray, weights: np.ndarray, stats: np.ndarray) -> np.ndarray:
        """Linear time: one sum and one sum of squares per rank."""
        x = self.scaled(stats)
        rows = len(x)
        out = np.full(rows, self.bias) + x @ self.linear[BUCKETS:]
        row = np.repeat(np.arange(rows), np.diff(row_starts))
        out += np.bincount(row, self.linear[buckets] * weights, rows)
        for f in range(self.pairs.shape[1]):
            t, d = self.pairs[buckets, f] * weights, x * self.pairs[BUCKETS:, f]
            total = np.bincount(row, t, rows) + d.sum(axis=1)
            out += 0.5 * (total * total - np.bincount(row, t * t, rows) - (d * d).sum(axis=1))
        return out


def constant(share: float) -> Machine:
    share = min(max(share, 1e-6), 1 - 1e-6)
    return Machine(float(np.log(share / (1 - share))), np.zeros(N_FEATURES), np.zeros((N_FEATURES, RANK)),
                   np.zeros(len(STATS)), np.ones(len(STATS)))


def fit(texts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], y: np.ndarray) -> Machine:
    """Adam on the logistic loss; ``texts``: (buckets, weights, stats) of each row."""
    rng = np.random.default_rng(SEED)
    stats = np.stack([t[2] for t in texts])
    m = Machine(float(np.log(y.mean() / (1 - y.mean()))), np.zeros(N_FEATURES), rng.normal(0, 0.05, (N_FEATURES, RANK)),
                stats.mean(axis=0), stats.std(axis=0) + 1e-6)
    table = np.column_stack([np.zeros(N_FEATURES), m.pairs])  # linear, then pairs
    first, second = np.zeros_like(table), np.zeros_like(table)
    dense = m.scaled(stats)
    extra = np.arange(BUCKETS, N_FEATURES)
    steps = 0
    for _ in range(max(EPOCHS, -(-LEAST_STEPS // -(-len(y) // BATCH)))):
        order = rng.permutation(len(y))
        for at in range(0, len(order), BATCH):
            part = order[at:at + BATCH]
            idx = np.concatenate([np.append(texts[i][0], extra) for i in part])
            val = np.concatenate([np.append(texts[i][1], dense[i]) for i in part])
            row = np.repeat(np.arange(len(part)), [len(texts[i][0]) + len(extra) for i in part])
            own = table[idx]
            terms = own * val[:, None]
            begin = np.searchsorted(row, np.arange(len(part)))
            total = np.add.reduceat(terms, begin, axis=0)
            squares = np.add.reduceat(terms[:, 1:] ** 2, begin, axis=0)
            logit = m.bias + total[:, 0] + 0.5 * (total[:, 1:] ** 2 - squares).sum(axis=1)
            err = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[part]
            m.bias -= RATE * err.mean()
            slope = np.empty_like(terms)
            slope[:, 0] = val
            slope[:, 1:] = val[:, None] * (total[row, 1:] - terms[:, 1:])
            slope *= err[row, None] / len(part)
            where, inverse = np.unique(idx, return_inverse=True)
            grad = np.stack([np.bincount(inverse, slope[:, k], len(where)) for k in range(slope.shape[1])], axis=1)
            grad[:, 0] += DECAY_LINEAR * table[where, 0]
            grad[:, 1:] += DECAY_PAIRS * table[where, 1:]
            steps += 1
            first[where] = 0.9 * first[where] + 0.1 * grad
            second[where] = 0.999 * second[where] + 0.001 * grad * grad
            step = RATE * np.sqrt(1 - 0.999 ** steps) / (1 - 0.9 ** steps)
            table[where] -= step * first[where] / (np.sqrt(second[where]) + 1e-8)
    m.linear, m.pairs = table[:, 0].copy(), table[:, 1:].copy()
    return m


def _blocks(texts: pa.Array, n_chars: pa.Array):
    chars = n_chars.cast(pa.float64()).to_numpy(zero_copy_only=False)
    for at, end, data, offsets in text_blocks(texts):
        yield at, end, features(data, offsets, chars[at:end])


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(y, text, n_chars) to (y, buckets, weights, stats) as packed numbers."""
    for batch in batches:
        y = batch.column(0).to_pylist()
        for at, end, (starts, buckets, weights, stats) in _blocks(batch.column(1), batch.column(2)):
            cut = [(starts[i], starts[i + 1]) for i in range(end - at)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(y[at:end], pa.int32()),
                 pa.array([buckets[a:b].astype(np.int32).tobytes() for a, b in cut], pa.binary()),
                 pa.array([weights[a:b].astype(np.float32).tobytes() for a, b in cut], pa.binary()),
                 pa.array([stats[i].astype(np.float64).tobytes() for i in range(end - at)], pa.binary())],
                ["y", "buckets", "weights", "stats"])


def _inputs(docs: DataFrame) -> DataFrame:
    chars = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    return docs.select("doc_id", "text", chars.alias("n_chars"))


def learn(docs: DataFrame, labels: DataFrame, learn_from: Column, rows: int = TRAIN_ROWS) -> Machine:
    """A machine from ``labels`` (doc_id, quality) for which ``learn_from`` (over doc_id) holds."""
    ship_package(docs.sparkSession)
    known = (labels.filter(learn_from & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max(F.col("quality").cast("int")).alias("y")))
    total = known.count()
    if not total:
        return constant(0.5)
    chosen = known.filter(F.abs(F.xxhash64(F.lit("quality"), F.col("doc_id")) % 1_000_000) < 1_000_000.0 * rows / total)
    # The chosen labels are bounded by ``rows``; the texts stay where they are.
    joined = _inputs(docs).join(F.broadcast(chosen), "doc_id").select("y", "text", "n_chars")
    # Texts repeated under one id make more rows; a document's copies weigh as often as they occur.
    # An id may hold any number of rows, though: beyond twice the bound each text counts once, chosen by its hash.
    if _inputs(docs).select("doc_id").join(F.broadcast(chosen), "doc_id").count() > 2 * rows:
        by_text = _inputs(docs).join(F.broadcast(chosen), "doc_id").withColumn("key", F.xxhash64("doc_id", "text"))
        keys = by_text.select("key").distinct().count()
        share = 1_000_000.0 * rows / keys
        joined = (by_text.filter(F.abs(F.xxhash64(F.lit("quality text"), F.col("key")) % 1_000_000) < share)
                  .dropDuplicates(["key"]).select("y", "text", "n_chars"))
    got = joined.mapInArrow(_featurise, "y int, buckets binary, weights binary, stats binary").collect()
    got.sort(key=lambda r: (bytes(r["stats"]), bytes(r["buckets"])))  # the fit must not depend on task order
    y = np.array([r["y"] for r in got], float)
    if not len(y) or y.min() == y.max():
        return constant(y.mean() if len(y) else 0.5)
    return fit([(np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["weights"], np.float32),
                 np.frombuffer(r["stats"], np.float64)) for r in got], y)


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """(doc_id, score) of every row."""
    spark = docs.sparkSession
    ship_package(spark)
    narrow = _inputs(docs)
    small = Machine(machine.bias, machine.linear.astype(np.float32), machine.pairs.astype(np.float32), machine.mean, machine.spread)
    shared = spark.sparkContext.broadcast(small)  # N_FEATURES x (RANK + 1) numbers, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for at, end, f in _blocks(batch.column(1), batch.column(2)):
                out[at:end] = 1 / (1 + np.exp(-np.clip(shared.value.logits(*f), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["doc_id", "score"])

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, score double")


def held_out(doc_id: Column, mod: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod == 0, F.lit(False))


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    machine = learn(docs, labels, ~held_out(F.col("doc_id")))
    return score(docs, machine).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                       (F.col("score") >= CUT).cast("int").alias("predicted"))
