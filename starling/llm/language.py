"""Language identification with bit-sliced Bloom filters of byte n-grams.

One table of slots serves all languages: a slot is a bitmask with one bit per
language.  Inserting an n-gram of language *l* sets bit *l* in each of its
``HASHES`` slots; looking an n-gram up is the AND of its slots: the set of all
languages that contain it, in one go.  For a text the hits of each language are
counted (popcounts down each bit) and corrected for false positives: with a
share *f* of slots having bit *l*, a foreign n-gram hits with probability
``f ** HASHES``, so ``(hits - n * fp) / (1 - fp)`` n-grams are expected to be
truly contained.  The language with most wins.

*Learning.*  From rows with a non-null language, at most about
``TRAIN_PER_LANGUAGE`` texts of each language, chosen by a hash of the id (a
documented bound; the share per language comes from counts over all rows).  An
n-gram enters the filter of each language in which it is at least ``KEEP_SHARE``
as frequent as where it is most frequent, so noise does not spread it.

Prediction reads whole texts in blocks of about one MB.  An n-gram is four bytes
of UTF-8, ASCII letters in lower case, the middle two being letters.

Defined cases: null, empty and letterless texts are ``und`` with score 0; a text
with letters but no n-gram (one-letter words) gets the commonest language with the
score of a blind guess; ties go to the language first by code point; with no labelled row at all every text is
``und``; repeated rows are each predicted; more than 64 languages raise.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship_package, text_blocks

GRAM = 4
HASHES = 3
TRAIN_PER_LANGUAGE = 3000
KEEP_SHARE = 0.4
MIN_COUNT = 3
#: Slots per n-gram: keeps the share of false positives near one percent.
SLOTS_PER_GRAM = 8
MIN_COVERAGE = 0.05
UNDETERMINED = "und"

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93], dtype=np.uint64)


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    b = np.arange(256)
    upper, lower = (b >= 65) & (b <= 90), (b >= 97) & (b <= 122)
    fold = np.where(upper, b + 32, np.where(lower | (b >= 128), b, 32)).astype(np.uint8)
    return fold, fold != 32


_FOLD, _LETTER = _byte_tables()


def grams_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram beginning at each byte (as uint32) and whether it counts."""
    f = _FOLD[data]
    n = len(f) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint32), np.zeros(0, bool)
    g = f[:n].astype(np.uint32)
    for k in range(1, GRAM):
        g |= f[k:k + n].astype(np.uint32) << np.uint32(8 * k)
    letter = _LETTER[data]
    return g, letter[1:1 + n] & letter[2:2 + n]


def slots_of(grams: np.ndarray, log_slots: int) -> Iterator[np.ndarray]:
    wide = grams.astype(np.uint64)
    for m in _MULTIPLIERS[:HASHES]:
        h = wide * m
        yield ((h ^ (h >> np.uint64(29))) * m) >> np.uint64(64 - log_slots)


@dataclass
class LanguageFilters:
    languages: list[str]
    slots: np.ndarray
    log_slots: int
    #: Index of the language with most rows: for texts without any n-gram.
    commonest: int = 0

    @classmethod
    def build(cls, languages: list[str], grams: np.ndarray, masks: np.ndarray, commonest: int = 0) -> LanguageFilters:
        if len(languages) > 64:
            raise ValueError(f"{len(languages)} languages; a slot holds 64 bits")
        log_slots = max(10, int(np.ceil(np.log2(max(1, len(grams)) * SLOTS_PER_GRAM))))
        kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if np.dtype(t).itemsize * 8 >= len(languages))
        slots = np.zeros(1 << log_slots, kind)
        for at in slots_of(grams, log_slots):
            np.bitwise_or.at(slots, at, masks.astype(kind))
        return cls(languages, slots, log_slots, commonest)

    def false_positive(self) -> np.ndarray:
        bits = [((self.slots >> self.slots.dtype.type(j)) & self.slots.dtype.type(1)).mean() for j in range(len(self.languages))]
        return np.minimum(np.array(bits) ** HASHES, 0.99)

    def lookup(self, grams: np.ndarray) -> np.ndarray:
        """The mask of languages containing each n-gram."""
        mask = None
        for at in slots_of(grams, self.log_slots):
            found = self.slots[at]
            mask = found if mask is None else mask & found
        return mask

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each row: index of its language, score, and number of n-grams."""
        rows = len(offsets) - 1
        grams, counts_in = grams_of(data)
        first = np.minimum(offsets[:-1], len(grams))
        last = np.clip(offsets[1:] - GRAM + 1, first, len(grams))

        def per_row(flags: np.ndarray) -> np.ndarray:
            run = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
            return run[last] - run[first]

        n = per_row(counts_in)
        if not self.languages:
            return np.zeros(rows, np.int64), np.zeros(rows), n
        if not len(grams):
            return np.full(rows, self.commonest), np.full(rows, 1 / len(self.languages)), n
        mask = self.lookup(grams)
        mask[~counts_in] = 0
        one = mask.dtype.type(1)
        hits = np.stack([per_row((mask >> mask.dtype.type(j)) & one) for j in range(len(self.languages))], axis=1)
        fp = self.false_positive()
        true = np.maximum((hits - n[:, None] * fp) / (1 - fp), 0.0)
        best = np.where(n > 0, true.argmax(axis=1), self.commonest)
        score = np.where(n > 0, np.clip(true[np.arange(rows), best] / np.maximum(n, 1), 0.0, 1.0), 1 / len(self.languages))
        return best, score, n


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, gram, n): the n-grams of each language in this task."""
    total: dict[str, dict[int, int]] = {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for at, _, data, offsets in text_blocks(batch.column(1)):
            grams, counted = grams_of(data)
            for i in range(len(offsets) - 1):
                a, b = offsets[i], max(offsets[i], offsets[i + 1] - GRAM + 1)
                g, n = np.unique(grams[a:b][counted[a:b]], return_counts=True)
                mine = total.setdefault(langs[at + i], {})
                for x, k in zip(g.tolist(), n.tolist()):
                    mine[x] = mine.get(x, 0) + k
    for lang, mine in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(mine), pa.string()), pa.array(list(mine.keys()), pa.int64()), pa.array(list(mine.values()), pa.int64())],
            ["lang", "gram", "n"])


def learn(docs: DataFrame, learn_from: Column, per_language: int = TRAIN_PER_LANGUAGE) -> LanguageFilters:
    """Filters from the rows of ``docs`` (doc_id, text, lang) for which ``learn_from`` holds."""
    ship_package(docs.sparkSession)
    rows = docs.select("doc_id", "text", "lang").filter(learn_from & F.col("lang").isNotNull())
    have = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(have)
    if not languages:
        return LanguageFilters([], np.zeros(1 << 10, np.uint8), 10)
    LanguageFilters.build(languages, np.zeros(0, np.uint32), np.zeros(0, np.uint64))  # raises when there are too many
    share = F.element_at(F.create_map(*[x for l in languages for x in (F.lit(l), F.lit(min(1.0, per_language / have[l])))]),
                         F.col("lang"))
    chosen = F.abs(F.xxhash64(F.lit("language"), F.col("doc_id")) % 1_000_000) < share * 1_000_000
    counted = rows.filter(chosen).select("lang", "text").mapInArrow(_count_grams, "lang string, gram bigint, n bigint")
    # Columns are numbered: a language may be called like a column.
    number = {l: f"n{k}" for k, l in enumerate(languages)}
    numbered = counted.withColumn("lang", F.element_at(F.create_map(*[F.lit(x) for pair in number.items() for x in pair]), F.col("lang")))
    names = list(number.values())
    per = numbered.groupBy("gram").pivot("lang", names).agg(F.sum("n")).fillna(0)
    kept = per.filter(F.greatest(*names, F.lit(0)) >= MIN_COUNT).toPandas()
    counts = kept[names].to_numpy(dtype=np.float64).reshape(len(kept), len(languages))
    rate = counts / np.maximum(counts.sum(axis=0), 1.0)
    member = (rate > 0) & (rate >= KEEP_SHARE * rate.max(axis=1, keepdims=True, initial=0.0))
    masks = (member.astype(np.uint64) << np.arange(len(languages), dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    commonest = max(range(len(languages)), key=lambda j: (have[languages[j]], -j))
    return LanguageFilters.build(languages, kept["gram"].to_numpy(dtype=np.uint32), masks, commonest)


def _row_predictions(filters: LanguageFilters, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    langs: list[str] = []
    scores = np.zeros(len(texts))
    for at, end, data, offsets in text_blocks(texts):
        best, score, n = filters.predict(data, offsets)
        letters = np.concatenate([[0], np.cumsum(((data | 32) >= 97) & ((data | 32) <= 122), dtype=np.int64)])
        ascii_letters = letters[offsets[1:]] - letters[offsets[:-1]]
        for i in range(end - at):
            some = ascii_letters[i] > 0 or any(
                c.isalpha() for c in data[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace"))
            langs.append(filters.languages[best[i]] if some and filters.languages else UNDETERMINED)
            scores[at + i] = score[i] if langs[-1] != UNDETERMINED else 0.0
    return langs, scores


def predict(docs: DataFrame, filters: LanguageFilters, lang_col: str = "lang_pred", score_col: str = "lang_score") -> DataFrame:
    """All columns of ``docs`` plus prediction and score; columns by those names are replaced."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(filters)  # bounded by the training bound, whatever the corpus
    base = docs.drop(lang_col, score_col)
    # The row travels as one struct, so that no column name can clash.
    packed = base.select(F.struct(*[F.col(f"`{c}`") for c in base.columns]).alias("row"), F.col("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = _row_predictions(shared.value, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             ["row", "lang", "score"])

    fields = T.StructType([packed.schema["row"], T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])
    return packed.mapInArrow(run, fields).select("row.*", F.col("lang").alias(lang_col), F.col("score").alias(score_col))


def accepted(lang_col: str = "lang_pred", score_col: str = "lang_score", least: float = MIN_COVERAGE) -> Column:
    """Documents with a language: some letter, and at least ``least`` of the n-grams known in it."""
    return (F.col(lang_col) != UNDETERMINED) & (F.col(score_col) >= least)


def held_out(doc_id: Column, mod: int = 4, rest: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod == rest, F.lit(False))


def language_digest(docs: DataFrame) -> DataFrame:
    narrow = docs.select("doc_id", "text", "lang")
    filters = learn(narrow, ~held_out(F.col("doc_id")))
    return predict(narrow.select("doc_id", "text"), filters).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
