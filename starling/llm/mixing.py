"""Mixing sources to target weights: repetition rates per source, seeded copies per document.

Sizes are words.  The sources, ordered by code point with null last, weigh
``weights`` in turn; their targets share the size of the whole corpus by weight,
but none exceeds ``max_repeat`` times its source's size: what a source cannot
take is shared again by weight among the others until none is above.

The closed form: with the sources ordered by (largest target / weight), those
that stop at their largest target come first, and each following source gets
weight x (total - stopped) / (weights not stopped).  The source table has one
row per source (aggregated before anything is ordered), never documents.

A document is taken floor(rate) times, rate = target / source size, plus once
more when a hash of (seed, doc_id, text) falls below the fraction: the draw
depends on the row alone, so reruns, retries and other partitionings agree.

Defined cases: null or empty text has size 0; a source of size 0 gets target 0;
null source is a source of its own; a null doc_id draws like the text ``null``;
rows repeated exactly draw alike; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, word_count

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
SEED = "mix-1"
#: Largest table of sources that is broadcast.
BROADCAST_SOURCES = 20_000


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, target) from rows of (source, size)."""
    per = sized.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    per = per.select("source", "source_size",
                     F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")).alias("w"))
    most = F.col("source_size") * F.lit(float(max_repeat))
    everything = Window.partitionBy()
    # Those that stop come first: smallest (largest target / weight).
    order = Window.orderBy(most / F.col("w"), F.col("source").isNull(), F.col("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(most).over(before), F.lit(0.0))
    per = per.withColumn("share", left / F.sum("w").over(after)).withColumn("stops", most <= F.col("w") * F.col("share"))
    # The level is that of the first source that does not stop; with none left, all stop.
    level = F.min(F.when(~F.col("stops"), F.struct(most / F.col("w"), F.col("share").alias("share")))).over(everything)["share"]
    target = F.when(F.col("stops") | level.isNull(), most).otherwise(F.col("w") * level)
    return per.select("source", "source_size", target.alias("target"))


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the row alone."""
    key = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null")),
                      F.coalesce(F.md5(text.cast("binary")), F.lit("null")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def mix_plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT,
             seed: str = SEED) -> DataFrame:
    """Every row of ``docs`` with ``mix_size``, ``mix_source_size``, ``mix_target`` and ``mix_copies``.

    Columns of ``docs`` by those names are replaced.  The per-source table is
    written first; up to ``BROADCAST_SOURCES`` rows it is broadcast, so the
    documents are not shuffled; beyond that it is joined by shuffle, where the
    adaptive skew join splits a hot source.
    """
    names = ("mix_size", "mix_source_size", "mix_target", "mix_copies")
    base = docs.drop(*names).withColumns({"mix_size": word_count(F.col("text")),
                                          "mix_draw": draw(F.col("doc_id"), F.col("text"), seed)})
    targets = materialize(source_targets(docs.select("source", word_count(F.col("text")).alias("size")), weights, max_repeat),
                          "mix-targets")
    t = targets.select(F.col("source").alias("mix_s"), F.col("source_size").alias("mix_source_size"),
                       F.col("target").alias("mix_target"))
    if targets.count() <= BROADCAST_SOURCES:
        t = F.broadcast(t)
    rate = F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    copies = whole + (F.col("mix_draw") < rate - whole).cast("bigint")
    joined = base.join(t, base["source"].eqNullSafe(t["mix_s"])).drop("mix_s")
    return joined.withColumn("mix_copies", copies).drop("mix_draw")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """The mixed corpus: each taken document once per copy, with ``copy`` = 1, 2, ... (replaces a column of that name)."""
    # The whole row rides along as one column, so that none of its names can clash with the plan's.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "copy"]).alias("document")
    plan = mix_plan(docs.select("doc_id", "text", "source", row), weights, max_repeat, seed)
    copies = F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int"))).alias("copy")
    return plan.filter(F.col("mix_copies") > 0).select("document", copies).select("document.*", "copy")


def mix_digest(docs: DataFrame) -> DataFrame:
    return mix_plan(docs).select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                                 F.col("mix_target").alias("target"),
                                 (F.col("mix_copies") * F.col("mix_size")).alias("taken"))


ORACLE_MIX = r"""
WITH base AS (
  SELECT doc_id, text, source,
         len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM base GROUP BY source),
weighed AS (
  SELECT source, source_size, 3.0::DOUBLE * source_size AS most,
         (((row_number() OVER (ORDER BY (source IS NULL), source) - 1) % 3) + 1)::DOUBLE AS w
  FROM per),
walk AS (
  SELECT *, ((SELECT sum(source_size) FROM per) - coalesce(sum(most) OVER (ORDER BY most / w, (source IS NULL), source
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY most / w, (source IS NULL), source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM weighed),
level AS (SELECT arg_min(share, most / w) AS share FROM walk WHERE most > w * share),
targets AS (
  SELECT source, source_size,
         CASE WHEN most <= w * walk.share OR (SELECT share FROM level) IS NULL THEN most
              ELSE w * (SELECT share FROM level) END AS target
  FROM walk),
rated AS (
  SELECT b.doc_id, b.text, b.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('mix-1:' || coalesce(b.doc_id::VARCHAR, 'null') || ':' || coalesce(md5(b.text), 'null')), 1, 12))::BIGINT
           / 281474976710656.0::DOUBLE AS draw
  FROM base b JOIN targets t ON b.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM rated
"""
