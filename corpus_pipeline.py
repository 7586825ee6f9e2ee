"""The corpus pipeline: documents in, a deduplicated, decontaminated, mixed corpus out.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes every
stage's result to the shared scratch folder and reads it back for the next one, so a lost
executor re-reads files and no stage is computed twice.  All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.llm import decontaminate, language, line_dedup, mixing, simhash
from starling.llm.common import delete_path, read_table, scratch_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: no letter, or hardly an n-gram of any learned language.

    Learns from the rows that carry a language, as the query does; with no such row
    nothing can be told and every document with a letter stays.
    """
    filters = language.learn(docs, ~language.held_out(F.col("doc_id")))
    if not filters.languages:
        return docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    found = language.predict(docs, filters, "__lang", "__score").filter(language.accepted("__lang", "__score"))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicate lines the first stays; every document stays, with what is left of its text."""
    return line_dedup.dedup_lines(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates by SimHash stays."""
    return simhash.keep_one_each(docs, simhash.SHINGLE, simhash.BITS)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document once per copy that the mix takes, with ``copy`` = 1, 2, ..."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash", dedup_documents),
    ("decontaminate", decontaminate_documents),
    ("mix", mix_sources),
]

#: Language identification and SimHash cannot be written in SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole table ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete_path(spark, before)
        before = path
    return docs
