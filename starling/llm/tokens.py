"""Token counts through a digest cache.

Every text is reduced to a digest of its normalised content.  Digests are joined
with the counts stored under the same tokenizer version (a digest of the
tokenizer's file); only one text per missing digest is encoded, and its count is
appended to the cache.  Then every document takes its count from the cache.

*Normalised content*: runs of ASCII white space become one space.  The supported
tokenizer drops white space and never joins characters across it, so texts of
equal normalised content have equal counts.

*Encoding a miss.*  For the same reason a text's count is the sum over its
white-space separated pieces, so a worker keeps a bounded memo of piece counts
and gives the library only pieces it has not met; the memo starts anew when it
is full, which changes the time and never a count.  Tests hold the sums against
the library's own counts of whole texts.

Defined cases: null text counts as empty (0 tokens, 0 bytes); rows repeated keep
one output row each; a null doc_id is kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, path_exists, scratch_path, ship_package

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
#: Most pieces a worker remembers (about 100 bytes each).
MEMO_PIECES = 1_200_000
#: Pieces given to the library at once.
ENCODE_BATCH = 20_000

CACHE_SCHEMA = T.StructType([T.StructField("tokenizer", T.StringType()), T.StructField("digest", T.BinaryType()),
                             T.StructField("n_tokens", T.LongType())])

#: A run of ASCII letters with one closing mark: the mark is a piece of its own to the tokenizer.
_MARKED = re.compile(rb"[A-Za-z]+[.,]\Z")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def tokenizer_version(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()[:16]


class PieceCounter:
    """Token counts of texts by the sum over their pieces, with a bounded memo.

    Pieces are UTF-8 bytes: what ``bytes.split`` and ``bytes.lower`` go by is ASCII white space and A-Z alone.
    """

    def __init__(self, path: str, most: int = MEMO_PIECES):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.most = most
        self.memo: dict[bytes, int] = {}

    def _learn(self, pieces: set[bytes]) -> None:
        """Counts of new pieces, a closing . or , apart from the ASCII letters before it."""
        memo = self.memo
        marked = [p for p in pieces if _MARKED.match(p)]
        plain = pieces.difference(marked)
        plain.update(p[:-1] for p in marked)
        plain.update((b".", b","))
        todo = [p for p in plain if p not in memo]
        for at in range(0, len(todo), ENCODE_BATCH):
            part = todo[at:at + ENCODE_BATCH]
            texts = [p.decode() for p in part]
            for p, e in zip(part, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                memo[p] = len(e)
        for p in marked:
            memo[p] = memo[p[:-1]] + memo[p[-1:]]

    def count(self, texts: list[bytes | str]) -> list[int]:
        """Token counts of texts, given as UTF-8 or str."""
        if len(self.memo) > self.most:
            self.memo = {}
        texts = [t.encode() if isinstance(t, str) else t for t in texts]
        # Only plain ASCII is lower-cased here: what the tokenizer does to other letters is its own,
        # and its special strings are matched as they are written.
        split = [(t.lower() if t.isascii() and b"<|" not in t else t).split() for t in texts]
        memo = self.memo
        new = set().union(*split).difference(memo)
        if new:
            self._learn(new)
        return [sum(map(memo.__getitem__, pieces)) for pieces in split]


_COUNTERS: dict[str, PieceCounter] = {}


def _encoder(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path not in _COUNTERS:
            _COUNTERS[path] = PieceCounter(path)
        counter = _COUNTERS[path]
        for batch in batches:
            digest, texts = batch.column(0), batch.column(1).cast(pa.binary())
            counts: list[int] = []
            for at in range(0, len(texts), 256):
                counts += counter.count(texts.slice(at, 256).to_pylist())
            yield pa.RecordBatch.from_arrays([digest, pa.array(counts, pa.int64())], ["digest", "n_tokens"])
    return encode


def content_digest(text: Column) -> Column:
    """SHA-256 of the text with each run of ASCII white space made one space."""
    return F.unhex(F.sha2(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "), 256))


def read_cache(spark, cache_path: str, version: str) -> DataFrame:
    """(digest, n_tokens) stored under a tokenizer version; one row per digest."""
    if not path_exists(spark, cache_path):
        return spark.createDataFrame([], CACHE_SCHEMA).select("digest", "n_tokens")
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache_path).filter(F.col("tokenizer") == version)
    # Two runs may have appended the same digest; their counts are equal.
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, cache_path: str, tokenizer: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs`` (doc_id, text).

    ``cache_path``: the cache, a folder of Parquet on storage all executors share;
    created on first use.  ``tokenizer``: path of a ``tokenizers`` file, the same
    on every machine.
    """
    spark = docs.sparkSession
    ship_package(spark)
    tokenizer = tokenizer or tokenizer_path()
    version = tokenizer_version(tokenizer)
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", content_digest(text).alias("digest"), text.alias("text"))
    digests = materialize(keyed.select("doc_id", "digest", F.octet_length("text").cast("bigint").alias("n_bytes")),
                          "token-digests")
    stored = materialize(read_cache(spark, cache_path, version), "token-stored")
    # One document stands for all of a missing digest (partial aggregation: a hot digest is one row per task).
    misses = digests.join(stored, "digest", "left_anti").groupBy("digest").agg(F.min("doc_id").alias("rep_id"))
    same = keyed["doc_id"].eqNullSafe(misses["rep_id"]) & (keyed["digest"] == misses["digest"])
    todo = keyed.join(misses.hint("shuffle_hash"), same, "left_semi").select("digest", "text")
    # A repeated row (same doc_id and text) is encoded as often as it occurs, and stored once.
    new = todo.mapInArrow(_encoder(tokenizer), "digest binary, n_tokens bigint").groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    (new.select(F.lit(version).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache_path))
    # Written first: both sides of the join are then plain scans, which the adaptive skew join can split
    # where copies share a digest.
    known = materialize(read_cache(spark, cache_path, version), "token-known")
    return digests.join(known, "digest").select("doc_id", "n_bytes", "n_tokens",
                                                (F.col("n_tokens") > limit).alias("over_limit"))


def fresh_cache_path(spark) -> str:
    """A new, empty cache in the shared scratch folder."""
    return scratch_path(spark, f"token-cache-{uuid.uuid4().hex[:6]}")
