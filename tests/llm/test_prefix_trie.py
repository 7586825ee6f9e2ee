"""The prefix trie against SQL and against a plain trie of Python tuples."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from starling.llm import prefix_trie as pt

from llm_helpers import SF01, con, same_as_oracle  # noqa: F401  (fixture)

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def naive(rows):
    """Rows (conv_id, turn, role, text), turns of a conversation distinct, to the nodes' rows."""
    original = {}
    for c, t, r, x in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        original.setdefault(c, []).append((r or "", x or ""))
    whole = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = int(c / 100) * 100
        whole[c] = tuple(original.get(base, [])[:h] + own[h:])
    members = {}
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[q] for q in below) if below else 1
        saved[p] = sum(saved[q] for q in below) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if whole[c] == p).encode()).hexdigest())
                  for p, m in members.items())


def found(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def random_rows(seed, convs=240):
    """Conversations over few texts, so that they share long prefixes; ids below zero as well."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-150, 400), convs):
        n = rng.randrange(1, 9)
        rows += [(c, t, rng.choice(["user", "user", "bot", None]), rng.choice(["a", "bb", "Über", "", None])) for t in range(n)]
    rng.shuffle(rows)
    return rows


def test_whole_table_against_sql(spark, con):
    con.execute(f"CREATE VIEW IF NOT EXISTS conversations AS SELECT * FROM '{SF01}/conversations.parquet'")
    same_as_oracle(pt.prefix_trie(spark.read.parquet(f"{SF01}/conversations.parquet")), con, pt.ORACLE_TRIE)


@pytest.fixture()
def many_shards(spark, monkeypatch):
    """Every partition a shard, also of the smaller trees down to 20 nodes."""
    monkeypatch.setattr(pt, "ONE_SHARD", 20)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_shards_against_brute_force(spark, many_shards):
    rows = random_rows(5)
    assert found(pt.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(5))) == naive(rows)


def test_long_conversation_over_several_shards(spark, many_shards):
    """One conversation holds most rows and hangs on others; another shares all but its end."""
    rows = [(c, t, "user", f"x{min(t, c % 3 + 2)}") for c in (0, 7, 13) for t in range(4)]
    rows += [(100, t, "bot", f"step {t}") for t in range(700)] + [(141, t, "bot", f"step {t}" if t < 690 else "other") for t in range(700)]
    assert found(pt.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(4))) == naive(rows)


def test_small_queue_spills(many_shards):
    queue = pt.SpillingQueue(3, limit=7)
    rng = random.Random(3)
    items = [(rng.randrange(-50, 50), rng.randrange(-9, 9), k) for k in range(5000)]
    out, waiting = [], []
    for k, item in enumerate(items):
        queue.push(item)
        waiting.append(item)
        if k % 3 == 0:
            waiting.sort()
            assert queue.peek() == waiting[0]
            assert queue.pop() == waiting.pop(0)
    while queue.peek() is not None:
        out.append(queue.pop())
    assert queue.made > 100 and out == sorted(waiting)


def test_very_common_first_turn_and_copies(spark, monkeypatch):
    """Thousands of members that end at one node: pieces of ids are put together in order."""
    monkeypatch.setattr(pt, "PIECE", 7)
    rows = [(c, 0, "user", "hello") for c in range(1500)] + [(c, 1, "bot", "hi") for c in range(1500) if c % 3]
    assert found(pt.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(6))) == naive(rows)


def test_odd_rows(spark):
    rows = [(5, None, "user", "first"), (5, 0, None, None), (5, 2, "user", ""), (None, 1, "user", "no id"),
            (100, 1, "a", "b:"), (101, 1, "a:b", ""), (102, 1, "", "a1:b"), (103, 7, "user", "word " * 30000)]
    df = spark.createDataFrame(rows, SCHEMA).select("*", F.lit(1).alias("d"), F.lit(2).alias("ka"), F.lit(3).alias("owner"), F.lit(4).alias("shard"),
                                                    F.lit("x").alias("a.b"))
    assert found(pt.prefix_trie(df)) == naive(rows)


def test_repeated_rows_are_turns(spark):
    rows = [(100, 1, "user", "x"), (100, 1, "user", "x"), (100, 1, "user", "x")]
    got = found(pt.prefix_trie(spark.createDataFrame(rows, SCHEMA)))
    assert [r[1] for r in got] == [0, 1, 2, 3]


def test_empty_table(spark):
    assert found(pt.prefix_trie(spark.createDataFrame([], SCHEMA))) == []
