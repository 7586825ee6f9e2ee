"""Hard negatives against SQL and against exact Python integers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starling.llm import negatives as ng

from llm_helpers import SF01, con, same_as_oracle  # noqa: F401  (fixture)

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def naive(rows):
    """Every anchor against every row, in Python integers."""
    whole = []
    for v, e, y in rows:
        if v is None or y is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        whole.append((v, (y + 1) % 10 if v % 7 == 0 else y, [math.floor(256 * x) for x in e]))
    out = []
    for a, label, vec in whole:
        if a % 50:
            continue
        scores = sorted({(-sum(x * z for x, z in zip(vec, w)), v, y == label) for v, y, w in whole})
        positives = [(-s, v) for s, v, same in scores if same and v != a][:5]
        for ps, p in positives:
            window = [(-s, v) for s, v, same in scores if not same and 50 * ps <= -100 * s <= 95 * ps][:3]
            out += [(a, p, k + 1, v, ps, s) for k, (s, v) in enumerate(window)]
    return sorted(out)


def found(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in df.collect())


def test_whole_table_against_sql(spark, con):
    con.execute(f"CREATE VIEW IF NOT EXISTS embeddings AS SELECT * FROM '{SF01}/embeddings.parquet'")
    same_as_oracle(ng.mine(spark.read.parquet(f"{SF01}/embeddings.parquet")), con, ng.ORACLE_NEGATIVES)


@pytest.mark.parametrize("top,length", [(1, 3), (300, 64), (40_000, 130), (2 ** 28, 17), (2 ** 31 - 2, 2)])
def test_products_are_exact(top, length):
    rng = np.random.default_rng(top % 97)
    x = rng.integers(-top, top + 1, (23, length))
    y = rng.integers(-top, top + 1, (19, length))
    x[0], y[0], y[1] = top, top, -top  # the bound itself, on both sides
    primes = ng.primes_for(length * top * top)
    got = ng.product([ng.residues(x, p) for p in primes], [ng.residues(y, p) for p in primes], primes)
    want = [[sum(int(a) * int(b) for a, b in zip(r, s)) for s in y] for r in x]
    assert got.tolist() == want


def test_primes_keep_float32_exact():
    assert all(ng.INNER * ((p - 1) // 2) ** 2 < 2 ** 24 for p in ng.PRIMES)
    assert math.prod(ng.PRIMES) > 2 ** 64


def random_rows(seed, n=260):
    rng = random.Random(seed)
    rows = [(v, [rng.choice([-0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(6)], rng.randrange(4)) for v in range(n)]
    return rows + [(v, [0.5] * 6, v % 4) for v in range(n, n + 120)]  # one vector of very many rows: ties


def test_ties_against_brute_force(spark):
    rows = random_rows(8)
    assert found(ng.mine(spark.createDataFrame(rows, SCHEMA).repartition(5))) == naive(rows)


def test_blocks_of_anchors_and_rows(spark, monkeypatch):
    """Blocks and pieces far smaller than the table give the same rows."""
    rows = random_rows(9, 400)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    anchor = F.col("vec_id") % 10 == 0
    whole = found(ng.mine(df, anchor))
    monkeypatch.setattr(ng, "BLOCK_ROWS", 7)
    monkeypatch.setattr(ng, "ANCHORS", 3)
    monkeypatch.setattr(ng, "ROWS", 11)
    assert whole and found(ng.mine(df, anchor)) == whole


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (50, [0.5, 0.5], 1), (1, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [0.9, 0.1], 2), (3, [0.5, 0.5], 3),
            (4, [nan, 1.0], 2), (5, [1.0, inf], 2), (6, [None, 1.0], 2), (8, None, 2), (9, [1.0, 1.0], None), (None, [1.0, 1.0], 2),
            (7, [1.0, 0.0], 0), (14, [0.7, 0.4], 9), (10, [], 2), (11, [0.8], 2), (12, [0.8, 0.1, 9.0], 2), (13, [-1.0, -1.0], 1),
            (0, [1.0, 0.5], 1), (100, [], 4), (101, [1.0], 4), (102, [200.0, 0.0], 5)]
    df = spark.createDataFrame(rows, SCHEMA).select("*", F.lit(1).alias("score"), F.lit(2).alias("top"), F.lit(3).alias("rank"), F.lit(4).alias("a.b"))
    got = found(ng.mine(df))
    assert got == sorted(set(naive(rows)))
    assert got


def test_scores_beyond_a_long(spark):
    rows = [(0, [2.0 ** 30], 1), (1, [2.0 ** 30], 1)]
    with pytest.raises(OverflowError):
        ng.mine(spark.createDataFrame(rows, SCHEMA))


def test_empty_table(spark):
    assert found(ng.mine(spark.createDataFrame([], SCHEMA))) == []
