"""Toxicity: held-out accuracy, the trees and the calibration against plain versions, odd input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from starling.llm import toxicity as tx

from llm_helpers import SF01, clashing, empty, odd  # noqa: F401  (fixtures)

LABELS = "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="module")
def scored(spark):
    """Rows of the digest over the larger table, with labels where there are."""
    sf = SF01.replace("0.01", "0.1")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    digest = tx.toxicity_digest(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    return digest.join(labels.select("doc_id", "toxic"), "doc_id", "left").collect()


def test_held_out_accuracy(scored):
    known = [r for r in scored if r["held_out"] and r["toxic"] is not None]
    assert len(known) > 1000
    hit = sum(r["predicted"] == 1 and r["toxic"] == 1 for r in known)
    said, there = sum(r["predicted"] for r in known), sum(r["toxic"] for r in known)
    assert hit / said > 0.9 and hit / there > 0.85


def test_scores_are_calibrated(scored):
    """Among held-out rows the mean score of the sure and of the unsure is near their share of label 1."""
    known = [r for r in scored if r["held_out"] and r["toxic"] is not None]
    for part in ([r for r in known if r["score"] >= 0.7], [r for r in known if r["score"] < 0.3]):
        assert abs(np.mean([r["score"] for r in part]) - np.mean([r["toxic"] for r in part])) < 0.08
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in scored)


def test_isotonic_against_plain_regression():
    """The shares are the best increasing fit: no block can be cut to fit better, by comparing with max-min averages."""
    rng = np.random.default_rng(4)
    s = np.round(rng.normal(size=300), 1)
    y = (rng.random(300) < 1 / (1 + np.exp(-s))).astype(float)
    at, shares = tx.isotonic(s, y)
    assert (np.diff(at) >= 0).all() and (np.diff(shares) >= 0).all()
    values = np.unique(s)
    for v in values:
        best = max(min(y[(s >= a) & (s <= b)].mean() for b in values if b >= v) for a in values if a <= v)
        k = int(np.searchsorted(at[::2], v, side="right")) - 1  # its block, from at[2 * k] to at[2 * k + 1]
        block = y[(s >= at[2 * k]) & (s <= at[2 * k + 1])]
        assert block.mean() == pytest.approx(best)
        assert shares[2 * k] == pytest.approx((block.sum() + 0.5) / (len(block) + 1)) or shares[2 * k] == shares[2 * k - 1]


def test_beginnings_of_words_are_learned(spark):
    """Words that share a beginning are one entry; copies of one text don't make their words significant."""
    rows = [(f"calm words here zorgo{chr(97 + k)}{chr(98 + k)} then zorgo{chr(99 + k)}x more", 1) for k in range(12)] + [("the same odd vexation text", 1)] * 20
    rows += [(f"calm words here and then more {chr(97 + k % 26)}{chr(97 + k // 26)}", 0) for k in range(80)]
    learned = tx.learn_lexicon(spark.createDataFrame(rows, "text string, y int"))
    assert any("zorgoab".startswith(w.strip()) for w in learned) and len([w for w in learned if w.startswith("zor")]) == 1
    assert not any("vexation".startswith(w.strip()) for w in learned)
    assert tx.Lexicon(learned).weight("zorgoxy") > 2 and tx.Lexicon(learned).weight("calm") == 0


def test_trees_lower_the_loss_and_route_as_they_were_grown():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)  # no single feature tells
    base, trees = tx.boost(x, y)
    assert (((tx.margins(x, base, trees) > 0) == (y > 0.5)).mean()) > 0.95
    one = trees[0]
    for row in x[:50]:
        node = 0
        for _ in range(tx.DEPTH):
            node = 2 * node + (2 if row[one.feature[node]] > one.cut[node] else 1)
        assert one.predict(row[None])[0] == one.value[node]


@pytest.mark.parametrize("word", ["1d1ot", "i.d.i.o.t", "idiooot", "i d i o t", "id1ot", "stup1d", "l0ser", "m-o-r-o-n"])
def test_obfuscated_words_are_put_back(word):
    x = dict(zip(tx.FEATURES, tx.text_features(f"You are a {word} and nothing else.", tx.Lexicon({}))))
    assert x["put_back"] >= 1


def test_features_by_hand():
    x = dict(zip(tx.FEATURES, tx.text_features("You IDIOT! What a moron, a moron #1", tx.Lexicon({"moron ": 2.0}))))
    assert (x["insults"], x["insult_kinds"], x["learned"], x["learned_weight"]) == (3, 2, 2, 4.0)
    assert x["near_person"] == 2  # the last one is six words from "you"
    assert x["exclaims"] == pytest.approx(100 / 35) and x["digits"] == pytest.approx(100 / 35)
    assert tx.text_features("", tx.Lexicon({})) == [0.0] * len(tx.FEATURES)


def test_time_is_linear_in_odd_texts():
    """Long runs without spaces, of letters, look-alikes or single letters, take no more than their length."""
    import time
    for text in ("x" * 300_000, "a1" * 150_000, "a." * 150_000, "a " * 150_000, "aa " * 100_000, "é" * 200_000, "1.-" * 100_000):
        t = time.time()
        tx.text_features(text, tx.Lexicon({"aaa": 1.0}))
        assert time.time() - t < 5, text[:10]


def test_odd_rows(spark, odd, clashing, empty):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (None, 1, 1), (2, None, None), (3, 0, 0)], LABELS)
    out = tx.toxicity_digest(odd, labels).collect()
    assert len(out) == odd.count() and all(0 <= r["score"] <= 1 for r in out)
    assert sorted(map(str, tx.toxicity_digest(clashing, labels).collect())) == sorted(map(str, out))
    assert tx.toxicity_digest(empty, labels).collect() == []
    nothing = tx.toxicity_digest(odd, spark.createDataFrame([], LABELS)).collect()
    assert {r["score"] for r in nothing} == {0.5}


def test_learning_is_bounded_by_rows(spark):
    """An id that very many rows share gives no more than the bound to the driver."""
    docs = spark.range(3000).select(F.lit(5).cast("bigint").alias("doc_id"), F.concat(F.lit("text you idiot "), F.col("id")).alias("text"))
    docs = docs.unionByName(spark.range(6, 60).select(F.col("id").alias("doc_id"), F.lit("a calm text").alias("text")))
    labels = spark.range(5, 60).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), (F.col("id") == 5).cast("int").alias("toxic"))
    model = tx.learn(docs, labels, F.lit(True), rows=50)
    assert 0 <= model.score(np.zeros((1, len(tx.FEATURES))))[0] <= 1
