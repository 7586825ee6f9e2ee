"""Line dedup (op9, pipeline) in DataFrame functions: no Python on the executors, the runs and similarity of the plain version, recall."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starling.llm import line_dedup
from test_line_shingles import edited_pairs, near, runs

LETTERS = ["ab ", "abcdefghij klmnop", "äöü ß", "的一是不了人我在有他", "x😀é的"]


def test_no_python_on_the_executors(spark, monkeypatch):
    def refuse(*args, **more):
        raise AssertionError("Python on the executors")

    for name in ("mapInArrow", "mapInPandas"):
        monkeypatch.setattr(spark.range(1).__class__, name, refuse)
    line = "one line of more than a few words that both of the documents of this test have, but for"
    docs = spark.createDataFrame([(1, line + " this"), (2, line + " that"), (3, "another\n\n" + line + " this")], "doc_id bigint, text string")
    got = {(r["doc_id"], r["line_no"]): r["kept"] for r in line_dedup.line_classes(docs).collect()}
    assert got == {(1, 0): True, (2, 0): False, (3, 0): True, (3, 2): False}
    texts = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs).collect()}
    assert texts == {1: line + " this", 2: "", 3: "another\n"}


def test_runs_and_similarity(spark):
    """The runs of any characters are all there, and the similarity is the plain version's."""
    rng = random.Random(8)
    pairs = []
    for _ in range(400):
        letters = rng.choice(LETTERS)
        a = [rng.choice(letters) for _ in range(rng.choice([1, 3, 9, 10, 11, 14, 40, 90, 300]))]
        b = list(a)
        for _ in range(rng.randrange(0, 3)):
            b[rng.randrange(len(b))] = rng.choice(letters)
        b += rng.choice([[], ["z"], ["的", "z"]])
        pairs.append(("".join(a), "".join(b)))
    a, b = line_dedup.run_hashes(F.col("a")), line_dedup.run_hashes(F.col("b"))
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "k int, a string, b string")
    got = df.select("k", F.size(a).alias("n"), line_dedup.near(a, b).alias("near")).orderBy("k").collect()
    assert [r["n"] for r in got] == [len(runs(x)) for x, _ in pairs]
    want = line_dedup.near_lines(pa.array([x for x, _ in pairs]), pa.array([y for _, y in pairs])).tolist()
    assert [r["near"] for r in got] == want and 50 < sum(want) < 380


def prose(rng, n, tries):
    """Pairs of lines of words of about ``n`` shingles, edited inside or at an end, whose similarity is the threshold or above."""
    out = []
    while len(out) < tries:
        a = ""
        while len(a) < n + line_dedup.SHINGLE - 1:
            a += "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 7, 8, 10, 12]))) + " "
        b = list(a.strip())
        for _ in range(max(1, n // 90)):
            b[rng.randrange(len(b))] = rng.choice("qrstuv")
        b = "".join(b) + rng.choice(["", " and", " and so on"])
        if near(a.strip(), b):
            out.append((a.strip(), b))
    return out


@pytest.mark.parametrize("n", [4, 10, 14, 15, 16, 18, 20, 30, 60, 90, 130, 200, 400])
def test_recall_and_sketches(spark, n):
    """Of lines at the threshold at least 0.97 meet in a bucket, all short ones, and all pass the sketches."""
    pairs = edited_pairs(random.Random(n), n, 300) + (prose(random.Random(n), n, 500) if n >= 90 else [])
    docs = spark.createDataFrame([(2 * k + i, x) for k, p in enumerate(pairs) for i, x in enumerate(p)], "doc_id bigint, text string")
    rows = line_dedup.signatures(docs).select("doc_id", "id", "keys").collect()
    keys, ids = {r["doc_id"]: set(r["keys"]) for r in rows}, {r["doc_id"]: r["id"] for r in rows}
    met = [bool(keys[2 * k] & keys[2 * k + 1]) for k in range(len(pairs))]
    at = spark.createDataFrame(sorted({(ids[2 * k], ids[2 * k + 1]) for k in range(len(pairs))}), "a bigint, b bigint")
    texts = line_dedup._candidate_lines(docs, spark.createDataFrame([(i,) for i in set(ids.values())], "id bigint"))
    print(n, sum(met) / len(met))
    assert line_dedup._sketched(at, texts).count() == line_dedup._links(at, texts).count() == at.count()
    assert sum(met) >= 0.97 * len(met)
    if n < 15:
        assert all(met)


def test_sketches_of_fixed_width(spark):
    """A line's sketch is some longs whatever its length; it tells lines apart that are half alike, and is odd counts by hand."""
    rng = random.Random(6)
    letters = "abcdefghij klmnop"
    pairs = []
    for k in range(120):
        a = [rng.choice(letters) for _ in range(rng.choice([100, 300, 600, 1000]))]
        b = list(a)
        for at in range(5, len(b), 25):
            b[at] = "z"
        pairs.append(("".join(a), "".join(b)))
    docs = spark.createDataFrame([(2 * k + i, x + "\n" + x) for k, p in enumerate(pairs) for i, x in enumerate(p)], "doc_id bigint, text string")
    ids = line_dedup.line_rows(docs).select("id").distinct()
    texts = line_dedup._candidate_lines(docs, ids).cache()
    assert {t for c, t in texts.dtypes if c != "line"} == {"bigint"} and texts.count() == 240
    ids = {r["line"]: r["id"] for r in texts.select("id", "line").collect()}
    at = spark.createDataFrame([tuple(sorted((ids[a], ids[b]))) for a, b in pairs], "a bigint, b bigint")
    assert line_dedup._links(at, texts).count() == 0 and line_dedup._sketched(at, texts).count() < 0.02 * len(pairs)
    sets = texts.select("line", "size", F.array(*line_dedup._sketch_columns()).alias("bits"), line_dedup.run_hashes(F.col("line")).alias("runs"))
    for r in sets.limit(20).collect():
        odd = [0] * line_dedup.SKETCH_LONGS
        for x in r["runs"]:
            odd[(x >> 6) % line_dedup.SKETCH_LONGS] ^= 1 << (x % 64)
        assert r["size"] == len(runs(r["line"])) and [x % (1 << 64) for x in r["bits"]] == odd
    texts.unpersist()
