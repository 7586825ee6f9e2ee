"""Line dedup (op9) against a brute force over all runs of characters."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from starling.llm import line_dedup

from llm_helpers import Sets, con, documents  # noqa: F401


def runs(line):
    n = line_dedup.SHINGLE
    return frozenset(line[i:i + n] for i in range(max(1, len(line) - n + 1)))


def near(a, b):
    return len(runs(a) & runs(b)) >= line_dedup.SIMILARITY * len(runs(a) | runs(b))


def classes_of(spark, lines):
    rows = [(k, x) for k, x in enumerate(lines)]
    return {r["doc_id"]: bytes(r["component"]) for r in line_dedup.line_classes(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}


def test_lines_without_spaces(spark):
    """One character changed in a line without spaces: a Chinese sentence, a URL, and strangers of both."""
    rng = random.Random(4)
    chinese = ["".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(120)) for _ in range(2)]
    changed = chinese[0][:60] + "的" + chinese[0][61:]
    url = "https://example.org/" + "/".join(f"part{k * 7919 % 1000}" for k in range(12))
    lines = [chinese[0], changed, chinese[1], url, url[:-1] + "x", "https://example.org/" + "q" * 60]
    got = classes_of(spark, lines)
    for i, a in enumerate(lines):
        for j, b in enumerate(lines):
            assert (got[i] == got[j]) == (i == j or near(a, b)), (i, j)
    assert got[0] == got[1] and got[3] == got[4]


def test_similarity_is_that_of_all_runs():
    """The verified similarity is that of the sets of runs, for lines of any length and width of character."""
    rng = random.Random(8)
    pairs = []
    for _ in range(600):
        letters = rng.choice(["ab ", "abcdefghij klmnop", "äöü ß", "的一是不了人我在有他", "x😀é的"])
        a = [rng.choice(letters) for _ in range(rng.choice([1, 3, 9, 10, 11, 14, 40, 90, 300]))]
        b = list(a)
        for _ in range(rng.randrange(0, 3)):
            b[rng.randrange(len(b))] = rng.choice(letters)
        b += rng.choice([[], ["z"], ["的", "z"]])
        pairs.append(("".join(a), "".join(b)))
    got = line_dedup.near_lines(pa.array([a for a, _ in pairs]), pa.array([b for _, b in pairs]))
    want = np.array([near(a, b) for a, b in pairs])
    assert (got == want).all() and 50 < want.sum() < 550


def test_line_classes_by_all_runs(spark, documents, con):  # noqa: F811
    """Every line of the table: nothing merged that the runs do not link, hardly a link lost."""
    lines = sorted({x for (t,) in con.execute("SELECT text FROM documents WHERE text IS NOT NULL").fetchall()
                    for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)})
    holders, sets, links = {}, Sets(len(lines)), 0
    all_runs = [runs(x) for x in lines]
    for i, s in enumerate(all_runs):
        both = {}
        for x in s:
            for j in holders.get(x, ()):
                both[j] = both.get(j, 0) + 1
            holders.setdefault(x, []).append(i)
        for j, n in both.items():
            if n >= line_dedup.SIMILARITY * (len(s) + len(all_runs[j]) - n):
                sets.join(i, j)
                links += 1
    at = {hashlib.md5(x.encode()).digest(): k for k, x in enumerate(lines)}
    found = {}
    for r in line_dedup.line_classes(documents).collect():
        found.setdefault(bytes(r["component"]), set()).add(sets.find(at[bytes(r["digest"])]))
    assert links > 50 and all(len(c) == 1 for c in found.values())
    want = len({sets.find(k) for k in range(len(lines))})
    print(f"links {links}, classes {want}, found {len(found)}")
    assert len(found) <= want * 1.001


def sets_of(lines):
    data = "".join(lines).encode()
    offsets = np.concatenate([[0], np.cumsum([len(x.encode()) for x in lines])])
    return line_dedup.shingle_sets(np.frombuffer(data, np.uint8), offsets)


def edited_pairs(rng, n, tries=4000):
    """Pairs of lines of about ``n`` shingles whose similarity is at or just above the threshold."""
    letters = "abcdefghij klmnop"
    out = []
    while len(out) < tries:
        a = "".join(rng.choice(letters) for _ in range(n + line_dedup.SHINGLE - 1))
        extra = max(1, round(n * rng.choice([0.1, 0.15, 0.2, 0.25])))
        tail = "".join(rng.choice(letters) for _ in range(extra))
        b = a + tail if rng.random() < 0.5 else tail + a
        if near(a, b):
            out.append((a, b))
    return out


@pytest.mark.parametrize("n", [4, 5, 8, 10, 12, 14, 15, 16, 18, 20, 30, 60, 200])
def test_recall_by_length(n):
    """Of pairs at the threshold, at least 0.97 meet in a bucket, whatever their length; all short ones.  All pass the sketches."""
    pairs = edited_pairs(random.Random(n), n, 1000 if n > 20 else 2000)
    keys, sketch = [], []
    for side in (0, 1):
        lines = [p[side] for p in pairs]
        k, s = [], []
        for low in range(0, len(lines), 1000):
            sets, begins = sets_of(lines[low:low + 1000])
            values, there = line_dedup.line_keys(sets, begins)
            k += [set(v[t].tolist()) for v, t in zip(values, there)]
            s += list(zip(np.diff(begins).tolist(), line_dedup.sketches(sets, begins).view(np.uint64).tolist()))
        keys.append(k)
        sketch.append(s)
    met = np.array([bool(a & b) for a, b in zip(*keys)])
    passed = []
    for (na, sa), (nb, sb) in zip(*sketch):
        apart = sum(bin(x ^ y).count("1") for x, y in zip(sa, sb))
        passed.append(apart <= (na + nb) * (1 - line_dedup.SIMILARITY) / (1 + line_dedup.SIMILARITY) + 1e-6)
    print(n, met.mean(), np.mean(passed), (met & np.array(passed)).mean())
    assert all(passed) and met.mean() >= 0.97
    if n < 15:
        assert met.all()


def test_sketches_by_hand():
    """A bit is set if a hash of the line lies in its part of the range."""
    lines = ["abcdefghijklmnopqrstuvwxyz" * 20, "short one", "的一是不了人我在有他这中大来上"]
    sets, begins = sets_of(lines)
    words = line_dedup.sketches(sets, begins).view(np.uint64)
    for i in range(len(lines)):
        own = sets[begins[i]:begins[i + 1]] & line_dedup._LOW
        for part in range(line_dedup.SKETCH):
            inside = own[own >> np.uint64(line_dedup.HASH_BITS - line_dedup.LOG_SKETCH) == part]
            bit = int(words[i, part // 64]) >> (part % 64) & 1
            assert bit == int(len(inside) > 0)


def test_many_near_copies_of_near_copies(spark):
    """A bucket full of lines that are near some of the others: no link is lost, in one class or in several."""
    rng = random.Random(12)
    base = "".join(rng.choice("abcdefghij klmnop") for _ in range(300))
    lines = [base]
    for k in range(150):  # a chain of edits that leads away from the base, and variants of the base
        x = list(rng.choice(lines[-3:]) if k % 2 else base)
        for _ in range(1 + k % 9):
            x[rng.randrange(len(x))] = rng.choice("qrstuv")
        lines.append("".join(x))
    lines = sorted(set(lines))
    got = classes_of(spark, lines)
    sets = Sets(len(lines))
    for i, a in enumerate(lines):
        for j in range(i):
            if near(a, lines[j]):
                sets.join(i, j)
    want = [sets.find(i) for i in range(len(lines))]
    assert len(set(want)) > 1
    pairs = {(got[i], want[i]) for i in range(len(lines))}
    assert len(pairs) == len({a for a, _ in pairs}) and len(pairs) <= len(set(want)) + 1
