"""Union-find, SimHash (op5), line dedup (op9), decontamination (op10) and the pipeline."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from starling.llm import components, decontaminate, language, line_dedup, mixing, registry, simhash

from llm_helpers import SF01, Sets, clashing, con, documents, empty, odd  # noqa: F401


def test_components_of_random_graphs(spark):
    rng = random.Random(5)
    for n, m in ((30, 15), (60, 80), (200, 120)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        sets = Sets(n)
        for a, b in edges:
            sets.join(a, b)
        got = {r["node"]: r["component"] for r in components.connected_components(
            spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()}
        assert got == {x: sets.find(x) for e in edges for x in e}


def test_components_of_a_chain_and_a_star(spark):
    chain = spark.range(1, 300).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    star = spark.range(1001, 3000).select(F.lit(1000).cast("bigint").alias("a"), F.col("id").alias("b"))
    got = components.connected_components(chain.union(star), "a", "b").groupBy("component").count().collect()
    assert sorted(map(tuple, got)) == [(0, 300), (1000, 2000)]
    nothing = chain.limit(0).union(spark.createDataFrame([(None, 1), (7, 7)], "a bigint, b bigint"))
    assert [tuple(r) for r in components.connected_components(nothing, "a", "b").collect()] == [(7, 7)]


# --- SimHash ---

def naive_fingerprint(text, k=3):
    import xxhash
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def naive_components(fps, ids, bits=3):
    f = np.array(fps, np.uint64)
    sets = Sets(len(f))
    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[i + 1:] ^ f[i]) <= bits):
            sets.join(i, i + 1 + int(j))
    least = {}
    for k in range(len(f)):
        if ids[k] is not None:
            r = sets.find(k)
            least[r] = min(least.get(r, ids[k]), ids[k])
    return [least.get(sets.find(k)) for k in range(len(f))]


def test_simhash_whole_table(spark, con):
    rows = con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()
    fps = [naive_fingerprint(t) for _, t in rows]
    want = {i: (f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, naive_components(fps, [i for i, _ in rows]))}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in registry.op5_simhash(spark, SF01).collect()}
    assert got == want


def test_matches_around_random_fingerprints(spark):
    """All pairs within 3 bits and no others, each once, also when both halves are near."""
    rng = random.Random(9)
    fps = set()
    for _ in range(60):
        f = rng.getrandbits(64)
        fps.add(f)
        for _ in range(6):
            g = f
            for b in rng.sample(range(64), rng.randrange(1, 6)):
                g ^= 1 << b
            fps.add(g)
    fps = sorted(fps)
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp bigint")
    got = sorted(tuple(sorted((r["a"], r["b"]))) for r in simhash._matches(df, 3).collect())
    signed = [simhash._signed(f) for f in fps]
    want = sorted(tuple(sorted((signed[i], signed[j]))) for i in range(len(fps)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 3)
    assert got == want


def test_simhash_odd_rows(odd, clashing, empty):
    rows = simhash.simhash_digest(odd).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[2]["fingerprint"] == "0" * 16 and by[2]["component_id"] == by[3]["component_id"] == by[4]["component_id"] == 2
    kept = simhash.keep_one_each(clashing)
    assert kept.columns == clashing.columns
    ids = sorted((r["doc_id"] for r in kept.select("doc_id").collect()), key=str)
    assert ids.count(1) == 1 and 2 in ids and 3 not in ids and 4 not in ids and None in ids
    assert simhash.simhash_digest(empty).count() == 0 and simhash.keep_one_each(empty).count() == 0


# --- lines ---

def line_shingles(x):
    """All runs of characters; a shorter line is one."""
    n = line_dedup.SHINGLE
    return frozenset(x[i:i + n] for i in range(max(1, len(x) - n + 1)))


def naive_line_classes(lines, at_least=0.8):
    shingles = [line_shingles(x) for x in lines]
    holders = {}
    sets = Sets(len(lines))
    links = 0
    for i, s in enumerate(shingles):
        near = {}
        for x in s:
            for j in holders.get(x, ()):
                near[j] = near.get(j, 0) + 1
        for j, both in near.items():
            if both >= at_least * (len(s) + len(shingles[j]) - both):
                sets.join(i, j)
                links += 1
        for x in s:
            holders.setdefault(x, []).append(i)
    return [sets.find(i) for i in range(len(lines))], links


def test_line_classes_whole_table(spark, documents, con):
    rows = line_dedup.line_classes(documents).collect()
    lines = sorted({x for (t,) in con.execute("SELECT text FROM documents WHERE text IS NOT NULL").fetchall()
                    for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)})
    import hashlib
    classes, links = naive_line_classes(lines)
    at = {hashlib.md5(x.encode()).digest(): k for k, x in enumerate(lines)}
    assert links > 50
    found = {}
    for r in rows:
        found.setdefault(bytes(r["component"]), set()).add(classes[at[bytes(r["digest"])]])
    assert all(len(c) == 1 for c in found.values())  # no two classes were merged
    assert len(found) <= len(set(classes)) * 1.001   # high recall: hardly a link was lost
    # One line of each class is kept: the first.
    first = {}
    for r in rows:
        c = bytes(r["component"])
        first[c] = min(first.get(c, (r["doc_id"], r["line_no"])), (r["doc_id"], r["line_no"]))
    assert all(r["kept"] == ((r["doc_id"], r["line_no"]) == first[bytes(r["component"])]) for r in rows)


def test_line_bands_recall(spark):
    """Lines changed in places up to the threshold are found again; strangers are not."""
    rng = random.Random(3)
    syllables = ["ka", "ro", "mi", "ten", "sul", "var", "ne", "lo", "pri", "dan", "ge", "hu"]

    def line(n):
        return " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(n))
    base = [line(rng.choice([4, 8, 12, 20, 40, 120])) for _ in range(150)]
    rows, pairs = [], []
    for k, b in enumerate(base):
        w = b.split()
        if len(w) >= 8:
            for q in rng.sample(range(len(w)), max(1, len(w) // 40)):
                w[q] = line(1)
        rows += [(2 * k, b), (2 * k + 1, " ".join(w))]
        a, c = line_shingles(b), line_shingles(" ".join(w))
        if len(a & c) >= 0.8 * len(a | c):
            pairs.append(k)
    got = {r["doc_id"]: bytes(r["component"]) for r in line_dedup.line_classes(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    hit = sum(got[2 * k] == got[2 * k + 1] for k in pairs)
    assert len(pairs) > 80 and hit / len(pairs) > 0.97


def test_line_dedup_odd_rows(spark, odd, clashing, empty):
    out = line_dedup.dedup_lines(clashing)
    assert out.columns == clashing.columns and out.count() == clashing.count()
    text = {(r["doc_id"], r["n_chars"]): r["text"] for r in out.select("doc_id", "text", "n_chars").collect()}
    assert text[(2, None)] is None and text[(3, 0)] == "" and text[(4, 6)] == "   \n\t\n "
    assert text[(6, 15)] == "Über 12 Zeilen."  # its first line is that of document 1
    assert line_dedup.dedup_lines(empty).count() == 0 and line_dedup.lines_digest(empty).count() == 0
    two = spark.createDataFrame([(1, "same line here\nother one", 5), (1, "quite different\nsame line here", 6), (0, "other one\n\n", 7)],
                                "doc_id bigint, text string, n bigint")
    assert {r["n"]: r["text"] for r in line_dedup.dedup_lines(two).collect()} == {5: "same line here", 6: "quite different", 7: "other one\n\n"}


# --- decontamination ---

def edit_distance_to_passage(item, text):
    """Plain Sellers' programme, one cell at a time."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_passage_distance():
    rng = np.random.default_rng(2)
    for _ in range(300):
        item, text = rng.integers(1, 5, rng.integers(1, 9)), rng.integers(0, 5, rng.integers(0, 20))
        d, a, b = decontaminate.passage_distance(item, text)
        assert d == edit_distance_to_passage(item.tolist(), text.tolist())
        assert 0 <= a <= b <= len(text) and edit_distance_to_passage(item.tolist(), text[a:b].tolist()) == d


def test_leaks_whole_table(spark, con):
    """Against a brute force: all documents with an exact passage, and no document beyond the distance."""
    docs = dict(con.execute("SELECT doc_id, text FROM documents").fetchall())
    items = dict(con.execute("SELECT item_id, text FROM benchmark").fetchall())
    got = {(r["doc_id"], r["item_id"]): r for r in registry.op10_decontaminate(spark, SF01).collect()}
    norm = {i: " " + " ".join(decontaminate.words_of(t)) + " " for i, t in docs.items()}
    exact = {(i, k) for k, t in items.items() for i, d in norm.items() if " " + " ".join(decontaminate.words_of(t)) + " " in d}
    assert exact and exact <= set(got)
    for (i, k), r in got.items():
        item = decontaminate.words_of(items[k])
        passage = decontaminate.words_of(docs[i].lower()[r["start"]:r["end"]])
        assert edit_distance_to_passage(item, passage) == r["n_edits"] <= decontaminate.MAX_EDITS * len(item)
    # Every pair of a document and an item of which a good part occurs is measured outright.
    for k, t in list(items.items())[:12]:
        item = decontaminate.words_of(t)
        for i in list(docs)[:250]:
            text = decontaminate.words_of(docs[i])
            if len(set(item) & set(text)) >= 0.8 * len(set(item)):
                near = edit_distance_to_passage(item, text) <= int(decontaminate.MAX_EDITS * len(item))
                assert ((i, k) in got) == near


def test_recall_of_edited_passages(con):
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    texts = [decontaminate.words_of(t) for (t,) in con.execute("SELECT text FROM documents ORDER BY doc_id LIMIT 200").fetchall()]
    index = decontaminate.Index(items)
    rng = random.Random(1)
    for share, least in ((0.0, 1.0), (0.05, 0.97), (0.1, 0.95), (0.2, 0.9)):
        hits = tried = 0
        for _ in range(150):
            k = rng.randrange(len(index.items))
            own = decontaminate.words_of(dict(items)[index.item_ids[k][0]])
            v = list(own)
            for _ in range(int(share * len(own))):
                p, op = rng.randrange(len(v)), rng.randrange(3)
                if op == 0:
                    v[p] = "zzz"
                elif op == 1:
                    del v[p]
                else:
                    v.insert(p, "and")
            host = rng.choice(texts)
            p = rng.randrange(len(host) + 1)
            tried += 1
            hits += k in index.search([index.encode(host[:p] + v + host[p:]), index.encode(host)])[0]
        assert hits / tried >= least, (share, hits / tried)


def test_leaks_odd_rows(spark, odd, clashing, empty):
    bench = spark.createDataFrame([(10, "the cat sat on the mat and looked at the dog"), (11, "The CAT, sat on the mat and looked at the dog!"),
                                   (12, None), (13, ""), (14, "too short"), (15, "nothing like this is to be found in any row")],
                                  "item_id bigint, text string")
    found = decontaminate.find_leaks(clashing, bench)
    pairs = sorted((r["doc_id"], r["item_id"]) for r in found.collect())
    assert pairs == [(1, 10), (1, 10), (1, 11), (1, 11), (6, 10), (6, 11)]
    blocks = decontaminate.find_leaks(odd, bench, block_words=12)  # the items in several blocks
    assert sorted((r["doc_id"], r["item_id"]) for r in blocks.collect()) == pairs
    left = decontaminate.drop_contaminated(clashing, bench)
    assert left.columns == clashing.columns and left.count() == odd.count() - 3
    assert decontaminate.find_leaks(empty, bench).count() == 0
    assert decontaminate.find_leaks(odd, bench.limit(0)).count() == 0


# --- pipeline ---

def test_pipeline_against_brute_force(spark, documents, con):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "simhash", "decontaminate", "mix"]
    got = corpus_pipeline.run(spark, SF01)
    assert got.columns == documents.columns + ["copy"]
    rows = sorted(tuple(r) for r in got.collect())

    filters = language.learn(documents, ~language.held_out(F.col("doc_id")))
    accepted = {r["doc_id"] for r in language.predict(documents, filters).filter(language.accepted()).select("doc_id").collect()}
    docs = [list(r) for r in con.execute("SELECT doc_id, text, lang, source, n_chars FROM documents ORDER BY doc_id").fetchall()
            if r[0] in accepted]
    # Lines: classes over all distinct lines, the first occurrence stays.
    blank = re.compile(r"[^\x20\x09-\x0D]")
    lines = sorted({x for d in docs for x in d[1].split("\n") if blank.search(x)})
    classes, _ = naive_line_classes(lines)
    cls = dict(zip(lines, classes))
    seen = set()
    for d in docs:
        stay = []
        for x in d[1].split("\n"):
            if blank.search(x):
                if cls[x] in seen:
                    continue
                seen.add(cls[x])
            stay.append(x)
        text = "\n".join(stay)
        if text != d[1]:
            d[1], d[4] = text, len(text)
    comp = naive_components([naive_fingerprint(d[1]) for d in docs], [d[0] for d in docs])
    docs = [d for d, c in zip(docs, comp) if d[0] == c]
    items = [" " + " ".join(decontaminate.words_of(t)) + " " for (t,) in con.execute("SELECT text FROM benchmark").fetchall()]
    docs = [d for d in docs if not any(i in " " + " ".join(decontaminate.words_of(d[1])) + " " for i in items)]
    frame = spark.createDataFrame([tuple(d) for d in docs], documents.schema)
    copies = {r["doc_id"]: r["mix_copies"] for r in mixing.mix_plan(frame).select("doc_id", "mix_copies").collect()}
    want = sorted((*d, k) for d in docs for k in range(1, copies[d[0]] + 1))
    assert rows == want


def test_stages_handle_odd_rows(spark, odd, empty, tmp_path):
    spark.createDataFrame([(1, "nothing of the kind occurs in those rows at all")], "item_id bigint, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    for docs in (odd, empty):
        now = docs
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, str(tmp_path))
            assert now.columns[:5] == docs.columns
        assert now.count() >= 0
