"""Quality classifier (op1), language identification (op2) and personal data (op4)."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starling.llm import char_crf, language, pii, quality_fm, registry

from llm_helpers import SF01, clashing, con, documents, empty, odd  # noqa: F401


def test_pair_sum_identity():
    rng = np.random.default_rng(1)
    m = quality_fm.Machine(0.3, rng.normal(size=quality_fm.N_FEATURES), rng.normal(size=(quality_fm.N_FEATURES, 4)),
                           np.zeros(len(quality_fm.STATS)), np.ones(len(quality_fm.STATS)))
    data = np.frombuffer(b"One two three, two. One!\nfour five FIVE", np.uint8)
    f = quality_fm.features(data, np.array([0, len(data)]), np.array([np.nan]))
    x = np.zeros(quality_fm.N_FEATURES)
    x[f[1]] = f[2]
    x[quality_fm.BUCKETS:] = m.scaled(f[3])[0]
    on = np.flatnonzero(x)
    pairs = sum(m.pairs[i] @ m.pairs[j] * x[i] * x[j] for a, i in enumerate(on) for j in on[a + 1:])
    assert m.logits(*f)[0] == pytest.approx(m.bias + m.linear @ x + pairs)


def test_features_do_not_depend_on_blocks():
    texts = [b"", b"alpha beta", b" gamma\n\ndelta delta\n", b"\n", b"end."]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    whole = quality_fm.features(np.frombuffer(b"".join(texts), np.uint8), offsets, np.full(5, np.nan))
    for k, t in enumerate(texts):
        one = quality_fm.features(np.frombuffer(t, np.uint8), np.array([0, len(t)]), np.array([np.nan]))
        a, b = whole[0][k], whole[0][k + 1]
        assert list(whole[1][a:b]) == list(one[1]) and np.allclose(whole[2][a:b], one[2]) and np.allclose(whole[3][k], one[3][0])


def test_quality_held_out(spark, con):
    got = {r["doc_id"]: r for r in registry.op1_quality_fm(spark, SF01).collect()}
    assert len(got) == con.execute("SELECT count(*) FROM documents").fetchone()[0]
    labels = con.execute("SELECT l.doc_id, quality FROM labels l JOIN documents d USING (doc_id)").fetchall()
    held = [(got[i]["predicted"], q) for i, q in labels if got[i]["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    assert sum(p == q for p, q in held) / len(held) > 0.93


def test_quality_odd_rows(spark, odd, clashing, empty):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (5, 0, 0), (6, 1, 0), (None, 1, 0), (2, None, 0)],
                                   "doc_id bigint, quality int, toxic int")
    for docs in (odd, clashing, odd.drop("n_chars")):
        rows = quality_fm.quality_digest(docs, labels).collect()
        assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["score"] == 0.5 for r in quality_fm.quality_digest(odd, labels.limit(0)).collect())
    assert quality_fm.quality_digest(empty, labels).count() == 0


def test_filters_have_no_false_negative():
    grams = np.arange(1000, 60000, 7, dtype=np.uint32) * np.uint32(2654435761)
    masks = (np.arange(len(grams)) % 7 + 1).astype(np.uint64)
    f = language.LanguageFilters.build(["a", "b", "c"], grams, masks)
    found = f.lookup(grams)
    assert np.array_equal(found & masks.astype(found.dtype), masks.astype(found.dtype))
    strange = f.lookup(np.arange(1, 40000, 3, dtype=np.uint32) * np.uint32(40503) + np.uint32(5))
    rate = np.array([((strange >> j) & 1).mean() for j in range(3)])
    assert np.allclose(rate, f.false_positive(), atol=0.02)


def test_language_held_out(spark, con):
    got = {r["doc_id"]: r for r in registry.op2_language_id(spark, SF01).collect()}
    rows = con.execute("SELECT doc_id, lang FROM documents").fetchall()
    held = [got[i]["lang_pred"] == lang for i, lang in rows if got[i]["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert sum(held) / len(held) > 0.98


def test_language_odd_rows(odd, clashing, empty):
    for docs in (odd, clashing):
        rows = language.language_digest(docs).collect()
        assert len(rows) == odd.count()
        for r in rows:
            if r["doc_id"] in (2, 3, 4, 7):
                assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            else:
                assert r["lang_pred"] in ("en", "de") and 0 <= r["score"] <= 1
    assert language.language_digest(empty).count() == 0
    nobody = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.language_digest(nobody).collect()} == {"und"}


def test_language_passes_columns(clashing):
    filters = language.learn(clashing, F.lit(True))
    out = language.predict(clashing, filters)
    assert out.columns == [c for c in clashing.columns if c != "lang_pred"] + ["lang_pred", "lang_score"]
    assert out.count() == clashing.count()


# --- personal data ---

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def naive_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), pii.KINDS.index(kind), m.end()))
    return sorted(out)


TRICKY = ["a@b.c@d.e", "x.y+z@mail-1.example.com.", "@@a@b", "a@b", "no@dots-here", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.1", "1.2.3.4",
          "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111 1111 1111", "+1 (988) 555-2485", "+12345", "++1 234 567 8901", "+1-2",
          "é 10.0.0.1 ü +49 30 1234567 ß a@b.de", "1" * 30, "0000.0000.0001.0255", "+1 234 567 8901 4111111111111111", "a" * 500 + "@b.cd",
          "1..2.3.4 5.6.7.8", "12.34.56", "mail a@b.c-d.e f@g.h,i@j.k", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7"]


def test_base_spans_equal_the_patterns(con):
    for t in TRICKY:
        assert pii.base_spans(t) == naive_spans(t), t
    rng = np.random.default_rng(0)
    for _ in range(3000):
        t = "".join(rng.choice(list("ab1 2.3-4@+(5)%é"), int(rng.integers(1, 60))))
        assert pii.base_spans(t) == naive_spans(t), t
    for (t,) in con.execute("SELECT text FROM documents WHERE text IS NOT NULL").fetchall():
        assert pii.base_spans(t) == naive_spans(t)


@pytest.fixture(scope="module")
def tagger(spark, documents):
    return pii.learn(documents)


def test_crf_decode_is_the_best_path(tagger):
    rng = np.random.default_rng(4)
    e = rng.normal(0, 2, (4, 6, 9)).astype(np.float32)
    tags = tagger.decode(e)
    import itertools
    for b in range(6):
        def score(path):
            s = tagger.first[path[0]] + e[0, b, path[0]]
            return s + sum(tagger.moves[p, q] + e[t, b, q] for t, (p, q) in enumerate(zip(path, path[1:]), 1))
        best = max(itertools.product(range(9), repeat=4), key=score)
        assert score(tuple(tags[:, b])) == pytest.approx(score(best), abs=1e-3)


def test_bound_never_drops_a_tagged_window(tagger, con):
    text = "\n".join(t for (t,) in con.execute("SELECT text FROM documents ORDER BY doc_id LIMIT 300").fetchall())
    coded = char_crf.classes_of(text)
    x = np.ascontiguousarray(coded[:len(coded) // 256 * 256].reshape(-1, 256).T)
    e = tagger.emissions(x)
    live = tagger.may_tag(e)
    assert live.mean() < 0.6
    assert not tagger.decode(np.ascontiguousarray(e[:, ~live])).any()


def test_tagger_finds_written_out_forms(tagger):
    """Fresh spans of every kind in plain prose: the tagger adds most of those the patterns miss."""
    rng = np.random.default_rng(77)
    texts, want = [], []
    for k in range(240):
        put = pii._written_out(k % 4, rng)
        texts.append(f"As was said on the day before, {put} is what they gave, and nobody asked for more of it.")
        want.append((k % 4, 31, 31 + len(put)))
    hit = [any(s[1] == k and s[0] < b and s[2] > a for s in found[1]) for (k, a, b), found in zip(want, pii.find_spans(tagger, texts))]
    assert sum(hit) / len(hit) > 0.8


def test_windows_do_not_change_spans(tagger):
    """A span at any place of a long text, over window seams, is found once."""
    filler = "plain words go on and on, "
    put = "+1 (415) 555-2671 and 10.20.30.40"
    for lead in range(880, 1010, 13):
        text = (filler * 50)[:lead] + " " + put + " " + filler * 60
        every = pii.find_spans(tagger, [text])[0][1]
        assert len(every) == len(set(every))
        assert all(b <= c for (_, _, b), (c, _, _) in zip(every, every[1:]))
        assert [s for s in every if s[0] > lead][:2] == pii.base_spans(text)[:2]


def test_pii_whole_table(spark, con):
    got = {r["doc_id"]: r for r in registry.op4_pii(spark, SF01).collect()}
    rows = con.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall()
    assert len(got) == len(rows)
    for i, t in rows:
        base = naive_spans(t)
        text = pii.spans_text(base)
        r = got[i]
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == j for s in base) for j in range(4)]
        every = [x for x in r["spans"].split(",") if x]
        assert set(x for x in text.split(",") if x) <= set(every)
        assert every == sorted(every, key=lambda x: (int(x.split(":")[1]), pii.KINDS.index(x.split(":")[0])))


def test_pii_odd_rows(odd, clashing, empty, tagger):
    assert pii.tag_documents(odd, tagger).count() == odd.count()
    rows = {r["doc_id"]: r["spans"] for r in pii.tag_documents(clashing, tagger).collect()}
    assert rows[2] == rows[3] == rows[4] == []
    assert pii.pii_digest(empty).count() == 0
