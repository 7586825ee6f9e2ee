"""Decontamination: short items, scripts without spaces, places in the text itself, size of the index."""

import pickle
import random

from pyspark.sql import types as T

from starling.llm import decontaminate

ITEM = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])

ITEMS = [
    (1, "Blue whale"), (2, "what now?"), (3, "seven"), (4, "one two three four"), (5, "日本の首都はどこですか"), (6, "答案是什么"),
    (7, "Which river runs through the middle of the old capital city"), (8, "..."), (9, None), (10, "blue WHALE"), (11, "ไทย"),
]
DOCS = [
    (1, "They saw a blue whale, and later a blue  whale again."), (2, "Bluewhale. Blue-whale! What, now"), (3, "nothing here"),
    (4, "We asked: 日本の首都はどこですか? Nobody knew."), (5, "他问答案是什麼呢"), (6, "他问答案是什么呢"),
    (7, "İİİ one two three four İ five"), (8, "which river runs thru the middle of the old capital city"), (9, None), (10, ""),
    (11, "seventeen, seventy"), (12, "ภาษาไทยง่าย"), (13, "one two three"),
]


def found(spark, docs=DOCS, **more):
    rows = decontaminate.find_leaks(spark.createDataFrame(docs, DOC), spark.createDataFrame(ITEMS, ITEM), **more).collect()
    return {(r["doc_id"], r["item_id"]): (r["n_edits"], r["start"], r["end"]) for r in rows}


def naive_short(docs):
    out = {}
    for i, t in ITEMS:
        want = decontaminate.words_of(t)
        for d, text in docs:
            words = decontaminate.words_of(text)
            at = [k for k in range(len(words)) if want and words[k:k + len(want)] == want]
            if at and len(want) < decontaminate.MIN_WORDS:
                places = decontaminate.word_places(text)
                out[d, i] = (0, places[at[0]][0], places[at[0] + len(want) - 1][1])
    return out


def test_short_items_and_unspaced_scripts(spark):
    got = found(spark)
    short = naive_short(DOCS)
    assert {k: v for k, v in got.items() if k in short} == short
    assert set(got) - set(short) == {(4, 5), (6, 6), (5, 6), (8, 7)}
    assert got[4, 5][0] == got[6, 6][0] == 0
    assert got[5, 6][0] == 1  # one character changed of five
    assert got[8, 7][0] == 1
    d = dict(DOCS)
    assert d[4][got[4, 5][1]:got[4, 5][2]] == "日本の首都はどこですか"
    assert d[1][got[1, 1][1]:got[1, 1][2]] == "blue whale"
    # A letter whose lower case is two characters does not move the places behind it.
    assert d[7][got[7, 4][1]:got[7, 4][2]] == "one two three four"


def test_blocks_and_random_short_items(spark):
    """Many short items, in several blocks, over random texts: as a plain search finds them."""
    assert found(spark, block_words=6) == found(spark)
    rng = random.Random(5)
    words = ["blue", "whale", "seven", "what", "now", "one", "two", "three", "four", "x"]
    docs = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for k in range(300)]
    got = found(spark, docs)
    assert {k: v for k, v in got.items() if k[1] != 7} == naive_short(docs)


def test_documents_stay_when_they_hold_short_items_only(spark):
    docs = spark.createDataFrame([(d, t, d) for d, t in DOCS], T.StructType([*DOC.fields, T.StructField("__leak", T.LongType())]))
    left = decontaminate.drop_contaminated(docs, spark.createDataFrame(ITEMS, ITEM))
    assert left.columns == docs.columns
    rows = {r["doc_id"]: r["__leak"] for r in left.collect()}
    assert rows == {d: d for d, _ in DOCS if d not in (4, 5, 6, 8)}


def test_index_is_small():
    """Bytes of the index for each word of its items, so a block of BLOCK_WORDS fits well under 300 MB."""
    rng = random.Random(6)
    items = [(k, " ".join(f"w{rng.randrange(20_000)}" for _ in range(rng.randint(16, 60)))) for k in range(1000)]
    n = sum(len(t.split()) for _, t in items)
    size = len(pickle.dumps(decontaminate.Index(items)))
    assert size / n * decontaminate.BLOCK_WORDS < 200e6


def test_recall_when_edits_are_words_of_no_item():
    """Passages with a fifth of their words edited, mostly by words that no item has, by item length."""
    rng = random.Random(9)
    common = [f"v{k}" for k in range(3000)]
    items = [(n, [rng.choice(common) for _ in range(n)]) for n in (5, 7, 10, 12, 16, 24, 40) for _ in range(150)]
    index = decontaminate.Index([(k, " ".join(w)) for k, (_, w) in enumerate(items)])
    texts = []
    for _, words in items:
        words = list(words)
        for _ in range(len(words) // 5):
            at, how = rng.randrange(len(words)), rng.random()
            new = f"other{rng.randrange(10 ** 6)}" if rng.random() < 0.7 else rng.choice(common)
            words[at:at + (how < 0.75)] = [] if how >= 0.9 else [new]
        around = [[f"near{rng.randrange(9999)}" for _ in range(rng.randrange(60))] for _ in range(2)]
        texts.append(index.encode(around[0] + words + around[1]))
    hits: dict[int, list[bool]] = {}
    for k, ((n, _), got) in enumerate(zip(items, index.search(texts))):
        hits.setdefault(n, []).append(any(k in index.item_ids[i] for i in got))
    recall = {n: sum(v) / len(v) for n, v in hits.items()}
    assert min(recall.values()) >= 0.95, recall
