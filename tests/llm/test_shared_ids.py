"""Filtering stages tell documents that share an id, or have none, by their texts (op5, op10, pipeline)."""

from starling.llm import decontaminate, simhash

from llm_helpers import DOC_SCHEMA

BASE = " ".join(f"token{k * 7919 % 1009} of" for k in range(400))
OTHER = " ".join(f"quite{k * 104729 % 1013} unlike" for k in range(400))
THIRD = " ".join(f"third{k * 15485863 % 1019} kind" for k in range(400))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOC_SCHEMA)


def near(text):
    """A text other than ``text`` with a fingerprint within the distance."""
    for k in range(2000):
        other = f"{text} end{k}"
        if bin(simhash.fingerprint(other) ^ simhash.fingerprint(text)).count("1") <= simhash.BITS:
            return other
    raise AssertionError("no near copy")


def left(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()), key=str)


def test_simhash_keeps_one_of_each_group(spark):
    base2, other2 = near(BASE), near(OTHER)
    rows = [(1, BASE), (None, base2), (None, BASE),      # group of document 1
            (None, OTHER), (None, OTHER), (None, other2),   # group without an id: one text stays
            (1, THIRD), (0, near(THIRD)),                   # document 1's second text belongs to document 0
            (5, ""), (5, None)]                             # one id, an empty and a null text: one group
    docs = frame(spark, rows)
    kept = left(simhash.keep_one_each(docs))
    assert len(kept) == 4
    assert (1, BASE) in kept and (0, near(THIRD)) in kept and (1, THIRD) not in kept
    assert sum(i is None for i, _ in kept) == 1 and [t for i, t in kept if i is None][0] in (OTHER, other2)
    assert sum(i == 5 for i, _ in kept) == 1
    # The components' names are as they were: the least id, null only if there is none.
    names = sorted(((r["doc_id"], r["component_id"]) for r in simhash.simhash_digest(docs).select("doc_id", "component_id").collect()), key=str)
    assert names == sorted([(1, 1), (None, 1), (None, 1), (None, None), (None, None), (None, None), (1, 0), (0, 0), (5, 5), (5, 5)], key=str)


def test_decontamination_keeps_clean_texts_of_shared_ids(spark):
    item = "the question that is asked here has one single answer and no more"
    bench = spark.createDataFrame([(10, item)], "item_id bigint, text string")
    rows = [(None, f"before {item} after"), (None, "a clean text without an id"), (None, None),
            (7, f"{item} again"), (7, "a clean text of the same id"), (7, ""), (8, "another clean one")]
    clean = sorted([(i, t) for i, t in rows if item not in (t or "")], key=str)
    assert left(decontaminate.drop_contaminated(frame(spark, rows), bench)) == clean
