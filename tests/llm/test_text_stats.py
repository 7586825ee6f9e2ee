"""Mixing (op6), token counts (op7) and quality rules (op8)."""

import re

import pytest
from pyspark.sql import functions as F

from starling.llm import mixing, quality_rules, registry, tokens

from llm_helpers import SF01, clashing, con, documents, empty, odd, same_as_oracle  # noqa: F401


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_mix_matches_oracle(spark, con):
    same_as_oracle(registry.op6_mix_sources(spark, SF01), con, registry.ORACLE["op6_mix_sources"])


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    left, target, free = float(sum(sizes.values())), {}, list(names)
    while free:
        share = left / sum(weight[s] for s in free)
        over = [s for s in free if share * weight[s] >= 3 * sizes[s]]
        if not over:
            target.update({s: share * weight[s] for s in free})
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            free.remove(s)
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 10, "c": 10}, {"a": 1000, "b": 1, "c": 2, None: 5}, {"x": 0, "y": 7}, {"only": 4},
    {f"s{k}": (k * 37) % 11 * (k % 3) for k in range(20)}, {"a": 1, "b": 1, "c": 100000, "d": 3}])
def test_targets_by_resharing(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size bigint")
    got = {r["source"]: (r["source_size"], r["target"]) for r in mixing.source_targets(df).collect()}
    want = brute_targets(sizes)
    assert {s: n for s, (n, _) in got.items()} == sizes
    for s, t in want.items():
        assert got[s][1] == pytest.approx(t)


def test_mix_odd_rows(odd, clashing, empty):
    rows = mixing.mix_digest(odd).collect()
    assert len(rows) == odd.count()
    sizes = {r["doc_id"]: r["size"] for r in rows}
    assert sizes[2] == sizes[3] == sizes[4] == 0 and sizes[5] == 60_000
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    assert rows == mixing.mix_digest(odd).collect()
    assert sorted(map(tuple, mixing.mix_digest(clashing).collect()), key=str) == sorted(map(tuple, rows), key=str)
    mixed = mixing.mix(clashing)
    assert mixed.columns == [c for c in clashing.columns if c != "copy"] + ["copy"]
    assert mixing.mix_digest(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_mix_repeats_match_the_plan(documents):
    plan = mixing.mix_plan(documents)
    taken = {r["doc_id"]: r["n"] for r in mixing.mix(documents).groupBy("doc_id").agg(F.max("copy").alias("n")).collect()}
    for r in plan.select("doc_id", "mix_copies", "mix_size", "mix_source_size", "mix_target").collect():
        assert taken.get(r["doc_id"], 0) == r["mix_copies"]
        rate = r["mix_target"] / r["mix_source_size"]
        assert int(rate) <= r["mix_copies"] <= int(rate) + 1
    # The taken words of a source are within five standard deviations of its target.
    rate = F.col("mix_target") / F.col("mix_source_size")
    part = rate - F.floor(rate)
    near = plan.groupBy("source").agg(F.sum(F.col("mix_copies") * F.col("mix_size")).alias("t"), F.max("mix_target").alias("w"),
                                      F.sum(F.col("mix_size") * F.col("mix_size") * part * (1 - part)).alias("v")).collect()
    assert all(abs(r["t"] - r["w"]) < 5 * r["v"] ** 0.5 + 1 for r in near)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokens.tokenizer_path())


TRICKY = ["", "  lead", "Don't we'll I'VE they'd", "a.b, c,d. e.", "naïve Ångström é İstanbul ΣΑΣ", "x<|endoftext|>y <|ENDOFTEXT|> <|startoftext|>",
          "tabs\tand\x0bvertical\x0cfeeds\r\n", "no break　wide line", "日本語のテキスト 漢字", "\x1c\x1d odd \x85 nel", "🙂🙂 ok!!!###",
          "1234567890 12.5%", "AAA.BBB,", "a" * 3000, "'s 't 'm", "end. . , .,"]


def test_piece_sums_equal_the_library(library):
    counter = tokens.PieceCounter(tokens.tokenizer_path(), most=5)  # the memo starts anew all the time
    for at in range(0, len(TRICKY), 3):
        part = TRICKY[at:at + 3]
        assert counter.count(part) == [len(e.ids) for e in library.encode_batch(part, add_special_tokens=False)]


def test_token_counts_whole_table(spark, con, library):
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in registry.op7_token_counts(spark, SF01).collect()}
    rows = con.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall()
    want = [len(e.ids) for e in library.encode_batch([t for _, t in rows], add_special_tokens=False)]
    assert got == {i: (len(t.encode()), n, n > 2048) for (i, t), n in zip(rows, want)}


def test_cache_hits_and_misses(spark, odd, clashing, empty, library):
    cache = tokens.fresh_cache_path(spark)
    first = sorted(map(tuple, tokens.count_tokens(odd, cache).collect()), key=str)
    assert len(first) == odd.count()
    stored = spark.read.parquet(cache).count()
    assert stored == 7  # null and empty are one text, as are the repeated rows
    assert sorted(map(tuple, tokens.count_tokens(clashing, cache).collect()), key=str) == first
    assert spark.read.parquet(cache).count() == stored  # nothing was encoded again
    more = odd.withColumn("text", F.concat(F.col("text"), F.lit(" again")))
    tokens.count_tokens(more, cache).collect()
    assert spark.read.parquet(cache).count() > stored
    # A stored count is believed: that is what the join is for.
    assert tokens.count_tokens(empty, cache).count() == 0
    spaced = spark.createDataFrame([(1, "a  b\n\nc"), (2, "a b c")], "doc_id bigint, text string")
    cache2 = tokens.fresh_cache_path(spark)
    assert [r["n_tokens"] for r in tokens.count_tokens(spaced, cache2).orderBy("doc_id").collect()] == [3, 3]
    assert spark.read.parquet(cache2).count() == 1


def test_rules_match_oracle(spark, con):
    same_as_oracle(registry.op8_quality_rules(spark, SF01), con, registry.ORACLE["op8_quality_rules"])


def brute_repeats(w):
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i:i + 8]), []).append(i)
    return len({p for at in seen.values() if len(at) > 1 for i in at for p in range(i, i + 8)})


def test_rule_statistics(spark):
    texts = ["", "one", "a b c d e f g h " * 3, "a b c d e f g h i a b c d e f g h", "x " * 40, "# * $ % & | < >\nline\nline\n\nline \nline",
             " ".join(map(str, range(50))), "p q r s t u v w x p q r s t u v w y p q r s t u v w"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in quality_rules.statistics(df).collect():
        t = texts[r["doc_id"]]
        w = words(t)
        lines = [x for x in t.split("\n") if words(x)]
        assert r["n_words"] == len(w) and r["word_chars"] == sum(map(len, w))
        assert r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", t))
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_repeat_words"] == brute_repeats(w), t


def test_rules_odd_rows(odd, clashing, empty):
    rows = {r["doc_id"]: r for r in quality_rules.rules_digest(odd).collect()}
    assert rows[2]["base_failed"] and rows[3]["base_failed"] and not rows[2]["kept"]
    assert quality_rules.rules_digest(clashing).count() == odd.count()
    assert quality_rules.rules_digest(empty).count() == 0


def test_rules_follow_the_labels(spark, con):
    kept = {r["doc_id"]: r["kept"] for r in registry.op8_quality_rules(spark, SF01).select("doc_id", "kept").collect()}
    good = [kept[i] for i, in con.execute("SELECT l.doc_id FROM labels l JOIN documents d USING (doc_id) WHERE quality = 1").fetchall()]
    bad = [kept[i] for i, in con.execute("SELECT l.doc_id FROM labels l JOIN documents d USING (doc_id) WHERE quality = 0").fetchall()]
    assert sum(good) / len(good) > 0.9
    assert sum(bad) / len(bad) < 0.5
