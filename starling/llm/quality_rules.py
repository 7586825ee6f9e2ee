"""Quality rules by weak supervision, in DataFrame functions only.

Rules look at one text each and vote good (1), bad (-1) or abstain (0).  No rule
decides alone: expectation-maximisation over the counts of vote patterns
estimates how often each rule is right and how common good texts are, and a
document is kept when its posterior probability of being good is at least
``KEEP_AT`` and it passes the base checks (enough words, not mostly repeats).

Cost: one pass over the texts writes a narrow row of statistics and votes per
document; the model is fitted on the table of distinct vote patterns (at most
3 ** number of rules rows, whatever the corpus) inside one expression; a second
pass over the narrow rows attaches the posterior.  There is no shuffle of texts.

Windows of eight words are compared by 64-bit hash.

Defined cases: null and empty texts have no words and fail the base check; rows
repeated keep one output row each; an empty table gives an empty result; columns
other than doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
EM_STEPS = 10
START_GOOD = 0.8
START_RIGHT = 0.8
RIGHT_RANGE = (0.5, 0.995)
KEEP_AT = 0.5

#: name: (value, good when, bad when) over the statistics; SQL text that Spark and an oracle both read.
#: ``value`` null or neither condition: the rule abstains.
RULES: dict[str, tuple[str, str, str]] = {
    "length": ("n_words * 1.0E0", ">= 50", "< 20"),
    "word_length": ("word_chars * 1.0E0 / nullif(n_words, 0)", "between 2.5E0 and 12E0", "> 16E0"),
    "symbols": ("n_symbols * 1.0E0 / nullif(n_words, 0)", "<= 0.1E0", "> 0.3E0"),
    "line_repeats": ("case when n_lines >= 3 then n_dup_lines * 1.0E0 / n_lines end", "<= 0.1E0", "> 0.3E0"),
    "passage_repeats": ("n_repeat_words * 1.0E0 / nullif(n_words, 0)", "<= 0.1E0", "> 0.25E0"),
    "shouting": ("n_upper * 1.0E0 / nullif(word_chars, 0)", "<= 0.15E0", "> 0.4E0"),
    "exclamations": ("n_exclaim * 1.0E0 / nullif(n_words, 0)", "<= 0.05E0", "> 0.3E0"),
    "line_ends": ("n_ended_lines * 1.0E0 / nullif(n_lines, 0)", ">= 0.5E0", "< 0.1E0"),
    "vocabulary": ("case when n_words >= 50 then n_distinct_words * 1.0E0 / n_words end", ">= 0.2E0", "< 0.1E0"),
}

STATS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_exclaim",
         "n_ended_lines", "n_distinct_words")


def _kept_length(text: Column, drop: str) -> Column:
    """Characters of a text that the class ``drop`` leaves."""
    return F.length(F.regexp_replace(text, drop, "")).cast("bigint")


def _paired(hashes: str, step: int) -> Column:
    """Each element's hash together with that of the element ``step`` further on."""
    return F.transform(hashes, lambda x, i: F.xxhash64(x, F.get(F.col(hashes), i + step)))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every whole text.

    Each array used more than once is a column of its own projection: an
    expression captured by a lambda would be evaluated again for every element.
    """
    d = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("t"))
    d = d.select("doc_id", "t", words(F.col("t")).alias("w"),
                 F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    d = d.select(
        "doc_id",
        F.transform("w", lambda x: F.xxhash64(x)).alias("h1"),
        F.size("w").cast("bigint").alias("n_words"),
        F.length(F.array_join("w", "")).cast("bigint").alias("word_chars"),
        _kept_length(F.col("t"), r"[^#*$%&|<>]+").alias("n_symbols"),
        _kept_length(F.col("t"), r"[^A-Z]+").alias("n_upper"),
        _kept_length(F.col("t"), r"[^!]+").alias("n_exclaim"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size(F.filter("lines", lambda x: x.rlike(r"[.!?][\x20\x09-\x0D]*\z"))).cast("bigint").alias("n_ended_lines"))
    d = d.withColumn("n_distinct_words", F.size(F.array_distinct("h1")).cast("bigint"))
    # Hashes of 2, 4 and 8 words, each from two of the half length.
    for src, step, out in (("h1", 1, "h2"), ("h2", 2, "h4"), ("h4", 4, "h8")):
        d = d.withColumn(out, _paired(src, step)).drop(src)
    d = d.withColumn("win", F.slice("h8", 1, F.greatest(F.col("n_words") - (WINDOW - 1), F.lit(0)).cast("int"))).drop("h8")
    # Most texts repeat no window: only the others order theirs.
    d = d.withColumn("again", F.size(F.array_distinct("win")) < F.size("win"))
    d = d.withColumn("by_hash", F.when(F.col("again"), F.sort_array(F.transform(
        "win", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))).drop("win")


    def same(x: Column, i: Column) -> Column:
        return F.coalesce(F.get(F.col("by_hash"), i)["h"] == x["h"], F.lit(False))

    d = d.withColumn("at", F.when(F.col("again"), F.sort_array(F.transform(
        F.filter("by_hash", lambda x, i: same(x, i + 1) | same(x, i - 1)), lambda x: x["i"])))).drop("by_hash")
    covered = F.aggregate(
        "at", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda s, p: F.struct((s["n"] + F.least(F.lit(WINDOW), p + WINDOW - s["end"])).alias("n"), (p + WINDOW).alias("end")),
        lambda s: s["n"])
    d = d.withColumn("n_repeat_words", F.coalesce(F.when(F.col("again"), covered), F.lit(0)).cast("bigint"))
    return d.select("doc_id", *STATS)


def vote(name: str) -> Column:
    value, good, bad = RULES[name]
    return F.expr(f"case when ({value}) {good} then 1 when ({value}) {bad} then -1 else 0 end")


def _posterior(votes: Column, good: Column, right: Column) -> Column:
    """Probability of a good text from its votes: independent rules, abstentions say nothing."""
    logit = F.aggregate(F.zip_with(votes, right, lambda v, a: v * F.log(a / (1 - a))), F.log(good / (1 - good)),
                        lambda s, x: s + x)
    return 1 / (1 + F.exp(-logit))


def fit(voted: DataFrame, rules: int = len(RULES), steps: int = EM_STEPS) -> DataFrame:
    """One row (good, right): the share of good texts and each rule's accuracy.

    ``voted``: rows with an array ``votes``.  The patterns (at most 3 ** rules)
    are put in order before summing, so the fit does not depend on partitioning.
    """
    patterns = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("p"))
    low, high = RIGHT_RANGE

    def step(s: Column, _: Column) -> Column:
        q = F.transform("p", lambda x: F.struct(x["votes"].alias("v"), x["n"].cast("double").alias("n"),
                                                _posterior(x["votes"], s["good"], s["right"]).alias("q")))
        total = F.aggregate("p", F.lit(0.0), lambda a, x: a + x["n"])
        good = F.aggregate(q, F.lit(0.0), lambda a, x: a + x["n"] * x["q"]) / total

        def right_of(j: int) -> Column:
            agree = F.aggregate(q, F.lit(0.0), lambda a, x: a + F.when(x["v"][j] == 1, x["n"] * x["q"])
                                .when(x["v"][j] == -1, x["n"] * (1 - x["q"])).otherwise(0.0))
            cast = F.aggregate("p", F.lit(0.0), lambda a, x: a + x["n"] * F.abs(x["votes"][j]))
            return F.least(F.lit(high), F.greatest(F.lit(low), F.coalesce(agree / F.nullif(cast, F.lit(0.0)),
                                                                          F.lit(START_RIGHT))))
        return F.struct(F.least(F.lit(0.999), F.greatest(F.lit(0.001), good)).alias("good"),
                        F.array(*[right_of(j) for j in range(rules)]).alias("right"))

    start = F.struct(F.lit(START_GOOD).alias("good"), F.array(*[F.lit(START_RIGHT)] * rules).alias("right"))
    return patterns.select(F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step).alias("m")).select("m.good", "m.right")


def rate_documents(docs: DataFrame) -> DataFrame:
    """Statistics, votes, posterior, ``base_failed`` and ``kept`` of every document."""
    stats = statistics(docs)
    voted = materialize(stats.withColumn("votes", F.array(*[vote(r) for r in RULES])), "rule-votes")
    model = fit(voted)
    good = model.select("good").scalar()
    right = model.select("right").scalar()
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rated = voted.withColumn("m_good", good).withColumn("m_right", right)
    rated = rated.withColumn("posterior", _posterior(F.col("votes"), F.col("m_good"), F.col("m_right")))
    return rated.drop("m_good", "m_right").withColumn("base_failed", failed).withColumn(
        "kept", ~failed & (F.col("posterior") >= KEEP_AT))


def rules_digest(docs: DataFrame) -> DataFrame:
    return rate_documents(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                       "base_failed", "kept")


def _oracle() -> str:
    names = list(RULES)
    votes = ",\n".join(f"CASE WHEN ({v}) {g} THEN 1 WHEN ({v}) {b} THEN -1 ELSE 0 END AS v{j}"
                       for j, (v, g, b) in enumerate(RULES.values()))
    cols = ", ".join(f"v{j}" for j in range(len(names)))
    logit = " + ".join(["ln(good / (1 - good))"] + [f"v{j} * ln(r{j} / (1 - r{j}))" for j in range(len(names))])
    low, high = RIGHT_RANGE
    steps = [f"m0 AS (SELECT {START_GOOD}::DOUBLE AS good, " + ", ".join(
        f"{START_RIGHT}::DOUBLE AS r{j}" for j in range(len(names))) + ")"]
    for k in range(1, EM_STEPS + 1):
        rights = ", ".join(
            f"least({high}, greatest({low}, coalesce(sum(CASE v{j} WHEN 1 THEN n * q WHEN -1 THEN n * (1 - q) ELSE 0 END)"
            f" / nullif(sum(n * abs(v{j})), 0), {START_RIGHT}))) AS r{j}" for j in range(len(names)))
        steps.append(f"q{k} AS MATERIALIZED (SELECT pat.*, 1 / (1 + exp(-({logit}))) AS q FROM pat, m{k - 1})")
        steps.append(f"m{k} AS MATERIALIZED (SELECT least(0.999, greatest(0.001, sum(n * q) / sum(n))) AS good, {rights} FROM q{k})")
    return rf"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
pos AS (SELECT rid, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM base WHERE len(w) >= {WINDOW}),
win AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, array_to_string(w[i:i + {WINDOW - 1}], ' ')) AS n FROM pos),
again AS (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM win WHERE n > 1),
rep AS (SELECT rid, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW})))::BIGINT AS n FROM again GROUP BY rid),
stats AS MATERIALIZED (
  SELECT base.rid, doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         length(regexp_replace(t, '[^A-Z]+', '', 'g'))::BIGINT AS n_upper,
         length(regexp_replace(t, '[^!]+', '', 'g'))::BIGINT AS n_exclaim,
         len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '[.!?][\x20\x09-\x0D]*$')))::BIGINT AS n_ended_lines,
         len(list_distinct(w))::BIGINT AS n_distinct_words, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM base LEFT JOIN rep ON base.rid = rep.rid),
voted AS MATERIALIZED (SELECT *, {votes} FROM stats),
pat AS MATERIALIZED (SELECT {cols}, count(*)::DOUBLE AS n FROM voted GROUP BY {cols}),
{(',' + chr(10)).join(steps)},
judged AS (
  SELECT voted.*, 1 / (1 + exp(-({logit}))) AS posterior,
         n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM voted, m{EM_STEPS})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND posterior >= {KEEP_AT} AS kept
FROM judged
"""


ORACLE_RULES = _oracle()